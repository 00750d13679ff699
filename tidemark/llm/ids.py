"""A bounded filter of ids, so that rows no decision names needn't be shuffled to learn that.

The filter is one bit per hash value, at most ``BITS`` in all and about ``SPARSE`` for each id, whatever the number of
ids; with very many ids it lets more rows through, and the join that follows stays exact. It is built and
asked by Spark's own bitmap functions: a scalar subquery holds it (4 MB at most), and no Python worker is needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

BITS = 1 << 25
#: Bits for each id, where there are fewer ids than ``BITS`` would hold so.
SPARSE = 256
#: Bits of one bitmap of Spark's.
MAP = 1 << 15


def maybe_in(ids: DataFrame, id_col: str) -> Callable[[str], Column]:
    """A function of a column's name: whether the value may be one of ``ids``; never false for one that is, false for null."""
    s = Scratch(ids.sparkSession, "ids")
    place = lambda c, n: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(n))
    bit = ids.where(F.col(id_col).isNotNull()).select(place(id_col, BITS).alias("b"))
    maps = s.save(bit.groupBy(F.expr(f"b div {MAP}").alias("m")).agg(F.bitmap_construct_agg(F.col("b") % MAP).alias("x")), "maps")  # at most BITS / MAP rows
    held = maps.agg(F.sum(F.bitmap_count("x"))).first()[0] or 0
    n = 1
    while n < BITS // MAP and n * MAP < SPARSE * held:
        n *= 2
    folded = maps.groupBy((F.col("m") % n).alias("m")).agg(F.bitmap_or_agg("x").alias("x"))
    array = (folded.agg(F.map_from_entries(F.collect_list(F.struct("m", "x"))).alias("of"))
             .select(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")), lambda m: F.try_element_at("of", m))).scalar())

    def test(c: str) -> Column:
        at = place(c, n * MAP)
        byte = F.substring(F.get(array, F.call_function("div", at, F.lit(MAP).cast("long")).cast("int")), F.floor(at % MAP / 8).cast("int") + 1, F.lit(1))
        found = F.call_function("bit_get", F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1
        return F.col(c).isNotNull() & F.coalesce(found, F.lit(False))

    return test


def without(rows: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """``rows`` without the ids in ``gone`` (one column of that name); rows with a null id stay."""
    maybe = maybe_in(gone, id_col)
    named = gone.select(F.col(id_col).alias("_gone")).distinct()
    rest = rows.where(maybe(id_col)).join(named, F.col(id_col) == F.col("_gone"), "left_anti")
    return rows.where(~maybe(id_col)).union(rest)


def one_of_equal(rows: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with one of several rows that are equal in all columns; rows with a null id stay."""
    again = rows.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("_n")).where("_n > 1").select(id_col)
    maybe = maybe_in(again, id_col)
    return rows.where(~maybe(id_col)).union(rows.where(maybe(id_col)).distinct())
