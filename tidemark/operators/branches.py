"""Branches over a change log: zero-copy fork, isolated writes, merge, conflicts.

``refs`` is the catalog: one row per branch and one per merge (metadata, not data). Creating a branch copies nothing. Every
log row carries the ``ref`` it was written on; commit ids grow over all refs. Reading a branch = the rows of all its
ancestors up to the commits at which they were forked, plus the branch's own rows, folded with nearer refs ranked
above farther ones (``_depth``), so a branch write always shadows its base regardless of event time. The chain of
one branch, a row per ancestor, is broadcast.

What a ref has taken in, by forks and by merges, is a commit per ref (``included``): the common history of two refs is the
least of both, and what one has beyond the other is all that a merge brings, also from a branch of a branch and after
earlier merges in either direction. A merge re-emits the source's state of those keys on the target with ``merge_commit`` set
and is remembered in the catalog. On the target its rows outrank every row of an earlier commit and give way to every
later one: a row's rank is its own merge, or the last merge before its commit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.fold import latest_state

MERGED = "merge_commit"
#: The bound of a ref's own rows: none.
HEAD = 2**63 - 1

#: A branch: what it was forked from, and at which commit. A merge (``kind``): ``name`` is the target, ``base_ref`` the source, ``base_commit`` the merge's commit.
REFS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("base_ref", T.StringType(), True),
    T.StructField("base_commit", T.LongType(), True),
    T.StructField("created_at_ms", T.LongType(), True),
    T.StructField("kind", T.StringType(), False),
])


def _refs(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    out = spark.createDataFrame(rows, REFS_SCHEMA)
    out._catalog = [Row(*REFS_SCHEMA.names)(*r) for r in rows]  # so that a chain of operations needn't ask for them again
    return out


def new_refs(spark: SparkSession, main: str = "main") -> DataFrame:
    return _refs(spark, [(main, None, None, None, "branch")])


def _catalog(refs: DataFrame) -> list[Row]:
    """All rows of the catalog: one per branch and merge."""
    return vars(refs).get("_catalog") or refs.collect()


def _add(refs: DataFrame, *row) -> DataFrame:
    return _refs(refs.sparkSession, [*map(tuple, _catalog(refs)), row])


def create_branch(refs: DataFrame, name: str, from_ref: str, at_commit: int, created_at_ms: int | None = None) -> DataFrame:
    """``CALL create_branch(name, from_ref)``: one metadata row, no data copied."""
    known = {r["name"] for r in _catalog(refs) if r["kind"] == "branch"}
    if name in known or from_ref not in known:
        raise ValueError(f"branch {name!r} exists already, or there is no {from_ref!r}")
    return _add(refs, name, from_ref, at_commit, created_at_ms, "branch")


def write_ref(changes: DataFrame, name: str, *, ref_col: str = "ref") -> DataFrame:
    """Changes as rows written on ``name``; append them to the log."""
    return changes.withColumn(ref_col, F.lit(name))


def ancestors(refs: DataFrame, name: str) -> list[tuple[str, int, int | None]]:
    """(ref, depth, last visible commit) of a branch and all it was forked from, nearest first with the highest depth."""
    of = {r["name"]: r for r in _catalog(refs) if r["kind"] == "branch"}
    chain: list[tuple[str, int | None]] = []
    upto = None
    while name is not None:
        row = of.get(name)
        if row is None or name in [c[0] for c in chain]:
            raise ValueError(f"no branch {name!r}, or one that is its own ancestor")
        chain.append((name, upto))
        bound = row["base_commit"]
        upto = bound if upto is None else upto if bound is None else min(upto, bound)
        name = row["base_ref"]
    return [(ref, len(chain) - 1 - k, bound) for k, (ref, bound) in enumerate(chain)]


def included(refs: DataFrame, name: str) -> dict[str, int]:
    """The last commit of every ref's own rows that ``name`` has taken in, by forks and merges; ``HEAD`` for its own."""
    rows = _catalog(refs)
    forks = {r["name"]: r for r in rows if r["kind"] == "branch"}
    if name not in forks:
        raise ValueError(f"no branch {name!r}")
    found: dict[str, int] = {}
    todo = [(name, HEAD)]
    while todo:
        ref, upto = todo.pop()
        if found.get(ref, -1) >= upto:
            continue
        found[ref] = upto
        base = forks[ref]
        if base["base_ref"] is not None:
            todo.append((base["base_ref"], min(upto, base["base_commit"])))
        todo += [(r["base_ref"], r["base_commit"]) for r in rows if r["kind"] == "merge" and r["name"] == ref and r["base_commit"] <= upto]
    return found


def merge_base(refs: DataFrame, a: str, b: str) -> dict[str, int]:
    """The common history of two refs: the last commit of each ref that both have taken in."""
    x, y = included(refs, a), included(refs, b)
    return {ref: min(x[ref], y[ref]) for ref in x.keys() & y.keys()}


def _visible(log: DataFrame, refs: DataFrame, name: str, commit: str, ref_col: str) -> DataFrame:
    """Rows visible on ``name`` in ONE pass over the log: its chain of refs (one row per ancestor, with
    the commits of the merges into it, broadcast) inner-joined on ``ref``."""
    into: dict[str, list[int]] = {}
    for r in _catalog(refs):
        if r["kind"] == "merge":
            into.setdefault(r["name"], []).append(r["base_commit"])
    chain = [(ref, depth, upto, sorted(into.get(ref, []))) for ref, depth, upto in ancestors(refs, name)]
    vis = F.broadcast(refs.sparkSession.createDataFrame(chain, "_vref string, _depth int, _upto long, _merges array<long>"))
    return (log.join(vis, F.col(ref_col) == F.col("_vref"), "inner")
            .filter(F.col("_upto").isNull() | (F.col(commit) <= F.col("_upto")))
            .drop("_vref", "_upto"))


def _fold_ref(rows: DataFrame, key: str, commit: str, order: Sequence[str], keep_deletes: bool) -> DataFrame:
    before = F.array_max(F.filter("_merges", lambda m: m < F.col(commit)))
    own = F.col(MERGED) if MERGED in rows.columns else F.lit(None)
    # A merge's rows stand between all rows before it and all after it.
    ranked = rows.withColumn("_merge", F.coalesce(own.cast("long") * 2, before * 2 + 1, F.lit(-1))).drop("_merges")
    return latest_state(ranked, key, ("_depth", "_merge", *order), keep_deletes=keep_deletes).drop("_depth", "_merge", MERGED)


def read_ref(log: DataFrame, refs: DataFrame, name: str, key: str, *, commit: str = "batch_id",
             ref_col: str = "ref", order: Sequence[str] = ("ts_ms", "pos"), keep_deletes: bool = False) -> DataFrame:
    """State of table on branch ``name`` (``SET SESSION ref = name``); the catalog knows the merges into it and its ancestors."""
    return _fold_ref(_visible(log, refs, name, commit, ref_col), key, commit, order, keep_deletes)


def changed_keys(log: DataFrame, refs: DataFrame, name: str, key: str, other: str, *,
                 commit: str = "batch_id", ref_col: str = "ref") -> DataFrame:
    """Keys of the changes that ``name`` has taken in and ``other`` hasn't, with their number. Rows that a merge
    re-emitted aren't counted again: the changes they stand for are."""
    mine, theirs = included(refs, name), included(refs, other)
    beyond = [(ref, theirs.get(ref, -HEAD), upto) for ref, upto in mine.items() if upto > theirs.get(ref, -HEAD)]
    bounds = F.broadcast(refs.sparkSession.createDataFrame(beyond, "_bref string, _after long, _upto long"))
    own = log.filter(F.col(MERGED).isNull()) if MERGED in log.columns else log
    return (own.join(bounds, (F.col(ref_col) == F.col("_bref")) & (F.col(commit) > F.col("_after")) & (F.col(commit) <= F.col("_upto")), "inner")
            .groupBy(key).agg(F.count(F.lit(1)).alias("n_changes")))


def conflicts(log: DataFrame, refs: DataFrame, source: str, target: str, key: str, *,
              commit: str = "batch_id", ref_col: str = "ref") -> DataFrame:
    """Keys changed on both refs since their common history (inner join of the key sets)."""
    a = changed_keys(log, refs, source, key, target, commit=commit, ref_col=ref_col).withColumnRenamed("n_changes", "source_changes")
    b = changed_keys(log, refs, target, key, source, commit=commit, ref_col=ref_col).withColumnRenamed("n_changes", "target_changes")
    return a.join(b, key, "inner")


def net_changes(log: DataFrame, refs: DataFrame, source: str, target: str, key: str, *, commit: str = "batch_id",
                ref_col: str = "ref", order: Sequence[str] = ("ts_ms", "pos")) -> DataFrame:
    """The source's state (deletes included) of every key that it changed since its common history with the target."""
    keys = changed_keys(log, refs, source, key, target, commit=commit, ref_col=ref_col).select(key)
    rows = _visible(log, refs, source, commit, ref_col).join(keys, key, "left_semi")
    return _fold_ref(rows, key, commit, order, keep_deletes=True)


def merge_branch(log: DataFrame, refs: DataFrame, source: str, target: str, key: str, merge_commit: int, *,
                 policy: str = "fail", created_at_ms: int | None = None, commit: str = "batch_id", ref_col: str = "ref",
                 order: Sequence[str] = ("ts_ms", "pos")) -> tuple[DataFrame, DataFrame]:
    """``CALL merge_branch(source, target)``: the log and the catalog after the merge, to read, write and merge on.

    ``merge_commit`` is later than all commits so far. ``policy``: ``fail`` raises when keys changed on both sides since
    their common history (one small distributed check), ``source_wins`` applies the source's net change on top,
    ``target_wins`` keeps conflicting keys as they are on the target.
    """
    how = {"commit": commit, "ref_col": ref_col}
    at = F.lit(merge_commit).cast("long")
    incoming = net_changes(log, refs, source, target, key, order=order, **how).withColumn(ref_col, F.lit(target)).withColumn(commit, at).withColumn(MERGED, at)
    if policy in ("fail", "target_wins"):
        c = conflicts(log, refs, source, target, key, **how).select(key)
        if policy == "fail":
            if not c.isEmpty():
                raise ValueError(f"merge {source} -> {target}: keys changed on both refs since their common history")
        else:
            incoming = incoming.join(c, key, "left_anti")
    elif policy != "source_wins":
        raise ValueError("policy must be 'fail', 'source_wins' or 'target_wins'")
    base = log if MERGED in log.columns else log.withColumn(MERGED, F.lit(None).cast("long"))
    return base.unionByName(incoming), _add(refs, target, source, merge_commit, created_at_ms, "merge")


def branches(refs: DataFrame, log: DataFrame, *, commit: str = "batch_id", ref_col: str = "ref") -> DataFrame:
    """``SELECT * FROM $branches``: branches with their head commit and own change count."""
    heads = log.groupBy(F.col(ref_col).alias("name")).agg(F.max(commit).alias("own_head_commit"),
                                                          F.count(F.lit(1)).alias("own_changes"))
    return (refs.filter("kind = 'branch'").join(heads, "name", "left")
            .withColumn("head_commit", F.coalesce(F.col("own_head_commit"), F.col("base_commit")))
            .withColumn("own_changes", F.coalesce(F.col("own_changes"), F.lit(0)))
            .select("name", "base_ref", "base_commit", "head_commit", "own_changes"))


def merges(refs: DataFrame) -> DataFrame:
    """The merges that the catalog remembers: source, target, merge_commit, and when."""
    return refs.filter("kind = 'merge'").select(F.col("base_ref").alias("source"), F.col("name").alias("target"), F.col("base_commit").alias(MERGED), "created_at_ms")
