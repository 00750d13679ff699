"""Scalar column functions (all built-in Spark expressions, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ms_from_ntz(ts: Column) -> Column:
    """Epoch milliseconds of a ``TIMESTAMP_NTZ`` (wall clock read as UTC),
    independent of the session time zone. Floors sub-millisecond parts."""
    us = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), ts)
    # Floor division made exact: the dividend is a multiple of 1000.
    return F.try_divide(us - F.pmod(us, F.lit(1000)), F.lit(1000)).cast("long")


def event_time(ms: Column) -> Column:
    """Epoch milliseconds -> ``TIMESTAMP_NTZ`` (UTC wall clock); NULL stays NULL."""
    return F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH_NTZ))


def minutes_before(now_ms: Column, minutes: int | Column) -> Column:
    """``now - n minutes`` on epoch milliseconds."""
    m = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return now_ms - m.cast("long") * F.lit(60_000)


def format_instant(ms: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Format an epoch-millisecond instant as a UTC string."""
    return F.date_format(event_time(ms), fmt)


def json_field(doc: Column, path: str, cast: str | None = None) -> Column:
    """One field of a JSON text without parsing the whole document."""
    v = F.get_json_object(doc, path)
    return v.try_cast(cast) if cast else v


def derive_email(name: Column, suffix: Column, domain: str = "example.com") -> Column:
    """``lower(replace(name, ' ', '.')) || '.' || suffix || '@' || domain``."""
    return F.concat(F.lower(F.replace(name, F.lit(" "), F.lit("."))), F.lit("."), suffix.cast("string"),
                    F.lit("@" + domain))


def phone_format(a: Column, b: Column, c: Column, d: Column, prefix: str = "+33-6") -> Column:
    """``<prefix>-aa-bb-cc-dd`` with two-digit groups."""
    return F.format_string(prefix + "-%02d-%02d-%02d-%02d", a, b, c, d)


def changed_columns(before: Column, after: Column) -> Column:
    """Sorted, comma-joined names of fields whose value differs NULL-safely
    between two string-map row images (a missing image counts as empty)."""
    b = F.coalesce(before, F.create_map().cast("map<string,string>"))
    a = F.coalesce(after, F.create_map().cast("map<string,string>"))
    keys = F.array_union(F.map_keys(b), F.map_keys(a))
    diff = F.filter(keys, lambda x: ~F.element_at(b, x).eqNullSafe(F.element_at(a, x)))
    return F.array_join(F.array_sort(diff), ",")
