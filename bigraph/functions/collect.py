"""Helpers for collecting a group into rows of bounded size.

A stripe (all followers of one word) or an adjacency list (all out-links of
one node) is one group.  A single hot key may hold a large share of all rows,
so such groups are cut into parts of about ``max_entries`` entries: the part
of an entry comes from a hash of the entry, and the number of parts of a
group from its size.  The union of the parts of a key is the whole group; no
entry is dropped.

The hash is the first 32 bits of MD5 of the entry's text, which any SQL engine
can recompute, so the split is reproducible outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ENTRIES = 100_000
MAX_HOT_KEYS = 1_000_000   # rows of a broadcast table of hot keys (some 50 MB)
SALTS = 1 << 20            # spread of a hot key's rows over the tasks of a join


def n_parts(group_size: Column, max_entries: int) -> Column:
    """Number of parts for a group of ``group_size`` entries (at least 1)."""
    return F.greatest(F.lit(1), F.ceil(group_size / F.lit(max_entries))).cast("int")


def part_of(entry: Column, parts: Column) -> Column:
    """Part index in ``[0, parts)`` of an entry, stable across engines."""
    h = F.conv(F.substring(F.md5(entry.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, parts.cast("bigint")).cast("int")


def sorted_entries_text(m: Column) -> Column:
    """A map rendered as ``k:v,k:v`` in key order (for comparing results)."""
    entries = F.sort_array(F.map_entries(m))      # no entry is NULL: array_sort's order, without its lambda
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))),
        ",")


def sorted_list_text(a: Column) -> Column:
    """An array rendered as its sorted elements joined by ``,``."""
    return F.array_join(F.transform(F.array_sort(a), lambda x: x.cast("string")), ",")


def hot_keys(sizes: DataFrame, size: str, key: str, max_entries: int, max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """The largest keys of a size table with more than ``max_entries`` entries,
    at most ``max_keys`` of them, hinted for broadcast.

    The bound holds by construction, whatever the data and the session's
    thresholds.  A key that is passed over has no more entries than each of
    the ``max_keys`` larger ones, so under ``rows / max_keys``.
    """
    return F.broadcast(sizes.where(F.col(size) > max_entries)
                       .orderBy(F.desc(size), F.asc(key)).limit(max_keys))


def with_group_totals(rows: DataFrame, totals: DataFrame, key: str, entry: str, size: str, max_entries: int,
                      max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """``rows`` with the columns of its key's row in ``totals`` (``key``,
    ``size`` and more; at most one row per key), NULLs where there is none.

    An equi-join on the key that no hot key can overload: the largest keys
    (:func:`hot_keys`) take their totals from the broadcast table, and their
    rows enter the join with a salt from ``entry`` that no total has, so they
    spread over its tasks.  Every other key, also one with more than
    ``max_entries`` entries that the bound passes over, meets its total in the
    join; the result does not depend on ``max_keys``.
    """
    values = [c for c in totals.columns if c != key]
    hot = hot_keys(totals, size, key, max_entries, max_keys).select(key, *[F.col(c).alias(f"_hot_{c}") for c in values])
    salt = F.when(F.col(f"_hot_{size}").isNull(), F.lit(0)).otherwise(
        1 + F.pmod(F.xxhash64(entry), F.lit(SALTS))).cast("int")
    # Always 0, but not a literal: Spark would take a constant out of the join's
    # keys and shuffle on ``key`` alone.
    zero = F.when(F.col(size) < 0, F.lit(-1)).otherwise(F.lit(0))
    plain = totals.select(key, zero.alias("_salt"), *[F.col(c).alias(f"_plain_{c}") for c in values])
    return (rows.join(hot, key, "left").withColumn("_salt", salt).join(plain, [key, "_salt"], "left")
            .select(*rows.columns, *[F.coalesce(f"_hot_{c}", f"_plain_{c}").alias(c) for c in values]))
