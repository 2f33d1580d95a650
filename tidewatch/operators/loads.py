"""Which load came twice, when rows have no key: order-free fingerprints of the rows of each load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRINT = ["n_rows", "_a", "_b", "_c", "_d"]


def fingerprints(rows: DataFrame, load: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(load, keys, fingerprint): row count and sums of the halves of two hashes of `columns` over the rows of a load.

    Sums do not depend on the order, and unlike a set or an exclusive or they tell one copy of a row from two. They are
    combined before the shuffle, so a load of any size moves one row per task and key.
    """
    hashes = [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]
    low = F.lit(0xFFFFFFFF)
    halves = [half for h in hashes for half in (h.bitwiseAND(low), F.shiftrightunsigned(h, 32))]
    return rows.groupBy(load, *keys).agg(F.count("*").alias("n_rows"), *[F.sum(h).alias(n) for h, n in zip(halves, PRINT[1:])])


def repeated_loads(rows: DataFrame, load: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, load, repeats, n_rows): loads that hold exactly the rows of an earlier load for a key, and that load.

    Loads are ordered by `load`. A key has one row per load after `fingerprints`, so its group is as small as the number
    of loads.
    """
    same = fingerprints(rows, load, keys, columns).groupBy(*keys, *PRINT).agg(F.array_sort(F.collect_set(load)).alias("_loads"))
    later = F.explode(F.slice("_loads", 2, F.size("_loads"))).alias(load)
    return same.filter(F.size("_loads") > 1).select(*keys, later, F.element_at("_loads", 1).alias("repeats"), "n_rows")
