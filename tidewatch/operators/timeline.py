"""Operators over the order of log times, without a window over all rows.

The order of a log is global: there may be no key to partition by, and one hour may hold a third of
all rows. Three steps keep every task bounded:

* rows are first reduced to distinct times (or to one row per stretch of the pause), with counts and extremes
  combined before the shuffle;
* what is left is put in order of (keys, time) and cut into ranges of about equal numbers of rows, wherever on the
  clock they lie (`in_ranges`); windows run inside a range;
* what crosses from range to range is carried on a table with one row per range and key in it: each range is added up
  on its own, and a window over that small table gives every range what comes before or after it.

Results do not depend on how the ranges are cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.sources.tables import stage


def in_ranges(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """`df` with `_range`: the number of a stretch of the order (keys, order); stretches are about equal in rows.

    The order must tell rows apart, or equal ones fall into one range. The table is written once: boundaries come from a
    sample, so a second evaluation might cut elsewhere.
    """
    cut = df.repartitionByRange(*keys, order).withColumn("_range", F.spark_partition_id())
    return stage(cut, "ranges")


def _carried(df: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join what is carried to the rows of each range; a null key meets a null key. The carry is one row per range and key."""
    both = ["_range", *keys]
    other = carry.select(*[F.col(c).alias(f"_c{c}") if c in both else F.col(c) for c in carry.columns])
    match = [F.col(c).eqNullSafe(F.col(f"_c{c}")) for c in both]
    return df.join(other, match, "left").drop(*[f"_c{c}" for c in both])


def next_mark(points: DataFrame, marks: DataFrame, ts: str, mark_id: str, keys: Sequence[str] = ()) -> DataFrame:
    """Forward as-of join: the first mark at or after each point, as <mark_id> and mark_<ts>.

    Several marks at one time count as the one with the smallest id. Points after the last mark, without a time or with
    a null key, get NULL.
    """
    keys = list(keys)
    # Distinct times of either side: both are reduced first and already lie in the same partitions.
    reduced = points.filter(F.col(ts).isNotNull()).select(*keys, ts).distinct()
    marked = marks.filter(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(F.min(mark_id).alias("_id"))
    times = in_ranges(reduced.join(marked, [*keys, ts], "full"), keys, ts)
    found = F.when(F.col("_id").isNotNull(), F.struct(F.col(ts).alias("t"), F.col("_id").alias("id")))
    inside = Window.partitionBy("_range", *keys).orderBy(F.col(ts).desc())
    within = times.select(*keys, ts, "_range", F.last(found, ignorenulls=True).over(inside).alias("_in"))
    later = Window.partitionBy(*keys).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        times.groupBy("_range", *keys)
        .agg(F.min(found).alias("_first"))
        .select("_range", *keys, F.last("_first", ignorenulls=True).over(later).alias("_carry"))
    )
    answer = _carried(within, carry, keys).select(*keys, ts, F.coalesce("_in", "_carry").alias("_mark"))
    return points.join(answer, [*keys, ts], "left").select(
        *points.columns, F.col("_mark.id").alias(mark_id), F.col("_mark.t").alias(f"mark_{ts}")
    )


def idle_groups(df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str] = ()) -> DataFrame:
    """Executions: maximal groups of rows with no pause longer than `gap_seconds`, one row each.

    Two rows of one stretch of that length are always in the same execution, so the extremes of the stretches are all
    that is needed to find the pauses.
    """
    groups = _stretches_with_group(df, ts, gap_seconds, keys)
    return groups.groupBy(*keys, "execution").agg(
        F.min("_lo").alias("started_at"), F.max("_hi").alias("ended_at"), F.sum("_n").alias("n_runs")
    )


def assign_idle_groups(
    df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Every row with the number of its execution, by a join on the stretch; NULL for rows without a time."""
    keys = list(keys)
    groups = _stretches_with_group(df, ts, gap_seconds, keys).select(
        *[F.col(c).alias(f"_g{c}") for c in keys], F.col("_stretch").alias("_gs"), "execution"
    )
    match = [F.col(c).eqNullSafe(F.col(f"_g{c}")) for c in keys]
    return (
        df.withColumn("_stretch", _stretch(F.col(ts), gap_seconds))
        .join(groups, [*match, F.col("_stretch") == F.col("_gs")], "left")
        .select(*df.columns, "execution")
    )


def _stretch(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / (seconds * 1_000_000))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _with_before(ranged: DataFrame, order: str, last: str, keys: Sequence[str]) -> DataFrame:
    """Rows of `in_ranges` with `_before`: the value of `last` in the row before, across the borders of ranges."""
    inside = Window.partitionBy("_range", *keys).orderBy(order)
    earlier = Window.partitionBy(*keys).orderBy("_range")
    ends = (
        ranged.groupBy("_range", *keys)
        .agg(F.max(F.col(last)).alias("_end"))
        .select("_range", *keys, F.lag("_end").over(earlier).alias("_carry"))
    )
    own = ranged.withColumn("_own", F.lag(last).over(inside))
    return _carried(own, ends, keys).withColumn("_before", F.coalesce("_own", "_carry")).drop("_own", "_carry")


def _stretches_with_group(df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str]) -> DataFrame:
    """(keys, _stretch, _lo, _hi, _n, execution): executions are counted in each range and the counts carried on."""
    stretches = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, _stretch(F.col(ts), gap_seconds).alias("_stretch"))
        .agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.count("*").alias("_n"))
    )
    linked = _with_before(in_ranges(stretches, keys, "_stretch"), "_stretch", "_hi", keys)
    pause = _micros(F.col("_lo")) - _micros(F.col("_before"))
    fresh = linked.withColumn("_new", F.coalesce(pause > gap_seconds * 1_000_000, F.lit(True)).cast("int"))
    inside = Window.partitionBy("_range", *keys).orderBy("_stretch")
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        fresh.groupBy("_range", *keys)
        .agg(F.sum("_new").alias("_count"))
        .select("_range", *keys, F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_ahead"))
    )
    numbered = fresh.withColumn("_place", F.sum("_new").over(inside))
    return _carried(numbered, counts, keys).select(
        *keys, "_stretch", "_lo", "_hi", "_n", (F.col("_ahead") + F.col("_place")).alias("execution")
    )


def seconds_between(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Seconds since the previous log time, one row per distinct time: (keys, ts, n_runs, seconds).

    Runs logged at the same instant share a row. The first time of a key has NULL seconds.
    """
    keys = list(keys)
    times = df.filter(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(F.count("*").alias("n_runs"))
    linked = _with_before(in_ranges(times, keys, ts), ts, ts, keys)
    gap = (_micros(F.col(ts)) - _micros(F.col("_before"))) / 1e6
    return linked.select(*keys, ts, "n_runs", gap.alias("seconds"))
