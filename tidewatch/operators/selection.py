"""Exact quantiles by distributed selection.

Each wanted rank has a bracket: the smallest and largest value between which it must lie, with the number of rows below
and inside. In a round the rows inside a bracket are counted against a ladder of `STEPS` steps between its ends, and the
step that holds the rank is the next bracket, with the true smallest and largest value of that step as its ends. Steps are
equal in value in one round and equal in logarithm of the distance from the lower end in the next, so outliers cost a
round and not a hundred. The largest value of a bracket is always a step of its own, so every round leaves values out and
the rounds come to an end for any data. A bracket that holds few rows, or a single value however many rows have
it, is done; the few rows are then put in order. The rule is the same for keys of three rows and of a third of the table.

What is shuffled in a round is one row per task, bracket and step. Rows of the table move only if there are so many keys
that their brackets are no longer small enough to be sent to every task; AQE decides that and splits a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.sources.tables import stage

#: Steps of a ladder; with the smallest and largest value counted, a round keeps about one row in so many.
STEPS = 1024

#: The first logarithmic step is the 2^-60th part of a bracket.
DEPTH = 2.0**60


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    rows: int = 4096,
) -> DataFrame:
    """Exact quantiles per key with linear interpolation, as (keys, probability, quantile).

    Values count as doubles; null and NaN are left out, and a key with nothing else has no quantiles. A null key is a
    key. Infinite values sort at the ends; between two of them or next to one, the result is what doubles give. `rows`
    bounds the rows that are put in order per key and rank.
    """
    keys, p = list(keys), [float(x) for x in probabilities]
    if not keys:
        raise ValueError("quantiles needs at least one key column")
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    inner = [f"_k{i}" for i in range(len(keys))]
    v = F.col(value).cast("double")
    # Every round reads the same rows, so they are written once, keys and value only.
    known = stage(df.filter(v.isNotNull() & ~F.isnan(v)).select(*named, v.alias("_v")), "values")

    position = lambda x: F.lit(x) * (F.col("_total") - 1)
    ranks = F.array_distinct(F.array(*[f(position(x)).cast("bigint") for x in p for f in (F.floor, F.ceil)]))
    whole = known.groupBy(*inner).agg(F.count("*").alias("_total"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    totals = stage(whole, "totals")
    brackets = totals.select(
        *inner, F.explode(ranks).alias("_rank"), "_lo", "_hi", F.lit(0).cast("bigint").alias("_below"), F.col("_total").alias("_inside")
    )
    done = (F.col("_inside") <= rows) | (F.col("_lo") == F.col("_hi"))
    finished: list[DataFrame] = []
    for turn in range(10_000):
        brackets = stage(brackets, "brackets") if turn else brackets
        finished.append(brackets.filter(done))
        # A look at one row tells whether another round is needed.
        if not brackets.filter(~done).limit(1).count():
            break
        brackets = _narrowed(known, brackets.filter(~done), inner, logarithmic=turn % 2 == 1)

    found = _selected(known, _union(finished), inner)
    picked = found.groupBy(*inner).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))
    at = lambda f: F.element_at("_at", f(F.col("_position")).cast("bigint"))
    share = F.col("_position") - F.floor("_position")
    between = F.when(share == 0, at(F.floor)).otherwise(at(F.floor) + share * (at(F.ceil) - at(F.floor)))
    wanted = totals.select(
        *inner,
        F.explode(F.array(*[F.struct(F.lit(x).alias("p"), position(x).alias("at")) for x in p])).alias("_want"),
    ).select(*inner, F.col("_want.p").alias("probability"), F.col("_want.at").alias("_position"))
    return _keyed(wanted, picked, inner).select(
        *[F.col(i).alias(k) for i, k in zip(inner, keys)], "probability", between.alias("quantile")
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _keyed(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which a null key meets a null key; the keys of the left side stay."""
    other = right.select(*[F.col(k).alias(f"_r{k}") if k in keys else F.col(k) for k in right.columns])
    match = [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys]
    return left.join(other, match).drop(*[f"_r{k}" for k in keys])


def _inside(known: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """Each row once for every bracket of its key that it lies in: (keys, _v, _b).

    Ranks that share a bracket, as all do at first, share its rows. One array per key is joined.
    """
    per_key = brackets.groupBy(*keys).agg(F.collect_set(F.struct("_lo", "_hi")).alias("_all"))
    v = F.col("_v")
    hit = F.filter("_all", lambda b: (v >= b["_lo"]) & (v <= b["_hi"]))
    return _keyed(known, per_key, keys).select(*keys, "_v", F.explode(hit).alias("_b"))


#: What a bracket is told by, beside the keys.
ENDS = ["_from", "_to"]


def _of_ranks(brackets: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """What was found per bracket, for each rank in it."""
    ranks = brackets.select(*keys, "_rank", F.col("_below").alias("_under"), F.col("_lo").alias("_from"), F.col("_hi").alias("_to"))
    return _keyed(ranks, found, [*keys, *ENDS])


def _step(v: Column, lo: Column, hi: Column, logarithmic: bool) -> Column:
    """Step of a value in the ladder from lo to hi; it never falls as the value grows. `hi` itself has the last one."""
    # Halves keep the difference of two large values finite.
    along = F.try_divide(v * 0.5 - lo * 0.5, hi * 0.5 - lo * 0.5)
    if logarithmic:
        along = F.log1p(along * DEPTH) / F.log1p(F.lit(DEPTH))
    step = F.when(F.isnan(along), F.lit(0.0)).otherwise(F.coalesce(along, F.lit(0.0))) * (STEPS - 1)
    return F.when(v == hi, F.lit(STEPS)).otherwise(F.least(F.lit(STEPS - 1), F.floor(step).cast("int")))


def _ends() -> list[Column]:
    return [F.col("_b._lo").alias("_from"), F.col("_b._hi").alias("_to")]


def _narrowed(known: DataFrame, brackets: DataFrame, keys: list[str], logarithmic: bool) -> DataFrame:
    """The step of each bracket that holds its rank, as the new bracket."""
    step = _step(F.col("_v"), F.col("_b._lo"), F.col("_b._hi"), logarithmic)
    counted = (
        _inside(known, brackets, keys)
        .groupBy(*keys, *_ends(), step.alias("_step"))
        .agg(F.count("*").alias("_inside"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    )
    order = Window.partitionBy(*keys, *ENDS).orderBy("_step")
    summed = counted.withColumn("_upto", F.sum("_inside").over(order)).drop("_step")
    below = F.col("_under") + F.col("_upto") - F.col("_inside")
    return (
        _of_ranks(brackets, summed, keys)
        .withColumn("_below", below)
        .filter((F.col("_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_below") + F.col("_inside")))
        .select(*keys, "_rank", "_lo", "_hi", "_below", "_inside")
    )


def _selected(known: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _rank, _value): the value at each rank. Brackets of a single value need no rows."""
    single = brackets.filter(F.col("_lo") == F.col("_hi")).select(*keys, "_rank", F.col("_lo").alias("_value"))
    open_ones = brackets.filter(F.col("_lo") != F.col("_hi"))
    sorted_ones = (
        _inside(known, open_ones, keys).groupBy(*keys, *_ends()).agg(F.sort_array(F.collect_list("_v")).alias("_values"))
    )
    place = (F.col("_rank") - F.col("_under") + 1).cast("int")
    picked = _of_ranks(open_ones, sorted_ones, keys).select(*keys, "_rank", F.element_at("_values", place).alias("_value"))
    return single.unionByName(picked)
