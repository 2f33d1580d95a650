"""Distributions of batches that can be added up: histograms with a two-sample test, and stored quantile sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.schema import RUN_KEY, SERIES


def batch_histograms(panel: DataFrame, lo: float, hi: float, bins: int) -> DataFrame:
    """(series, batch, n, histogram): counts of y in `bins` equal steps, with one place before and one after for the rest.

    Two histograms of the same steps add up to that of both batches. Rows without y are left out.
    """
    place = F.width_bucket("y", F.lit(lo), F.lit(hi), F.lit(bins))
    counts = [F.count_if(F.col("_place") == b) for b in range(bins + 2)]
    known = panel.filter(F.col("y").isNotNull()).select(*RUN_KEY, place.alias("_place"))
    return known.groupBy(*RUN_KEY).agg(F.count("*").alias("n"), F.array(*counts).alias("histogram"))


def _total(histograms: Column) -> Column:
    """The sum of an array of histograms, place by place."""
    return F.aggregate(
        F.slice(histograms, 2, F.size(histograms)),
        F.try_element_at(histograms, F.lit(1)),
        lambda total, h: F.zip_with(total, h, lambda a, b: a + b),
    )


def _distance(a: Column, b: Column, n: Column, m: Column) -> Column:
    """The largest gap between two cumulative distributions."""
    start = F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), F.lit(0.0).alias("most"))

    def step(seen: Column, pair: Column) -> Column:
        one, two = seen["a"] + pair["0"], seen["b"] + pair["1"]
        return F.struct(one.alias("a"), two.alias("b"), F.greatest(seen["most"], F.abs(one / n - two / m)).alias("most"))

    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("0"), y.alias("1")))
    return F.aggregate(pairs, start, step, lambda seen: seen["most"])


def distribution_drift(histograms: DataFrame, reference_batches: int = 3, critical: float = 1.358) -> DataFrame:
    """(series, batch, distance, has_concept_drift): two-sample Kolmogorov-Smirnov test of each batch against those before.

    The reference is the merged histogram of up to `reference_batches` batch numbers before. Drift is a distance above
    critical * sqrt((n + m) / (n * m)); 1.358 is the bound of the 5 % level. It sees a change of spread with equal means,
    which a test of means does not. Fewer than two rows on a side are no drift. One row per series and batch is shuffled.
    """
    before = Window.partitionBy(*SERIES).orderBy("batch_number").rangeBetween(-reference_batches, -1)
    sides = histograms.select(
        *RUN_KEY, "n", "histogram", F.sum("n").over(before).alias("_m"), _total(F.collect_list("histogram").over(before)).alias("_before")
    )
    n, m = F.col("n"), F.col("_m")
    enough = (n >= 2) & (m >= 2)
    distance = F.when(enough, _distance(F.col("histogram"), F.col("_before"), n, m))
    bound = critical * F.sqrt((n + m) / (n * m))
    measured = sides.select(*RUN_KEY, distance.alias("distance"), bound.alias("_bound"))
    flag = F.coalesce(F.col("distance") > F.col("_bound"), F.lit(False))
    return measured.select(*RUN_KEY, "distance", flag.alias("has_concept_drift"))


def sketches(df: DataFrame, keys: Sequence[str], values: Sequence[str], k: int = 400) -> DataFrame:
    """(keys, n, <value>_sketch): a mergeable quantile sketch of every value per key, to be stored with the records.

    A sketch is a few kilobytes however many rows it has seen; it is built in every task and merged before the shuffle
    ends. Null and NaN are left out.
    """
    known = lambda v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double"))
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(known(v), k).alias(f"{v}_sketch") for v in values])


def sketched_quantiles(stored: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """(keys, probability, quantile) from stored sketches merged over all other keys; no value is read again."""
    merged = stored.groupBy(*keys).agg(F.kll_merge_agg_double(f"{value}_sketch").alias("_sketch"))
    at = [
        F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))).alias("quantile"))
        for p in probabilities
    ]
    return merged.select(*keys, F.explode(F.array(*at)).alias("_q")).select(*keys, "_q.probability", "_q.quantile")
