"""Questions about the history of runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.timeline import next_mark
from tidewatch.schema import RUN_KEY, SERIES


def latest_runs(runs: DataFrame, keys: Sequence[str] = RUN_KEY) -> DataFrame:
    """The newest record of each key, by log time and then id. Older reruns are dropped before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(
        F.col("logged_at").desc_nulls_last(), F.col("run_id").desc()
    )
    return runs.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def close_runs(runs: DataFrame, rollups: DataFrame) -> DataFrame:
    """Each record with the roll-up that closes it, the next one in time: rollup_id, rollup_logged_at.

    A record without a batch takes the batch of its roll-up, and every record takes the execution number of
    its roll-up, so that a counter raised per record becomes one number per execution.
    """
    marks = rollups.select(
        "logged_at",
        F.struct(F.col("run_id").alias("id"), "batch_number", "execution_number").alias("_rollup"),
    )
    closed = next_mark(runs, marks, "logged_at", "_rollup")
    number = F.coalesce(F.col("_rollup.execution_number"), F.col("execution_number"))
    return closed.select(
        *[c for c in runs.columns if c not in ("batch_number", "execution_number")],
        F.coalesce("batch_number", "_rollup.batch_number").alias("batch_number"),
        number.alias("execution_number"),
        F.col("_rollup.id").alias("rollup_id"),
        F.col("mark_logged_at").alias("rollup_logged_at"),
    )


def compare_chains(left: DataFrame, right: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per (series, batch) of two chains: score deltas (right - left) and whether the flags agree.

    Both sides hold one record per key (`latest_runs`). Keys of one chain only appear with NULL deltas.
    """
    a, b = left.alias("a"), right.alias("b")
    key = [F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in RUN_KEY]
    match = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in RUN_KEY]
    return a.join(b, match, "full").select(
        *key,
        F.col("a.run_id").isNotNull().alias("in_left"),
        F.col("b.run_id").isNotNull().alias("in_right"),
        *[(F.col(f"b.{m}") - F.col(f"a.{m}")).alias(f"{m}_delta") for m in metrics],
        F.col("a.has_concept_drift").eqNullSafe(F.col("b.has_concept_drift")).alias("same_flag"),
    )


def score_change(runs: DataFrame, metric: str = "rmse") -> DataFrame:
    """Change of a score against the previous batch of the series; input holds one record per key."""
    order = Window.partitionBy(*SERIES).orderBy("batch_number")
    previous = F.lag(metric).over(order)
    return runs.select(
        *RUN_KEY,
        metric,
        F.lag("batch_number").over(order).alias("previous_batch"),
        (F.col(metric) - previous).alias("change"),
    )


def worst_series(runs: DataFrame, k: int, metric: str = "rmse") -> DataFrame:
    """The k series with the largest score of each batch; ties share a rank. Limited before the shuffle."""
    order = Window.partitionBy("batch_number").orderBy(F.col(metric).desc())
    return (
        runs.filter(F.col(metric).isNotNull())
        .select(*RUN_KEY, metric, F.rank().over(order).alias("rank"))
        .filter(F.col("rank") <= k)
    )


def product_ranking(runs: DataFrame, k: int, metric: str = "rmse") -> DataFrame:
    """The products with the k largest mean scores of each batch; limited before the shuffle like above."""
    order = Window.partitionBy("batch_number").orderBy(F.col("mean_score").desc())
    return (
        runs.groupBy("batch_number", "product_id")
        .agg(F.avg(metric).alias("mean_score"), F.count("*").alias("n_models"))
        .filter(F.col("mean_score").isNotNull())
        .withColumn("place", F.dense_rank().over(order))
        .filter(F.col("place") <= k)
    )


def flag_changes(runs: DataFrame, before: int, after: int) -> DataFrame:
    """Series flagged in both batches, only before, or only after, by set operations."""

    def flagged(n: int) -> DataFrame:
        return runs.filter((F.col("batch_number") == n) & F.col("has_concept_drift")).select(*SERIES)

    old, new = flagged(before), flagged(after)
    parts = [
        (old.intersect(new), "both"),
        (old.subtract(new), "only_before"),
        (new.subtract(old), "only_after"),
    ]
    labelled = [df.withColumn("change", F.lit(label)) for df, label in parts]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


def flag_transitions(runs: DataFrame) -> DataFrame:
    """How many series kept, gained or lost the flag from each batch to the next, all batches at once."""
    order = Window.partitionBy(*SERIES).orderBy("batch_number")
    was = F.lag("has_concept_drift").over(order)
    state = (
        F.when(F.col("_was") & F.col("has_concept_drift"), F.lit("both"))
        .when(F.col("_was"), F.lit("only_before"))
        .when(F.col("has_concept_drift"), F.lit("only_after"))
        .otherwise(F.lit("neither"))
    )
    return (
        runs.select("batch_number", "has_concept_drift", was.alias("_was"))
        .filter(F.col("_was").isNotNull() & F.col("has_concept_drift").isNotNull())
        .groupBy("batch_number", state.alias("change"))
        .agg(F.count("*").alias("n_series"))
    )


def coverage(runs: DataFrame, metrics: Sequence[str], by: Sequence[Column | str] = ()) -> DataFrame:
    """Share of records without each metric, per group."""
    return runs.groupBy(*by).agg(
        F.count("*").alias("n_runs"),
        *[(1.0 - F.count(m) / F.count("*")).alias(f"{m}_missing") for m in metrics],
    )


def period_label(ts: Column, periods: Sequence[tuple[str, str]]) -> Column:
    """Label of the period a log time falls in; `periods` holds (label, start), oldest first."""
    label = F.lit(None).cast("string")
    for name, start in periods:
        label = F.when(ts >= F.lit(start).cast("timestamp"), F.lit(name)).otherwise(label)
    return label


def histogram(runs: DataFrame, metric: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts of a score per batch in `bins` equal steps; 0 and bins + 1 hold what lies outside."""
    return (
        runs.filter(F.col(metric).isNotNull())
        .groupBy("batch_number", F.width_bucket(metric, F.lit(lo), F.lit(hi), F.lit(bins)).alias("bin"))
        .agg(F.count("*").alias("n_models"))
    )
