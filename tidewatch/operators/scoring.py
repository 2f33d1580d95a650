"""Scores per model and the audits built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import scores as S
from tidewatch.schema import BOOKKEEPING, RUN_KEY


def run_id(*parts: str) -> Column:
    """32 hex digits from the key of a record, so that a rerun writes the same id."""
    return F.md5(F.concat_ws("|", *parts))


def score(predicted: DataFrame, keys: list[str] = RUN_KEY) -> DataFrame:
    """The six scores over the scored rows of each group. Rows without a prediction are not scored."""
    y = F.col("y")
    e = F.col("_e")
    return (
        predicted.filter("is_scored")
        .withColumn("_e", y - F.col("yhat"))
        .filter(F.col("_e").isNotNull())
        .groupBy(*keys)
        .agg(
            S.rmse(e).alias("rmse"),
            S.mae(e).alias("mae"),
            S.mape(y, e).alias("mape"),
            S.r2(y, e).alias("r2"),
            S.error_mean(e).alias("erreur_moyenne"),
            S.error_std(e).alias("erreur_std"),
            F.count("*").alias("n_scored"),
            F.max("day").alias("last_day"),
        )
    )


def model_records(predicted: DataFrame, execution: int | None = None) -> DataFrame:
    """One record per (series, batch): scores and bookkeeping.

    `logged_at` is the newest day the model has seen, so a replay of old batches gives the same records.
    """
    scored = score(predicted, [*RUN_KEY, *BOOKKEEPING])
    execution_number = F.lit(execution).cast("int")
    return scored.select(
        run_id(*RUN_KEY, F.coalesce(execution_number.cast("string"), F.lit(""))).alias("run_id"),
        *RUN_KEY,
        execution_number.alias("execution_number"),
        F.col("last_day").cast("timestamp").alias("logged_at"),
        "rmse", "mae", "mape", "r2", "erreur_moyenne", "erreur_std",
        *BOOKKEEPING,
    )


def audit_scores(runs: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Records that break an identity of the scores; expected to be empty.

    rmse^2 = erreur_moyenne^2 + erreur_std^2, rmse >= mae and rmse >= erreur_std. A missing score
    breaks nothing.
    """
    slack = tolerance * F.greatest(F.lit(1.0), F.col("rmse") * F.col("rmse"))
    gap = F.col("rmse") ** 2 - F.col("erreur_moyenne") ** 2 - F.col("erreur_std") ** 2
    broken = F.array_compact(
        F.array(
            F.when(F.abs(gap) > slack, F.lit("decomposition")),
            F.when(F.col("mae") - F.col("rmse") > slack, F.lit("rmse_below_mae")),
            F.when(F.col("erreur_std") - F.col("rmse") > slack, F.lit("rmse_below_std")),
        )
    )
    return runs.select(*RUN_KEY, F.explode(broken).alias("violation"))


def compare_implied_variance(runs: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Spread of the implied target variance between the reruns of one (series, batch, window).

    A ratio of 1 says that the reruns scored the same target; 4 is the mark of a doubled target. The
    reruns of a group are reduced to their extremes instead of being paired with each other.
    """
    implied = S.implied_variance(F.col("rmse"), F.col("r2"))
    return (
        runs.withColumn("_v", implied)
        .filter(F.col("_v").isNotNull())
        .groupBy(*RUN_KEY, "data_points")
        .agg(
            F.count("*").alias("n_runs"),
            F.min("_v").alias("min_variance"),
            F.max("_v").alias("max_variance"),
        )
        .withColumn("ratio", F.col("max_variance") / F.nullif(F.col("min_variance"), F.lit(0.0)))
        .withColumn("same_target", F.col("ratio") <= 1.0 + tolerance)
    )
