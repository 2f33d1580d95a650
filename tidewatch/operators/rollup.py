"""Roll-ups of model records: per batch, and over products and stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.scoring import run_id


def _measures(sample_std: bool) -> list[Column]:
    """Plain means of the per-model scores (not pooled errors), their spread, and the counts."""
    std = F.stddev_samp if sample_std else F.stddev_pop
    return [
        *[F.avg(m).alias(f"{m}_global") for m in ("rmse", "mae", "r2")],
        *[std(m).alias(f"{m}_std") for m in ("rmse", "mae", "r2")],
        F.count("*").alias("nombre_modeles"),
        F.count_if("has_concept_drift").alias("modeles_avec_derive"),
    ]


def batch_rollup(runs: DataFrame, sample_std: bool = False) -> DataFrame:
    """One record per batch, complete or not.

    Its time is the last record it closes; a mean skips the models whose score is missing.
    """
    rolled = runs.groupBy("batch_number").agg(
        F.max("execution_number").alias("execution_number"),
        F.max("logged_at").alias("logged_at"),
        *_measures(sample_std),
    )
    key = run_id(
        F.lit("global"),
        F.col("batch_number").cast("string"),
        F.coalesce(F.col("execution_number").cast("string"), F.lit("")),
    )
    return rolled.select(key.alias("run_id"), "*")


def dimension_rollup(runs: DataFrame, sample_std: bool = False) -> DataFrame:
    """The same measures by product, by store and in total, with the level in `level`."""
    grouped = runs.groupingSets(
        [("product_id",), ("store_id",), ()], "product_id", "store_id"
    ).agg(F.grouping_id("product_id", "store_id").alias("_gid"), *_measures(sample_std))
    level = (
        F.when(F.col("_gid") == 1, F.lit("product"))
        .when(F.col("_gid") == 2, F.lit("store"))
        .otherwise(F.lit("total"))
    )
    return grouped.select(
        level.alias("level"), "product_id", "store_id",
        "rmse_global", "mae_global", "r2_global", "rmse_std", "mae_std", "r2_std",
        "nombre_modeles", "modeles_avec_derive",
    )


def audit_rollups(runs: DataFrame, rollups: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Stored roll-ups next to what their members give: counts, flags and the mean rmse.

    `agrees` is NULL-safe: a value lost on either side is not held against the other, but a roll-up without
    members, or members without a roll-up, do not agree.
    """
    found = runs.groupBy("batch_number", "execution_number").agg(
        F.count("*").alias("members"),
        F.count_if("has_concept_drift").alias("members_in_drift"),
        F.count("rmse").alias("_scored"),
        F.avg("rmse").alias("mean_rmse"),
    )
    f, r = found.alias("f"), rollups.alias("r")
    match = (F.col("f.batch_number") == F.col("r.batch_number")) & F.col(
        "f.execution_number"
    ).eqNullSafe(F.col("r.execution_number"))
    # A mean can only be compared where every member still has its score.
    whole = F.col("_scored") == F.col("members")
    distance = F.abs(F.col("mean_rmse") - F.col("r.rmse_global"))
    agrees = (
        F.coalesce(F.col("members") == F.col("r.nombre_modeles"), F.col("members").isNotNull())
        & F.coalesce(F.col("members_in_drift") == F.col("r.modeles_avec_derive"), F.lit(True))
        & F.coalesce(~whole | (distance <= tolerance * F.greatest(F.lit(1.0), F.col("mean_rmse"))), F.lit(True))
    )
    return f.join(r, match, "full").select(
        F.coalesce("f.batch_number", "r.batch_number").alias("batch_number"),
        F.coalesce("f.execution_number", "r.execution_number").alias("execution_number"),
        "members",
        F.col("r.nombre_modeles").alias("reported"),
        "members_in_drift",
        F.col("r.modeles_avec_derive").alias("reported_in_drift"),
        F.coalesce(agrees & F.col("r.run_id").isNotNull(), F.lit(False)).alias("agrees"),
    )


#: Scores of a record that roll-ups average.
ROLLED = ("rmse", "mae", "r2")


def batch_moments(runs: DataFrame) -> DataFrame:
    """What a roll-up can be revised from: models, flags and, of each score, its count, mean and squared deviation."""
    parts = [F.count("*").alias("models"), F.count_if("has_concept_drift").alias("flagged")]
    for m in ROLLED:
        parts += [F.count(m).alias(f"n_{m}"), F.avg(m).alias(f"mean_{m}"), (F.var_pop(m) * F.count(m)).alias(f"m2_{m}")]
    return runs.groupBy("batch_number").agg(*parts)


def revise(moments: DataFrame, taken_out: DataFrame, put_in: DataFrame) -> DataFrame:
    """Moments after some records are taken out and others put in, without reading those that stay.

    Changes are summed as deviations from the mean before, or from that of the new records where there was none, so nothing
    large cancels. A batch that lost all its records has counts of 0. Both sides of the join have one row per batch, and the
    changed records are combined before they move.
    """
    signed = taken_out.withColumn("_sign", F.lit(-1)).unionByName(put_in.withColumn("_sign", F.lit(1)))
    fresh = put_in.groupBy("batch_number").agg(*[F.avg(m).alias(f"_f_{m}") for m in ROLLED])
    known = moments.select("batch_number", *[f"mean_{m}" for m in ROLLED]).join(fresh, "batch_number", "full")
    centres = known.select("batch_number", *[F.coalesce(f"mean_{m}", f"_f_{m}", F.lit(0.0)).alias(f"_c_{m}") for m in ROLLED])
    s = F.col("_sign")
    sums = [F.sum(s).alias("_models"), F.sum(F.when(F.col("has_concept_drift"), s).otherwise(0)).alias("_flagged")]
    for m in ROLLED:
        gap = F.col(m) - F.col(f"_c_{m}")
        sums += [
            F.max(f"_c_{m}").alias(f"_c_{m}"),
            F.coalesce(F.sum(F.when(F.col(m).isNotNull(), s)), F.lit(0)).alias(f"_n_{m}"),
            F.coalesce(F.sum(gap * s), F.lit(0.0)).alias(f"_s_{m}"),
            F.coalesce(F.sum(gap * gap * s), F.lit(0.0)).alias(f"_q_{m}"),
        ]
    changed = signed.join(centres, "batch_number", "left").groupBy("batch_number").agg(*sums)
    both = moments.join(changed, "batch_number", "full")
    plus = lambda name: (F.coalesce(name, F.lit(0)) + F.coalesce(f"_{name}", F.lit(0))).alias(name)
    out = [plus("models"), plus("flagged")]
    for m in ROLLED:
        n = F.coalesce(f"n_{m}", F.lit(0)) + F.coalesce(f"_n_{m}", F.lit(0))
        step = F.coalesce(f"_s_{m}", F.lit(0.0)) / F.nullif(n, F.lit(0))  # of the mean
        spread = F.coalesce(f"m2_{m}", F.lit(0.0)) + F.coalesce(f"_q_{m}", F.lit(0.0)) - n * step * step
        out += [
            plus(f"n_{m}"),
            F.when(n > 0, F.coalesce(f"mean_{m}", f"_c_{m}") + step).alias(f"mean_{m}"),
            F.when(n > 0, F.greatest(spread, F.lit(0.0))).alias(f"m2_{m}"),
        ]
    return both.select("batch_number", *out)


def measures_of(moments: DataFrame) -> DataFrame:
    """The measures of `batch_rollup` from moments; batches without a record are left out."""
    std = lambda m: F.sqrt(F.col(f"m2_{m}") / F.nullif(F.col(f"n_{m}"), F.lit(0)))
    return moments.filter("models > 0").select(
        "batch_number",
        *[F.col(f"mean_{m}").alias(f"{m}_global") for m in ROLLED],
        *[std(m).alias(f"{m}_std") for m in ROLLED],
        F.col("models").alias("nombre_modeles"),
        F.col("flagged").alias("modeles_avec_derive"),
    )
