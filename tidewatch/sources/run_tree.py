"""Reader of a tree of run records: <root>/<run_id>/{tags,metrics}/<key>, one small file per key.

The tree is meant to be read once and written as Parquet (`write_runs`); everything downstream works on
the two tables that `model_table` and `global_table` return.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.text import parse_metric_line, parse_run_name
from tidewatch.schema import GLOBAL_METRICS, GLOBAL_TYPE, MODEL_METRICS, SCORES, TAGS

PATH = r"([0-9a-f]{32})/(tags|metrics)/([^/]+)$"

NAME_TAG = "mlflow.runName"  # fixed value: the tag that holds the name of a run


def scan_runs(
    spark: SparkSession,
    root: str,
    tags: Iterable[str] = TAGS,
    metrics: Iterable[str] = tuple(dict.fromkeys([*MODEL_METRICS, *GLOBAL_METRICS])),
) -> DataFrame:
    """(run_id, kind, key, text) of the wanted keys, one row per file.

    The key is part of the path, so a glob per key keeps unwanted files from being opened. Small files are
    packed into tasks by size.
    """
    wanted = f"{{{','.join([*(f'tags/{k}' for k in tags), *(f'metrics/{k}' for k in metrics)])}}}"
    files = spark.read.text(f"{root.rstrip('/')}/*/{wanted}", wholetext=True)
    return records_of(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def records_of(files: DataFrame) -> DataFrame:
    """(run_id, kind, key, text) of files given as (path, text); paths that belong to no run are left out."""
    found = files.select(
        *[F.regexp_extract("path", PATH, k).alias(name) for k, name in enumerate(("run_id", "kind", "key"), 1)],
        F.rtrim(F.col("text"), F.lit("\n")).alias("text"),
    )
    return found.filter("run_id <> ''")


def parse_metric(long: DataFrame) -> DataFrame:
    """Metric points as (run_id, key, ts, value, step), one row per line of a metric file."""
    return (
        long.filter(F.col("kind") == "metrics")
        .select("run_id", "key", F.explode(F.split("text", "\n")).alias("_line"))
        .select("run_id", "key", parse_metric_line(F.col("_line")).alias("_p"))
        .select("run_id", "key", "_p.ts", "_p.value", "_p.step")
    )


def latest_points(points: DataFrame) -> DataFrame:
    """The newest point of each metric, by step and then time."""
    return points.groupBy("run_id", "key").agg(
        F.max_by(F.struct("value", "ts", "step"), F.struct("step", "ts", "value")).alias("_p")
    ).select("run_id", "key", "_p.ts", "_p.value", "_p.step")


def to_wide(
    long: DataFrame,
    tags: list[str] = TAGS,
    metrics: list[str] = tuple(dict.fromkeys([*MODEL_METRICS, *GLOBAL_METRICS])),
) -> DataFrame:
    """One row per run: tag_<key> and metric_<key> columns, NULL for a missing key, and logged_at.

    One aggregation with fixed keys: no pass to discover columns. logged_at is the first point of a run,
    or NULL where no metric survived.
    """
    point = F.explode_outer(F.when(F.col("kind") == "metrics", F.split("text", "\n")))
    rows = long.select("run_id", "kind", "key", "text", point.alias("_line")).select(
        "*", parse_metric_line(F.col("_line")).alias("_p")
    )
    is_tag = F.col("kind") == "tags"
    is_metric = F.col("kind") == "metrics"
    newest = F.struct("_p.step", "_p.ts", "_p.value")
    return rows.groupBy("run_id").agg(
        F.min(F.when(is_metric, F.col("_p.ts"))).alias("logged_at"),
        *[F.max(F.when(is_tag & (F.col("key") == k), F.col("text"))).alias(f"tag_{_plain(k)}") for k in tags],
        *[
            F.max(F.when(is_metric & (F.col("key") == k), newest))["value"].alias(f"metric_{_plain(k)}")
            for k in metrics
        ],
    )


def _plain(key: str) -> str:
    return key.replace(".", "_")


def split_kinds(wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(model records, roll-up records)."""
    is_global = F.col("tag_Type") == GLOBAL_TYPE
    return wide.filter(F.col("tag_Type").isNull()), wide.filter(is_global)


def with_kind(wide: DataFrame) -> DataFrame:
    """Records with their kind, for counts over both in one pass; records of another type have none."""
    kind = F.when(F.col("tag_Type").isNull(), "model").when(F.col("tag_Type") == GLOBAL_TYPE, "global")
    return wide.withColumn("kind", kind).filter(F.col("kind").isNotNull())


def check_identity(wide: DataFrame) -> DataFrame:
    """Runs whose name and tags disagree, or whose name has no known shape; expected to be empty."""
    named = wide.withColumn("_n", parse_run_name(F.col(f"tag_{_plain(NAME_TAG)}")))
    number = F.coalesce(F.col("tag_batch_number"), F.col("tag_execution_number")).try_cast("int")
    is_model = F.col("tag_Type").isNull()
    agrees = (
        F.col("_n.kind").isNotNull()
        & ((F.col("_n.kind") == "model") == is_model)
        & F.col("_n.product_id").eqNullSafe(F.col("tag_Product_ID"))
        & F.col("_n.store_id").eqNullSafe(F.col("tag_Store_ID"))
        & (F.col("_n.n").isNull() | F.col("_n.n").eqNullSafe(number))
    )
    return named.filter(~F.coalesce(agrees, F.lit(False))).select(
        "run_id", F.col(f"tag_{_plain(NAME_TAG)}").alias("run_name"),
        F.col("tag_Product_ID").alias("product_id"), F.col("tag_Store_ID").alias("store_id"),
    )


def _number(tag: str) -> Column:
    return F.coalesce(
        F.col(f"tag_{tag}").try_cast("int"), F.col(f"metric_{tag}").cast("int")
    ).alias(tag)


def model_table(wide: DataFrame) -> DataFrame:
    """The typed table of model records. Lost values stay NULL."""
    models, _ = split_kinds(wide)
    return models.select(
        "run_id",
        F.col("tag_Store_ID").alias("store_id"),
        F.col("tag_Product_ID").alias("product_id"),
        _number("batch_number"),
        _number("execution_number"),
        "logged_at",
        *[F.col(f"metric_{m}").alias(m) for m in SCORES],
        F.col("metric_data_points").cast(T.LongType()).alias("data_points"),
        F.col("metric_training_period_days").cast("int").alias("training_period_days"),
        (F.col("metric_has_concept_drift") == 1.0).alias("has_concept_drift"),
    )


def global_table(wide: DataFrame) -> DataFrame:
    """The typed table of roll-up records."""
    _, rollups = split_kinds(wide)
    counts = ("nombre_modeles", "modeles_avec_derive")
    return rollups.select(
        "run_id",
        _number("batch_number"),
        _number("execution_number"),
        "logged_at",
        *[
            F.col(f"metric_{m}").cast("bigint" if m in counts else "double").alias(m)
            for m in GLOBAL_METRICS
        ],
    )


def to_long(records: DataFrame, name: Column, tags: dict[str, Column], metrics: list[str]) -> DataFrame:
    """Records as (run_id, kind, key, text) rows in the form of the tree; NULL values have no row."""
    stamp = F.unix_millis(F.col("logged_at")).cast("string")

    def row(kind: str, key: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), text.alias("text"))

    def line(metric: str) -> Column:
        value = F.col(metric).cast("double").cast("string")
        return F.concat(stamp, F.lit(" "), value, F.lit(" 0"))

    rows = [row("tags", NAME_TAG, name)]
    rows += [row("tags", key, text.cast("string")) for key, text in tags.items()]
    rows += [row("metrics", m, line(m)) for m in metrics]
    return (
        records.select("run_id", F.explode(F.array(*rows)).alias("_r"))
        .select("run_id", "_r.kind", "_r.key", "_r.text")
        .filter(F.col("text").isNotNull())
    )


def model_long(runs: DataFrame, model: str = "Model") -> DataFrame:
    """Model records in the form of the tree, named <model>_<product>_<store>_#<batch>."""
    name = F.concat_ws("_", F.lit(model), "product_id", "store_id")
    return to_long(
        runs,
        F.concat(name, F.lit("_#"), F.col("batch_number")),
        {
            "Product_ID": F.col("product_id"),
            "Store_ID": F.col("store_id"),
            "batch_number": F.col("batch_number"),
            "execution_number": F.col("execution_number"),
        },
        [*SCORES, "data_points", "training_period_days", "has_concept_drift", "batch_number"],
    )


def global_long(rollups: DataFrame) -> DataFrame:
    """Roll-up records in the form of the tree."""
    return to_long(
        rollups,
        F.concat(F.lit(f"{GLOBAL_TYPE}_#"), F.col("batch_number")),
        {"Type": F.lit(GLOBAL_TYPE), "batch_number": F.col("batch_number")},
        [*GLOBAL_METRICS, "batch_number"],
    )
