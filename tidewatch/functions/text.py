"""Parsing of the text fields of a run record."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four shapes of a run name are <Model>_P001_S001, the same with _#n, and the
# roll-up name with and without _#n.
MODEL_NAME = r"^[A-Za-z]+_(P\d+)_(S\d+)(?:_#(\d+))?$"
GLOBAL_NAME = r"^Global_Metrics(?:_#(\d+))?$"


def parse_run_name(name: Column) -> Column:
    """Struct (kind, product_id, store_id, n); kind is NULL for an unknown shape."""
    is_model = name.rlike(MODEL_NAME)
    is_global = name.rlike(GLOBAL_NAME)
    number = F.when(is_model, F.regexp_extract(name, MODEL_NAME, 3)).when(
        is_global, F.regexp_extract(name, GLOBAL_NAME, 1)
    )
    return F.struct(
        F.when(is_model, F.lit("model")).when(is_global, F.lit("global")).alias("kind"),
        F.when(is_model, F.regexp_extract(name, MODEL_NAME, 1)).alias("product_id"),
        F.when(is_model, F.regexp_extract(name, MODEL_NAME, 2)).alias("store_id"),
        F.nullif(number, F.lit("")).cast("int").alias("n"),
    )


def parse_metric_line(line: Column) -> Column:
    """Struct (ts, value, step) of 'epoch_ms value step'; NULL fields where the text is malformed."""
    part = F.split(F.trim(line), r"\s+")
    return F.struct(
        F.timestamp_millis(part.getItem(0).try_cast("bigint")).alias("ts"),
        F.get(part, F.lit(1)).try_cast("double").alias("value"),
        F.get(part, F.lit(2)).try_cast("bigint").alias("step"),
    )
