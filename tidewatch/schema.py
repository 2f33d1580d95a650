"""Column names and schemas shared by every module."""

from pyspark.sql import types as T

SERIES = ["store_id", "product_id"]
RUN_KEY = [*SERIES, "batch_number"]

PANEL = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("y", T.DoubleType()),
    ]
)

# Names of the logged fields, in the order a record is written.
SCORES = ["rmse", "mae", "mape", "r2", "erreur_moyenne", "erreur_std"]
BOOKKEEPING = ["data_points", "training_period_days", "has_concept_drift"]
MODEL_METRICS = [*SCORES, *BOOKKEEPING, "batch_number", "execution_number"]
GLOBAL_METRICS = [
    "rmse_global", "mae_global", "r2_global",
    "rmse_std", "mae_std", "r2_std",
    "nombre_modeles", "modeles_avec_derive",
]
TAGS = ["Product_ID", "Store_ID", "batch_number", "execution_number", "Type", "mlflow.runName"]
GLOBAL_TYPE = "Global_Metrics"

# Training window sizes in rows, without and with drift.
LONG_WINDOW = 365
SHORT_WINDOW = 180
