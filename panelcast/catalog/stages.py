"""Stage frames the registered queries start from: panel, cleaned panel, forecasts, scores, champions.

What the lifecycle stores between its steps is a stage table here (see ``session.staged``): panel,
forecasts, scores, evaluation metrics, predictions. Everything else is lazy. The ``build_*`` functions
give the plan of a stage itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.config import BRAND_KEY_COLUMNS, REGRESSOR_COLUMNS
from panelcast.functions.quarters import origin_quarter
from panelcast.operators import clean as C
from panelcast.operators import horizon as H
from panelcast.operators import models as M
from panelcast.operators import windows as X
from panelcast.session import staged
from panelcast.sources.panel import SNAPSHOTS, horizon_panel
from panelcast.sources.tables import version_number, with_partition

LATEST = min(SNAPSHOTS, key=SNAPSHOTS.get)  # the snapshot that knows the newest complete quarter
SERIES = ["VERSION", "PARTITION_COLUMN"]

# fixed values: load times of the three snapshots and the clock of the monitoring queries
LOAD_TIMES = {"V_1": "2000-07-01 00:00:00", "V_2": "2001-01-01 00:00:00", "V_3": "2001-07-01 00:00:00"}
NOW = "2001-07-25 12:00:00"
DATA_TABLE = "horizon_panel"


def build_panel_all(spark: SparkSession, d: str) -> DataFrame:
    """Every snapshot, including rows whose version label has no number."""
    return with_partition(horizon_panel(spark, d), BRAND_KEY_COLUMNS)


def panel_all(spark: SparkSession, d: str) -> DataFrame:
    return staged(spark, "panel", d, lambda: build_panel_all(spark, d), "VERSION")


def panel(spark: SparkSession, d: str) -> DataFrame:
    """The newest snapshot; only its folder is read."""
    return panel_all(spark, d).filter(F.col("VERSION") == LATEST)


def cleaned(rows: DataFrame) -> DataFrame:
    """Numbered snapshots with the target filled forward."""
    rows = rows.filter(version_number("VERSION").isNotNull())
    return C.ffill_target(rows, SERIES).withColumn("ORIGIN_QUARTER", origin_quarter("MOF_VERSION"))


def clean_all(spark: SparkSession, d: str) -> DataFrame:
    return cleaned(panel_all(spark, d))


def clean(spark: SparkSession, d: str) -> DataFrame:
    return clean_all(spark, d).filter(F.col("VERSION") == LATEST)


def split_panel(spark: SparkSession, d: str) -> DataFrame:
    """The newest cleaned snapshot with train, validation and test rows."""
    return X.split_train_val_test(clean(spark, d), ["PARTITION_COLUMN"])


def forecast_rows(rows: DataFrame) -> DataFrame:
    """Three closed-form forecasts and a fitted one per row; ``BILLING`` is what was really observed."""
    every = M.naive_forecasts(M.ridge_forecasts(rows, SERIES, REGRESSOR_COLUMNS), SERIES, rivals=["RIDGE"])
    return C.standard_renames(every.drop("BB").withColumnRenamed("BB_RAW", "BB"))


def build_forecasts(spark: SparkSession, d: str) -> DataFrame:
    """Forecasts of the newest snapshot as one lazy plan."""
    return forecast_rows(cleaned(build_panel_all(spark, d).filter(F.col("VERSION") == LATEST)))


def forecasts_all(spark: SparkSession, d: str) -> DataFrame:
    return staged(spark, "forecasts", d, lambda: forecast_rows(clean_all(spark, d)), "VERSION")


def forecasts(spark: SparkSession, d: str) -> DataFrame:
    return forecasts_all(spark, d).filter(F.col("VERSION") == LATEST)


def horizon_scores_all(spark: SparkSession, d: str) -> DataFrame:
    return staged(spark, "scores", d, lambda: build_scores(spark, d), "VERSION")


def build_scores(spark: SparkSession, d: str) -> DataFrame:
    """Per snapshot, partition and model: Q1..Q6 errors and their mean."""
    return H.horizon_mape_wide(forecasts_all(spark, d), ["VERSION", "MARKET_SEGMENT", "PARTITION_COLUMN", "MODEL_USED"])


def champions_all(spark: SparkSession, d: str) -> DataFrame:
    """The model with the lowest horizon error per snapshot and partition."""
    return H.select_champion(
        horizon_scores_all(spark, d), SERIES, score="HORIZON_MAPE", fallbacks=(), metric="HORIZON_MAPE"
    ).select("VERSION", "MARKET_SEGMENT", "PARTITION_COLUMN", "MODEL_USED", "HORIZON_MAPE")


def load_time(version: str = "VERSION"):
    out = F.lit(None).cast("timestamp_ntz")
    for v, ts in LOAD_TIMES.items():
        out = F.when(F.col(version) == v, F.lit(ts).cast("timestamp_ntz")).otherwise(out)
    return out


def predictions_label(version: str = "VERSION"):
    return F.concat(F.lit("V_"), F.date_format(load_time(version), "yyyyMMdd_HHmmss"))


def predictions_all(spark: SparkSession, d: str) -> DataFrame:
    return staged(spark, "predictions", d, lambda: build_predictions(spark, d), "PREDICTIONS_VERSION")


def build_predictions(spark: SparkSession, d: str) -> DataFrame:
    """What each snapshot published: the champion's forecasts with their error and load time."""
    best = champions_all(spark, d).select(*SERIES, "MODEL_USED")
    rows = forecasts_all(spark, d).join(best, [*SERIES, "MODEL_USED"])
    return rows.withColumns(
        {"APE": H.ape("BILLING", "BILLING_PREDICTED"), "PREDICTIONS_VERSION": predictions_label(), "LOAD_TS": load_time()}
    )


def window_metrics(spark: SparkSession, d: str) -> DataFrame:
    return staged(spark, "eval_metrics", d, lambda: build_window_metrics(spark, d))


def build_window_metrics(spark: SparkSession, d: str, n_windows: int = 3) -> DataFrame:
    """Evaluation rows of the newest snapshot, one per partition, model and backtest window."""
    windows = X.backtest_windows(panel(spark, d), n_windows)
    return H.evaluate_windows(forecasts(spark, d), windows, ["MARKET_SEGMENT", "PARTITION_COLUMN", "MODEL_USED"])


def backtest_scores(spark: SparkSession, d: str) -> DataFrame:
    return H.backtest_aggregate(window_metrics(spark, d), ["MARKET_SEGMENT", "PARTITION_COLUMN", "MODEL_USED"])


def champions(spark: SparkSession, d: str) -> DataFrame:
    return H.select_champion(backtest_scores(spark, d))


def model_results(spark: SparkSession, d: str) -> DataFrame:
    """One training result per snapshot, partition and model, with the run it came from."""
    scores = horizon_scores_all(spark, d)
    best = champions_all(spark, d).select(*SERIES, "MODEL_USED").withColumn("_won", F.lit(True))
    return (
        scores.join(best, [*SERIES, "MODEL_USED"], "left")
        .withColumns(
            {
                "LOAD_TS": load_time(),
                "run_id": F.concat(F.lit("run_"), F.lower("VERSION")),
                "DATA_TABLE": F.lit(DATA_TABLE),
                "is_champion": F.col("_won").isNotNull(),
                "error": F.when(F.col("HORIZON_MAPE").isNull(), "Insufficient training data: no scored quarter"),
            }
        )
        .withColumnRenamed("HORIZON_MAPE", "mape")
        .drop("_won", *[f"Q{h}_MAPE" for h in H.HORIZONS])
    )
