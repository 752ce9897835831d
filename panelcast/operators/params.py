"""Configuration as small tables, joined to the segments that occur in the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.config import segment_settings

PARAM_SCHEMA = (
    "MARKET_SEGMENT string, preferred_model string, used_regressors map<string,double>, "
    "models array<string>, grid_search map<string,boolean>"
)


def params_table(spark: SparkSession, config: dict) -> DataFrame:
    """One row per configured segment plus the row ``general``; as small as the configuration file."""
    rows = []
    for name in ["general", *config.get("segments", {})]:
        s = segment_settings(config, name)
        regressors = {k: float(v) for k, v in s["USED_REGRESSORS"].items()}
        rows.append((name, s["PREFERRED_MODEL"], regressors, list(s["models"]), dict(s["grid_search"])))
    return spark.createDataFrame(rows, PARAM_SCHEMA)


def segment_params(df: DataFrame, params: DataFrame, segment: str = "MARKET_SEGMENT") -> DataFrame:
    """Attach each row's segment settings, those of ``general`` where the segment has none."""
    fields = [c for c in params.columns if c != segment]
    own = params.filter(F.col(segment) != "general").select(segment, *[F.col(c).alias(f"_own_{c}") for c in fields])
    # an aggregate has one row even if ``general`` is not configured, so no segment is lost
    general = params.filter(F.col(segment) == "general").agg(*[F.first(c).alias(f"_gen_{c}") for c in fields])
    return (
        df.join(F.broadcast(own), segment, "left")
        .crossJoin(F.broadcast(general))
        .withColumns({c: F.coalesce(F.col(f"_own_{c}"), F.col(f"_gen_{c}")) for c in fields})
        .drop(*[f"_own_{c}" for c in fields], *[f"_gen_{c}" for c in fields])
    )


def feature_count(segment, config: dict):
    """How many regressors a segment may keep."""
    rule = config["FEATURE_SELECTION"]
    extended = F.col(segment).isin(rule["EXTENDED_SEGMENTS"])
    return F.when(extended, rule["N_FEATURES_EXTENDED"]).otherwise(rule["N_FEATURES_GENERAL"])


def excluded_regressors(spark: SparkSession, segments: Sequence[str], regressor: str = "SELLIN_MINUS3_MONTH") -> DataFrame:
    return spark.createDataFrame([(s, regressor) for s in segments], "MARKET_SEGMENT string, regressor string")


def cross_partition_models(df: DataFrame, models: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    """Every row once per model; the model list is a handful of rows."""
    return df.crossJoin(F.broadcast(models))
