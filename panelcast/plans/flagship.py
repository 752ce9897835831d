"""The shortest complete run: panel to champion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.catalog import stages as S
from panelcast.operators import horizon as H


def champion_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the newest snapshot, forecast three ways from each origin, score per horizon, pick the best."""
    scores = H.horizon_mape_wide(S.build_forecasts(spark, sf_dir), ["MARKET_SEGMENT", "PARTITION_COLUMN", "MODEL_USED"])
    best = H.select_champion(scores, score="HORIZON_MAPE", fallbacks=(), metric="HORIZON_MAPE")
    return best.select("MARKET_SEGMENT", "PARTITION_COLUMN", "MODEL_USED", "HORIZON_MAPE", *[f"Q{h}_MAPE" for h in H.HORIZONS])
