"""Settings of the forecast lifecycle.

Everything here is either a column name of the panel contract or a threshold that decides a result,
so the values are kept together and plain. ``load_config`` overlays a YAML file on the defaults.
"""

from __future__ import annotations

import copy
from typing import Any

# --- fixed values: column names of the panel -------------------------------------------------------
KEY_COLUMNS = ["MARKET_SEGMENT", "SCENARIO"]
BRAND_KEY_COLUMNS = ["MARKET_SEGMENT", "BRAND", "SCENARIO"]

SELECT_COLUMNS = [
    "QUARTER",
    "QUARTER_PARSED",
    "MARKET_SEGMENT",
    "SCENARIO",
    "VERIFICATION_HORIZON",
    "PREDICTION_HORIZON",
    "BB",
    "BILLING_MOVING_AVERAGE_2Q",
    "BILLING_MOVING_AVERAGE_3Q",
    "BILLING_MOVING_AVERAGE_4Q",
    "BILLING_MOVING_AVERAGE_5Q",
    "BB_VERSION",
    "MOF_VERSION",
    "BB_VERSION_LATEST",
    "MOF_VERSION_LATEST",
    "MOF_0_MONTH",
    "MOF_PLUS_BUFFER_0_MONTH",
    "SELLIN_0_MONTH",
    "SR_0_MONTH",
    "SELLIN_MINUS3_MONTH",
    "MOF_MINUS3_MONTH",
    "SR_MINUS3_MONTH",
    "MOF_PLUS_BUFFER_MINUS3_MONTH",
]

SIGNAL_COLUMNS = ["MOF_0_MONTH", "MOF_PLUS_BUFFER_0_MONTH", "SELLIN_0_MONTH", "SR_0_MONTH"]

DEMAND_SIGNALS = ["MOF", "MOF_PLUS_BUFFER", "SELLIN", "SR"]

DEMAND_SIGNAL_RENAMES = {
    "BB": "BILLING",
    "MOF_0_MONTH": "MOF",
    "MOF_PLUS_BUFFER_0_MONTH": "MOF_PLUS_BUFFER",
    "SELLIN_0_MONTH": "SELLIN",
    "SR_0_MONTH": "SR",
}

REGRESSOR_COLUMNS = [
    "SELLIN_MINUS3_MONTH",
    "MOF_PLUS_BUFFER_MINUS3_MONTH",
    "SR_MINUS3_MONTH",
    "BILLING_MOVING_AVERAGE_2Q",
    "BILLING_MOVING_AVERAGE_3Q",
    "BILLING_MOVING_AVERAGE_4Q",
    "BILLING_MOVING_AVERAGE_5Q",
]

MOVING_AVERAGE_WINDOWS = [2, 3, 4, 5]

# --- fixed values: defaults and thresholds ---------------------------------------------------------
DEFAULTS: dict[str, Any] = {
    "general": {
        "PREFERRED_MODEL": "PROPHET",
        "USED_REGRESSORS": {
            "SELLIN_MINUS3_MONTH": 1.0,
            "MOF_PLUS_BUFFER_MINUS3_MONTH": 0.1,
            "SR_MINUS3_MONTH": 1.0,
            "BILLING_MOVING_AVERAGE_2Q": 1.0,
            "BILLING_MOVING_AVERAGE_3Q": 1.0,
            "BILLING_MOVING_AVERAGE_4Q": 1.0,
            "BILLING_MOVING_AVERAGE_5Q": 1.0,
        },
        "models": ["prophet", "xgboost", "lightgbm", "catboost", "seasonalnaive", "nhits", "rnn", "autolstm"],
        "grid_search": {"prophet": True, "xgboost": False, "lightgbm": True, "catboost": True},
    },
    "segments": {},
    "EXCLUDE_SELLIN_PROPHET": ["MOBILE", "AIB", "EMBEDDED"],
    "EXCLUDE_SELLIN_XGBOOST": ["AIB", "EMBEDDED"],
    "FEATURE_SELECTION": {
        "N_FEATURES_GENERAL": 5,
        "N_FEATURES_EXTENDED": 6,
        "EXTENDED_SEGMENTS": ["MOBILE", "AIB", "EMBEDDED"],
    },
    "QUALITY_GATES": {"MAX_CHAMPION_MAPE": 200.0, "MIN_CHAMPION_MAPE": 1.0},
    "PREDICTION_SANITY_CHECKS": {
        "EXTREME_APE_THRESHOLD": 500.0,
        "FLAT_MIN_UNIQUE_VALUES": 2,
        "MIN_DIRECTIONAL_CORRECTNESS": 0.25,
        "MAX_VALIDATION_DISTANCE": 3.0,
    },
    "EVALUATION": {"horizon_range": [1, 6], "BACKTEST": {"stability_penalty": 0.5}},
    "MONITORING": {
        "BACKTEST_ACTUALS": {"N_PREVIOUS_VERSIONS": 3, "MAPE_RATIO_ALERT_THRESHOLD": 2.0},
        "STALENESS": {"MAX_MODEL_AGE_DAYS": 30},
    },
    "INTERPRETABILITY": {"TOP_N_FEATURES": 10, "TOP_N_PARTITIONS": 5},
    "DATA_QUALITY": {"NEGATIVE_THRESHOLD": 0.2, "MIN_TRAIN_PERIODS": 6, "NULL_RATE_LIMIT": 0.1},
    "ADJUST_THRESHOLD": 0.1,
    "NONZERO_ONLY_SEGMENT": "GAMING",
    "SEASON_LENGTH": 4,
    "FOURIER": {"period_days": 91.3125, "order": 5},
    "RIDGE_ALPHA": 1.0,
}


def _overlay(base: dict, extra: dict) -> dict:
    out = dict(base)
    for key, value in extra.items():
        if isinstance(value, dict) and isinstance(out.get(key), dict):
            out[key] = _overlay(out[key], value)
        else:
            out[key] = value
    return out


def load_config(path: str | None = None, overrides: dict | None = None) -> dict[str, Any]:
    """Defaults, then the YAML file at ``path``, then ``overrides``."""
    config = copy.deepcopy(DEFAULTS)
    if path is not None:
        import yaml

        with open(path, encoding="utf-8") as handle:
            config = _overlay(config, yaml.safe_load(handle) or {})
    return _overlay(config, overrides or {})


def segment_settings(config: dict, segment: str) -> dict[str, Any]:
    """Settings of one segment: its own entry where present, ``general`` for everything else."""
    return _overlay(config["general"], config.get("segments", {}).get(segment) or {})
