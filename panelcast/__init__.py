"""panelcast: forecast-lifecycle operators for quarterly panels, written as lazy Spark DataFrames."""

__version__ = "0.1.0"
