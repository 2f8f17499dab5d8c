"""Daily price panels on Spark: summaries, forecasts, anomalies and streams."""

from marketloom.plans.batch import detect_anomalies, run_batch
from marketloom.sources.panel import load_csv

__all__ = ["detect_anomalies", "load_csv", "run_batch"]
