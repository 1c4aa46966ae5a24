"""Unsupervised anomaly detection on daily price-and-volume bars, as Spark DataFrame transforms."""
