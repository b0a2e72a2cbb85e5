"""Snapshot-to-star operators for Spark: every operator is DataFrame in, DataFrame out."""
