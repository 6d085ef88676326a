"""Timed-segment and text analytics, written Spark-first."""
