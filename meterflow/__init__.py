"""Interval time series analytics as composable Spark DataFrame operators."""

from meterflow.spec import Layout, SeriesSpec

__all__ = ["Layout", "SeriesSpec"]
