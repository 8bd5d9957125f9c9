"""Interval-load analytics as Spark DataFrame operators."""

from kilospan.schema import HALF_HOURLY, HOURLY, Frequency
from kilospan.plans.series import Series

__all__ = ["Frequency", "HOURLY", "HALF_HOURLY", "Series"]
