"""Spark operators for time-stamped sensor observations with weather and calendar context."""

from kerbline.errors import DataError

__all__ = ["DataError"]
