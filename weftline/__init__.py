"""Time joins, windows and extrema over timestamped series, as Spark DataFrame plans."""

from weftline.series import Series

__all__ = ["Series"]
