"""Sensor-event analytics on PySpark: reports, labels, a sleep classifier, and its scoring in batch and stream."""

from slumberline.rules import ModelParams, SleepRule

__all__ = ["ModelParams", "SleepRule"]
