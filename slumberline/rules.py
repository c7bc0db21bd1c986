"""The parameters every job shares, so that report, training and serving cannot drift apart."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SleepRule:
    """Which sensor is read and when a reading counts as "asleep".

    A reading is labelled 1.0 when it is strictly above ``threshold`` and its hour lies in the
    night window, which starts at ``night_start`` (included) and ends at ``night_end`` (excluded).
    """

    # Fixed values of the business rule.
    sensor_id: str = "P02"
    threshold: float = 500.0
    night_start: int = 22
    night_end: int = 7
    zone: str = "UTC"


@dataclass(frozen=True)
class ModelParams:
    """Settings of the logistic regression; the defaults are those of the served model."""

    reg_param: float = 0.3
    max_iter: int = 100
    elastic_net: float = 0.0
    tol: float = 1e-6
    threshold: float = 0.5


REPLAYED_SENSORS = ("P02", "M04")
SPLIT_WEIGHTS = (0.7, 0.3)
SPLIT_SEED = 42
EVERY_NTH = 100
PEEK_SIZE = 10
