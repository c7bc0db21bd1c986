"""What the registered queries share: sensors, the settings of models, plain result types."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slumberline.operators import learning, sampling
from slumberline.plans.training import split_features
from slumberline.rules import ModelParams, SleepRule
from slumberline.sources.events import read_events_table
from slumberline.sources.schema import EVENT_ID

# ``click`` takes the place of the bed sensor, ``view`` of the second replayed one.
RULE = SleepRule(sensor_id="click", threshold=25.0)
REPLAYED = ("click", "view")
REGS = (0.3, 0.0)
# One micro-batch reads at most this many bytes, which bounds what a lost driver has to repeat.
STREAM_BATCH = 1 << 40
COEFFICIENTS = "reg double, intercept double, w_pressure double, w_hour double"

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame, digits: int | None = None, **more_digits: int) -> DataFrame:
    """Floats as doubles, integers as bigints; doubles rounded where ``digits`` says so."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            places = more_digits.get(field.name, digits)
            column = column.cast("double")
            column = column if places is None else F.round(column, places)
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_features(read_events_table(spark, sf_dir), RULE, key=[EVENT_ID], carry=[EVENT_ID])


def params_of(regs: Sequence[float] = REGS, tol: float = ModelParams.tol) -> list[ModelParams]:
    return [ModelParams(reg_param=reg, tol=tol) for reg in regs]


def serving_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return learning.fit_model(sampling.side(split_rows(spark, sf_dir), "train"), ModelParams(reg_param=0.0))
