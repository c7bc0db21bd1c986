"""Quality of scored rows or cells. All of it is exact, but for the binned area, which states its error.

Every function takes rows with ``label`` and ``prediction`` or ``margin``, a ``weight`` column where
a row stands for several, and ``by`` columns that tell models apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slumberline.operators.sampling import cut_points, range_of
from slumberline.session import materialize
from slumberline.sources.schema import LABEL

MARGINS_PER_RANGE = 1 << 20
BINS = 1000
# How much finer than its bins the sketch of quantiles is.
SKETCH = 20


def confusion_matrix(scored: DataFrame, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Count per observed (label, prediction)."""
    count = F.sum(weight) if weight else F.count(F.lit(1))
    return scored.groupBy(*by, LABEL, "prediction").agg(count.cast("bigint").alias("count"))


def classification_report(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 from a confusion matrix, for any number of classes.

    A class that is never predicted has precision 0; one without precision and recall has F1 0.
    """
    hits = F.when(F.col(LABEL) == F.col("prediction"), F.col("count")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    as_label = F.struct(
        F.col(LABEL).alias("class"), F.col("count").alias("actual"), none.alias("predicted"), hits.alias("hit")
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"), none.alias("actual"), F.col("count").alias("predicted"), none.alias("hit")
    )
    classes = (
        confusion.select(*by, F.inline(F.array(as_label, as_prediction)))
        .groupBy(*by, "class")
        .agg(*[F.sum(name).alias(name) for name in ("actual", "predicted", "hit")])
        .withColumn("precision", _ratio("hit", "predicted"))
        .withColumn("recall", _ratio("hit", "actual"))
    )
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0)
    total = F.sum("actual")
    return classes.groupBy(*by).agg(
        (F.sum("hit") / total).alias("accuracy"),
        (F.sum(F.col("actual") * F.col("precision")) / total).alias("weighted_precision"),
        (F.sum(F.col("actual") * F.col("recall")) / total).alias("weighted_recall"),
        (F.sum(F.col("actual") * f1) / total).alias("f1"),
    )


def _ratio(part: str, whole: str):
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def areas_under_roc(scored: DataFrame, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per ``by``, over every distinct margin, without binning; null for one class.

    All models share one pass: equal margins are added up first, so a margin that very many rows share is
    one row, and that table is stored. The rows below a margin are those of lower ranges of margins,
    which are few, and those below it in its own range; no task sees all margins.
    """
    count = F.sum(F.when(F.col(LABEL) > 0, _weight(weight))), F.sum(F.when(F.col(LABEL) <= 0, _weight(weight)))
    none = F.lit(0.0)
    margins = scored.groupBy(*by, "margin").agg(
        F.coalesce(count[0].cast("double"), none).alias("p"), F.coalesce(count[1].cast("double"), none).alias("n")
    )
    margins = materialize(margins, "margins")
    # The shuffle partitions bound the number of cut points, and a range is found among them by halving.
    cuts = cut_points(margins, ["margin"]) if margins.count() > MARGINS_PER_RANGE else []
    margins = margins.withColumn("_range", range_of(cuts, margins, ["margin"]))
    lower = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = margins.groupBy(*by, "_range").agg(F.sum("n").alias("_n"))
    starts = starts.select(*by, "_range", F.coalesce(F.sum("_n").over(lower), none).alias("_start"))
    within = Window.partitionBy(*by, "_range").orderBy("margin").rowsBetween(Window.unboundedPreceding, -1)
    placed = margins.withColumn("_before", F.coalesce(F.sum("n").over(within), none)).join(starts, [*by, "_range"])
    below = F.col("_start") + F.col("_before") + F.col("n") / 2
    total = F.sum("p") * F.sum("n")
    return placed.groupBy(*by).agg(F.when(total > 0, F.sum(F.col("p") * below) / total).alias("auc"))


def _weight(weight: str | None) -> Column:
    return F.col(weight) if weight else F.lit(1)


def area_under_roc(scored: DataFrame, weight: str | None = None) -> float | None:
    """The area of rows of one model."""
    return areas_under_roc(scored, weight).first()["auc"]


def binned_area_under_roc(scored: DataFrame, weight: str | None = None, bins: int = BINS) -> DataFrame:
    """One row for one model: its area ``auc`` from at most ``bins`` + 1 bins of margins, and the ``bound`` of its error.

    A mergeable sketch of quantiles, of fixed size, cuts the margins into bins of about equally many rows or cells. A bin adds
    up its positive and negative rows; no margins are sorted or stored. Within a bin the order is unknown, which can move
    the area by half of the pairs inside the bin at most: ``bound`` is that sum. A bin of one value adds nothing to it, since ties count half
    in the exact area, too. Null for one class. The driver gets the cut points.
    """
    shares = [i / bins for i in range(bins + 1)]
    cuts = scored.agg(F.percentile_approx("margin", shares, SKETCH * bins).alias("cuts")).first()["cuts"]
    inner = sorted({cut for cut in cuts or [] if abs(cut) < float("inf")}) or [0.0]
    splits = [-float("inf"), *inner, float("inf")]
    binned = Bucketizer(splits=splits, inputCol="margin", outputCol="_bin").transform(scored)
    per_bin = binned.groupBy("_bin").agg(
        F.coalesce(F.sum(F.when(F.col(LABEL) > 0, _weight(weight))).cast("double"), F.lit(0.0)).alias("p"),
        F.coalesce(F.sum(F.when(F.col(LABEL) <= 0, _weight(weight))).cast("double"), F.lit(0.0)).alias("n"),
        (F.min("margin") < F.max("margin")).alias("mixed"),
    )
    # At most a bin per cut point is left, so one task orders them.
    before = Window.partitionBy(F.lit(0)).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_bin.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0.0)) + F.col("n") / 2)
    pairs, unsure = F.sum("p") * F.sum("n"), F.sum(F.when(F.col("mixed"), F.col("p") * F.col("n") / 2).otherwise(0.0))
    return placed.agg(
        F.when(pairs > 0, F.sum(F.col("p") * F.col("below")) / pairs).alias("auc"),
        F.when(pairs > 0, unsure / pairs).alias("bound"),
    )
