"""Evaluation aggregates.

Inputs are scored rows with an actual class name and a predicted verdict.  Every
output is a small aggregate; the 2x2 spine is a literal four-row frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import LABEL_NAMES
from ..plans.broadcast import tiny

def _spine(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, p) for a in LABEL_NAMES for p in LABEL_NAMES],
                                 "actual string, predicted string")


def confusion_matrix(scored: DataFrame, actual: str = "sentiment",
                     predicted: str = "verdict") -> DataFrame:
    """(actual, predicted, n) over all four cells, zeros included (A4)."""
    spark = scored.sparkSession
    counts = (scored.where(F.col(predicted).isNotNull())
              .groupBy(F.col(actual).alias("actual"),
                       F.lower(F.col(predicted)).alias("predicted"))
              .agg(F.count(F.lit(1)).alias("n")))
    # The spine has four rows: broadcasting it is bounded by construction.
    return (tiny(_spine(spark)).join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def _ratio(num, den):
    return F.when(den > 0, num / den)


def _cell(actual_is, predicted_is):
    return F.sum(F.when(actual_is & predicted_is, F.col("n")).otherwise(F.lit(0)))


def classification_metrics(cm: DataFrame) -> DataFrame:
    """Rows per class and a macro row: precision, recall, f1, support, accuracy (A5).

    One global aggregate over the four cells, then ``inline`` of three structs:
    no join is needed.
    """
    a, p = F.col("actual"), F.col("predicted")
    sums = [F.sum("n").alias("total"), _cell(a == p, F.lit(True)).alias("hit")]
    for c in LABEL_NAMES:
        sums += [_cell(a == c, p == c).alias(f"tp_{c}"),
                 _cell(a != c, p == c).alias(f"fp_{c}"),
                 _cell(a == c, p != c).alias(f"fn_{c}")]
    one = cm.agg(*sums)
    for c in LABEL_NAMES:
        tp, fp, fn = (F.col(f"{k}_{c}") for k in ("tp", "fp", "fn"))
        one = (one.withColumn(f"precision_{c}", _ratio(tp.cast("double"), tp + fp))
               .withColumn(f"recall_{c}", _ratio(tp.cast("double"), tp + fn)))
        pr, rc = F.col(f"precision_{c}"), F.col(f"recall_{c}")
        one = one.withColumn(f"f1_{c}", _ratio(2 * pr * rc, pr + rc))

    def macro(metric):
        vals = [F.col(f"{metric}_{c}") for c in LABEL_NAMES]
        num = sum((F.coalesce(v, F.lit(0.0)) for v in vals), F.lit(0.0))
        den = sum((v.isNotNull().cast("int") for v in vals), F.lit(0))
        return _ratio(num, den)

    rows = [F.struct(F.lit(c).alias("class"), F.col(f"precision_{c}").alias("precision"),
                     F.col(f"recall_{c}").alias("recall"), F.col(f"f1_{c}").alias("f1"),
                     (F.col(f"tp_{c}") + F.col(f"fn_{c}")).alias("support"))
            for c in LABEL_NAMES]
    rows.append(F.struct(F.lit("macro").alias("class"), macro("precision").alias("precision"),
                         macro("recall").alias("recall"), macro("f1").alias("f1"),
                         F.col("total").alias("support")))
    acc = _ratio(F.col("hit").cast("double"), F.col("total"))
    return (one.select(F.inline(F.array(*rows)), acc.alias("accuracy"))
            .select("class",
                    F.round("precision", 6).alias("precision"),
                    F.round("recall", 6).alias("recall"),
                    F.round("f1", 6).alias("f1"),
                    F.col("support").cast("bigint").alias("support"),
                    F.round("accuracy", 6).alias("accuracy")))


def cross_entropy(scored: DataFrame, group: str = "split") -> DataFrame:
    """(group, n, loss): mean of -ln p(true class) over scored rows.

    Taken from the logit z of the positive class as ln(1 + exp(-+z)), which stays exact
    where the probability itself would be rounded to 0 or 1."""
    wrong = F.when(F.col("label") == 0, -F.col("z")).otherwise(F.col("z"))
    loss = F.greatest(wrong, F.lit(0.0)) + F.log1p(F.exp(-F.abs(F.col("z"))))
    return (scored.where(F.col("z").isNotNull())
            .groupBy(group)
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(loss), 6).alias("loss")))
