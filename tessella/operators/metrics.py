"""Classification metrics and ranking curves from (y, pred) and (y, score), with 0/1 labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running


def confusion(rows: DataFrame) -> DataFrame:
    return rows.groupBy("y", "pred").agg(F.count("*").alias("n"))


def accuracy(rows: DataFrame) -> DataFrame:
    return rows.agg(F.avg((F.col("pred") == F.col("y")).cast("double")).alias("accuracy"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))


def per_class(rows: DataFrame) -> DataFrame:
    """(cls, precision, recall, f1, support) of each class that occurs as a label or a prediction; 0 where undefined."""
    each = rows.select(F.explode(F.array_distinct(F.array("y", "pred"))).alias("cls"), "y", "pred")
    counts = each.groupBy("cls").agg(*(F.count_if(c).alias(n) for n, c in (("tp", (F.col("y") == F.col("cls")) & (F.col("pred") == F.col("cls"))), ("pp", F.col("pred") == F.col("cls")), ("support", F.col("y") == F.col("cls")))))
    precision, recall = _ratio(F.col("tp"), F.col("pp")), _ratio(F.col("tp"), F.col("support"))
    out = counts.select("cls", precision.alias("precision"), recall.alias("recall"), "support")
    return out.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def weighted(rows: DataFrame) -> DataFrame:
    """Precision, recall and F1 averaged by support."""
    each, share = per_class(rows), lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
    return each.agg(share("precision"), share("recall"), share("f1"))


def report(rows: DataFrame) -> DataFrame:
    """Rows of each class, then accuracy, macro and weighted averages, as (name, precision, recall, f1, support)."""
    each = per_class(rows)
    cols = ("precision", "recall", "f1")
    total = F.sum("support").alias("support")
    macro = each.agg(*(F.avg(c).alias(c) for c in cols), total).withColumn("name", F.lit("macro avg"))
    by_support = each.agg(*((F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in cols), total).withColumn("name", F.lit("weighted avg"))
    right = rows.agg(F.avg((F.col("pred") == F.col("y")).cast("double")).alias("a"), F.count("*").alias("support")).select(F.lit("accuracy").alias("name"), *(F.col("a").alias(c) for c in cols), "support")
    names = ["name", *cols, "support"]
    return each.withColumn("name", F.col("cls").cast("string")).select(names).union(right.select(names)).union(macro.select(names)).union(by_support.select(names))


def thresholds(rows: DataFrame) -> DataFrame:
    """(score, tp, fp, p, n): at each distinct score, the positives and negatives at or above it, and all of them."""
    each = rows.groupBy("score").agg(F.sum("y").cast("long").alias("pos"), F.sum(1 - F.col("y")).cast("long").alias("neg"))
    all_ = rows.agg(F.sum("y").cast("long").alias("p"), F.sum(1 - F.col("y")).cast("long").alias("n"))
    return running(each, [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}).crossJoin(F.broadcast(all_)).select("score", "pos", "neg", "tp", "fp", "p", "n")  # one row


def roc(rows: DataFrame) -> DataFrame:
    """(score, fpr, tpr) at every distinct score; collinear points stay, and the origin is left out."""
    return thresholds(rows).select("score", (F.col("fp") / F.col("n")).alias("fpr"), (F.col("tp") / F.col("p")).alias("tpr"))


def precision_recall(rows: DataFrame) -> DataFrame:
    return thresholds(rows).select("score", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (F.col("tp") / F.col("p")).alias("recall"))


def auc(rows: DataFrame) -> DataFrame:
    """Area under the ROC curve: each score's step is a trapezoid that its own counts give, so no row needs the one before."""
    step = F.col("neg") * (2 * F.col("tp") - F.col("pos"))
    return thresholds(rows).agg((F.sum(step) / (2.0 * F.max("p") * F.max("n"))).alias("auc"))


def average_precision(rows: DataFrame) -> DataFrame:
    return thresholds(rows).agg(F.sum(F.col("pos") / F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("average_precision"))
