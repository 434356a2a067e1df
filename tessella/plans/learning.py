"""Training, scoring, metrics and curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, model
from .inputs import PREDICTED, SCORED, Plans, embeddings, predicted, scored

PLANS = Plans()
add = PLANS.add
_S = SCORED.format(i=1)


@add(f"SELECT vec_id, score FROM ({_S}) WHERE score > 0.1")
def threshold_gt(spark, sf_dir):
    return scored(spark, sf_dir).filter(F.col("score") > 0.1).select("vec_id", "score")


@add(f"SELECT y, pred, count(*) AS n FROM ({PREDICTED}) GROUP BY y, pred")
def confusion(spark, sf_dir):
    return metrics.confusion(predicted(spark, sf_dir))


@add(f"SELECT round(avg(CASE WHEN y = pred THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM ({PREDICTED})")
def accuracy(spark, sf_dir):
    return metrics.accuracy(predicted(spark, sf_dir)).select(F.round("accuracy", 6).alias("accuracy"))


_CLASS = f"""WITH p AS ({PREDICTED}), c AS (SELECT cls, count(*) FILTER (WHERE y = cls AND pred = cls) AS tp, count(*) FILTER (WHERE pred = cls) AS pp, count(*) FILTER (WHERE y = cls) AS support FROM p, (VALUES (0), (1)) v(cls) GROUP BY cls),
r AS (SELECT cls, coalesce(tp / nullif(pp, 0), 0) AS precision_, coalesce(tp / nullif(support, 0), 0) AS recall_, support FROM c), f AS (SELECT *, coalesce(2 * precision_ * recall_ / nullif(precision_ + recall_, 0), 0) AS f1_ FROM r)"""


@add(f'{_CLASS} SELECT round(sum(precision_ * support) / sum(support), 6) AS "precision", round(sum(recall_ * support) / sum(support), 6) AS recall, round(sum(f1_ * support) / sum(support), 6) AS f1 FROM f')
def prf_weighted(spark, sf_dir):
    return metrics.weighted(predicted(spark, sf_dir)).select(*(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@add(f"""{_CLASS}, a AS (SELECT avg(CASE WHEN y = pred THEN 1e0 ELSE 0e0 END) AS a, count(*) AS n FROM p)
SELECT name, round(precision_, 6) AS "precision", round(recall_, 6) AS recall, round(f1_, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
SELECT CAST(cls AS VARCHAR) AS name, precision_, recall_, f1_, support FROM f UNION ALL SELECT 'accuracy', a, a, a, n FROM a
UNION ALL SELECT 'macro avg', avg(precision_), avg(recall_), avg(f1_), sum(support) FROM f
UNION ALL SELECT 'weighted avg', sum(precision_ * support) / sum(support), sum(recall_ * support) / sum(support), sum(f1_ * support) / sum(support), sum(support) FROM f)""")
def class_report(spark, sf_dir):
    return metrics.report(predicted(spark, sf_dir)).select("name", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")), "support")


_CURVE = f"SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, neg, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM ({_S}) GROUP BY score) WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@add(f"SELECT score, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM ({_CURVE})")
def roc_curve(spark, sf_dir):
    return metrics.roc(scored(spark, sf_dir)).select("score", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@add(f'SELECT score, round(tp / (tp + fp), 6) AS "precision", round(tp / p, 6) AS recall FROM ({_CURVE})')
def pr_curve(spark, sf_dir):
    return metrics.precision_recall(scored(spark, sf_dir)).select("score", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@add(f"SELECT round(sum((fp - coalesce(f0, 0)) / n * (tp + coalesce(t0, 0)) / p / 2), 6) AS auc FROM (SELECT *, lag(fp) OVER (ORDER BY score DESC) AS f0, lag(tp) OVER (ORDER BY score DESC) AS t0 FROM ({_CURVE}))")
def roc_auc(spark, sf_dir):
    return metrics.auc(scored(spark, sf_dir)).select(F.round("auc", 6).alias("auc"))


@add(f"SELECT round(sum((tp - coalesce(t0, 0)) / p * tp / (tp + fp)), 6) AS average_precision FROM (SELECT *, lag(tp) OVER (ORDER BY score DESC) AS t0 FROM ({_CURVE}))")
def average_precision(spark, sf_dir):
    return metrics.average_precision(scored(spark, sf_dir)).select(F.round("average_precision", 6).alias("average_precision"))


@add()
def gbt_train_score(spark, sf_dir):
    rows = embeddings(spark, sf_dir).select(F.col("vec_id").alias("tile_id"), "embedding", (F.col("label") < 3).cast("int").alias("label"), F.col("label").cast("string").alias("class"))
    fitted, split = model.train(rows, pos_weight=2.0, trees=10, depth=3)
    return model.without_training(model.score(fitted, rows.select("tile_id", "embedding")), split)
