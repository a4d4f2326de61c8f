"""Splits and evaluation metrics as grouped aggregates.

Row positions come from ``number_rows`` (no per-key partition); every
metric is one ``groupBy.agg`` so any number of (model, split, fold) groups
are evaluated in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.operators.ranks import running_totals

OVERFIT_BANDS = (0.1, 0.2, 0.4)


def chronological_split(df: DataFrame, pos: str, n: str, fractions: Sequence[float] = (0.7, 0.15)) -> Column:
    """E1: 'train' / 'val' / 'test' by position against floor(n * cumulative
    fraction); positions are 1-based."""
    cuts, acc = [], 0.0
    for f in fractions:
        acc += f
        cuts.append(F.floor(F.col(n) * acc))
    labels = ["train", "val", "test"]
    expr = F.when(F.col(pos) <= cuts[0], labels[0])
    if len(cuts) > 1:
        expr = expr.when(F.col(pos) <= cuts[1], labels[1])
    return expr.otherwise(labels[-1])


def expanding_fold(pos: str, n: str, k: int) -> tuple[Column, Column]:
    """E5: expanding-window folds whose test blocks are the last k blocks of
    n // (k + 1) rows; what is left over goes to the first train block.
    Returns (fold 1..k of the test block the row belongs to or null, size)."""
    size = F.floor(F.col(n) / (k + 1))
    past = F.col(pos) - 1 - (F.col(n) - size * k)
    return F.when((size > 0) & (past >= 0), (F.floor(F.try_divide(past, size)) + 1).cast("int")), size


def k_fold(pos: str, n: Column, k: int) -> Column:
    """Contiguous fold ids 0..k-1; the first n mod k folds get one row more."""
    size, more, at = F.floor(n / k), n % k, F.col(pos) - 1
    long_part = more * (size + 1)
    return F.when(at < long_part, F.floor(at / (size + 1))).otherwise(
        more + F.floor(F.try_divide(at - long_part, size))).cast("int")


def random_split(key: Column, seed: int = 42, train_pct: int = 80) -> Column:
    """Deterministic hash split, independent of partitioning."""
    return F.when(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(100)) < train_pct, "train").otherwise("test")


def regression_metrics(df: DataFrame, keys: Sequence[str], y: str, p: str) -> DataFrame:
    """V1: RMSE, MAE, R², MAPE (non-zero y), mean error, median AE, max
    error, relative RMSE/MAE; finite rows only. The mean error is prediction
    minus truth."""
    d = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    err = F.col(y) - F.col(p)
    return d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.sum(err * err) / F.nullif(F.var_pop(y) * F.count(F.lit(1)), F.lit(0.0))).alias("r2"),
        (F.avg(F.when(F.col(y) != 0, F.abs(err / F.col(y)))) * 100).alias("mape"),
        F.avg(-err).alias("mean_error"),
        F.percentile(F.abs(err), 0.5).alias("median_ae"),
        F.max(F.abs(err)).alias("max_error"),
        (F.sqrt(F.avg(err * err)) / F.nullif(F.avg(y), F.lit(0.0))).alias("rel_rmse"),
        (F.avg(F.abs(err)) / F.nullif(F.avg(y), F.lit(0.0))).alias("rel_mae"))


def overfit(train: dict[str, Column], test: dict[str, Column]) -> tuple[Column, Column]:
    """V6: overfitting score, the mean of the positive parts of the relative
    RMSE and MAE gaps and of the R² gap, and its severity band."""
    gaps = [(test[m] - train[m]) / (train[m] + F.lit(1e-10)) for m in ("rmse", "mae")] + [train["r2"] - test["r2"]]
    score = sum(F.greatest(g, F.lit(0.0)) for g in gaps) / 3
    a, b, c = OVERFIT_BANDS
    band = (F.when(score < a, "None").when(score < b, "Mild").when(score < c, "Moderate").otherwise("Severe"))
    return score, band


def classification_metrics(df: DataFrame, keys: Sequence[str], y: str, pred: str) -> DataFrame:
    """V3: confusion counts, accuracy, precision, recall, F1 (positive = 1)."""
    tp = F.count_if((F.col(y) == 1) & (F.col(pred) == 1))
    fp = F.count_if((F.col(y) == 0) & (F.col(pred) == 1))
    fn = F.count_if((F.col(y) == 1) & (F.col(pred) == 0))
    tn = F.count_if((F.col(y) == 0) & (F.col(pred) == 0))
    out = df.groupBy(*keys).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    prec = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))
    rec = F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    return out.select("*", ((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")))
                      .alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
                      (2 * prec * rec / F.nullif(prec + rec, F.lit(0.0))).alias("f1"))


def _tie_counts(df: DataFrame, keys: Sequence[str], y: str, score: str) -> DataFrame:
    d = df.filter(F.col(score).isNotNull() & F.col(y).isNotNull())
    return d.groupBy(*keys, score).agg(F.count_if(F.col(y) == 1).alias("_pos"), F.count_if(F.col(y) == 0).alias("_neg"))


def roc_auc(df: DataFrame, keys: Sequence[str], y: str, score: str) -> DataFrame:
    """V4: exact ROC AUC by the rank-sum formula with average ranks for
    ties: over tie groups, positives times the negatives below them and half of
    those beside them. Groups of any size are spread over tasks."""
    t = running_totals(_tie_counts(df, keys, y, score), keys, [F.col(score)], {"_b": "_neg"})
    won = F.sum(F.col("_pos") * (F.col("_b_before") + F.col("_neg") / 2.0))
    g = t.groupBy(*keys).agg(F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"), won.alias("_won"))
    return g.select(*keys, "n_pos", "n_neg", (F.col("_won") / F.nullif(F.col("n_pos") * F.col("n_neg"), F.lit(0))).alias("roc_auc"))


def roc_curve(df: DataFrame, keys: Sequence[str], y: str, score: str) -> DataFrame:
    """V4: (keys, threshold, fpr, tpr), the points of the ROC curve by falling
    threshold: (0, 0) without a threshold, then one per distinct score, leaving
    out those between two equal steps, which lie on a straight line. A rate
    without any row of its class is null. Its trapezoids add up to ``roc_auc``."""
    t = running_totals(_tie_counts(df, keys, y, score), keys, [F.col(score).desc()], {"_p": "_pos", "_n": "_neg"}, {"_p": "_pos", "_n": "_neg"})
    corner = (F.col("_p_next").isNull() | (F.col("_p_next") != F.col("_pos")) | (F.col("_n_next") != F.col("_neg"))
              | (F.col("_p_before") + F.col("_n_before") == 0))
    points = t.filter(corner).select(*keys, F.col(score).cast("double").alias("threshold"),
                                     F.try_divide(F.col("_n_before") + F.col("_neg"), F.col("_n_all")).alias("fpr"),
                                     F.try_divide(F.col("_p_before") + F.col("_pos"), F.col("_p_all")).alias("tpr"))
    origin = points.groupBy(*keys).agg(F.min(F.col("fpr") * 0).alias("fpr"), F.min(F.col("tpr") * 0).alias("tpr"))
    return points.unionByName(origin.select(*keys, F.lit(None).cast("double").alias("threshold"), "fpr", "tpr"))


def direction_accuracy(df: DataFrame, keys: Sequence[str], order: str, y: str, p: str) -> DataFrame:
    """V2: share of rows where the prediction moves as the truth does, each
    against its own previous value (the first row's previous value is itself,
    so it counts as no move for both); null for a single row. And the share
    with sign(pred) == sign(y). Finite rows only."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    d = d.select(*keys, y, p, (F.col(y) - F.coalesce(F.lag(y, 1).over(w), F.col(y))).alias("_dy"),
                 (F.col(p) - F.coalesce(F.lag(p, 1).over(w), F.col(p))).alias("_dp"))
    same = F.avg((F.signum("_dy") == F.signum("_dp")).cast("double"))
    return d.groupBy(*keys).agg(
        F.when(F.count(F.lit(1)) > 1, same).alias("direction_accuracy"),
        F.avg((F.signum(F.col(p)) == F.signum(F.col(y))).cast("double")).alias("sign_accuracy"))
