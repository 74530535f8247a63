"""Model training and scoring on Spark MLlib.

Splits and folds come from a seeded key hash (deterministic, independent of
partitioning, no shuffle). Every fit, transform and evaluation runs as MLlib /
DataFrame jobs; fold metrics reuse ``operators.metrics`` (exact, bucketed).
"""

from __future__ import annotations

import functools
import itertools
import random
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlab.functions.columns import key_hash
from churnlab.operators import metrics as M
from churnlab.operators.monitor import class_weights
from churnlab.operators.quantiles import before, in_ranges
from churnlab.operators.validate import missing_columns
from churnlab.session import materialize, scratch_path

T = TypeVar("T")
HASH_BUCKETS = 10000
MAX_CATEGORIES = 32  # feature values up to which a column is treated as categorical by the forest


def _h(key: str, seed: int):
    return key_hash(key, seed, HASH_BUCKETS)


def split(df: DataFrame, frac: float = 0.8, seed: int = 42, key: str = "msno") -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash; stratified in expectation."""
    cut = int(frac * HASH_BUCKETS)
    return df.where(_h(key, seed) < cut), df.where(_h(key, seed) >= cut)


def subsample(df: DataFrame, frac: float, seed: int = 42, key: str = "msno") -> DataFrame:
    """Keyed subsample (same users on every run)."""
    return df.where(_h(key, seed + 1) < int(frac * HASH_BUCKETS))


def stratified_folds(df: DataFrame, k: int = 5, seed: int = 42, key: str = "msno", label: str = "is_churn",
                     exact: bool = False) -> DataFrame:
    """Fold id per row.

    Default: ``pmod(hash, k)`` - no shuffle, stratified in expectation.
    ``exact``: fold sizes within each class differ by at most one. Rows are
    ranked by (hash, key) inside their class: written in ranges of a bounded
    number of rows, ranked inside each range, the rows of the ranges before
    added. fold = floor(rank * k / class size).
    """
    if not exact:
        return df.withColumn("fold", key_hash(key, seed, k).cast("int"))
    x = in_ranges(df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))), [label, "_h", key])
    off = before(["_n"], x.groupBy(label, "part").agg(F.count(F.lit(1)).alias("_n")), [label]).drop("_n")
    inner = Window.partitionBy(label, "part").orderBy("_h", key)
    ranked = x.join(F.broadcast(off), [label, "part"]).withColumn(
        "_rank", F.col("_n_before") + F.row_number().over(inner) - 1)
    return ranked.withColumn("fold", F.floor(F.col("_rank") * k / F.col("_n_all")).cast("int")).drop(
        "_h", "part", "_n_before", "_n_all", "_rank")


def with_class_weight(df: DataFrame, label: str = "is_churn", col: str = "weight") -> DataFrame:
    """Balanced weight column from a one-row aggregate (broadcast)."""
    w = class_weights(df, label).select("weight_pos", "weight_neg")
    return df.crossJoin(F.broadcast(w)).withColumn(
        col, F.when(F.col(label) == 1, F.col("weight_pos")).otherwise(F.col("weight_neg"))
    ).drop("weight_pos", "weight_neg")


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def lr_pipeline(features: Sequence[str], label: str = "is_churn", weight: str | None = "weight",
                reg: float = 0.0, max_iter: int = 100) -> Pipeline:
    """T4: standardise + logistic regression (class-balanced through ``weight``)."""
    lr = LogisticRegression(featuresCol="scaled", labelCol=label, regParam=reg, maxIter=max_iter)
    if weight:
        lr = lr.setWeightCol(weight)
    return Pipeline(stages=[_assembler(features),
                            StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True), lr])


def gbt_pipeline(features: Sequence[str], label: str = "is_churn", weight: str | None = "weight",
                 max_iter: int = 30, max_depth: int = 5, step: float = 0.1, subsample_rate: float = 1.0,
                 seed: int = 42) -> Pipeline:
    """T5: gradient-boosted trees."""
    g = GBTClassifier(labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step,
                      subsamplingRate=subsample_rate, seed=seed)
    if weight:
        g = g.setWeightCol(weight)
    return Pipeline(stages=[_assembler(features), g])


def rf_pipeline(features: Sequence[str], label: str = "is_churn", weight: str | None = "weight",
                num_trees: int = 50, max_depth: int = 8, seed: int = 42) -> Pipeline:
    """Random forest, the differently biased third ensemble member.

    Columns with at most ``MAX_CATEGORIES`` values are indexed and split as categories, not as numbers.
    """
    raw = _assembler(features).setOutputCol("raw_features")
    index = VectorIndexer(inputCol="raw_features", outputCol="features", maxCategories=MAX_CATEGORIES,
                          handleInvalid="keep")
    r = RandomForestClassifier(labelCol=label, numTrees=num_trees, maxDepth=max_depth, seed=seed)
    if weight:
        r = r.setWeightCol(weight)
    return Pipeline(stages=[raw, index, r.setMaxBins(2 * MAX_CATEGORIES)])


BUILDERS = {"lr": lr_pipeline, "gbt": gbt_pipeline, "rf": rf_pipeline}


def score(model: PipelineModel, df: DataFrame, out: str = "prob", keep: Sequence[str] = ("msno", "is_churn")
          ) -> DataFrame:
    """Positive-class probability as a double column."""
    return add_score(model, df, out).select(*keep, out)


def add_score(model: PipelineModel, df: DataFrame, out: str = "prob") -> DataFrame:
    """``df`` with one score column more; models chain on one DataFrame, without joining scored copies."""
    return model.transform(df).select(*df.columns, vector_to_array("probability")[1].alias(out))


def evaluate(scored: DataFrame, label: str = "is_churn", prob: str = "prob") -> DataFrame:
    """ROC-AUC, PR-AUC and log loss of one scored table, one row."""
    t = M.threshold_table(scored, label, prob)
    return M.roc_auc(scored, table=t).crossJoin(M.pr_auc(scored, table=t)).crossJoin(
        M.log_loss(scored, label, prob))


def temporal_validate(fit, prev: DataFrame, cur: DataFrame, upcoming: DataFrame
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``fit`` (table -> model) on ``prev``, evaluated on ``cur``; refitted on both, ``upcoming`` scored.

    Returns the scores of ``cur``, their ROC-AUC, PR-AUC and log loss (one row), and the scores of ``upcoming``.
    """
    scored = materialize(score(fit(prev), cur))
    return scored, evaluate(scored), score(fit(prev.unionByName(cur)), upcoming)


def _at_once(spark, jobs: Sequence[Callable[[], T]], parallelism: int) -> list[T]:
    """Results of some jobs, at most ``parallelism`` of them at a time; each thread has the caller's job properties."""
    if parallelism <= 1:
        return [job() for job in jobs]
    with ThreadPool(min(parallelism, max(1, len(jobs)))) as pool:
        return pool.map(lambda job: job(), [inheritable_thread_target(spark)(job) for job in jobs], chunksize=1)


def cross_validate(df: DataFrame, features: Sequence[str], models: Sequence[str] = ("lr",), k: int = 5,
                   seed: int = 42, label: str = "is_churn", params: dict | None = None, parallelism: int = 1) -> DataFrame:
    """K-fold metrics per model -> rows (model, fold, roc_auc, pr_auc, log_loss); folds are fitted at once."""
    folds = df if "fold" in df.columns else materialize(stratified_folds(df, k, seed, label=label))

    def job(name: str, i: int):
        tr = with_class_weight(folds.where(F.col("fold") != i), label)  # weights of the training part only
        m = BUILDERS[name](features, label, **(params or {}).get(name, {})).fit(tr)
        ev = evaluate(score(m, folds.where(F.col("fold") == i)), label).first()
        return name, i, ev["roc_auc"], ev["pr_auc"], ev["log_loss"]
    jobs = [functools.partial(job, name, i) for name in models for i in range(k)]
    return df.sparkSession.createDataFrame(
        _at_once(df.sparkSession, jobs, parallelism),
        "model string, fold int, roc_auc double, pr_auc double, log_loss double")


def _combos(grid: dict[str, Sequence], n_draws: int | None, seed: int) -> list[dict]:
    keys = sorted(grid)
    combos = list(itertools.product(*[grid[k] for k in keys]))
    if n_draws is not None and n_draws < len(combos):
        combos = random.Random(seed).sample(combos, n_draws)
    return [dict(zip(keys, c)) for c in combos]


def _trials(folds: DataFrame, features, trials: Sequence[tuple[int, dict]], model, k, seed, label, parallelism) -> list[tuple]:
    """(trial, params, mean ROC-AUC, mean log loss) of each, fitted over the written folds."""
    def job(t: int, params: dict):
        rows = cross_validate(folds, features, (model,), k, seed, label, {model: params}).collect()
        mean = lambda c: sum(r[c] for r in rows) / len(rows) if all(r[c] is not None for r in rows) else None
        return t, str(params), mean("roc_auc"), mean("log_loss")
    return _at_once(folds.sparkSession, [functools.partial(job, t, p) for t, p in trials], parallelism)


def tune(df: DataFrame, features: Sequence[str], grid: dict[str, Sequence], model: str = "gbt", k: int = 3,
         n_draws: int | None = None, seed: int = 42, label: str = "is_churn", parallelism: int = 4) -> DataFrame:
    """Grid (or seeded random draws from it) x k-fold CV -> trials table with mean metrics, some trials at once."""
    folds = materialize(stratified_folds(df, k, seed, label=label))  # read by every trial and fold
    rows = _trials(folds, features, list(enumerate(_combos(grid, n_draws, seed))), model, k, seed, label, parallelism)
    return df.sparkSession.createDataFrame(rows, "trial int, params string, roc_auc double, log_loss double")


def tune_halving(df: DataFrame, features: Sequence[str], grid: dict[str, Sequence], model: str = "gbt", k: int = 3,
                 rungs: int = 3, eta: int = 2, n_draws: int | None = None, seed: int = 42, label: str = "is_churn",
                 key: str = "msno", parallelism: int = 4) -> DataFrame:
    """T8 by successive halving: all trials on a small keyed sample, the best 1/``eta`` of them on one ``eta`` times
    larger, the last ones on all rows.

    Samples are nested (by hash of the key), so results depend on the seed alone. Rows: rung, fraction, trial, params,
    roc_auc, log_loss, kept (goes on to the next rung; in the last one the winner). Ties go to the earlier trial.
    """
    if rungs < 1 or eta < 2:
        raise ValueError("at least one rung, and eta of two at least")
    folds = materialize(stratified_folds(df, k, seed, label=label).withColumn("_rung_hash", _h(key, seed + 1)))
    left, out = list(enumerate(_combos(grid, n_draws, seed))), []
    for rung in range(rungs):
        fraction = eta ** -(rungs - 1 - rung)
        part = folds.where(F.col("_rung_hash") < fraction * HASH_BUCKETS).drop("_rung_hash")
        rows = _trials(part, features, left, model, k, seed, label, parallelism)
        rank = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0.0), r[0]))
        keep = {r[0] for r in rank[:max(1, -(-len(rank) // eta)) if rung < rungs - 1 else 1]}
        out += [(rung, float(fraction), *r, r[0] in keep) for r in rows]
        left = [(t, p) for t, p in left if t in keep]
    return df.sparkSession.createDataFrame(
        out, "rung int, fraction double, trial int, params string, roc_auc double, log_loss double, kept boolean")


def calibrate(holdout_scored: DataFrame, label: str = "is_churn", prob: str = "prob"):
    """Isotonic calibration fitted on held-out scores (off by default in the pipeline)."""
    from pyspark.ml.regression import IsotonicRegression
    return IsotonicRegression(featuresCol=prob, labelCol=label, predictionCol="calibrated_prob").fit(holdout_scored)


def blend(df: DataFrame, cols: Sequence[str], weights: Sequence[float] | None = None, out: str = "prob"
          ) -> DataFrame:
    """(weighted) mean of model scores held as columns of one DataFrame."""
    w = list(weights or [1.0] * len(cols))
    tot = sum(w)
    expr = None
    for c, wi in zip(cols, w):
        t = F.col(c) * (wi / tot)
        expr = t if expr is None else expr + t
    return df.withColumn(out, expr)


def tree_nodes(model: PipelineModel) -> DataFrame:
    """The nodes of the fitted trees: tree, node, feature (index, -1 at leaves), gain, weight (of the rows it split).

    Read from the model as MLlib stores it, in a scratch folder.
    """
    spark, stage = SparkSession.getActiveSession(), model.stages[-1]
    path = scratch_path(spark, "churnlab_trees")
    stage.write().save(path)
    n = F.col("nodeData")
    stats = n["impurityStats"]
    gini = stage.getImpurity() in ("gini", "entropy") and not isinstance(stage, GBTClassificationModel)
    weight = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x) if gini else stats[0]  # of variance the first is the count
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.when(n["leftChild"] >= 0, n["gain"]).alias("gain"), weight.alias("weight"))


def tree_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, gain_importance, n_splits) of every feature, from the trees' nodes.

    Gain importance is the summed gain times rows of a feature's splits, as a share (a forest's trees count alike, the
    trees of boosting by their gains), as MLlib's ``featureImportances``; n_splits counts the splits.
    """
    spark, nodes = SparkSession.getActiveSession(), tree_nodes(model).where("feature >= 0 AND gain IS NOT NULL")
    per = nodes.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("g"), F.count(F.lit(1)).alias("n"))
    if not isinstance(model.stages[-1], GBTClassificationModel):
        total = F.sum("g").over(Window.partitionBy("tree"))
        per = per.withColumn("g", F.when(total > 0, F.col("g") / F.when(total > 0, total)).otherwise(0.0))
    sums = per.groupBy("feature").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    all_gain = F.sum("g").over(Window.partitionBy())  # a row a feature
    share = sums.select(F.col("feature").alias("i"), "n", F.when(all_gain > 0, F.col("g") / F.when(all_gain > 0, all_gain))
                        .otherwise(0.0).alias("gain_importance"))
    names = spark.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in features])).alias("i", "feature"))
    return names.join(F.broadcast(share), "i", "left").select(
        "feature", F.coalesce("gain_importance", F.lit(0.0)).alias("gain_importance"),
        F.coalesce("n", F.lit(0)).alias("n_splits"))


def feature_importance(model: PipelineModel, features: Sequence[str], top: int = 10):
    """The ``top`` (feature, importance) pairs of the tree stage, largest first."""
    rows = tree_importance(model, features).orderBy(F.desc("gain_importance"), "feature").limit(top).collect()
    return [(r["feature"], r["gain_importance"]) for r in rows]


def register_version(versions: DataFrame | None, spark, name: str, version: int, metrics: dict,
                     stage: str = "None", now=None) -> DataFrame:
    """Append a version row; ``promote`` moves one version to Production and archives the previous."""
    import datetime as dt
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(name, version, stage, float(metrics.get("log_loss", float("nan"))),
                                  float(metrics.get("roc_auc", float("nan"))), int(metrics.get("feature_count", 0)),
                                  now)],
                                "name string, version int, stage string, log_loss_val double, roc_auc_val double, "
                                "feature_count int, registered_at timestamp")
    return row if versions is None else versions.unionByName(row)


def promote(versions: DataFrame, name: str, version: int) -> DataFrame:
    is_target = (F.col("name") == name) & (F.col("version") == version)
    was_prod = (F.col("name") == name) & (F.col("stage") == "Production") & ~is_target
    return versions.withColumn("stage", F.when(is_target, "Production").when(was_prod, "Archived")
                               .otherwise(F.col("stage")))


def score_batch(model: PipelineModel, features: DataFrame, period: str, version: str, path: str | None = None,
                source: str = "batch", thr: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Score one period, label at ``thr``, round to 6 dp, optionally upsert into the
    prediction table (replacing this period and version only); returns (scores, distribution)."""
    from churnlab.functions.columns import label_at
    from churnlab.operators.eda import score_distribution
    missing_columns(features, ["msno", *model.stages[0].getInputCols()])  # V3: before any job
    p = score(model, features, "p", keep=("msno",))
    out = p.select("msno", F.round("p", 6).cast("float").alias("churn_prob"),
                   label_at(F.round("p", 6), thr).cast("short").alias("churn_label"))
    if path is not None:
        from churnlab.sources.store import read_predictions, upsert_predictions
        upsert_predictions(out, path, period, version, source)
        written = read_predictions(features.sparkSession, path).where(
            (F.col("period") == period) & (F.col("model_version") == version) & (F.col("source") == source))
        out = written.select(*out.columns)  # the written rows; nothing is scored twice
    return out, score_distribution(out.select(F.col("churn_prob").cast("double").alias("prob")), "prob", thr)
