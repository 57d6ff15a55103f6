"""Churn classifier: deterministic stratified split, Spark ML random forest, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recurra.functions import ratio
from recurra.operators.ranking import global_row_number, running_sums

MODEL_FEATURES = ("monthly_price", "total_events", "active_minutes", "total_tickets")


def n5_split(df: DataFrame, *, label: str = "is_churned", id_col: str = "subscription_id",
             test: float = 0.3, seed: int = 42) -> DataFrame:
    """Stratified, deterministic hold-out: within each class rows are ordered by a
    seeded MD5 of the id (then the id) and the first ones are 'test'. Together they are
    ceil(test * n) rows; a class takes its share by largest remainder (ties: smaller label).

    Only the narrow (class, hash, id) keys are numbered (range-partitioned global
    numbering minus the class offset); that yields one cut-off (hash, id) per class,
    which is broadcast (one row per class) and compared on every row -- the wide
    feature rows are never shuffled or sorted.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    keys = df.select(F.col(label).alias("_y"), h.alias("_h"), F.col(id_col).alias("_id"))
    ranked = global_row_number(keys, [F.col("_y"), F.col("_h"), F.col("_id")], out="_rank")
    counts = keys.groupBy("_y").agg(F.count(F.lit(1)).alias("_n"))      # one row per class
    share = F.round(F.col("_n") * test, 9)
    whole = W.partitionBy(F.lit(1))                                        # over the few classes
    offsets = counts.select(
        "_y", F.floor(share).alias("_base"), (share - F.floor(share)).alias("_rest"),
        F.ceil(F.round(F.sum("_n").over(whole) * test, 9)).alias("_want"),
        F.coalesce(F.sum("_n").over(W.orderBy("_y").rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    spare = F.col("_want") - F.sum("_base").over(whole)
    place = F.row_number().over(W.orderBy(F.desc("_rest"), "_y"))
    offsets = offsets.select("_y", "_off", (F.col("_base") + (place <= spare).cast("int")).alias("_take"))
    cut = (ranked.join(F.broadcast(offsets), "_y")
           .where(F.col("_rank") - F.col("_off") == F.col("_take"))
           .select(F.col("_y").alias(label), F.col("_h").alias("_cut_h"),
                   F.col("_id").alias("_cut_id")))
    in_test = (h < F.col("_cut_h")) | ((h == F.col("_cut_h")) & (F.col(id_col) <= F.col("_cut_id")))
    return (df.join(F.broadcast(cut), label, "left")
            .withColumn("split", F.when(F.coalesce(in_test, F.lit(False)), "test")
                        .otherwise("train"))
            .drop("_cut_h", "_cut_id"))


def n5_random_forest(train: DataFrame, *, features: Sequence[str] = MODEL_FEATURES,
                     label: str = "is_churned", trees: int = 50, depth: int = 5,
                     seed: int = 42) -> PipelineModel:
    """Spark ML random forest (gini, sqrt feature subsets) on the training rows."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees,
                                maxDepth=depth, seed=seed, impurity="gini",
                                featureSubsetStrategy="sqrt")
    return Pipeline(stages=[assembler, rf]).fit(train)


def predictions(model: PipelineModel, test: DataFrame, *, label: str = "is_churned",
                id_col: str = "subscription_id") -> DataFrame:
    out = model.transform(test)
    p1 = F.get(vector_to_array("probability"), 1)
    return out.select(id_col, F.col(label).cast("int").alias("label"),
                      F.col("prediction").cast("int").alias("prediction"),
                      p1.alias("p_churn"))


def n5_class_report(pred: DataFrame) -> DataFrame:
    """classification_report: per class precision/recall/f1/support, then accuracy,
    macro avg and weighted avg rows. Built from the small confusion table."""
    conf = pred.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    tp = (conf.where(F.col("label") == F.col("prediction"))
          .select(F.col("label").alias("c"), F.col("n").alias("tp")))
    support = conf.groupBy(F.col("label").alias("c")).agg(F.sum("n").alias("support"))
    predicted = conf.groupBy(F.col("prediction").alias("c")).agg(F.sum("n").alias("predicted"))
    # every frame here has one row per class
    per = (support.join(predicted, "c", "full").join(tp, "c", "left")
           .fillna(0, subset=["support", "predicted", "tp"]))
    per = per.select(
        F.col("c").cast("string").alias("class"),
        F.coalesce(ratio("tp", "predicted"), F.lit(0.0)).alias("precision"),
        F.coalesce(ratio("tp", "support"), F.lit(0.0)).alias("recall"),
        F.col("support").cast("long").alias("support"), F.col("tp"))
    per = per.withColumn("f1_score", F.coalesce(ratio(
        2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"),
                  F.avg("f1_score").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("class"), ratio("tp", "n").alias("precision"),
                     ratio("tp", "n").alias("recall"), ratio("tp", "n").alias("f1_score"),
                     F.col("n").cast("long").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1_score"),
                       F.col("n").cast("long").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("class"), ratio("wp", "n").alias("precision"),
                          ratio("wr", "n").alias("recall"), ratio("wf", "n").alias("f1_score"),
                          F.col("n").cast("long").alias("support"))
    cols = ["class", "precision", "recall", "f1_score", "support"]
    return per.select(*cols).unionByName(acc).unionByName(macro).unionByName(weighted)


def n5_importances(model: PipelineModel, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """(feature, importance) sorted descending -- a 4-row frame from the fitted model."""
    rf = model.stages[-1]
    imp = rf.featureImportances.toArray().tolist()
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession().createDataFrame(list(zip(features, [float(v) for v in imp])),
                             "feature string, importance double").orderBy(F.desc("importance"))


def n5_auc(pred: DataFrame) -> DataFrame:
    """Area under ROC of the churn probability (one row)."""
    from pyspark.sql import SparkSession
    ev = BinaryClassificationEvaluator(rawPredictionCol="p_churn", labelCol="label",
                                       metricName="areaUnderROC")
    value = ev.evaluate(pred.withColumn("label", F.col("label").cast("double")))
    return SparkSession.getActiveSession().createDataFrame([(float(value),)], "auc double")


def exact_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """(auc, positives, negatives): the exact area under the ROC curve of a score.

    It is the share of (positive, negative) pairs that the score orders rightly, ties counting
    half. Rows reduce to one per distinct score; the negatives below each come from running
    sums over score ranges, all in exact integers. Rows without a score or a label do not
    count; without positives or without negatives the area is NULL.
    """
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    per = known.groupBy(F.col(score).alias("score")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) != 1, 1)).alias("neg"))
    placed = running_sums(per, ["score"], ["neg"])
    whole = "decimal(38,0)"
    twice = F.col("pos").cast("decimal(19,0)") * (2 * F.col("before_neg") + F.col("neg")).cast("decimal(19,0)")
    sums = placed.agg(F.sum(twice.cast(whole)).alias("twice"), F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
                      F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"))
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double") * 2
    return sums.select(ratio(F.col("twice"), pairs).alias("auc"), "positives", "negatives")


def fixed_score(matrix: DataFrame, *, threshold: float = 60.0) -> DataFrame:
    """A score of the model matrix that needs no fitting: (subscription_id, label, prediction, score).
    Many tickets and little activity raise it; it has many ties."""
    score = (3 * F.col("total_tickets") - F.col("total_events") + F.pmod(F.col("active_minutes"), F.lit(97))).cast("double")
    return matrix.select("subscription_id", F.col("is_churned").alias("label"),
                         (score >= threshold).cast("int").alias("prediction"), score.alias("score"))
