"""Gradient boosting in residual blocks, with patience and resumption.

Spark's booster ends with the first round that raises its loss.  Here it fits a block of rounds at a
time on what the blocks before leave, the validation score is taken after each block, and boosting ends once
``patience`` rounds in a row brought no gain; the blocks up to the best one are the model.  The scores are
those the settings ask for: mean absolute error, or for the classifier the area under its ROC curve.

* Regression: a block's label is the residual, so its squared-error rounds go on with the sum.  As in any
  fit of Spark's, the first tree of a block has full weight, the others the learning rate.
* Classification: a block is a Newton step on the log-odds; its label is ``(y - p) / (p (1 - p))`` and the
  rows' weight ``p (1 - p)``.

Every block is stored with its score when it is done.  A fit that is started again on the same folder
reads them and goes on with the next block, so a lost driver costs at most one block.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusgrid.operators.metrics import roc_auc
from nimbusgrid.sources import storage

BLOCK, PATIENCE = 25, 50
#: Labels of a Newton step are kept within this, as odds near 0 or 1 make them large.
_STEEPEST = 4.0
#: Training rows that one task holds in its binned form, or ranks.
ROWS_A_TASK = 100_000
SCORES = "target string, block int, rounds int, metric string, score double"


def tasks_for(rows: int) -> int:
    return -(-max(rows, 1) // ROWS_A_TASK)


def rounds_allowed(settings: Mapping[str, float]) -> int:
    return 3000 if settings["learning_rate"] < 0.03 else 1500


def block_booster(settings: Mapping[str, float], *, rounds: int, max_bins: int = 255, seed: int = 42) -> GBTRegressor:
    """The estimator of one block.  Trees grow level by level, so the leaf count caps the depth."""
    return GBTRegressor(
        labelCol="_left", featuresCol="features", predictionCol="_step", weightCol="_weight", stepSize=settings["learning_rate"],
        maxIter=rounds, maxBins=max_bins, maxDepth=min(settings["max_depth"], math.ceil(math.log2(settings["num_leaves"]))),
        minInstancesPerNode=settings["min_child_samples"], featureSubsetStrategy=str(settings["feature_fraction"]), seed=seed)


def judged(scores: Sequence[tuple[int, float]], *, larger_is_better: bool, patience: int, most: int) -> tuple[int, str | None]:
    """(blocks to keep, why to stop): of (rounds so far, score) after each block.

    A tie is no gain.  The first block is always kept.  Nothing to stop for yet gives None.
    """
    best = 0
    for i, (_, value) in enumerate(scores):
        gain = value > scores[best][1] if larger_is_better else value < scores[best][1]
        if gain and not math.isnan(value) or math.isnan(scores[best][1]):
            best = i
    done = scores[-1][0]
    why = "rounds" if done >= most else "patience" if done - scores[best][0] >= patience else None
    return best + 1, why


def margin(blocks: int) -> Column:
    """The sum of the blocks' predictions."""
    return sum((F.col(f"_block_{i}") for i in range(1, blocks)), F.col("_block_0")) if blocks else F.lit(0.0)


def prediction(target: str, blocks: int) -> Column:
    total = margin(blocks)
    return 1.0 / (1.0 + F.exp(-total)) if target == "rain" else total


def _pipeline(names: Sequence[str], blocks: Sequence[GBTRegressionModel]) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="error")
    return PipelineModel([assembler, *[b.setPredictionCol(f"_block_{i}") for i, b in enumerate(blocks)]])


def _with_margin(rows: DataFrame, blocks: Sequence[GBTRegressionModel]) -> DataFrame:
    out = rows
    for i, block in enumerate(blocks):
        out = block.setPredictionCol(f"_block_{i}").transform(out)
    return out.withColumn("_sum", margin(len(blocks))).drop(*[f"_block_{i}" for i in range(len(blocks))])


def _left(target: str) -> tuple[Column, Column]:
    """What the sum leaves of the label, and the rows' weight."""
    if target != "rain":
        return F.col("label") - F.col("_sum"), F.lit(1.0)
    chance = 1.0 / (1.0 + F.exp(-F.col("_sum")))
    weight = F.greatest(chance * (1.0 - chance), F.lit(1e-6))
    step = (F.col("label") - chance) / weight
    return F.least(F.greatest(step, F.lit(-_STEEPEST)), F.lit(_STEEPEST)), weight


def validation_score(rows: DataFrame, target: str) -> float:
    """The score of ``_sum`` on validation rows; NaN without any."""
    found = rows.filter("is_validation")
    if target == "rain":
        got = roc_auc(found, "label", "_sum", partitions=tasks_for(found.count())).first()
        return math.nan if got is None or got[0] is None else float(got["roc_auc"])
    got = found.agg(F.avg(F.abs(F.col("label") - F.col("_sum")))).first()[0]
    return math.nan if got is None else got


def read_scores(spark, folder: str) -> DataFrame:
    """(target, block, rounds, metric, score) of every stored block of every target below ``folder``."""
    return spark.read.schema(SCORES).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/scores")


def boost(rows: DataFrame, target: str, names: Sequence[str], settings: Mapping[str, float], folder: str, *, block: int = BLOCK,
          patience: int = PATIENCE, max_iter: int | None = None, **options) -> PipelineModel:
    """Fit the target on ``rows`` (features, label, is_validation), storing every block in ``folder``.

    ``rows`` must be stored rows, as every block reads them again.
    """
    spark, most = rows.sparkSession, max_iter or rounds_allowed(settings)
    metric, larger = ("auc", True) if target == "rain" else ("mae", False)
    blocks, scores = [], []
    if storage.path_exists(spark, f"{folder}/scores/{target}"):
        # a block without its score was not done
        for row in read_scores(spark, folder).filter(F.col("target") == target).orderBy("block").collect():
            blocks.append(GBTRegressionModel.load(f"{folder}/blocks/{target}/{row.block}"))
            scores.append((row.rounds, row.score))
    while True:
        if scores:
            kept, why = judged(scores, larger_is_better=larger, patience=patience, most=most)
            if why:
                return _pipeline(names, blocks[:kept])
        done = scores[-1][0] if scores else 0
        left, weight = _left(target)
        train = _with_margin(rows.filter("not is_validation"), blocks).withColumns({"_left": left, "_weight": weight})
        rounds = min(block, most - done)
        blocks.append(block_booster(settings, rounds=rounds, **options).fit(train))
        score = validation_score(_with_margin(rows, blocks), target)
        number = len(blocks) - 1
        blocks[-1].write().overwrite().save(f"{folder}/blocks/{target}/{number}")
        row = [(target, number, done + rounds, metric, score)]
        spark.createDataFrame(row, SCORES).coalesce(1).write.mode("overwrite").parquet(f"{folder}/scores/{target}/{number}")
        scores.append((done + rounds, score))


def stored_nodes(spark, path: str) -> DataFrame:
    """The nodes of a stored model's trees: (block, tree, weight, node, feature, threshold, left, right, value, gain, rows)."""
    where = F.regexp_extract(F.col("_metadata.file_path"), r"stages/0*(\d+)_", 1).cast("int").alias("block")
    nodes = spark.read.parquet(f"{path}/stages/*_GBTRegressor_*/data").select(where, "treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/stages/*_GBTRegressor_*/treesMetadata").select(
        where, F.col("_1").alias("treeID"), F.col("_3").alias("weight"))
    return nodes.join(weights, ["block", "treeID"]).select(
        "block", F.col("treeID").alias("tree"), "weight", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"), F.col("prediction").alias("value"), "gain", F.col("rawCount").alias("rows"))


def importances(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, importance): each feature's share of the squared error its splits took away."""
    spark = nodes.sparkSession
    labels = spark.createDataFrame(list(enumerate(names)), "feature int, name string")
    gains = nodes.filter("left >= 0").groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows") * F.abs("weight")).alias("g"))
    total = gains.agg(F.sum("g")).first()[0] or 1.0
    return labels.join(gains, "feature", "left").select(
        F.col("name").alias("feature"), (F.coalesce("g", F.lit(0.0)) / total).alias("importance"))
