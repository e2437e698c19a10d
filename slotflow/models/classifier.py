"""Will a tote be taken? A random forest over tote features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from slotflow.functions.special import exact_interval
from slotflow.models.resampling import resampled_accuracy
from slotflow.operators.sampling import hash_folds
from slotflow.session import materialize

ID_COLUMNS = ("insert_date", "item_number", "licenceplate", "locno")
FACTORS = (
    "location",
    "z_pos",
    "classification",
    "directorate",
    "hanging_garment",
    "sor_indicator",
    "confirmed",
    "item_group_name",
)
NUMBERS = ("quantity", "cumunits", "itemrank", "likelihood", "exp_demand")
LABEL = "move"
POSITIVE = 1


MOST_DEPTH = 30  # trees grow out; Spark allows no deeper ones


def _stages(trees: int, seed: int) -> tuple[list, RandomForestClassifier]:
    indexed, dummies = [f"{c}_index" for c in FACTORS], [f"{c}_dummies" for c in FACTORS]
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=MOST_DEPTH, seed=seed)
    return [
        StringIndexer(
            inputCols=[f"{c}_text" for c in FACTORS],
            outputCols=indexed,
            stringOrderType="alphabetDesc",
            handleInvalid="keep",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=dummies, handleInvalid="keep"),
        VectorAssembler(inputCols=[*dummies, *NUMBERS], outputCol="features"),
        forest,
    ], forest


def model_frame(df: DataFrame) -> DataFrame:
    """Factors as text next to the columns of ``df``, and the label as a double."""
    texts = [F.col(c).cast("string").alias(f"{c}_text") for c in FACTORS]
    return df.select("*", *texts, F.col(LABEL).cast("double").alias("label"))


KEY = ("insert_date", "licenceplate", "item_number")
TRIES = ("2", "0.5", "1.0")  # candidates for the columns per split: two, half of them, all


def tote_resampling(
    df: DataFrame, folds: int = 10, repeats: int = 10, seed: int = 102, trees: int = 500, tries: Sequence[str] = TRIES, key: Sequence[str] = KEY
) -> DataFrame:
    """[place, columns, accuracy, spread, resamples]: held-out accuracy of forests by repeated cross-validation, for each of ``tries``."""
    return resampled_accuracy(df, NUMBERS, FACTORS, LABEL, POSITIVE, key, tries, folds, repeats, trees, seed, MOST_DEPTH)


def tote_classifier(
    df: DataFrame, folds: int = 10, repeats: int = 10, seed: int = 102, trees: int = 500, tries: Sequence[str] = TRIES, key: Sequence[str] = KEY
) -> PipelineModel:
    """A forest whose columns per split are chosen by repeated cross-validation, fitted on all of ``df``.

    ``tries`` are the candidates: a number of columns or a share of them; the first of the best is taken. All resamples are one job.
    """
    frame = materialize(model_frame(df))
    stages, forest = _stages(trees, seed)
    best = tries[0]
    if len(tries) > 1:
        scored = tote_resampling(frame, folds, repeats, seed, trees, tries, key).collect()
        best = min(scored, key=lambda r: (-r.accuracy, r.place)).columns if scored else best
    return Pipeline(stages=stages).copy({forest.featureSubsetStrategy: best}).fit(frame)


SCORES = 1000  # scores are pooled to so many values before they are calibrated


def out_of_fold_scores(df: DataFrame, columns: str, folds: int, seed: int, trees: int, key: Sequence[str]) -> DataFrame:
    """[score, label] of every row of ``df``, scored by a forest that was fitted without its fold."""
    frame = materialize(hash_folds(model_frame(df), key, folds, seed, "_fold"))
    stages, forest = _stages(trees, seed)
    pipeline = Pipeline(stages=stages).copy({forest.featureSubsetStrategy: columns})
    scored = None
    for fold in [r["_fold"] for r in frame.select("_fold").distinct().orderBy("_fold").collect()]:
        model = pipeline.fit(frame.where(F.col("_fold") != fold))
        held = model.transform(frame.where(F.col("_fold") == fold)).select(vector_to_array("probability")[1].alias("score"), "label")
        scored = held if scored is None else scored.unionByName(held)
    return materialize(scored)


def calibrated(
    model: PipelineModel, df: DataFrame, folds: int = 5, seed: int = 102, trees: int = 500, columns: str = TRIES[0],
    key: Sequence[str] = KEY, population: DataFrame | None = None,
) -> PipelineModel:
    """``model`` with a last stage that turns its votes into ``chance``, the probability that a tote is taken.

    An increasing function is fitted to scores of ``df`` out of fold, as votes of the rows a forest was grown on say little. ``df`` has
    both classes in every set of folds. If it is a sample by class, ``population`` gives the share of each class: rows weigh accordingly.
    """
    scored = out_of_fold_scores(df, columns, folds, seed, trees, key)
    weight = F.lit(1.0)
    if population is not None:
        # two rows each: the classes
        sampled, real = ({r["y"]: r["n"] for r in d.groupBy(F.col(c).cast("double").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()} for d, c in ((scored, "label"), (population, LABEL)))
        for y, n in sampled.items():
            weight = F.when(F.col("label") == y, real.get(y, 0) / n).otherwise(weight)
    pooled = scored.withColumn("weight", weight).groupBy(F.rint(F.col("score") * SCORES).alias("_place")).agg(
        (F.sum(F.col("score") * F.col("weight")) / F.sum("weight")).alias("score"),
        (F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("label"),
        F.sum("weight").alias("weight"),
    ).where("weight > 0")
    rising = IsotonicRegression(featuresCol="score", labelCol="label", weightCol="weight").fit(pooled)
    rising.setFeaturesCol("probability").setFeatureIndex(1).setPredictionCol("chance")
    return PipelineModel(stages=[*model.stages, rising])


def chances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``chance``, from 0 to 1, by a model that ``calibrated`` gave."""
    return model.transform(model_frame(df)).select(*df.columns, "chance")


def calibration(scored: DataFrame, chance: str = "chance", label: str = LABEL, bins: int = 10) -> DataFrame:
    """[bin, rows, expected, observed, low, high]: mean chance and share taken by tenths of the chance, with the share's exact interval."""
    place = F.least(F.floor(F.col(chance) * bins), F.lit(bins - 1)).cast("int").alias("bin")
    taken = F.sum((F.col(label) == POSITIVE).cast("int")).alias("taken")
    found = scored.groupBy(place).agg(F.count(F.lit(1)).alias("rows"), F.avg(chance).alias("expected"), taken)
    low, high = exact_interval(F.col("taken"), F.col("rows"))
    return found.select("bin", "rows", "expected", (F.col("taken") / F.col("rows")).alias("observed"), low.alias("low"), high.alias("high"))


def classify(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``predicted``."""
    scored = model.transform(model_frame(df))
    return scored.select(*df.columns, F.col("prediction").cast("long").alias("predicted"))


def save_model(model: PipelineModel, path: str) -> None:
    """Stores a fitted model, replacing what ``path`` holds."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A stored model."""
    return PipelineModel.load(path)
