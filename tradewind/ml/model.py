"""Late-delivery classifier: Spark ML stages fitted on the training rows only."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.config import TrainingSettings
from tradewind.functions.ranking import grouped_percentile
from tradewind.ml.dataset import CATEGORICAL, NUMERIC, TARGET


def medians(train: DataFrame) -> DataFrame:
    """(feature, median): the midpoint of the two middle values, NULLs ignored."""
    long = train.select(*NUMERIC).unpivot([], list(NUMERIC), "feature", "value")
    return grouped_percentile(long, ["feature"], "value", 0.5, "median")


def scaling(train: DataFrame, fill: dict[str, float]) -> DataFrame:
    """One row: mean and population deviation of every numeric feature after imputation."""
    filled = {c: F.coalesce(F.col(c), F.lit(fill[c])) for c in NUMERIC}
    return train.agg(
        *[F.avg(v).alias(f"{c}_mean") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"{c}_std") for c, v in filled.items()],
    )


def fill_values(train: DataFrame) -> dict[str, float]:
    """Median of each numeric feature; a feature without any training value is an error."""
    found = {row["feature"]: row["median"] for row in medians(train).collect()}  # one row per feature
    empty = [c for c in NUMERIC if c not in found]
    if empty:
        raise ValueError(f"no training row has a value of {', '.join(empty)}")
    return {c: found[c] for c in NUMERIC}


def _preparation(train: DataFrame) -> SQLTransformer:
    """Impute and scale with constants from the training rows; they are saved with the stage."""
    fill = fill_values(train)
    row = scaling(train, fill).first()
    columns = ", ".join(
        f"(coalesce(`{c}`, {fill[c]!r}D) - {row[f'{c}_mean']!r}D) / {row[f'{c}_std'] or 1.0!r}D"
        f" AS `{c}_scaled`"
        for c in NUMERIC
    )
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def fit(train: DataFrame, settings: TrainingSettings = TrainingSettings()) -> PipelineModel:
    """Impute, scale, one-hot encode, then logistic regression with balanced class weights.

    The weights add up to the row count, so a penalty of 1 / (C n) weighs the L2 term as an
    inverse regularisation strength C does in a summed loss. The driver receives only constants:
    one median, mean and deviation per feature and the labels of the two category columns.
    """
    preparation = _preparation(train)
    indexed = [f"{c}_index" for c in CATEGORICAL]
    encoded = [f"{c}_hot" for c in CATEGORICAL]
    # "keep" gives unknown values the last index and the encoder drops that one: all zeros.
    indexer = StringIndexer(
        inputCols=list(CATEGORICAL), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
    ).fit(train)
    prepared = indexer.transform(preparation.transform(train))
    encoder = OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True).fit(prepared)
    assembler = VectorAssembler(inputCols=[f"{c}_scaled" for c in NUMERIC] + encoded, outputCol="features")

    label = F.col(TARGET).cast("double")
    classes = train.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("late")).first()
    n, late = classes["n"], classes["late"]
    if not n or late in (None, 0, n):
        raise ValueError("training rows must contain both classes")
    weight = F.when(label == 1, n / (2 * late)).otherwise(n / (2 * (n - late)))
    weighted = assembler.transform(encoder.transform(prepared)).select(
        "features", label.alias("label"), weight.alias("weight")
    )
    classifier = LogisticRegression(
        weightCol="weight",
        regParam=1.0 / (settings.inverse_regularization * n),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=settings.max_iter,
    ).fit(weighted)
    return PipelineModel([preparation, indexer, encoder, assembler, classifier])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input columns plus ``score``, the probability of a late delivery."""
    probability = vector_to_array("probability")[1]
    return model.transform(df).select(*df.columns, probability.alias("score"))


def gradient(model: PipelineModel, train: DataFrame, settings: TrainingSettings = TrainingSettings()) -> DataFrame:
    """(coefficient, gradient) of the fitted objective at the model's coefficients; zero at the optimum.

    The objective is the mean of the class-weighted log loss plus half the squared norm of the
    coefficients over C n; the intercept is not penalised.
    """
    indexer, classifier = model.stages[1], model.stages[-1]
    labels = [f"{c}={v}" for c, values in zip(CATEGORICAL, indexer.labelsArray) for v in values]
    names = [*NUMERIC, *labels]
    scored = model.transform(train).select(
        F.col(TARGET).cast("double").alias("y"), vector_to_array("features").alias("x"),
        vector_to_array("probability")[1].alias("p"),
    )
    row = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("late")).first()
    n, late = row["n"], row["late"]
    weight = F.when(F.col("y") == 1, n / (2 * late)).otherwise(n / (2 * (n - late)))
    error = (weight * (F.col("p") - F.col("y"))).alias("error")
    sums = scored.select(error, F.posexplode("x").alias("place", "value")).groupBy("place").agg(
        (F.sum(F.col("error") * F.col("value")) / n).alias("slope")
    )
    penalty = [float(b) / (settings.inverse_regularization * n) for b in classifier.coefficients]
    table = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(p).alias("penalty")) for c, p in zip(names, penalty)])
    own = sums.withColumn("c", table[F.col("place")]).select(
        F.col("c.name").alias("coefficient"), (F.col("slope") + F.col("c.penalty")).alias("gradient")
    )
    intercept = scored.agg((F.sum(error) / n).alias("gradient")).select(
        F.lit("intercept").alias("coefficient"), "gradient"
    )
    return own.unionByName(intercept)


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
