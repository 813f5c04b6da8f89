"""Preparing, fitting and scoring models on event rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import written
from .windows import row_numbers


def outcomes(df: DataFrame, targets: dict[str, Column], picks: list[tuple[str, Column]], other: str = "Other") -> DataFrame:
    """Target columns, and ``outcome``: the first label whose condition holds."""
    chosen = reduce(lambda w, p: w.when(p[1], p[0]), picks[1:], F.when(picks[0][1], picks[0][0])).otherwise(other)
    return df.withColumns(targets | {"outcome": chosen})


def inverse_weights(df: DataFrame, label: str, mask: Column, name: str = "weight") -> DataFrame:
    """Weights inverse to the label's frequency among unmasked rows, 0 for masked ones, with mean one over all rows."""
    sizes = df.where(mask).groupBy(label).agg((1.0 / F.count("*")).alias("_w"))
    weighted = df.join(sizes, label, "left").withColumn("_w", F.when(mask, F.col("_w")).otherwise(0.0))
    return weighted.crossJoin(weighted.agg(F.avg("_w").alias("_m"))).withColumn(name, F.try_divide(F.col("_w"), F.col("_m"))).drop("_w", "_m")


def features(df: DataFrame, numbers: dict[str, Column], caps: dict[str, float], categories: list[str], missing: str = "N/A") -> DataFrame:
    """Doubles, capped where told, and categories without nulls."""
    held = {n: (F.least(c.cast("double"), F.lit(float(caps[n]))) if n in caps else c.cast("double")) for n, c in numbers.items()}
    return df.withColumns(held | {c: F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in categories})


def split(df: DataFrame, group: str, test_percent: int = 2, key: Column | None = None) -> DataFrame:
    """Adds split, train or test, the same for all rows of a group; by a hash unless an integer key is given."""
    place = F.pmod(F.xxhash64(group) if key is None else key, F.lit(100))
    return df.withColumn("split", F.when(place < test_percent, "test").otherwise("train"))


def select_target(df: DataFrame, target: str, kind: str, weight: str | None = None, use_weight: bool = False) -> DataFrame:
    """Rows with a target; for binary targets and regression, or if told, with a positive weight too."""
    rows = df.where(F.col(target).isNotNull())
    return rows.where(F.col(weight) > 0) if weight and (use_weight or kind in ("binary", "regression")) else rows


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values with codes from 1; 0 is for what isn't among them."""
    return row_numbers(df.select(F.col(column).alias("value")).dropna().distinct(), ["value"], "code").withColumn("code", F.col("code").cast("int"))


def encode(df: DataFrame, vocabularies: dict[str, DataFrame], numbers: list[str]) -> DataFrame:
    """Codes for categories (column_code) and 0 for missing numbers. Vocabularies are lookups far smaller than the rows."""
    for column, words in vocabularies.items():
        df = df.join(words.select(F.col("value").alias(column), F.col("code").alias(f"{column}_code")), column, "left").fillna(0, [f"{column}_code"])
    return df.fillna(0.0, numbers)


def class_index(df: DataFrame, target: str, classes: DataFrame) -> DataFrame:
    """Adds label, the class number from 0; rows of unknown classes go."""
    return df.join(classes.select(F.col("value").alias(target), (F.col("code") - 1).cast("double").alias("label")), target)


def numeric_stats(df: DataFrame, numbers: list[str]) -> DataFrame:
    """Mean and population variance (at least 1e-6) of each column, in one pass."""
    one = df.agg(*[f(c).alias(f"{c}_{n}") for c in numbers for n, f in (("mean", F.avg), ("variance", lambda x: F.greatest(F.var_pop(x), F.lit(1e-6))))])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_variance").alias("variance")) for c in numbers])).alias("x")).select("x.*")


def fit(df: DataFrame, codes: list[str], numbers: list[str], kind: str, label: str = "label", weight: str | None = None) -> PipelineModel:
    """A linear model on one-hot codes and numbers: logistic for classes, least squares for regression."""
    hot = OneHotEncoder(inputCols=codes, outputCols=[f"{c}_hot" for c in codes], handleInvalid="keep")
    vector = VectorAssembler(inputCols=[f"{c}_hot" for c in codes] + numbers, outputCol="features")
    common = {"labelCol": label} | ({"weightCol": weight} if weight else {})
    model = LinearRegression(regParam=0.01, **common) if kind == "regression" else LogisticRegression(regParam=0.01, maxIter=20, family="multinomial" if kind == "multiclass" else "binomial", **common)
    return Pipeline(stages=[hot, vector, model]).fit(df)


def score(model: PipelineModel, df: DataFrame, keys: list[str], kind: str, run_id: str) -> DataFrame:
    """keys, run_id and: predicted with its probability, or the probability of 1, or a value."""
    out = model.transform(df)
    if kind == "regression":
        return out.select(*keys, F.lit(run_id).alias("run_id"), F.col("prediction").alias("value"))
    p = vector_to_array("probability")
    if kind == "binary":
        return out.select(*keys, F.lit(run_id).alias("run_id"), F.col("prediction").cast("int").alias("predicted"), p[1].alias("probability"))
    return out.select(*keys, F.lit(run_id).alias("run_id"), F.col("prediction").cast("int").alias("predicted"), F.array_max(p).alias("probability"))


def evaluate(scored: DataFrame, kind: str, label: str = "label") -> DataFrame:
    """One row: accuracy, or mean squared and mean absolute error."""
    if kind == "regression":
        e = F.col("value") - F.col(label)
        return scored.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.count("*").alias("n"))
    return scored.agg(F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("accuracy"), F.count("*").alias("n"))


@dataclass
class Fitted:
    """Models of several targets over one vector of features: what makes the vector, and for each target its kind, model and class names."""

    run_id: str
    prepare: PipelineModel
    models: dict[str, tuple[str, object, list[str]]]

    def save(self, folder: str) -> None:
        """Writes all under folder/run_id, where load finds it."""
        path = f"{folder}/{self.run_id}"
        self.prepare.write().overwrite().save(f"{path}/prepare")
        for name, (_, model, _) in self.models.items():
            model.write().overwrite().save(f"{path}/model-{name}")
        rows = [(name, kind, labels) for name, (kind, _, labels) in self.models.items()]
        SparkSession.active().createDataFrame(rows, "name string, kind string, labels array<string>").coalesce(1).write.mode("overwrite").parquet(f"{path}/targets")

    @classmethod
    def load(cls, spark, folder: str, run_id: str) -> Fitted:
        path = f"{folder}/{run_id}"
        kinds = {"regression": LinearRegressionModel}
        rows = spark.read.parquet(f"{path}/targets").collect()
        models = {r["name"]: (r["kind"], kinds.get(r["kind"], LogisticRegressionModel).load(f"{path}/model-{r['name']}"), list(r["labels"])) for r in rows}
        return cls(run_id, PipelineModel.load(f"{path}/prepare"), models)


def fit_targets(df: DataFrame, targets: list, numbers: list[str], categories: list[str], identities: list[str], run_id: str, hashed: int = 1024, rounds: int = 20) -> Fitted:
    """Linear models of all targets (name, column, weight, kind, weighed_only) from one vector: numbers, categories one-hot, and identities hashed to a fixed width.

    The vectors are worked out and written once. A category that wasn't seen has
    a place of its own; a target of one class is fitted as such.
    """
    clean = df.fillna(0.0, numbers).fillna("N/A", [*categories, *identities])
    codes = [f"{c}_code" for c in categories]
    parts = [StringIndexer(inputCols=categories, outputCols=codes, handleInvalid="keep"), OneHotEncoder(inputCols=codes, outputCols=[f"{c}_hot" for c in categories], handleInvalid="keep", dropLast=False)]
    parts += [FeatureHasher(inputCols=identities, outputCol="hashed", numFeatures=hashed), VectorAssembler(inputCols=[*numbers, *[f"{c}_hot" for c in categories], "hashed"], outputCol="features")]
    prepare = Pipeline(stages=parts).fit(clean)
    vectors = written(prepare.transform(clean).select("features", *{t.column for t in targets}, *{t.weight for t in targets}), "vectors")
    models = {}
    for t in targets:
        rows = select_target(vectors, t.column, t.kind, t.weight, t.weighed_only)
        common = {"labelCol": "label", "weightCol": t.weight, "regParam": 0.01}
        if t.kind == "regression":
            models[t.name] = t.kind, LinearRegression(**common).fit(rows.withColumn("label", F.col(t.column).cast("double"))), []
            continue
        labels = sorted(r[0] for r in rows.select(F.col(t.column).cast("string")).distinct().collect())  # classes, a few
        number = F.array_position(F.array(*map(F.lit, labels)), F.col(t.column).cast("string")) - 1
        model = LogisticRegression(maxIter=rounds, family="multinomial", **common).fit(rows.withColumn("label", number.cast("double")))
        models[t.name] = t.kind, model, labels
    return Fitted(run_id, prepare, models)


def score_targets(df: DataFrame, fitted: Fitted, key: str, numbers: list[str], categories: list[str], identities: list[str]) -> DataFrame:
    """key and a struct for each target: the class and its probability, the probability of 1, or the value. One pass, from one vector."""
    rows = fitted.prepare.transform(df.fillna(0.0, numbers).fillna("N/A", [*categories, *identities])).select(key, "features")
    outs = []
    for name, (kind, model, labels) in fitted.models.items():
        model = model.copy().setFeaturesCol("features").setPredictionCol(f"_p_{name}")
        if kind == "regression":
            rows = model.transform(rows)
            outs.append(F.struct(F.col(f"_p_{name}").alias("value")).alias(name))
            continue
        rows = model.setRawPredictionCol(f"_r_{name}").setProbabilityCol(f"_q_{name}").transform(rows).drop(f"_r_{name}")
        at, chances = F.col(f"_p_{name}").cast("int"), vector_to_array(f"_q_{name}")
        chosen = F.get(F.array(*map(F.lit, labels)), at)
        if kind == "binary":
            one = F.get(chances, F.lit(labels.index("1"))) if "1" in labels else F.lit(0.0)
            outs.append(F.struct(chosen.cast("int").alias("predicted"), one.alias("probability")).alias(name))
        else:
            outs.append(F.struct(chosen.alias("predicted_class"), F.get(chances, at).alias("predicted_class_proba")).alias(name))
    return rows.select(key, *outs)
