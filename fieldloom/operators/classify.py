"""Random forests and principal components on feature rows."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .samples import SEED, class_weights


def assemble(rows: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(rows)


def train_forest(samples: DataFrame, features: list[str], trees: int = 300, depth: int = 30, label: str = "class_id", seed: int = SEED) -> RandomForestClassificationModel:
    """A forest with balanced class weights.  Spark bins splits and limits depth to 30."""
    weights = class_weights(samples, label).select(label, "weight")
    rows = assemble(samples.join(F.broadcast(weights), label), features)  # a row per class
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed)
    return forest.fit(rows.withColumn(label, F.col(label).cast("double")))


def or_background(class_id: Column, features: list[str]) -> Column:
    """The class, or 0 where a feature is missing."""
    whole = F.lit(True)
    for f in features:
        whole = whole & F.col(f).isNotNull()
    return F.when(whole, class_id).otherwise(F.lit(0))


def predict(model: RandomForestClassificationModel, cells: DataFrame, features: list[str]) -> DataFrame:
    """(row, col, class_id) in one pass; rows with a missing feature are 0 whatever the model says."""
    kept = cells.select("row", "col", or_background(F.lit(1), features).alias("__whole"), *[F.coalesce(F.col(f), F.lit(0.0)).alias(f) for f in features])
    return model.transform(assemble(kept, features)).select("row", "col", F.when(F.col("__whole") == 1, F.col("prediction").cast("int")).otherwise(0).alias("class_id"))


def save_forest(model: RandomForestClassificationModel, classes: DataFrame, path: str) -> None:
    """The model and the class ids it was trained with, side by side."""
    model.write().overwrite().save(f"{path}/forest")
    classes.write.mode("overwrite").parquet(f"{path}/classes")


def load_forest(spark: SparkSession, path: str) -> tuple[RandomForestClassificationModel, DataFrame]:
    return RandomForestClassificationModel.load(f"{path}/forest"), spark.read.parquet(f"{path}/classes")


def fit_pca(sample: DataFrame, columns: list[str], components: int = 16) -> PipelineModel:
    """Centre, then project; Spark's PCA alone would not centre."""
    k = min(components, len(columns))
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="__raw"),
        StandardScaler(inputCol="__raw", outputCol="__centred", withMean=True, withStd=False),
        PCA(k=k, inputCol="__centred", outputCol="__pca"),
    ]).fit(sample)


def explained_variance(model: PipelineModel) -> float:
    return float(sum(model.stages[-1].explainedVariance))


def apply_pca(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Append ``deep_pca_00`` and so on; each component's largest loading is positive."""
    pca = model.stages[-1]
    loadings = pca.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(loadings.shape[1])]
    values = vector_to_array(F.col("__pca"))
    out = model.transform(rows).withColumns({f"deep_pca_{j:02d}": values[j] * s for j, s in enumerate(signs)})
    return out.drop("__raw", "__centred", "__pca")


def clean_key(name: Column) -> Column:
    """A checkpoint's parameter name without its wrapper's prefix."""
    return F.regexp_replace(F.regexp_replace(name, r"^model\.", ""), r"^backbone\.", "")


def backbone_keys(keys: DataFrame, column: str = "key") -> DataFrame:
    """Cleaned parameter names without those of the classification head."""
    out = keys.withColumn(column, clean_key(F.col(column)))
    return out.where(~F.col(column).startswith("fc.") & ~F.col(column).startswith("head."))
