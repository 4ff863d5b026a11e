"""Feature preparation, models and their checks.

* Linear regression: Spark ML over one-hot slots, every known level getting a slot and an unseen level being all zeros
  (StringIndexer ``keep`` + OneHotEncoder ``dropLast``: the dropped slot is the "unseen" index).
* Forests: exact CART rules (``operators/forest.py``), whose splits on levels are those of the one-hot slots.
* k-means with all restarts at once and the Euclidean silhouette: ``operators/clusters.py``.
* The test rows are exactly ceil(0.2 n) rows, those of the smallest md5 of the row key (``operators/split.py``).
* No fit depends on how its rows are partitioned, and none fixes a number of partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens import constants as C
from wagelens.operators import clusters as K
from wagelens.operators import forest as FO
from wagelens.operators.split import with_exact_share
from wagelens.session import scratch_path

MODEL_CATEGORICALS = ["sector_cnae", "comunidad"]
MODEL_NUMERIC = ["anio", "sexo_num"]
APP_CATEGORICALS = ["sector_cnae", "sexo", "comunidad"]
CLUSTER_FEATURES = ["salario", "sexo_num", "anio"]
LABEL = "salario"
#: The tuned forest splits nodes of 5 rows and more.
MIN_SPLIT = 5


# ------------------------------------------------------------------ A11


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation matrix in long form (var_a, var_b, corr).

    Computed as covar_pop / (std_pop * std_pop) in one aggregate; a zero
    variance gives NULL instead of a division error.
    """
    aggs = [F.stddev_pop(c).alias(f"sd__{c}") for c in cols]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs += [F.covar_pop(a, b).alias(f"cv__{a}__{b}") for a, b in pairs]
    row = df.agg(*aggs)
    cells = []
    for a in cols:
        for b in cols:
            sd_a, sd_b = F.col(f"sd__{a}"), F.col(f"sd__{b}")
            if a == b:
                value = F.when(sd_a > 0, F.lit(1.0))
            else:
                cv = F.col(f"cv__{a}__{b}") if f"cv__{a}__{b}" in row.columns else F.col(f"cv__{b}__{a}")
                value = F.when((sd_a > 0) & (sd_b > 0), cv / (sd_a * sd_b))
            cells.append(F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), value.alias("corr")))
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


# ------------------------------------------------------------------ M3


def split_key(df: DataFrame) -> Column:
    cents = F.round(F.col(LABEL) * 100, 0).cast("long").cast("string")
    return F.concat_ws("|", "fecha_iso", "comunidad", "sector_cnae", "sexo", cents)


def split_bucket(key: Column) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(100))


def with_bucket(df: DataFrame, test_fraction: float = C.TEST_FRACTION) -> DataFrame:
    """Adds ``en_test``: md5 bucket of the row key < test share (about 20 %, known without a pass over the rows)."""
    bucket = split_bucket(split_key(df))
    return df.withColumn("en_test", bucket < F.lit(int(round(test_fraction * 100))))


def with_split(df: DataFrame, test_fraction: float = C.TEST_FRACTION) -> DataFrame:
    """Adds ``en_test``: true for exactly ceil(test_fraction * n) rows, by the md5 of the row key."""
    return with_exact_share(df, split_key(df), test_fraction)


def train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    s = with_split(df)
    return s.where(~F.col("en_test")).drop("en_test"), s.where(F.col("en_test")).drop("en_test")


# ------------------------------------------------------------------ M1, M2


def encoder_stages(categoricals: Sequence[str], numeric: Sequence[str], features: str = "features") -> list:
    idx = [f"{c}__idx" for c in categoricals]
    ohe = [f"{c}__ohe" for c in categoricals]
    stages = []
    if categoricals:
        stages.append(StringIndexer(inputCols=list(categoricals), outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=list(numeric) + ohe, outputCol=features))
    return stages


def feature_names(model: PipelineModel, df: DataFrame, features: str = "features") -> list[str]:
    """Slot names of the assembled vector (numeric first, then '<column>_<level>')."""
    meta = model.transform(df.limit(0)).schema[features].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    names = [None] * meta.get("num_attrs", len(attrs))
    for a in attrs:
        name = a.get("name", str(a["idx"]))
        for c in MODEL_CATEGORICALS + APP_CATEGORICALS:
            name = name.replace(f"{c}__ohe_", f"{c}_")
        names[a["idx"]] = name
    return names


# ------------------------------------------------------------------ M4-M8, M14


def linear_regression(categoricals=MODEL_CATEGORICALS, numeric=MODEL_NUMERIC) -> Pipeline:
    return Pipeline(stages=encoder_stages(categoricals, numeric)
                    + [LinearRegression(featuresCol="features", labelCol=LABEL, regParam=0.0)])


@dataclass
class ForestModel:
    """A fitted forest, used like a Spark ML model."""
    forest: FO.Forest
    spec: "ForestRegressor"

    def transform(self, df: DataFrame) -> DataFrame:
        return self.forest.predict(df)

    def violations(self) -> DataFrame:
        return self.forest.violations(self.spec.min_split, self.spec.depth)


@dataclass
class ForestRegressor:
    trees: int
    depth: int | None
    min_split: int
    categoricals: Sequence[str]
    numeric: Sequence[str]

    def fit(self, df: DataFrame) -> ForestModel:
        return ForestModel(FO.fit(df, self.categoricals, self.numeric, LABEL, self.trees, self.depth, self.min_split, C.SEED), self)


def random_forest(trees: int = 200, depth: int | None = 10, min_split: int = MIN_SPLIT,
                  categoricals=MODEL_CATEGORICALS, numeric=MODEL_NUMERIC) -> ForestRegressor:
    return ForestRegressor(trees, depth, min_split, categoricals, numeric)


def scores(predictions: DataFrame, model_name: str) -> DataFrame:
    """R2 and mean absolute error in one pass (modelo, metrica, valor)."""
    error = F.col(LABEL) - F.col("prediction")
    row = predictions.agg((1 - F.sum(error * error) / (F.count(LABEL) * F.var_pop(LABEL))).alias("r2"), F.avg(F.abs(error)).alias("mae"))
    return row.select(F.lit(model_name).alias("modelo"), F.inline(F.array(*(F.struct(F.lit(m).alias("metrica"), F.col(m).alias("valor")) for m in ("r2", "mae")))))


def fit_and_score(pipeline, df: DataFrame, model_name: str):
    """(model, predictions of the test rows, scores); the predictions are written once."""
    train, test = train_test(df)
    model = pipeline.fit(train)
    path = scratch_path(df.sparkSession, f"predictions-{uuid.uuid4().hex}")
    model.transform(test).select(*df.columns, "prediction").write.parquet(path)
    pred = df.sparkSession.read.parquet(path)
    return model, pred, scores(pred, model_name)


def actual_vs_predicted(pred: DataFrame) -> DataFrame:
    return pred.select(F.col(LABEL).alias("real"), F.col("prediction").alias("predicho"))


def feature_importance(model: ForestModel, top: int = 10) -> DataFrame:
    """Top-``top`` forest importances with slot names (a top-k report)."""
    return model.forest.importances().orderBy(F.desc("importancia"), "variable").limit(top)


def comparison_forest() -> ForestRegressor:
    return random_forest(trees=50, depth=None, min_split=2)


def model_comparison(df: DataFrame) -> DataFrame:
    """R2 of linear regression vs a 50-tree forest of unbounded depth."""
    _, _, lr = fit_and_score(linear_regression(), df, "Regresión Lineal")
    _, _, rf = fit_and_score(comparison_forest(), df, "Random Forest")
    return lr.unionByName(rf).where(F.col("metrica") == "r2").select("modelo", F.col("valor").alias("r2"))


# ------------------------------------------------------------------ M7, M15


def app_forest() -> ForestRegressor:
    return random_forest(trees=100, depth=10, min_split=2, categoricals=APP_CATEGORICALS, numeric=[])


def score_batch(model: ForestModel, rows: DataFrame) -> DataFrame:
    """Predict a wage for every (sector, sex, region) row; unseen levels encode as zeros."""
    return model.transform(rows).select(*APP_CATEGORICALS, F.col("prediction").alias("salario_estimado"))


# ------------------------------------------------------------------ M11-M13, M16


@dataclass
class Clusters:
    labelled: DataFrame      # the rows with their cluster
    silhouette: float
    error_bound: float       # of the silhouette; 0 while rows are few enough to be told apart
    centres: np.ndarray      # standardised, in the order of their coordinates
    costs: np.ndarray        # of every restart
    standard: list           # the standardised features, as columns


def kmeans_clusters(df: DataFrame, k: int = C.KMEANS_K, restarts: int = C.KMEANS_RESTARTS) -> Clusters:
    """Standardise, run k-means with ``restarts`` seeds in the same scans, keep the least cost."""
    points, mean, deviation = K.standardised(df, CLUSTER_FEATURES)
    centres, costs = K.kmeans(points, len(CLUSTER_FEATURES), k, range(C.SEED, C.SEED + restarts))
    best = centres[int(np.argmin(costs))]
    best = best[np.lexsort(best.T[::-1])]
    silhouette, bound = K.silhouette(points, len(CLUSTER_FEATURES), best)
    standard = [(F.col(c).cast("double") - float(m)) / float(d) for c, m, d in zip(CLUSTER_FEATURES, mean, deviation, strict=True)]
    return Clusters(df.withColumn("cluster", K.nearest(best, standard)), silhouette, bound, best, costs, standard)


# ------------------------------------------------------------------ checks


def residual_sums(model, train: DataFrame, categoricals=MODEL_CATEGORICALS) -> DataFrame:
    """Residual sum per level of the training rows, as a share of the label's; least squares with a slot per level leaves 0."""
    pred = model.transform(train)
    levels = F.inline(F.array(*(F.struct(F.lit(c).alias("variable"), F.col(c).alias("nivel")) for c in categoricals)))
    return (pred.select(LABEL, "prediction", levels).groupBy("variable", "nivel")
            .agg(F.count("*").alias("n"), F.round(F.abs(F.sum(F.col(LABEL) - F.col("prediction"))) / F.sum(F.abs(LABEL)), 6).alias("resto")))


def nearer_elsewhere(found: Clusters) -> DataFrame:
    """Per cluster: rows that stand nearer to another cluster's centre than to their own (0 if the labels are right)."""
    far = F.array(*(sum((x - float(v)) ** 2 for x, v in zip(found.standard, centre, strict=True)) for centre in found.centres))
    return (found.labelled.select("cluster", F.posexplode(far).alias("otro", "lejos"), F.get(far, F.col("cluster")).alias("suyo"))
            .groupBy("cluster").agg(F.count_if(F.col("lejos") < F.col("suyo")).alias("mas_cerca_de_otro")))


def outside_labels(predictions: DataFrame, labels: DataFrame, model_name: str) -> DataFrame:
    """Predictions beyond the least or greatest label learned from (a forest's means can't be)."""
    bounds = labels.agg(F.min(LABEL).alias("least"), F.max(LABEL).alias("most"))
    beyond = (F.col("p") < F.col("least") * (1 - 1e-12)) | (F.col("p") > F.col("most") * (1 + 1e-12)) | F.col("p").isNull()
    return predictions.crossJoin(F.broadcast(bounds)).agg(F.lit(model_name).alias("modelo"), F.count_if(beyond).alias("fuera"))  # bounds is one row
