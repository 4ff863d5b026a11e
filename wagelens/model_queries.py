"""Model queries of the contract.

Each trains on the model input derived from the driver tables (via the
warehouse star schema) with fixed seeds and returns a small result frame.  A
fit is made once per session and folder and shared by the queries that need it.
Scores have no SQL form; what SQL can state about the results (test rows,
scored combinations, clustered rows, rules that no node, residual, label or
score may break) is checked by queries of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagelens.operators import models as M
from wagelens.plans import gold as G

LINEAR, FOREST = "Regresión Lineal", "Random Forest"
_FITS: dict[tuple, object] = {}


def _shared(spark: SparkSession, sf_dir: str, name: str, fit: Callable):
    """fit(model input), once per session, folder and name."""
    from wagelens.contract import star, warehouse
    wh, _ = warehouse(spark, sf_dir)
    key = (wh.root, name)
    if key not in _FITS:
        _FITS[key] = fit(G.model_input(star(spark, sf_dir)))
    return _FITS[key]


def _linear(spark, sf_dir):
    return _shared(spark, sf_dir, "linear", lambda df: M.fit_and_score(M.linear_regression(), df, LINEAR))


def _forest(spark, sf_dir):
    return _shared(spark, sf_dir, "forest", lambda df: M.fit_and_score(M.random_forest(), df, FOREST))


def _clusters(spark, sf_dir):
    return _shared(spark, sf_dir, "kmeans", M.kmeans_clusters)


def q_linear_regression_scores(spark, sf_dir):
    return _linear(spark, sf_dir)[2]


def q_actual_vs_predicted(spark, sf_dir):
    return M.actual_vs_predicted(_linear(spark, sf_dir)[1])


def q_model_test_actuals(spark, sf_dir):
    """Actual wages of the test rows that have a prediction."""
    return M.actual_vs_predicted(_linear(spark, sf_dir)[1]).where(F.col("predicho").isNotNull()).select("real")


def q_forest_scores(spark, sf_dir):
    return _forest(spark, sf_dir)[2]


def q_feature_importance(spark, sf_dir):
    return M.feature_importance(_forest(spark, sf_dir)[0])


def _forest50(spark, sf_dir):
    return _shared(spark, sf_dir, "forest50", lambda df: M.fit_and_score(M.comparison_forest(), df, FOREST))


def _app(spark, sf_dir):
    from wagelens.contract import star
    return _shared(spark, sf_dir, "app", lambda _: M.app_forest().fit(G.app_input(star(spark, sf_dir))))


def q_model_comparison(spark, sf_dir):
    both = _linear(spark, sf_dir)[2].unionByName(_forest50(spark, sf_dir)[2])
    return both.where(F.col("metrica") == "r2").select("modelo", F.col("valor").alias("r2"))


def q_kmeans_clusters(spark, sf_dir):
    return _clusters(spark, sf_dir).labelled


def q_cluster_rows(spark, sf_dir):
    return _clusters(spark, sf_dir).labelled.groupBy("cluster").agg(F.count("*").alias("n")).agg(F.sum("n").alias("filas"))


def q_cluster_violations(spark, sf_dir):
    return M.nearer_elsewhere(_clusters(spark, sf_dir))


def q_silhouette(spark, sf_dir):
    found = _clusters(spark, sf_dir)
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("silhouette", T.DoubleType()), T.StructField("error_bound", T.DoubleType())])
    return spark.createDataFrame([(len(found.centres), found.silhouette, found.error_bound)], schema)


def q_score_batch(spark, sf_dir):
    from wagelens.contract import star
    return M.score_batch(_app(spark, sf_dir), G.app_input(star(spark, sf_dir)).select(*M.APP_CATEGORICALS).distinct())


def q_score_batch_levels(spark, sf_dir):
    """The combinations that got a score."""
    return q_score_batch(spark, sf_dir).where(F.col("salario_estimado").isNotNull()).select(*M.APP_CATEGORICALS)


def q_exact_split(spark, sf_dir):
    """M3: exactly ceil(0.2 n) test rows."""
    from wagelens.contract import star
    return M.with_split(G.model_input(star(spark, sf_dir)))


def q_forest_rules(spark, sf_dir):
    """Nodes of the three forests that break a rule of their fit (minimum split size, depth, sums)."""
    out = None
    for name, model in (("200", _forest(spark, sf_dir)[0]), ("50", _forest50(spark, sf_dir)[0]), ("app", _app(spark, sf_dir))):
        each = model.violations().select(F.lit(name).alias("bosque"), "rule", "violations")
        out = each if out is None else out.unionByName(each)
    return out


def q_linear_residuals(spark, sf_dir):
    from wagelens.contract import star
    train, _ = M.train_test(G.model_input(star(spark, sf_dir)))
    return M.residual_sums(_linear(spark, sf_dir)[0], train)


def q_score_violations(spark, sf_dir):
    """Scores that differ from Spark ML's evaluators on the same predictions, and forest predictions beyond all labels."""
    from pyspark.ml.evaluation import RegressionEvaluator

    from wagelens.contract import star
    rows = []
    for name, (_, pred, scores) in (("lineal", _linear(spark, sf_dir)), ("bosque", _forest(spark, sf_dir)), ("bosque50", _forest50(spark, sf_dir))):
        for r in scores.collect():  # two rows
            other = RegressionEvaluator(labelCol=M.LABEL, predictionCol="prediction", metricName=r.metrica).evaluate(pred)
            rows.append((name, r.metrica, int(abs(other - r.valor) > 1e-9 * (1 + abs(other)))))
    out = spark.createDataFrame(rows, "modelo string, regla string, violaciones long")
    star_ = star(spark, sf_dir)
    for name, frame, labels in (("bosque", _forest(spark, sf_dir)[1].select(F.col("prediction").alias("p")), G.model_input(star_)),
                                ("app", q_score_batch(spark, sf_dir).select(F.col("salario_estimado").alias("p")), G.app_input(star_))):
        out = out.unionByName(M.outside_labels(frame, labels, name).select("modelo", F.lit("fuera").alias("regla"), F.col("fuera").alias("violaciones")))
    return out


MODEL_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "linear_regression_scores": q_linear_regression_scores,
    "actual_vs_predicted": q_actual_vs_predicted,
    "model_test_actuals": q_model_test_actuals,
    "forest_scores": q_forest_scores,
    "feature_importance": q_feature_importance,
    "model_comparison": q_model_comparison,
    "kmeans_clusters": q_kmeans_clusters,
    "cluster_rows": q_cluster_rows,
    "silhouette": q_silhouette,
    "score_batch": q_score_batch,
    "score_batch_levels": q_score_batch_levels,
    "exact_split": q_exact_split,
    "forest_rules": q_forest_rules,
    "linear_residuals": q_linear_residuals,
    "cluster_violations": q_cluster_violations,
    "score_violations": q_score_violations,
}
