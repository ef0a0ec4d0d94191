"""Batch job: risk segmentation from dataset to stored model."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession

from ventis.operators import cluster as C
from ventis.sources.writers import write_table


@dataclass(frozen=True)
class Segmentation:
    model: KMeansModel
    scaling: C.Scaling
    rows: DataFrame
    summary: DataFrame
    centroids: DataFrame
    sweep: DataFrame
    metrics: dict


def run_segmentation(dataset: DataFrame, k: int = 3, seed: int = 42, starts: int = 10,
                     low: int = 2, high: int = 6,
                     columns: Sequence[str] = C.CLUSTER_COLUMNS) -> Segmentation:
    """Scale, sweep k, keep the model of the wanted k, label and summarise.

    The sweep's own model is reused. Vectors are cached while the fits run over them.
    """
    scaling = C.fit_scaling(dataset, columns)
    vectors = C.assemble(dataset, scaling).select(C.FEATURES).persist()
    try:
        sweep, models = C.k_sweep(vectors, low, high, seed, starts)
        model = models.get(k) or C.fit_kmeans(vectors, k, seed, starts)
    finally:
        vectors.unpersist()
    assigned = model.transform(C.assemble(dataset, scaling)).drop(C.FEATURES)
    rows = C.assign_labels(assigned)
    summary = C.summarize_clusters(assigned)
    table = [row.asDict() for row in sweep.orderBy("n_clusters").collect()]
    chosen = next((row for row in table if row["n_clusters"] == k), {})
    metrics = {
        "n_clusters": k,
        "variables": scaling.columns,
        "inercia": chosen.get("inercia"),
        "silhouette": chosen.get("silhouette"),
        "silhouette_cuadrada": chosen.get("silhouette_cuadrada"),
        "evaluacion_k": table,
    }
    centers = C.centroids(model, scaling, dataset)
    return Segmentation(model, scaling, rows, summary, centers, sweep, metrics)


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    text = json.dumps(value, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def save_segmentation(result: Segmentation, out: str) -> None:
    spark = result.rows.sparkSession
    result.model.write().overwrite().save(f"{out}/modelo")
    write_json(spark, result.metrics, f"{out}/metricas")
    write_json(spark, {
        "columns": result.scaling.columns, "median": result.scaling.median,
        "mean": result.scaling.mean, "std": result.scaling.std,
    }, f"{out}/escala")
    write_table(result.rows, f"{out}/clusters")
    write_table(result.summary, f"{out}/resumen_clusters")


def load_segmentation(spark: SparkSession, out: str) -> tuple[KMeansModel, C.Scaling, dict]:
    model = KMeansModel.load(f"{out}/modelo")
    return model, C.Scaling(**read_json(spark, f"{out}/escala")), read_json(spark, f"{out}/metricas")
