"""Batch job: 24-hour forecast from dataset to stored model and report."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, SparkSession

from ventis.functions.text import repair_labels
from ventis.operators import features as X
from ventis.operators import forecast as P
from ventis.plans.segmentation import read_json, write_json
from ventis.schemas import MODELING_COLUMNS, require_columns
from ventis.session import materialize
from ventis.sources.writers import write_table


@dataclass(frozen=True)
class Forecasting:
    models: dict[str, PipelineModel]
    best: str
    metrics: dict
    predictions: DataFrame
    importance: DataFrame

    @property
    def model(self) -> PipelineModel:
        return self.models[self.best]


def run_forecast(dataset: DataFrame, steps: int = X.TARGET_STEPS,
                 train_fraction: float = X.TRAIN_FRACTION, forest: P.Forest = P.Forest(),
                 folds: int = 3, tie_break: list[str] | None = None) -> Forecasting:
    """Features, temporal split, candidates, cross-validation, best model and reports.

    The feature frame is written once and ranked once; split and folds are rank filters on it.
    """
    df = X.fill_context(repair_labels(dataset))
    require_columns(df, [c for c in MODELING_COLUMNS if c != "categoria_ica"], "regresion")
    if not df.filter(F.col(X.TIME).isNull()).isEmpty():
        raise ValueError(f"{X.TIME} tiene valores nulos; la serie no se puede ordenar.")
    order = [X.TIME, *(tie_break or [])]
    features = materialize(X.build_features(df, order, steps), "features")
    ranked = materialize(X.rank_in_time(X.training_rows(features), tie_break), "ranked")
    rows = ranked.count()
    cut = X.split_point(rows, train_fraction)
    train, test = X.temporal_split(ranked, train_fraction)

    models = P.fit_models(train, forest)
    scored = {name: P.predict(model, test) for name, model in models.items()}
    metrics = {name: P.metrics_dict(df) for name, df in scored.items()}
    best = P.best_model(metrics)
    summary = {
        "horizon_hours": X.HORIZON_HOURS,
        "sampling_frequency_hours": X.STEP_HOURS,
        "target_shift_steps": steps,
        "train_rows": cut,
        "test_rows": rows - cut,
        "best_model": best,
        "features_used": P.FEATURES,
        "models": metrics,
    }
    cv = P.cross_validate(train, cut, forest, folds) if folds else {}
    if cv:
        summary["time_series_cv"] = cv

    latest = P.forecast_rows(features, order)
    predictions = P.evaluation_report(scored[best]).unionByName(
        P.forecast_report(P.predict(models[best], latest))
    )
    importance = P.feature_importance(models[best], models[best].transform(latest))
    return Forecasting(models, best, summary, predictions, importance)


def save_forecast(result: Forecasting, out: str) -> None:
    spark = result.predictions.sparkSession
    result.model.write().overwrite().save(f"{out}/modelo")
    write_json(spark, result.metrics, f"{out}/metricas")
    write_table(result.predictions, f"{out}/predicciones")


def load_forecast(spark: SparkSession, out: str, legacy: str | None = None) -> tuple[PipelineModel, dict]:
    """Stored model and metrics; ``legacy`` is tried when ``out`` has none."""
    try:
        return PipelineModel.load(f"{out}/modelo"), read_json(spark, f"{out}/metricas")
    except (PySparkException, Py4JJavaError):
        if legacy is None:
            raise
        return load_forecast(spark, legacy)
