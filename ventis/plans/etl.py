"""Batch job: raw feeds to validated measurements, payload and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventis.functions.air import ica_category
from ventis.operators.features import fill_context
from ventis.operators.filters import DAY
from ventis.operators.ingest import INGEST_COLUMNS, ingest_batch, load_report, prepare_load
from ventis.operators.joins import join_weather, modeling_dataset
from ventis.operators.prepare import (
    number_rows, prepare_industries, prepare_measurements, prepare_weather, unify,
)
from ventis.operators.quality import flag_errors, split_validated
from ventis.schemas import MEASUREMENT_COLUMNS, MODELING_COLUMNS
from ventis.session import materialize
from ventis.sources.readers import read_all_sources
from ventis.sources.star import Star
from ventis.sources.writers import write_days, write_measurements, write_payload, write_table


@dataclass(frozen=True)
class LoadResult:
    payload: DataFrame
    omitted: DataFrame
    report: DataFrame


def transform_sources(sources: Mapping[str, DataFrame],
                      date_policy: str = "iso") -> dict[str, DataFrame]:
    """Clean measurements with weather, clean industries and clean weather, all lazy."""
    weather = prepare_weather(sources["clima_historico"], date_policy)
    measurements = unify(
        prepare_measurements(sources["mediciones_oficiales"], "oficial", date_policy),
        prepare_measurements(sources["sensores_comunitarios"], "comunitaria", date_policy),
    )
    return {
        "mediciones_limpias": join_weather(measurements, weather),
        "industrias_limpias": prepare_industries(sources["fiscalizacion_industrias"], date_policy),
        "clima_limpio": weather,
    }


def validate_measurements(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and error rows with a dense ``numero_fila`` in reading order.

    Numbering and flagging are written once, because both outputs read them.
    """
    flagged = materialize(flag_errors(number_rows(clean), "numero_fila"), "validadas")
    valid, errors = split_validated(flagged)
    return (
        valid.select("numero_fila", *MEASUREMENT_COLUMNS),
        errors.select(*MEASUREMENT_COLUMNS, "numero_fila", "motivo_error", "fase"),
    )


def load(valid: DataFrame, stations: DataFrame, mapping: DataFrame,
         store: DataFrame | None = None) -> LoadResult:
    """Payload, omitted rows and report; without a store it is a dry run."""
    payload, omitted = prepare_load(valid, stations, mapping, store)
    return LoadResult(payload, omitted, load_report(payload, omitted, dry_run=store is None))


def store_payload(result: LoadResult, stations: DataFrame, store: DataFrame,
                  path: str) -> tuple[LoadResult, DataFrame]:
    """Ingest a prepared payload and append the accepted rows to the fact table at ``path``.

    Returns the result with its final report, and the rejected rows. Both outputs are written
    before the append, so reading ``store`` from ``path`` itself is safe.
    """
    batch = materialize(
        result.payload.select(*INGEST_COLUMNS, F.monotonically_increasing_id().alias("indice")),
        "payload",
    )
    accepted, rejected = ingest_batch(batch, stations, store)
    accepted, rejected = materialize(accepted, "aceptadas"), materialize(rejected, "rechazadas")
    write_measurements(accepted.drop("indice"), path, mode="append")
    # Counts come from the files just written.
    report = load_report(result.payload, result.omitted, False, accepted.count(), rejected)
    return LoadResult(result.payload, result.omitted, materialize(report, "reporte")), rejected


def run_etl(spark: SparkSession, paths: Mapping[str, str], out: str, stations: DataFrame,
            mapping: DataFrame, store: DataFrame | None = None, store_path: str | None = None,
            date_policy: str = "iso", formats: Mapping[str, str] | None = None) -> LoadResult:
    """Read, clean, validate, prepare the load and write every output under ``out``.

    With ``store`` and ``store_path`` accepted rows are appended to the fact table; otherwise
    it is a dry run.
    """
    tables = transform_sources(read_all_sources(spark, paths, formats), date_policy)
    clean = materialize(tables["mediciones_limpias"], "limpias")
    valid, errors = validate_measurements(clean)
    result = load(valid, stations, mapping, store)
    result = LoadResult(
        materialize(result.payload, "carga"), materialize(result.omitted, "omitidas"),
        result.report,
    )
    if store is not None and store_path is not None:
        result, rejected = store_payload(result, stations, store, store_path)
        write_table(rejected, f"{out}/rechazadas_carga_api")
    outputs = {
        "mediciones_limpias": clean.drop("_seq"),
        "industrias_limpias": tables["industrias_limpias"],
        "clima_limpio": tables["clima_limpio"],
        "mediciones_validas": valid.drop("numero_fila"),
        "errores_etl": errors,
        "omitidas_carga_api": result.omitted,
    }
    for name, df in outputs.items():
        write_table(df, f"{out}/{name}")
    write_table(result.report, f"{out}/reporte_carga_api", "csv")
    write_payload(result.payload, f"{out}/payload_monitoreo_bulk")
    return result


def dataset_from_valid(valid: DataFrame) -> DataFrame:
    """Modelling columns from validated rows alone, for runs without a store."""
    return (
        fill_context(valid)
        .withColumn("categoria_ica", ica_category(F.col("mp25")))
        .select(*MODELING_COLUMNS)
    )


def export_dataset(star: Star, path: str, days: Sequence[date] | None = None) -> None:
    """The modelling dataset in one distributed write by day, no paging.

    ``days`` (for example those that late data touched) are computed and replaced alone; on a fact
    stored by day the scan opens only their folders.
    """
    if days is not None:
        fact = star.monitoreo
        wanted = F.to_date("fecha_hora").isin(list(days))
        if DAY in fact.columns:
            wanted = wanted & F.col(DAY).isin(list(days))
        star = replace(star, monitoreo=fact.filter(wanted))
    write_days(modeling_dataset(star), path, days)
