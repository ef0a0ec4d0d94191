"""Bulk ingest and load preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventis.operators.joins import existing_measurements, new_measurements, resolve_stations
from ventis.operators.quality import RANGES, Rule, messages
from ventis.operators.ranking import first_per_key
from ventis.schemas import OMITTED_COLUMNS, POLLUTANTS, WEATHER
from ventis.session import materialize

INGEST_COLUMNS = ["fecha_hora", "id_estacion", *POLLUTANTS, *WEATHER]
UNREADABLE = "_ilegibles"
# How an unreadable field is reported, by kind.
TYPE_ERRORS = {
    "fecha_hora": "Input should be a valid datetime",
    "id_estacion": "Input should be a valid integer, unable to parse string as an integer",
}
NUMBER_ERROR = "Input should be a valid number, unable to parse string as a number"
DUPLICATE_REASON = "Ya existe una medicion para esa estacion y fecha_hora."
UNKNOWN_STATION = "No existe estacion con id_estacion="
MAPPING_MODE = "exacto_api>mapeo_manual_csv>heuristico_seguro"
# Report column -> omission reason.
OMISSION_COUNTS = {
    "omitidas_por_estacion_no_encontrada": "estacion_no_encontrada",
    "omitidas_por_estacion_ambigua": "estacion_ambigua",
    "omitidas_por_codigo_api_no_disponible": "codigo_api_no_disponible",
    "omitidas_por_clima_requerido_api": "clima_requerido_por_api",
    "omitidas_por_medicion_ya_existente": "medicion_ya_existente",
}


def typed_payload(batch: DataFrame) -> DataFrame:
    """Text fields of a payload as typed columns, plus ``_ilegibles``, the fields whose text
    cannot be read. A field that is absent or null is NULL and not listed."""
    kinds = {"fecha_hora": "timestamp_ntz", "id_estacion": "bigint"}
    typed = {
        name: F.col(name).try_cast(kinds.get(name, "double")) if name in batch.columns
        else F.lit(None).cast(kinds.get(name, "double"))
        for name in INGEST_COLUMNS
    }
    finite = {
        name: value if name in kinds else
        F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
        for name, value in typed.items()
    }
    unreadable = F.array_compact(F.array(*[
        F.when(F.col(name).isNotNull() & finite[name].isNull(), F.lit(name))
        for name in INGEST_COLUMNS if name in batch.columns
    ]))
    return batch.withColumn(UNREADABLE, unreadable).withColumns(finite)


def payload_rules(typed: bool = False) -> list[Rule]:
    """Field rules of an incoming measurement: presence first, then bounds, field by field.

    ``typed`` tells an unreadable field, listed by :func:`typed_payload`, from an absent one.
    """
    rules = []
    for name in INGEST_COLUMNS:
        absent = F.col(name).isNull()
        if typed:
            unreadable = F.array_contains(UNREADABLE, name)
            rules.append(Rule(f"{name}: {TYPE_ERRORS.get(name, NUMBER_ERROR)}", unreadable))
            absent = absent & ~unreadable
        rules.append(Rule(f"{name}: Field required", absent))
        if name in (*POLLUTANTS, "velocidad_viento"):
            rules.append(
                Rule(f"{name}: Input should be greater than or equal to 0", F.col(name) < 0)
            )
        elif name in RANGES:
            low, high = RANGES[name]
            rules.append(Rule(
                f"{name}: Input should be greater than or equal to {low:g}", F.col(name) < low))
            rules.append(Rule(
                f"{name}: Input should be less than or equal to {high:g}", F.col(name) > high))
    return rules


def _field_errors(batch: DataFrame) -> DataFrame:
    return batch.withColumn("motivo", F.concat_ws(
        "; ", messages(payload_rules(UNREADABLE in batch.columns))))


def _unknown_station() -> Column:
    return F.concat(F.lit(UNKNOWN_STATION), F.col("id_estacion"))


def orphan_rows(batch: DataFrame, stations: DataFrame) -> DataFrame:
    """Rows whose station is not in the dimension, with the reason."""
    known = stations.select("id_estacion")
    return batch.join(known, "id_estacion", "left_anti").withColumn("motivo", _unknown_station())


def ingest_batch(batch: DataFrame, stations: DataFrame, store: DataFrame,
                 index: str = "indice") -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected rows (``indice``, ``motivo``) of a bulk payload.

    Checks run per row in this order: field rules, known station, duplicate of a stored row or
    of an earlier accepted row. An invalid earlier row does not block a later valid one.
    ``index`` must be unique; losers are found by it, so a hot key never meets in one task.
    Every row is decided once and written with its reason; both results are filters on that.
    """
    known = stations.select("id_estacion").distinct().withColumn("_conocida", F.lit(True))
    checked = _field_errors(batch).join(known, "id_estacion", "left").withColumn(
        "motivo",
        F.coalesce(
            F.nullif(F.col("motivo"), F.lit("")),
            F.when(F.col("_conocida").isNull(), _unknown_station()),
        ),
    ).drop("_conocida")
    candidates = checked.filter(F.col("motivo").isNull())
    winners = first_per_key(candidates, ["id_estacion", "fecha_hora"], [F.col(index).asc()])
    fresh = new_measurements(winners, store, range_of=batch).select(
        index, F.lit(True).alias("_nueva"))
    lost = F.when(F.col("_nueva").isNull(), DUPLICATE_REASON)
    decided = materialize(
        checked.join(fresh, index, "left").select(
            index, *INGEST_COLUMNS, F.coalesce("motivo", lost).alias("motivo")),
        "lote-revisado")
    return (
        decided.filter(F.col("motivo").isNull()).select(index, *INGEST_COLUMNS),
        decided.filter(F.col("motivo").isNotNull()).select(index, "motivo"),
    )


def insert_one(measurement: DataFrame, stations: DataFrame, store: DataFrame,
               index: str = "indice") -> DataFrame:
    """Single-row ingest: the accepted row, or an error.

    An unknown station raises ``LookupError``, any other rejection ``ValueError``.
    """
    accepted, rejected = ingest_batch(measurement, stations, store, index)
    problem = rejected.first()
    if problem is None:
        return accepted
    if problem["motivo"].startswith(UNKNOWN_STATION):
        raise LookupError(problem["motivo"])
    raise ValueError(problem["motivo"])


def error_details(rejected: DataFrame) -> DataFrame:
    """Rows (motivo, cantidad) per single reason, most frequent first.

    A row with several field errors counts for each; unknown stations count together, so the
    table is as small as the list of rules.
    """
    reason = F.when(F.col("motivo").startswith(UNKNOWN_STATION), F.array(F.lit(UNKNOWN_STATION))) \
        .otherwise(F.split("motivo", "; "))
    return (
        rejected.select(F.explode(reason).alias("motivo")).groupBy("motivo")
        .agg(F.count("*").alias("cantidad")).orderBy(F.desc("cantidad"), "motivo")
    )


def ingest_summary(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    return accepted.agg(F.count("*").alias("insertados")).select(
        "insertados", rejected.agg(F.count("*")).scalar().alias("errores")
    )


def resolve_for_load(valid: DataFrame, stations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Resolved measurements; those without full weather get an omission reason."""
    resolved = resolve_stations(valid, stations, mapping)
    incomplete = F.lit(False)
    for name in WEATHER:
        incomplete = incomplete | F.col(name).isNull()
    reason = F.coalesce(
        F.col("motivo_omision"), F.when(incomplete, F.lit("clima_requerido_por_api"))
    )
    return resolved.withColumn("motivo_omision", reason)


def split_load(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payload rows and omitted rows."""
    ready = resolved.filter(F.col("motivo_omision").isNull()).drop("motivo_omision")
    omitted = resolved.filter(F.col("motivo_omision").isNotNull()).select(*OMITTED_COLUMNS)
    return ready, omitted


def prepare_load(valid: DataFrame, stations: DataFrame, mapping: DataFrame,
                 store: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Payload and omitted rows of a load; with a store, rows already there are omitted too."""
    ready, omitted = split_load(resolve_for_load(valid, stations, mapping))
    if store is None:
        return ready, omitted
    stored = existing_measurements(ready, store, range_of=valid).select(*OMITTED_COLUMNS)
    return new_measurements(ready, store, range_of=valid), omitted.unionByName(stored)


def load_report(payload: DataFrame, omitted: DataFrame, dry_run: bool = True,
                inserted: int = 0, rejected: DataFrame | None = None) -> DataFrame:
    """One row with the counts of a load: independent aggregates, no per-reason scan.

    ``detalle_errores`` is a JSON list of rejection reasons and their counts; the rejected rows
    themselves are a table of their own.
    """
    errors, details = F.lit(0).cast("long"), F.lit("[]")
    if rejected is not None:
        listed = error_details(rejected).agg(F.to_json(F.sort_array(
            F.collect_list(F.struct("motivo", "cantidad")))))
        errors, details = rejected.agg(F.count("*")).scalar(), listed.scalar()
    by_reason = omitted.agg(*[
        F.count_if(F.col("motivo_omision") == reason).alias(name)
        for name, reason in OMISSION_COUNTS.items()
    ])
    ready = payload.agg(F.count("*")).scalar()
    with_id = (
        ready + F.col("omitidas_por_clima_requerido_api")
        + F.col("omitidas_por_medicion_ya_existente")
    )
    empty = "No hay mediciones nuevas compatibles para enviar a la API."
    done = "Payload preparado sin envio a API." if dry_run else ""
    return by_reason.select(
        F.lit("dry-run" if dry_run else "api").alias("modo"),
        ready.alias("total_preparadas"),
        with_id.alias("total_con_id_estacion"),
        *OMISSION_COUNTS,
        F.lit(inserted).cast("long").alias("insertados"),
        errors.alias("errores"),
        F.when(ready == 0, empty).otherwise(done).alias("mensaje"),
        F.lit(MAPPING_MODE).alias("modo_mapeo"),
        details.alias("detalle_errores"),
    )
