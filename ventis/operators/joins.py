"""Joins between measurements, weather, dimensions and the store."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ventis.functions.air import ica_category
from ventis.functions.dates import hour_floor
from ventis.functions.sensors import sensor_type_from_code
from ventis.functions.text import normalize_comuna
from ventis.operators.filters import DAY, MeasurementFilter
from ventis.operators.ranking import first_per_key
from ventis.schemas import DETAIL_COLUMNS, MEASUREMENT_COLUMNS, MODELING_COLUMNS, WEATHER
from ventis.session import materialize
from ventis.sources.star import Star

NO_FILTER = MeasurementFilter()


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL matches NULL; key columns are kept from the left side."""
    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_r_{key}")) for key in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{key}" for key in keys])


def join_weather(measurements: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join on municipality, region and hour; NULL keys match NULL keys.

    Several weather rows of one key repeat the measurement. Missing keys can be many, and all
    share one key value: adaptive execution splits such a partition.
    """
    hours = weather.select("comuna", "region", hour_floor("fecha_hora").alias("_hora"), *WEATHER)
    extra = [c for c in measurements.columns if c not in MEASUREMENT_COLUMNS]
    hourly = measurements.drop(*WEATHER).withColumn("_hora", hour_floor("fecha_hora"))
    joined = null_safe_join(hourly, hours, ["comuna", "region", "_hora"], "left")
    return joined.select(*extra, *MEASUREMENT_COLUMNS)


def star_join(star: Star, where: MeasurementFilter = NO_FILTER) -> DataFrame:
    """Fact with station and municipality, each filter applied on its own side first."""
    fact = star.monitoreo.filter(where.on_fact(star.monitoreo))
    places = star.places().filter(where.on_place())
    return fact.join(places, "id_estacion")


def measurement_details(star: Star, where: MeasurementFilter = NO_FILTER) -> DataFrame:
    return star_join(star, where).select(*DETAIL_COLUMNS)


def measurement_by_id(star: Star, id_monitoreo: int) -> DataFrame:
    """At most one row; the id filter reaches the fact scan."""
    fact = star.monitoreo.filter(F.col("id_monitoreo") == id_monitoreo)
    return fact.join(star.places(), "id_estacion").select(*DETAIL_COLUMNS)


def modeling_dataset(star: Star, where: MeasurementFilter = NO_FILTER,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Measurements with municipality context and category.

    Emissions are reduced to one row per municipality before the join, so several industries
    do not repeat a measurement.
    """
    emission = star.industrias.groupBy("id_comuna").agg(
        F.max("emision_maxima_permitida").alias("emision_maxima_permitida")
    )
    places = star.places().filter(where.on_place()).join(emission, "id_comuna", "left").select(
        "id_estacion", "id_comuna", "comuna", "region",
        F.col("codigo_unico").alias("codigo_estacion"), F.col("tipo").alias("tipo_sensor"),
        "indice_vulnerabilidad_respiratoria", "emision_maxima_permitida",
    )
    return (
        star.monitoreo.filter(where.on_fact(star.monitoreo))
        .join(places, "id_estacion")
        .withColumn("categoria_ica", ica_category(F.col("mp25")))
        .select(*keep, *MODELING_COLUMNS)
    )


def resolve_codes(codes: DataFrame, stations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Stored station of each (``_code``, ``_place``) pair.

    Exact code first, then the hand mapping, then the only station of the same municipality and
    sensor type. A hand mapping whose target is missing ends the search.
    """
    stations = stations.filter(F.col("id_estacion").isNotNull() & (F.col("codigo_unico") != ""))
    # One row per code even when the catalogue repeats one; the newest id wins.
    by_code = stations.groupBy("codigo_unico").agg(F.max("id_estacion").alias("_id"))
    exact = by_code.select(F.col("codigo_unico").alias("_code"), F.col("_id").alias("_exacto"))
    manual = (
        mapping.select(
            F.trim("codigo_estacion_raw").alias("_code"),
            F.col("codigo_unico_api").alias("_manual_codigo"),
        )
        .join(by_code, F.col("_manual_codigo") == F.col("codigo_unico"), "left")
        .select("_code", "_manual_codigo", F.col("_id").alias("_manual_id"),
                F.lit(True).alias("_en_mapeo"))
    )
    candidates = (
        stations.filter(F.col("tipo").isNotNull())
        .groupBy(normalize_comuna("comuna").alias("_place"), F.col("tipo").alias("_kind"))
        .agg(
            F.count("*").alias("_candidatas"),
            F.min("id_estacion").alias("_unica_id"),
            F.min("codigo_unico").alias("_unica_codigo"),
        )
    )
    joined = (
        codes.withColumn("_kind", sensor_type_from_code(F.col("_code")))
        .join(exact, "_code", "left")
        .join(manual, "_code", "left")
        .join(candidates, ["_place", "_kind"], "left")
    )
    is_exact = F.col("_exacto").isNotNull()
    is_manual = F.col("_en_mapeo").isNotNull()
    can_guess = F.col("_place").isNotNull() & F.col("_kind").isNotNull()
    one = F.col("_candidatas") == 1
    return joined.select(
        "_code", "_place",
        F.when(is_exact, F.col("_exacto")).when(is_manual, F.col("_manual_id"))
        .when(one, F.col("_unica_id")).alias("id_estacion"),
        F.when(is_exact, F.col("_code")).when(is_manual, F.col("_manual_codigo"))
        .when(one, F.col("_unica_codigo")).alias("codigo_unico_api"),
        F.when(is_exact, "exacto_api").when(is_manual, "mapeo_manual_csv")
        .when(can_guess, "heuristico_seguro").otherwise("sin_mapeo").alias("modo_mapeo"),
        F.when(is_exact, None)
        .when(is_manual, F.when(F.col("_manual_id").isNull(), "codigo_api_no_disponible"))
        .when(one, None)
        .when(F.col("_candidatas") > 1, "estacion_ambigua")
        .otherwise("estacion_no_encontrada").alias("motivo_omision"),
    )


def resolve_stations(measurements: DataFrame, stations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Find the stored station of each measurement.

    Adds ``id_estacion``, ``codigo_unico_api``, ``modo_mapeo`` and ``motivo_omision`` (NULL when
    resolved). ``stations`` needs id_estacion, codigo_unico, tipo, comuna.

    The outcome depends on code and municipality only, so the chain runs over the distinct
    pairs. Its result is written once: Spark then knows its real size and broadcasts it when
    small, so the measurements are not shuffled once per step; a large one is merge-joined.
    """
    keyed = measurements.drop("id_estacion").withColumns({
        "_code": F.trim("codigo_estacion"), "_place": normalize_comuna("comuna"),
    })
    pairs = keyed.select("_code", "_place").distinct()
    resolved = materialize(resolve_codes(pairs, stations, mapping), "estaciones")
    return null_safe_join(keyed, resolved, ["_code", "_place"], "left").drop("_code", "_place")


def _stored_keys(store: DataFrame, incoming: DataFrame) -> DataFrame:
    """(station, timestamp) keys of the store on the days of the incoming rows.

    A stray timestamp adds its own day and nothing between. On a store partitioned by ``fecha``
    the join prunes folders when it runs; Spark broadcasts the days by their real size.
    """
    ts = F.col("fecha_hora")
    # The comparison holds for every timestamp; it tells the planner that pruning is worth while.
    days = incoming.filter(ts >= F.lit("0001-01-01").cast("timestamp_ntz")).select(
        F.to_date(ts).alias(DAY)).distinct()
    dated = store if DAY in store.columns else store.withColumn(DAY, F.to_date(ts))
    return dated.join(days, DAY, "left_semi").select("id_estacion", "fecha_hora")


def new_measurements(incoming: DataFrame, store: DataFrame,
                     range_of: DataFrame | None = None) -> DataFrame:
    """Incoming rows whose (station, timestamp) is not stored yet.

    ``range_of`` gives the days when ``incoming`` is costly to compute: any frame that
    holds at least its timestamps.
    """
    known = _stored_keys(store, incoming if range_of is None else range_of)
    return incoming.join(known, ["id_estacion", "fecha_hora"], "left_anti")


def existing_measurements(incoming: DataFrame, store: DataFrame,
                          range_of: DataFrame | None = None) -> DataFrame:
    """Incoming rows already stored, with the reason."""
    known = _stored_keys(store, incoming if range_of is None else range_of)
    return incoming.join(known, ["id_estacion", "fecha_hora"], "left_semi").withColumn(
        "motivo_omision", F.lit("medicion_ya_existente")
    )


def insert_absent(incoming: DataFrame, existing: DataFrame, keys: Sequence[str],
                  order: Sequence[str] = ()) -> DataFrame:
    """Rows to append so that each natural key is stored once.

    Of rows with one key the first by ``order`` (by default all columns) is stored. A key with a
    NULL equals no other key, as in a unique constraint, so all such rows are stored.
    """
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    names = [*order, *(c for c in incoming.columns if c not in order)]
    first = first_per_key(incoming.filter(known), keys, [F.col(c).asc_nulls_last() for c in names])
    absent = first.join(existing.select(*keys).distinct(), list(keys), "left_anti")
    return absent.select(*incoming.columns).unionByName(incoming.filter(~known))


def region_coverage(star: Star) -> DataFrame:
    """Municipalities and stations per region, also where there is no station."""
    per_comuna = star.estaciones.groupBy("id_comuna").agg(
        F.countDistinct("id_estacion").alias("n")
    )
    return (
        star.comunas.join(per_comuna, "id_comuna", "left")
        .groupBy("region")
        .agg(
            F.countDistinct("id_comuna").alias("comunas"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("sensores"),
        )
        .orderBy("region")
    )


def missing_slots(star: Star, step_hours: int = 6) -> DataFrame:
    """Gaps of each station between the first and the last slot of the fact.

    Rows (id_estacion, desde, hasta, franjas): first and last missing slot and their number. A
    station without measurements has one row over the whole range. Observed slots are made
    distinct map-side; two marks per station, one step outside the range, close its series, so
    a stray timestamp lengthens gaps and never multiplies rows.
    """
    if step_hours < 1 or 24 % step_hours:
        raise ValueError("step_hours debe dividir el dia.")
    ts = F.col("fecha_hora")
    hour = F.hour(ts)
    day = F.to_date(ts).cast("timestamp_ntz")
    slot = day + F.make_dt_interval(F.lit(0), hour - hour % step_hours)
    step = F.expr(f"INTERVAL {step_hours} HOURS")
    seen = star.monitoreo.filter(ts.isNotNull()).select("id_estacion", slot.alias("franja")).distinct()
    span = seen.agg((F.min("franja") - step).alias("a"), (F.max("franja") + step).alias("b")).first()
    if span["a"] is None:
        return seen.select("id_estacion", F.col("franja").alias("desde"),
                           F.col("franja").alias("hasta"), F.lit(0).cast("long").alias("franjas"))
    ids = star.estaciones.select("id_estacion")
    marks = ids.select("id_estacion", F.explode(F.array(
        *[F.lit(edge).cast("timestamp_ntz") for edge in span])).alias("franja"))
    series = seen.join(ids, "id_estacion", "left_semi").unionByName(marks)
    following = F.lead("franja").over(Window.partitionBy("id_estacion").orderBy("franja"))
    return (
        series.withColumn("_next", following)
        .withColumn("franjas", F.expr(
            f"timestampdiff(HOUR, franja, _next) DIV {step_hours} - 1"))
        .filter(F.col("franjas") > 0)
        .select("id_estacion", (F.col("franja") + step).alias("desde"),
                (F.col("_next") - step).alias("hasta"), "franjas")
    )
