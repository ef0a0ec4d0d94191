"""Aggregates over the star schema.

Every rollup first reduces the fact per station (and day when needed), which Spark combines
map-side, and only then joins the dimensions. The fact is never shuffled row by row for these
queries, and a station holding a third of the rows costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventis.functions.air import (
    ALERT_CATEGORIES, CRITICAL_MP25, ica_category, ica_columns, icap_category,
)
from ventis.functions.numeric import round_half_up, safe_mean
from ventis.operators.filters import MeasurementFilter
from ventis.operators.joins import NO_FILTER
from ventis.sources.star import Star

# 24 h regulatory limits.
DAILY_NORMS = {"mp25": 50.0, "mp10": 130.0, "so2": 150.0, "no2": 100.0}
LOW_WIND = 1.5


def station_rollup(star: Star, where: MeasurementFilter = NO_FILTER,
                   by_day: bool = False) -> DataFrame:
    """Sum, count, maximum and row count of PM2.5 per station, with place columns."""
    keys = ["id_estacion"] + (["fecha"] if by_day else [])
    fact = star.monitoreo.filter(where.on_fact(star.monitoreo))
    if by_day:
        fact = fact.withColumn("fecha", F.to_date("fecha_hora"))
    mp25 = F.col("mp25")
    reduced = fact.groupBy(*keys).agg(
        F.sum(mp25).alias("_suma"),
        F.count(mp25).alias("_validas"),
        F.max(mp25).alias("_maximo"),
        F.count("*").alias("_filas"),
        F.count_if(mp25 >= CRITICAL_MP25).alias("_criticas"),
    )
    return reduced.join(star.places().filter(where.on_place()), "id_estacion")


def combine(rollup: DataFrame, *keys: str) -> DataFrame:
    """Re-aggregate a station rollup: exact mean, maximum, rows and non-null count per key."""
    total = rollup.groupBy(*keys).agg(
        F.sum("_suma").alias("_suma"),
        F.sum("_validas").alias("_validas"),
        F.max("_maximo").alias("_maximo"),
        F.sum("_filas").alias("_filas"),
        F.sum("_criticas").alias("_criticas"),
    )
    return total.withColumn("_media", safe_mean(F.col("_suma"), F.col("_validas")))


def _top(df: DataFrame, order: Sequence[Column], limit: int, maximum: int) -> DataFrame:
    if not 1 <= limit <= maximum:
        raise ValueError(f"limit debe estar entre 1 y {maximum}.")
    return df.orderBy(*order).limit(limit)


def general_summary(star: Star) -> DataFrame:
    """One row: table sizes, overall mean and maximum, municipality with the highest mean."""
    by_comuna = combine(station_rollup(star), "id_comuna", "comuna")
    worst = (
        by_comuna.orderBy(F.col("_media").desc_nulls_last(), "comuna").limit(1).select("comuna")
    )

    def size(df: DataFrame) -> Column:
        return df.agg(F.count("*")).scalar()

    return star.monitoreo.agg(
        F.count("*").alias("total_mediciones"),
        F.coalesce(round_half_up(F.avg("mp25")), F.lit(0.0)).alias("mp25_promedio"),
        F.coalesce(round_half_up(F.max("mp25")), F.lit(0.0)).alias("mp25_maximo"),
    ).select(
        size(star.comunas).alias("total_comunas"),
        size(star.estaciones).alias("total_estaciones"),
        size(star.industrias).alias("total_industrias"),
        "total_mediciones", "mp25_promedio", "mp25_maximo",
        worst.scalar().alias("comuna_mas_critica"),
    )


def mp25_by_comuna(star: Star, where: MeasurementFilter = NO_FILTER) -> DataFrame:
    means = combine(station_rollup(star, where), "id_comuna", "comuna", "region")
    return means.orderBy(F.col("_media").desc_nulls_last(), "comuna").select(
        "comuna", "region",
        round_half_up(F.col("_media")).alias("mp25_promedio"),
        F.col("_filas").alias("cantidad_mediciones"),
    )


def critical_comunas(star: Star, limit: int = 10) -> DataFrame:
    """Highest means first; the category comes from the rounded mean."""
    means = combine(station_rollup(star), "id_comuna", "comuna", "region")
    order = [F.col("_media").desc_nulls_last(), F.col("_maximo").desc_nulls_last(), F.col("comuna")]
    mean = round_half_up(F.col("_media"))
    return _top(means, order, limit, 100).select(
        "comuna", "region", mean.alias("mp25_promedio"),
        round_half_up(F.col("_maximo")).alias("mp25_maximo"),
        ica_category(mean).alias("categoria"),
    )


def daily_evolution(star: Star, where: MeasurementFilter = NO_FILTER) -> DataFrame:
    means = combine(station_rollup(star, where, by_day=True), "fecha", "id_comuna", "comuna")
    return means.orderBy("fecha", "comuna").select(
        "fecha", "comuna", round_half_up(F.col("_media")).alias("mp25_promedio")
    )


def ica_by_comuna(star: Star, where: MeasurementFilter = NO_FILTER) -> DataFrame:
    """Category, advice and colour of each municipality, from its rounded mean."""
    return mp25_by_comuna(star, where).drop("cantidad_mediciones").withColumns(
        ica_columns(F.col("mp25_promedio"))
    )


def sensor_ranking(star: Star, limit: int = 20) -> DataFrame:
    means = station_rollup(star).withColumn(
        "_media", safe_mean(F.col("_suma"), F.col("_validas"))
    )
    order = [F.col("_media").desc_nulls_last(), F.col("_filas").desc(), F.col("id_estacion")]
    return _top(means, order, limit, 100).select(
        "id_estacion", F.col("codigo_unico").alias("codigo_estacion"),
        F.col("tipo").alias("tipo_sensor"), "comuna",
        round_half_up(F.col("_media")).alias("mp25_promedio"),
        F.col("_filas").alias("cantidad_mediciones"),
    )


def rank_by(star: Star, *keys: str, where: MeasurementFilter = NO_FILTER) -> DataFrame:
    """Mean, maximum and non-null count of PM2.5 by place columns or by ``fecha``."""
    rollup = station_rollup(star, where, by_day="fecha" in keys)
    return (
        combine(rollup, *keys)
        .orderBy(F.col("_media").desc_nulls_last(), *keys)
        .select(
            *keys, F.col("_media").alias("mp25_promedio"),
            F.col("_maximo").alias("mp25_maximo"),
            F.col("_validas").alias("cantidad_mediciones"),
        )
    )


def station_daily(star: Star) -> DataFrame:
    return star.monitoreo.groupBy(F.to_date("fecha_hora").alias("fecha"), "id_estacion").agg(
        F.avg("mp25").alias("promedio_diario_mp25"), F.max("mp25").alias("maximo_diario_mp25")
    )


def icap_distribution(star: Star) -> DataFrame:
    category = icap_category(F.col("mp25"), F.col("mp10")).alias("categoria_icap")
    return (
        star.monitoreo.groupBy(category)
        .agg(F.count("*").alias("cantidad_registros"))
        .orderBy("categoria_icap")
    )


def coverage(star: Star) -> DataFrame:
    """Rows, time span and distinct places that have measurements."""
    per_station = star.monitoreo.groupBy("id_estacion").agg(
        F.count("*").alias("n"), F.min("fecha_hora").alias("a"), F.max("fecha_hora").alias("b")
    )
    return per_station.join(star.places(), "id_estacion").agg(
        F.sum("n").alias("filas"), F.min("a").alias("fecha_minima"),
        F.max("b").alias("fecha_maxima"), F.countDistinct("region").alias("regiones"),
        F.countDistinct("id_comuna").alias("comunas"),
        F.countDistinct("id_estacion").alias("estaciones"),
    )


def episode_counts(star: Star, low_wind: float = LOW_WIND) -> DataFrame:
    """Per municipality: critical episodes, their share, and days of low ventilation.

    A day is low on ventilation when its mean wind speed is under ``low_wind``.
    """
    daily = (
        star.monitoreo.groupBy("id_estacion", F.to_date("fecha_hora").alias("fecha"))
        .agg(
            F.count("*").alias("n"), F.count_if(F.col("mp25") >= CRITICAL_MP25).alias("c"),
            F.sum("velocidad_viento").alias("v"), F.count("velocidad_viento").alias("nv"),
        )
        .join(star.places(), "id_estacion")
        .groupBy("id_comuna", "comuna", "region", "fecha")
        .agg(F.sum("n").alias("n"), F.sum("c").alias("c"),
             safe_mean(F.sum("v"), F.sum("nv")).alias("viento"))
    )
    return daily.groupBy("id_comuna", "comuna", "region").agg(
        F.sum("n").alias("mediciones"),
        F.sum("c").alias("episodios_criticos"),
        round_half_up(F.sum("c") * 100.0 / F.sum("n")).alias("porcentaje_critico"),
        F.count_if(F.round("viento", 9) < low_wind).alias("dias_baja_ventilacion"),
    ).drop("id_comuna")


def norm_exceedance(star: Star, norms: dict[str, float] | None = None) -> DataFrame:
    """Station days whose 24 h mean exceeds the limit, per pollutant."""
    norms = norms or DAILY_NORMS
    daily = star.monitoreo.groupBy("id_estacion", F.to_date("fecha_hora").alias("fecha")).agg(
        *[F.avg(name).alias(name) for name in norms]
    )
    pairs = [
        F.struct(
            F.lit(name).alias("contaminante"), F.lit(float(limit)).alias("norma_24h"),
            F.col(name).alias("media"),
        )
        for name, limit in norms.items()
    ]
    return (
        daily.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
        .groupBy("contaminante", "norma_24h")
        .agg(
            F.count("media").alias("dias_estacion"),
            F.count_if(F.round("media", 9) > F.col("norma_24h")).alias("excedencias"),
        )
    )


def critical_share(df: DataFrame, is_critical: Column) -> DataFrame:
    """Share of critical rows per municipality, worst first. Works on any labelled frame."""
    return (
        df.groupBy("region", "comuna")
        .agg(
            F.count("mp25").alias("cantidad_mediciones"),
            F.avg("mp25").alias("mp25_promedio"),
            F.max("mp25").alias("mp25_maximo"),
            round_half_up(
                F.count_if(is_critical) * 100.0 / F.count("*")
            ).alias("porcentaje_critico"),
        )
        .orderBy(F.desc("porcentaje_critico"), F.desc_nulls_last("mp25_promedio"), "comuna")
    )


def alert_share(category: Column) -> Column:
    """Percentage of rows in an alert category or worse."""
    return F.count_if(category.isin(*ALERT_CATEGORIES)) * 100.0 / F.count("*")
