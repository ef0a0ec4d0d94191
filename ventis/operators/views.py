"""Frames behind the executive, technical and citizen views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventis.functions.air import (
    ALERT_CATEGORIES, CATEGORIES, citizen_outlook, ica_category, ordinal,
)
from ventis.functions.numeric import round_half_up, safe_mean
from ventis.operators.filters import ALERT_COLUMNS, alert_column
from ventis.operators.ranking import first_per_key
from ventis.operators.rollups import alert_share

RISK_ORDER = ["Bajo riesgo", "Riesgo moderado", "Riesgo crítico"]
OPTION_COLUMNS = ["region", "comuna", "tipo_sensor", "nivel_riesgo"]


def filter_options(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct non-blank choices per filter over all frames; alerts carry their severity."""
    parts = []
    for df in frames:
        fields = [(c, c) for c in OPTION_COLUMNS if c in df.columns]
        fields += [("categoria_alerta", c) for c in ALERT_COLUMNS if c in df.columns]
        if fields:
            pairs = [F.struct(F.lit(name).alias("filtro"), F.col(c).alias("valor"))
                     for name, c in fields]
            parts.append(df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").distinct())
    if not parts:
        raise ValueError("Ningun dataset tiene columnas de filtro.")
    options = parts[0]
    for part in parts[1:]:
        options = options.unionByName(part)
    severity = F.when(
        F.col("filtro") == "categoria_alerta", ordinal(F.col("valor"), CATEGORIES)
    ).otherwise(F.lit(0).cast("long"))
    return (
        options.filter(F.trim("valor") != "").distinct()
        .withColumn("prioridad", severity)
        .orderBy("filtro", "prioridad", "valor")
    )


def _mean_by_comuna(dataset: DataFrame) -> DataFrame:
    return dataset.filter(F.col("comuna").isNotNull()).groupBy("comuna").agg(
        F.avg("mp25").alias("m")
    )


def executive_kpis(dataset: DataFrame, forecast: DataFrame) -> DataFrame:
    """One row of headline figures for history and forecast."""
    worst = _mean_by_comuna(dataset).orderBy(F.desc_nulls_last("m"), "comuna").limit(1)
    alerts = F.count_if(F.col(alert_column(forecast)).isin(*ALERT_CATEGORIES))
    ahead = forecast.agg(
        round_half_up(F.avg("mp25_predicho_24h")).alias("m"), alerts.alias("n")
    )
    return dataset.agg(
        round_half_up(F.avg("mp25")).alias("mp25_promedio"),
        round_half_up(F.max("mp25")).alias("mp25_maximo"),
        F.count("*").alias("total_mediciones"),
        round_half_up(alert_share(F.col("categoria_ica"))).alias("porcentaje_alerta"),
    ).select(
        "*",
        worst.select("comuna").scalar().alias("comuna_mas_critica"),
        ahead.select("m").scalar().alias("pronostico_promedio"),
        ahead.select("n").scalar().alias("alertas_pronosticadas"),
    )


def executive_ranking(df: DataFrame, value: str = "mp25_predicho_24h", top_n: int = 12) -> DataFrame:
    """Municipalities with the highest mean; pass history with ``mp25`` when there is no forecast."""
    means = df.filter(F.col("comuna").isNotNull() & F.col("region").isNotNull()).groupBy(
        "comuna", "region"
    ).agg(F.avg(value).alias(value))
    return means.orderBy(F.desc_nulls_last(value), "comuna").limit(top_n)


def daily_trend(dataset: DataFrame) -> DataFrame:
    return (
        dataset.filter(F.col("fecha_hora").isNotNull())
        .groupBy(F.to_date("fecha_hora").alias("fecha"))
        .agg(F.avg("mp25").alias("mp25")).orderBy("fecha")
    )


def alert_counts(forecast: DataFrame) -> DataFrame:
    """Forecasts per category, mildest first."""
    name = alert_column(forecast)
    return (
        forecast.groupBy(F.col(name).alias("categoria")).agg(F.count("*").alias("cantidad"))
        .withColumn("prioridad", ordinal(F.col("categoria"), CATEGORIES))
        .orderBy("prioridad")
    )


def alert_summary(forecast: DataFrame, top_n: int = 12) -> DataFrame:
    """Highest forecast means by municipality and category, with their stations."""
    name = alert_column(forecast)
    return (
        forecast.groupBy("comuna", "region", F.col(name).alias("categoria"))
        .agg(
            F.avg("mp25_predicho_24h").alias("mp25_predicho_24h"),
            F.countDistinct("codigo_estacion").alias("estaciones"),
        )
        .orderBy(F.desc_nulls_last("mp25_predicho_24h"), "comuna", "categoria")
        .limit(top_n)
    )


def risk_distribution(clusters: DataFrame, levels: Sequence[str] = RISK_ORDER) -> DataFrame:
    """Rows and share per risk level; absent levels of ``levels`` count 0.

    The given levels come first, in their order, then all others by name. Rows without a level
    count in the total only.
    """
    known = F.array(*[F.lit(level) for level in levels])
    counts = clusters.groupBy("nivel_riesgo").agg(F.count("*").alias("n"))
    # One map of all levels: as many entries as there are levels.
    whole = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.map_from_entries(F.collect_list(F.when(
            F.col("nivel_riesgo").isNotNull(), F.struct("nivel_riesgo", "n")))).alias("counts"))
    named = F.concat(known, F.array_sort(F.array_except(F.map_keys("counts"), known)))
    share = F.col("cantidad_registros") * 100.0 / F.nullif(F.col("total"), F.lit(0))
    return (
        whole.select("total", "counts", F.posexplode(named).alias("orden", "nivel_riesgo"))
        .withColumn("cantidad_registros", F.coalesce(
            F.element_at("counts", F.col("nivel_riesgo")), F.lit(0).cast("long")))
        .select("orden", "nivel_riesgo", "cantidad_registros",
                round_half_up(share).alias("porcentaje"))
        .orderBy("orden")
    )


def cluster_summary_from_rows(clusters: DataFrame) -> DataFrame:
    """Summary rebuilt from labelled rows, largest cluster first."""
    means = ["mp25", "mp10", "so2", "no2", "humedad", "indice_vulnerabilidad_respiratoria",
             "emision_maxima_permitida", "velocidad_viento"]
    return (
        clusters.groupBy("cluster", "nivel_riesgo")
        .agg(F.count("*").alias("cantidad_registros"), *[F.avg(c).alias(c) for c in means])
        .orderBy(F.desc("cantidad_registros"))
    )


def recent_history(dataset: DataFrame, rows: int = 20) -> DataFrame:
    """Newest rows of every municipality. Map tasks keep at most ``rows`` per municipality."""
    newest = [F.desc_nulls_last("fecha_hora"), F.col("codigo_estacion").asc()]
    if "id_monitoreo" in dataset.columns:
        newest.append(F.col("id_monitoreo").asc())
    return first_per_key(
        dataset.filter(F.col("comuna").isNotNull()), ["comuna"], newest, rows
    ).select("comuna", "fecha_hora", "codigo_estacion", "mp25")


def citizen_status(dataset: DataFrame, forecast: DataFrame) -> DataFrame:
    """Current and expected state of every municipality, in plain language.

    The forecast is the mean over stations at the latest target time.
    """
    current = recent_history(dataset, 1).select(
        "comuna", F.col("fecha_hora").alias("fecha_ultima"), F.col("mp25").alias("mp25_actual"),
        F.coalesce(ica_category(F.col("mp25")), F.lit("N/D")).alias("categoria_actual"),
    )
    by_target = forecast.groupBy("comuna", "fecha_hora_objetivo").agg(
        safe_mean(F.sum("mp25_predicho_24h"), F.count("mp25_predicho_24h")).alias("esperado"),
        F.countDistinct("codigo_estacion").alias("estaciones"),
    )
    expected = first_per_key(
        by_target, ["comuna"], [F.desc_nulls_last("fecha_hora_objetivo")]
    )
    value = round_half_up(F.col("esperado"))
    return current.join(expected, "comuna", "left").select(
        "comuna", "fecha_ultima", "mp25_actual", "categoria_actual",
        "fecha_hora_objetivo", value.alias("mp25_esperado_24h"),
        F.coalesce(ica_category(value), "categoria_actual").alias("categoria_esperada"),
        F.coalesce("estaciones", F.lit(0).cast("long")).alias("estaciones_consideradas"),
        citizen_outlook(value).alias("mensaje"),
    )


def citizen_forecast_detail(forecast: DataFrame, comuna: str) -> DataFrame:
    """Forecast rows of one municipality, highest first."""
    columns = ["codigo_estacion", "tipo_sensor", "fecha_hora_base", "fecha_hora_objetivo",
               "mp25_actual", "mp25_predicho_24h", "categoria_alerta_predicha",
               "mensaje_ciudadano"]
    return (
        forecast.filter(F.col("comuna") == comuna)
        .select(*[c for c in columns if c in forecast.columns])
        .orderBy(F.desc_nulls_last("mp25_predicho_24h"))
    )
