"""Column lists and table schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names of the feeds, the store and the reports.
POLLUTANTS = ["mp25", "mp10", "so2", "no2"]
WEATHER = ["velocidad_viento", "direccion_viento_grados", "temperatura", "humedad"]
CONTEXT = ["indice_vulnerabilidad_respiratoria", "emision_maxima_permitida"]

MEASUREMENT_COLUMNS = [
    "fecha_hora", "codigo_estacion", "comuna", "region", *POLLUTANTS, *WEATHER, "fuente_dato",
]
WEATHER_COLUMNS = ["fecha_hora", "comuna", "region", *WEATHER]
INDUSTRY_COLUMNS = [
    "nombre_industria", "rubro_industrial", "comuna", "region",
    "emision_maxima_permitida", "fecha_fiscalizacion", "observacion",
]
MAPPING_COLUMNS = [
    "codigo_estacion_raw", "codigo_unico_api", "comuna", "region", "fuente_dato", "tipo_sensor_api",
]
OMITTED_COLUMNS = [
    "codigo_estacion", "codigo_unico_api", "id_estacion", "comuna", "region",
    "fuente_dato", "fecha_hora", "motivo_omision", "modo_mapeo",
]
MODELING_COLUMNS = [
    "fecha_hora", "comuna", "region", "codigo_estacion", "tipo_sensor",
    *POLLUTANTS, *WEATHER, *CONTEXT, "categoria_ica",
]
DETAIL_COLUMNS = [
    "id_monitoreo", "fecha_hora", "id_estacion", "id_comuna", "comuna", "region",
    "poblacion_estimada", "indice_vulnerabilidad_respiratoria", "codigo_unico", "tipo",
    "latitud", "longitud", *POLLUTANTS, *WEATHER,
]
PREDICTION_COLUMNS = [
    "tipo_registro", "fecha_hora_base", "fecha_hora_objetivo", "fecha_hora", "codigo_estacion",
    "comuna", "region", "tipo_sensor", "mp25_actual", "mp25_real", "mp25_real_24h",
    "mp25_predicho", "mp25_predicho_24h", "error", "error_absoluto", "categoria_alerta",
    "categoria_predicha", "categoria_alerta_predicha", "mensaje_ciudadano", "color_referencial",
]

RAW_MEASUREMENT_FIELDS = ["fecha_hora", "codigo_estacion", "comuna", "region", *POLLUTANTS]
RAW_WEATHER_FIELDS = WEATHER_COLUMNS
RAW_INDUSTRY_FIELDS = INDUSTRY_COLUMNS


def all_string(names: Iterable[str]) -> T.StructType:
    """Raw feeds are read as text and typed later by the cleaning expressions."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


COMUNAS = T.StructType([
    T.StructField("id_comuna", T.LongType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("poblacion_estimada", T.LongType()),
    T.StructField("indice_vulnerabilidad_respiratoria", T.DoubleType()),
])
ESTACIONES = T.StructType([
    T.StructField("id_estacion", T.LongType()),
    T.StructField("codigo_unico", T.StringType()),
    T.StructField("tipo", T.StringType()),
    T.StructField("latitud", T.DoubleType()),
    T.StructField("longitud", T.DoubleType()),
    T.StructField("id_comuna", T.LongType()),
])
INDUSTRIAS = T.StructType([
    T.StructField("id_industria", T.LongType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("rubro_industrial", T.StringType()),
    T.StructField("emision_maxima_permitida", T.DoubleType()),
    T.StructField("id_comuna", T.LongType()),
])
MONITOREO = T.StructType(
    [
        T.StructField("id_monitoreo", T.LongType()),
        T.StructField("fecha_hora", T.TimestampNTZType()),
        T.StructField("id_estacion", T.LongType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in POLLUTANTS + WEATHER]
)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in required if name not in present]


def require_columns(df: DataFrame, required: Iterable[str], context: str = "") -> DataFrame:
    """Fail when a required column is absent; the message lists them in contract order."""
    missing = missing_columns(df, required)
    if missing:
        where = f" en {context}" if context else ""
        raise ValueError(f"Faltan columnas requeridas{where}: " + ", ".join(missing))
    return df
