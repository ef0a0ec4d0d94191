"""Readers for raw feeds, the station mapping and analysis artefacts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventis import schemas
from ventis.functions import text

SOURCE_FIELDS = {
    "mediciones_oficiales": schemas.RAW_MEASUREMENT_FIELDS,
    "sensores_comunitarios": schemas.RAW_MEASUREMENT_FIELDS,
    "clima_historico": schemas.RAW_WEATHER_FIELDS,
    "fiscalizacion_industrias": schemas.RAW_INDUSTRY_FIELDS,
}

# Repeated codes that an error message names.
NAMED_CODES = 20


def read_table(spark: SparkSession, path: str, fmt: str = "csv",
               schema: T.StructType | None = None) -> DataFrame:
    """CSV with header, Parquet or JSON. A missing path raises ``FileNotFoundError``."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", False)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"Nada que leer en {path}") from error
        raise


def read_source(spark: SparkSession, path: str, name: str, fmt: str = "csv") -> DataFrame:
    """One raw feed as text columns, plus its reading order in ``_seq``.

    CSV columns are bound by header name, so a reordered or widened file reads the same.
    """
    raw = read_table(spark, path, fmt)
    frame = with_read_order(raw)
    if raw.isEmpty():
        raise ValueError(f"Sin filas en la fuente {name}.")
    return frame


def with_read_order(df: DataFrame, column: str = "_seq") -> DataFrame:
    """File position of each row: path, block start, row within the block.

    Row ids rise inside a block, but blocks are packed into partitions by size, so the id
    alone would not follow file order.
    """
    meta = F.col("_metadata")
    return df.select(
        "*",
        F.struct(
            meta["file_path"].alias("archivo"),
            meta["file_block_start"].alias("bloque"),
            F.monotonically_increasing_id().alias("fila"),
        ).alias(column),
    )


def read_all_sources(spark: SparkSession, paths: Mapping[str, str],
                     formats: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The four raw feeds, lazily. Spreadsheet feeds are read from a CSV or Parquet export."""
    formats = formats or {}
    return {
        name: read_source(spark, paths[name], name, formats.get(name, "csv"))
        for name in SOURCE_FIELDS
    }


def duplicated_codes(mapping: DataFrame) -> DataFrame:
    """Raw codes that occur more than once in a station mapping."""
    code = F.trim(F.col("codigo_estacion_raw")).alias("codigo_estacion_raw")
    return (
        mapping.groupBy(code)
        .agg(F.count("*").alias("apariciones"))
        .filter(F.col("apariciones") > 1)
    )


def read_station_mapping(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Station mapping under contract: columns present, valid UTF-8, unique raw codes."""
    mapping = read_table(spark, path, fmt)
    schemas.require_columns(mapping, schemas.MAPPING_COLUMNS, "mapeo_estaciones")
    mapping = mapping.select(
        F.trim("codigo_estacion_raw").alias("codigo_estacion_raw"),
        *schemas.MAPPING_COLUMNS[1:],
    )
    broken = F.lit(False)
    for name in schemas.MAPPING_COLUMNS:
        # The CSV reader replaces malformed bytes with U+FFFD.
        broken = broken | F.coalesce(F.col(name).contains("�"), F.lit(False))
    if not mapping.filter(broken).isEmpty():
        raise ValueError("El mapeo de estaciones trae texto que no es UTF-8.")
    # The message names the first codes; ``duplicated_codes`` hands out all of them.
    codes = duplicated_codes(mapping).select("codigo_estacion_raw")
    first = [row[0] for row in codes.orderBy("codigo_estacion_raw").limit(NAMED_CODES).collect()]
    if first:
        raise ValueError(
            f"codigo_estacion_raw con {codes.count()} valores duplicados: " + ", ".join(map(str, first)))
    return mapping


def read_labeled(spark: SparkSession, path: str, fmt: str = "csv", strict_dates: bool = False,
                 date_columns: tuple[str, ...] = ("fecha_hora",)) -> DataFrame:
    """A stored analysis table with repaired labels and typed timestamps.

    An unreadable timestamp becomes NULL, or fails the job when ``strict_dates``: the check is
    part of the expression, so it costs no extra pass.
    """
    df = text.repair_labels(read_table(spark, path, fmt))
    if fmt == "csv":
        numeric = [
            name for name in df.columns
            if name in schemas.POLLUTANTS + schemas.WEATHER + schemas.CONTEXT
            or name.startswith(("mp25_", "error"))
        ]
        df = df.withColumns({name: F.col(name).try_cast("double") for name in numeric})
    for name in date_columns:
        if name in df.columns:
            parsed = F.col(name).try_cast("timestamp_ntz")
            if strict_dates:
                failure = F.raise_error(
                    F.lit("El dataset contiene fechas invalidas en fecha_hora.")
                ).cast("timestamp_ntz")
                parsed = F.coalesce(parsed, failure)
            df = df.withColumn(name, parsed)
    return df
