"""Typed feeds from raw text: measurements, weather, industry inspections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventis.functions.dates import parse_date_mixed
from ventis.functions.numeric import parse_number
from ventis.functions.text import (
    normalize_columns, normalize_comuna, normalize_region, normalize_text,
)
from ventis.operators.ranking import cells_of, with_prefix_rank
from ventis.schemas import INDUSTRY_COLUMNS, POLLUTANTS, WEATHER, WEATHER_COLUMNS

_PREPARED = ["fecha_hora", "codigo_estacion", "comuna", "region", *POLLUTANTS]


def _carry(df: DataFrame) -> list[str]:
    """Reading order, kept when the reader added it."""
    return ["_seq"] if "_seq" in df.columns else []


def _places() -> dict[str, Column]:
    return {"comuna": normalize_comuna("comuna"), "region": normalize_region("region")}


def prepare_measurements(df: DataFrame, source: str, date_policy: str = "iso") -> DataFrame:
    """Official or community measurements; any other source name counts as community."""
    df = normalize_columns(df)
    tag = "oficial" if source == "oficial" else "comunitaria"
    return df.withColumns({
        **_places(),
        "fecha_hora": parse_date_mixed("fecha_hora", date_policy),
        **{name: parse_number(name) for name in POLLUTANTS},
        "fuente_dato": F.lit(tag),
    }).select(*_carry(df), *_PREPARED, "fuente_dato")


def prepare_weather(df: DataFrame, date_policy: str = "iso") -> DataFrame:
    df = normalize_columns(df)
    return df.withColumns({
        **_places(),
        "fecha_hora": parse_date_mixed("fecha_hora", date_policy),
        **{name: parse_number(name) for name in WEATHER},
    }).select(*WEATHER_COLUMNS)


def prepare_industries(df: DataFrame, date_policy: str = "iso") -> DataFrame:
    df = normalize_columns(df)
    return df.withColumns({
        **_places(),
        "rubro_industrial": normalize_text("rubro_industrial"),
        "emision_maxima_permitida": parse_number("emision_maxima_permitida"),
        "fecha_fiscalizacion": parse_date_mixed("fecha_fiscalizacion", date_policy),
    }).select(*INDUSTRY_COLUMNS)


def unify(official: DataFrame, community: DataFrame) -> DataFrame:
    """All official rows, then all community rows; ``_seq`` keeps that order when present."""
    if "_seq" in official.columns and "_seq" in community.columns:
        official = official.withColumn("_seq", F.struct(F.lit(0).alias("fuente"), "_seq"))
        community = community.withColumn("_seq", F.struct(F.lit(1).alias("fuente"), "_seq"))
    return official.unionByName(community)


def number_rows(df: DataFrame, column: str = "numero_fila") -> DataFrame:
    """Dense 0-based row number in reading order, from counts per range of ``_seq``."""
    inner = [f"_seq.{f.name}" for f in getattr(df.schema["_seq"].dataType, "fields", [])]
    flat = df.withColumns({f"_seq{k}": F.col(n) for k, n in enumerate(inner or ["_seq"])})
    names = [c for c in flat.columns if c not in df.columns]
    cells = [cell for name in names for cell in cells_of(flat, name)]
    return with_prefix_rank(flat, names, cells, rank=column).drop("_seq", *names)
