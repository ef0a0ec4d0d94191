"""Text normalisation expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Region spellings found in the feeds -> official name.
REGION_NAMES = {
    "bio bio": "Biobío",
    "biobio": "Biobío",
    "bío bío": "Biobío",
    "biobío": "Biobío",
    "nuble": "Ñuble",
    "ñuble": "Ñuble",
    "ohiggins": "O'Higgins",
    "o higgins": "O'Higgins",
    "o'higgins": "O'Higgins",
    "maule": "Maule",
}

# Municipality spellings found in the feeds -> official name.
COMUNA_NAMES = {
    "chillan": "Chillán",
    "chillán": "Chillán",
    "concepcion": "Concepción",
    "concepción": "Concepción",
    "curico": "Curicó",
    "curicó": "Curicó",
    "talca": "Talca",
    "rancagua": "Rancagua",
    "san fernando": "San Fernando",
    "san carlos": "San Carlos",
    "coronel": "Coronel",
    "hualpen": "Hualpén",
    "hualpén": "Hualpén",
}

# Columns that hold labels.
LABEL_COLUMNS = [
    "comuna", "region", "tipo_sensor", "categoria_ica", "codigo_estacion", "nivel_riesgo",
    "categoria_alerta", "categoria_predicha", "categoria_alerta_predicha", "mensaje_ciudadano",
]

_BLANKS = r"[\s\p{Z}\x1c-\x1f\x85]+"


def collapse_spaces(col: Column | str) -> Column:
    """One space between words, none around them. Keeps the empty string."""
    return F.trim(F.regexp_replace(col, _BLANKS, " "))


def normalize_text(col: Column | str) -> Column:
    return F.nullif(collapse_spaces(col), F.lit(""))


def _lookup(text: Column, table: dict[str, str]) -> Column:
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.create_map(*pairs)[F.lower(text)], text)


def normalize_region(col: Column | str) -> Column:
    return _lookup(normalize_text(col), REGION_NAMES)


def normalize_comuna(col: Column | str) -> Column:
    return _lookup(normalize_text(col), COMUNA_NAMES)


def repair_mojibake(col: Column | str) -> Column:
    """Undo UTF-8 text that was once decoded as Latin-1; other text only loses extra spaces.

    The bytes are taken only when every character fits Latin-1, and the result is kept only
    when it is valid UTF-8, so nothing can fail at run time.
    """
    text = collapse_spaces(col)
    suspicious = text.rlike("[ÃÂâ]") & text.rlike(r"^[\x00-\xFF]*$")
    repaired = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    return F.when(suspicious, F.coalesce(repaired, text)).otherwise(text)


def repair_labels(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Repair every label column that is present."""
    wanted = LABEL_COLUMNS if columns is None else columns
    return df.withColumns({name: repair_mojibake(name) for name in wanted if name in df.columns})


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().lower().replace(" ", "_") for name in df.columns])
