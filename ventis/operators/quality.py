"""Validation rules, cleaning, deduplication and constraint audit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventis.functions.sensors import COMMUNITY, OFFICIAL
from ventis.operators.joins import null_safe_join
from ventis.operators.ranking import first_per_key
from ventis.operators.statistics import add_calendar
from ventis.schemas import (
    COMUNAS, ESTACIONES, INDUSTRIAS, MEASUREMENT_COLUMNS, MONITOREO, POLLUTANTS, require_columns,
)
from ventis.session import materialize
from ventis.sources.star import Star

KEY = ["codigo_estacion", "fecha_hora"]
DUPLICATE_MESSAGE = "duplicado codigo_estacion+fecha_hora"
# Inclusive ranges of the weather readings.
RANGES = {
    "direccion_viento_grados": (0.0, 360.0),
    "temperatura": (-50.0, 60.0),
    "humedad": (0.0, 100.0),
}
NON_NEGATIVE = [
    *POLLUTANTS, "velocidad_viento", "indice_vulnerabilidad_respiratoria",
    "emision_maxima_permitida",
]
SOURCES = ["oficial", "comunitaria"]
REGIONS = ["O'Higgins", "Maule", "Ñuble", "Biobío"]


@dataclass(frozen=True)
class Rule:
    """A message and the condition under which a row breaks the rule. NULL is not a breach."""

    message: str
    broken: Column


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(name) == "")


def _outside(name: str, low: float, high: float) -> Column:
    return ~F.col(name).between(low, high)


def measurement_rules() -> list[Rule]:
    """Rules in reporting order."""
    rules = [Rule("fecha_hora nula", F.col("fecha_hora").isNull())]
    rules += [
        Rule("codigo_estacion vacio", _blank("codigo_estacion")),
        Rule("comuna vacia", _blank("comuna")),
        Rule("region vacia", _blank("region")),
    ]
    for name in POLLUTANTS:
        rules.append(Rule(f"{name} faltante", F.col(name).isNull()))
        rules.append(Rule(f"{name} negativo", F.col(name) < 0))
    rules.append(Rule("velocidad_viento negativa", F.col("velocidad_viento") < 0))
    rules += [Rule(f"{name} fuera de rango", _outside(name, *RANGES[name])) for name in RANGES]
    known = F.coalesce(F.col("fuente_dato").isin(*SOURCES), F.lit(False))
    rules.append(Rule("fuente_dato invalida", ~known))
    return rules


def messages(rules: Sequence[Rule]) -> Column:
    """Array with the message of every broken rule, in rule order."""
    return F.array_compact(F.array(*[F.when(r.broken, F.lit(r.message)) for r in rules]))


def duplicate_keys(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """First ``seq`` of every key that occurs more than once; combined map-side."""
    return (
        df.groupBy(*keys).agg(F.min(seq).alias("_primera"), F.count("*").alias("_n"))
        .filter(F.col("_n") > 1).drop("_n")
    )


def flag_duplicates(df: DataFrame, keys: Sequence[str] = KEY, seq: str = "_seq",
                    flag: str = "duplicado") -> DataFrame:
    """True on every row of a key but the first by ``seq``; NULL keys equal each other.

    The repeated keys are written once, so the join is planned from their real size: usually
    they are few and broadcast, and the rows are not shuffled however many share a key. A large
    set is merge-joined, where adaptive execution splits a hot key.
    """
    repeated = materialize(duplicate_keys(df, keys, seq), "repetidas")
    joined = null_safe_join(df, repeated, keys, "left")
    is_later = F.coalesce(F.col(seq) > F.col("_primera"), F.lit(False))
    return joined.withColumn(flag, is_later).drop("_primera")


def dedupe_first(df: DataFrame, keys: Sequence[str], seq: str = "_seq") -> DataFrame:
    """The first row of each key by ``seq``."""
    return first_per_key(df, keys, [F.col(seq).asc()])


def flag_errors(df: DataFrame, seq: str = "_seq", rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``_errores``: all messages of a row, the duplicate message last."""
    require_columns(df, MEASUREMENT_COLUMNS)
    rules = measurement_rules() if rules is None else rules
    flagged = flag_duplicates(df, KEY, seq)
    repeated = F.when(F.col("duplicado"), F.array(F.lit(DUPLICATE_MESSAGE))).otherwise(
        F.array().cast("array<string>")
    )
    return flagged.withColumn("_errores", F.concat(messages(rules), repeated)).drop("duplicado")


def validate(df: DataFrame, seq: str = "_seq",
             rules: Sequence[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split measurements into valid rows and error rows with their reasons.

    The first row of a repeated key is the keeper even when it is itself invalid. Both outputs
    read the same flagged plan; persist or :func:`ventis.session.materialize` it through
    :func:`flag_errors` when both are written.
    """
    return split_validated(flag_errors(df, seq, rules))


def split_validated(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    clean = F.size("_errores") == 0
    valid = flagged.filter(clean).drop("_errores")
    errors = flagged.filter(~clean).withColumns({
        "motivo_error": F.concat_ws("; ", "_errores"),
        "fase": F.lit("validate"),
    }).drop("_errores")
    return valid, errors


def clean_dataset(df: DataFrame, seq: str = "_seq", sort: bool = True) -> DataFrame:
    """Trim labels, type numbers, blank impossible values, drop later duplicates, sort.

    Labels are not imputed. The sort is a distributed range sort and can be turned off.
    """
    labels = [c for c in ("comuna", "region", "codigo_estacion", "tipo_sensor", "categoria_ica")
              if c in df.columns]
    result = add_calendar(df).withColumns({c: F.trim(c) for c in labels})
    ranged = {c: F.col(c).try_cast("double") for c in (*NON_NEGATIVE, *RANGES) if c in df.columns}
    for name, value in ranged.items():
        kept = value.between(*RANGES[name]) if name in RANGES else value >= 0
        ranged[name] = F.when(kept, value)
    result = result.withColumns(ranged)
    keys = [c for c in ("fecha_hora", "codigo_estacion") if c in df.columns]
    if keys:
        result = dedupe_first(result, keys, seq)
    order = [c for c in ("fecha_hora", "region", "comuna", "codigo_estacion") if c in df.columns]
    if sort and order:
        result = result.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return result


def _checks(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Violations of every row rule of a table in one pass."""
    row = df.agg(*[
        F.struct(F.lit(f"{table}.{name}").alias("regla"), F.count_if(c).alias("violaciones")).alias(f"r{i}")
        for i, (name, c) in enumerate(rules.items())
    ])
    return row.select(F.explode(F.array(*row.columns)).alias("r")).select("r.*")


def _repeated(df: DataFrame, table: str, name: str, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; a key with a NULL repeats no other."""
    return df.dropna(subset=list(keys)).groupBy(*keys).count().agg(
        F.lit(f"{table}.{name}").alias("regla"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violaciones"),
    )


def _orphans(df: DataFrame, table: str, key: str, parent: DataFrame) -> DataFrame:
    """Rows whose key, unless NULL, has no parent; the child is counted per key before the join."""
    counts = df.dropna(subset=[key]).groupBy(key).agg(F.count("*").alias("n"))
    return counts.join(parent.select(key), key, "left_anti").agg(
        F.lit(f"{table}.fk_{key}").alias("regla"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("violaciones"),
    )


def constraint_audit(star: Star, regions: Sequence[str] = REGIONS,
                     types: Sequence[str] = (OFFICIAL, COMMUNITY)) -> DataFrame:
    """Violations of each key, reference, range, domain and NOT NULL constraint of the star schema."""
    c, e, i, m = star.comunas, star.estaciones, star.industrias, star.monitoreo
    domain = lambda name, values: ~F.col(name).isin(*values)
    absent = lambda schema: {f"nn_{n}": F.col(n).isNull() for n in schema.names}
    parts = [
        _repeated(c, "comunas", "pk", ["id_comuna"]),
        _repeated(c, "comunas", "uk_nombre", ["nombre"]),
        _checks(c, "comunas", {
            "poblacion": F.col("poblacion_estimada") <= 0,
            "vulnerabilidad": _outside("indice_vulnerabilidad_respiratoria", 0, 100),
            "region": domain("region", regions),
            **absent(COMUNAS),
        }),
        _repeated(e, "estaciones", "pk", ["id_estacion"]),
        _repeated(e, "estaciones", "uk_codigo", ["codigo_unico"]),
        _checks(e, "estaciones", {
            "latitud": _outside("latitud", -90, 90),
            "longitud": _outside("longitud", -180, 180),
            "tipo": domain("tipo", types),
            **absent(ESTACIONES),
        }),
        _orphans(e, "estaciones", "id_comuna", c),
        _repeated(i, "industrias", "pk", ["id_industria"]),
        _repeated(i, "industrias", "uk_nombre", ["nombre"]),
        _checks(i, "industrias", {
            "emision": F.col("emision_maxima_permitida") < 0, **absent(INDUSTRIAS),
        }),
        _orphans(i, "industrias", "id_comuna", c),
        _repeated(m, "monitoreo", "pk", ["id_monitoreo"]),
        _repeated(m, "monitoreo", "uk_estacion_fecha", ["id_estacion", "fecha_hora"]),
        _checks(m, "monitoreo", {
            **{name: F.col(name) < 0 for name in (*POLLUTANTS, "velocidad_viento")},
            **{name: _outside(name, *bounds) for name, bounds in RANGES.items()},
            **absent(MONITOREO),
        }),
        _orphans(m, "monitoreo", "id_estacion", e),
    ]
    return reduce(DataFrame.unionByName, parts)
