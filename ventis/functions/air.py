"""Air-quality categories and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exclusive PM2.5 upper bound, category, advice, colour. The last has no bound.
ICA_LEVELS = [
    (50.0, "Buena", "Calidad del aire favorable para actividades al aire libre.", "verde"),
    (80.0, "Regular", "Personas sensibles deberian reducir exposicion prolongada.", "amarillo"),
    (110.0, "Alerta", "Evitar actividad fisica intensa al aire libre.", "naranjo"),
    (170.0, "Preemergencia",
     "Reducir actividades al aire libre y priorizar grupos de riesgo.", "rojo"),
    (None, "Emergencia",
     "Permanecer en interiores y evitar exposicion al aire libre.", "morado"),
]
# PM2.5 and PM10 lower bounds of the combined index, worst first.
ICAP_LEVELS = [
    (170.0, 330.0, "Emergencia"),
    (110.0, 230.0, "Preemergencia"),
    (80.0, 180.0, "Alerta"),
    (50.0, 130.0, "Regular"),
]
# Sentence shown to citizens for each forecast category.
OUTLOOK_MISSING = "Todavia no hay un pronostico disponible para las proximas 24 horas."
OUTLOOK_SENTENCES = {
    "Buena": "La calidad del aire estimada para las proximas 24 horas se mantiene en niveles "
             "bajos de riesgo.",
    "Regular": "Se espera un aumento moderado de MP2.5. Conviene monitorear la evolucion "
               "durante el dia.",
    "Alerta": "El modelo estima un aumento relevante de MP2.5 para las proximas 24 horas.",
    "Preemergencia": "El modelo estima niveles altos de MP2.5 para las proximas 24 horas. "
                     "Esta comuna requiere atencion preventiva.",
    "Emergencia": "Se proyectan niveles muy altos de MP2.5 para las proximas 24 horas. "
                  "Esta comuna requiere atencion preventiva inmediata.",
}

CATEGORIES = [level[1] for level in ICA_LEVELS]
ALERT_CATEGORIES = ["Alerta", "Preemergencia", "Emergencia"]
CRITICAL_MP25 = 80.0


def _by_level(mp25: Column, values: list[str], strict: bool) -> Column:
    result = F.lit(values[-1])
    for (bound, *_), value in reversed(list(zip(ICA_LEVELS[:-1], values[:-1]))):
        result = F.when(mp25 < bound, F.lit(value)).otherwise(result)
    negative = (
        F.raise_error(F.lit("No se pueden clasificar valores negativos de MP2.5")).cast("string")
        if strict else F.lit(None).cast("string")
    )
    return F.when(mp25.isNull(), None).when(mp25 < 0, negative).otherwise(result)


def ica_category(mp25: Column, strict: bool = False) -> Column:
    """PM2.5 category; a negative value is NULL, or an error when ``strict``."""
    return _by_level(mp25, CATEGORIES, strict)


def ica_columns(mp25: Column, strict: bool = False, category: str = "categoria") -> dict[str, Column]:
    """Category, citizen advice and reference colour as three columns."""
    return {
        category: ica_category(mp25, strict),
        "mensaje_ciudadano": _by_level(mp25, [level[2] for level in ICA_LEVELS], strict),
        "color_referencial": _by_level(mp25, [level[3] for level in ICA_LEVELS], strict),
    }


def classify_ica(mp25: Column, strict: bool = False) -> Column:
    """The three classification fields as one struct."""
    fields = ica_columns(mp25, strict)
    return F.struct(*[col.alias(name) for name, col in fields.items()])


def icap_category(mp25: Column, mp10: Column) -> Column:
    result = F.lit("Buena")
    for fine, coarse, name in reversed(ICAP_LEVELS):
        result = F.when((mp25 >= fine) | (mp10 >= coarse), F.lit(name)).otherwise(result)
    return result


def citizen_outlook(mp25: Column) -> Column:
    category = ica_category(mp25)
    sentence = F.lit(OUTLOOK_MISSING)
    for name, text in OUTLOOK_SENTENCES.items():
        sentence = F.when(category == name, F.lit(text)).otherwise(sentence)
    return sentence


def ordinal(col: Column, ordered: list[str], unknown: int = 999) -> Column:
    """Position of a category in ``ordered``, for sorting by severity."""
    position = F.array_position(F.array(*[F.lit(item) for item in ordered]), col)
    return F.when(position > 0, position - 1).otherwise(F.lit(unknown).cast("long"))
