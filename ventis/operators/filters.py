"""Optional filters on measurements and view frames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = "fecha"  # partition column of a stored fact
ALERT_COLUMNS = ["categoria_alerta_predicha", "categoria_alerta", "categoria_predicha"]


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


@dataclass(frozen=True)
class MeasurementFilter:
    """Conjunction of optional predicates.

    Text and dates are ignored when empty, ids and numbers only when None. ``comuna`` matches
    anywhere and without case; ``%`` and ``_`` in it act as wildcards.
    """

    region: str | None = None
    id_comuna: int | None = None
    id_estacion: int | None = None
    fecha_inicio: datetime | str | None = None
    fecha_fin: datetime | str | None = None
    tipo_sensor: str | None = None
    mp25_min: float | None = None
    mp25_max: float | None = None
    comuna: str | None = None

    def on_fact(self, fact: DataFrame) -> Column:
        """Predicates on the columns of ``fact``; they reach the Parquet scan.

        Where the fact is partitioned by ``fecha``, time bounds also bound that column, so other
        days' folders are never opened.
        """
        ts, mp25 = F.col("fecha_hora"), F.col("mp25")
        conditions = []
        if self.id_estacion is not None:
            conditions.append(F.col("id_estacion") == self.id_estacion)
        if self.fecha_inicio:
            start = F.lit(self.fecha_inicio).cast("timestamp_ntz")
            conditions.append(ts >= start)
            if DAY in fact.columns:
                conditions.append(F.col(DAY) >= F.to_date(start))
        if self.fecha_fin:
            end = F.lit(self.fecha_fin).cast("timestamp_ntz")
            conditions.append(ts <= end)
            if DAY in fact.columns:
                conditions.append(F.col(DAY) <= F.to_date(end))
        if self.mp25_min is not None:
            conditions.append(mp25 >= self.mp25_min)
        if self.mp25_max is not None:
            conditions.append(mp25 <= self.mp25_max)
        return _all(conditions)

    def on_place(self, station_type: str = "tipo") -> Column:
        """Predicates on station and municipality columns."""
        conditions = []
        if self.region:
            conditions.append(F.col("region") == self.region)
        if self.id_comuna is not None:
            conditions.append(F.col("id_comuna") == self.id_comuna)
        if self.tipo_sensor:
            conditions.append(F.col(station_type) == self.tipo_sensor)
        if self.comuna:
            conditions.append(F.lower("comuna").like(f"%{self.comuna.lower()}%"))
        return _all(conditions)


@dataclass(frozen=True)
class ViewFilter:
    """Multi-select filters of the views; an empty list filters nothing."""

    regions: Sequence[str] = field(default_factory=tuple)
    communes: Sequence[str] = field(default_factory=tuple)
    sensor_types: Sequence[str] = field(default_factory=tuple)
    risk_levels: Sequence[str] = field(default_factory=tuple)
    alert_categories: Sequence[str] = field(default_factory=tuple)
    date_start: date | str | None = None
    date_end: date | str | None = None


def alert_column(df: DataFrame) -> str | None:
    """Alert category column of a prediction frame, newest name first."""
    return next((name for name in ALERT_COLUMNS if name in df.columns), None)


def apply_view(df: DataFrame, view: ViewFilter, date_column: str | None = None) -> DataFrame:
    """Apply the filters whose column exists. The end date includes its last second."""
    choices = {
        "region": view.regions,
        "comuna": view.communes,
        "tipo_sensor": view.sensor_types,
        "nivel_riesgo": view.risk_levels,
        alert_column(df): view.alert_categories,
    }
    conditions = [
        F.col(name).isin(*values)
        for name, values in choices.items()
        if values and name in df.columns
    ]
    if date_column in df.columns:
        ts = F.col(date_column)
        if view.date_start is not None:
            conditions.append(ts >= F.lit(view.date_start).cast("date").cast("timestamp_ntz"))
        if view.date_end is not None:
            end = F.lit(view.date_end).cast("date").cast("timestamp_ntz")
            conditions.append(ts <= end + F.expr("INTERVAL '0 23:59:59' DAY TO SECOND"))
    return df.filter(_all(conditions))
