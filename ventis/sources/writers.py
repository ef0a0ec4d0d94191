"""Sinks: partitioned tables, CSV reports, JSON payloads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventis.functions.dates import iso_timestamp
from ventis.operators.filters import DAY
from ventis.schemas import POLLUTANTS, WEATHER
from ventis.session import delete_path

PAYLOAD_FIELDS = ["fecha_hora", "id_estacion", *POLLUTANTS, *WEATHER]


def write_days(df: DataFrame, path: str, days: Sequence[date] | None = None,
               mode: str = "overwrite", order: Sequence[str] = ("fecha_hora",)) -> None:
    """Rows as Parquet partitioned by the date of ``fecha_hora``.

    With ``days`` the rows of these days replace what is stored of them, a day without rows
    becomes empty, and the files of all other days stay as they are; rows of other days in ``df``
    are not written. Days are replaced one after the other: readers may see some done and some
    not, and a repeat after a failure completes the work.

    The rebalance hint lets adaptive execution split a busy date over several tasks and merge
    quiet ones, so neither one huge task nor many tiny files result.
    """
    dated = df.withColumn(DAY, F.to_date("fecha_hora"))
    if days is not None:
        dated = dated.filter(F.col(DAY).isin(list(days)))
    writer = (
        dated.hint("rebalance", DAY).sortWithinPartitions(DAY, *order)
        .write.mode(mode).partitionBy(DAY)
    )
    if days is None:
        writer.parquet(path)
        return
    # Only days that were asked for: one value each.
    filled = {row[0] for row in dated.select(DAY).distinct().collect()}
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for day in set(days) - filled:
        delete_path(df.sparkSession, f"{path}/{DAY}={day.isoformat()}")


def write_measurements(df: DataFrame, path: str, mode: str = "overwrite",
                       days: Sequence[date] | None = None) -> None:
    """Fact rows by date, sorted by station and time; see :func:`write_days`."""
    write_days(df, path, days, mode, ["id_estacion", "fecha_hora"])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Parquet, CSV with header, or JSON lines."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        # By default the CSV writer cuts timestamps to milliseconds.
        writer = writer.option("header", True).options(
            timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        )
    writer.format(fmt).save(path)


def payload_struct():
    """Measurement as sent to the store: ISO time, doubles, no metadata fields."""
    return F.struct(
        iso_timestamp("fecha_hora").alias("fecha_hora"),
        F.col("id_estacion").cast("long").alias("id_estacion"),
        *[F.col(name).cast("double").alias(name) for name in POLLUTANTS + WEATHER],
    )


def payload_json(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One JSON text per measurement; NULL fields are written as null."""
    text = F.to_json(payload_struct(), {"ignoreNullFields": "false"}).alias("medicion")
    return df.select(*(keep or []), text)


def write_payload(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Payload as JSON lines, one measurement per line, metadata columns dropped."""
    df.select(payload_struct().alias("m")).select("m.*").write.mode(mode).json(
        path, ignoreNullFields=False
    )
