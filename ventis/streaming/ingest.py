"""Continuous bulk ingest with the batch rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ventis.operators.ingest import (
    INGEST_COLUMNS, UNREADABLE, ingest_batch, payload_rules, typed_payload,
)
from ventis.operators.quality import messages
from ventis.schemas import POLLUTANTS, WEATHER, all_string
from ventis.session import materialize, temporary_tables
from ventis.streaming.store import add_batch, clear_batch, days_of, read_store, stored_on

# Hidden from readers of the store by its first letter.
LOG = "_registro"

PAYLOAD_SCHEMA = T.StructType(
    [T.StructField("fecha_hora", T.TimestampNTZType()), T.StructField("id_estacion", T.LongType())]
    + [T.StructField(name, T.DoubleType()) for name in POLLUTANTS + WEATHER]
)


def read_payloads(spark: SparkSession, path: str, fmt: str = "json",
                  max_files: int | None = None) -> DataFrame:
    """Stream of payload files. JSON and CSV are read as text and typed, so that an unreadable
    value is told from an absent one."""
    as_text = fmt in ("json", "csv")
    schema = all_string(INGEST_COLUMNS) if as_text else PAYLOAD_SCHEMA
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(path)
    return typed_payload(stream) if as_text else stream


def valid_unique_stream(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Well-formed measurements, repeats within the watermark delay dropped.

    Rules come first, so an invalid row does not block a later valid one. State is one key per
    (station, timestamp) inside the delay.
    """
    ok = stream.filter(F.size(messages(payload_rules(UNREADABLE in stream.columns))) == 0)
    return (
        ok.withColumn("ts", F.col("fecha_hora").cast("timestamp"))
        .withWatermark("ts", delay)
        .dropDuplicatesWithinWatermark(["id_estacion", "ts"])
        .drop("ts")
    )


def ingest_stream(stream: DataFrame, stations: DataFrame, store: str, rejects: str,
                  checkpoint: str) -> DataStreamWriter:
    """Writer that adds each micro-batch to ``store`` and its rejects to ``rejects``.

    The store has a folder per day; a batch reads and writes only the days of its own rows, so its
    cost does not follow the history. Duplicates are found against everything stored on these
    days, however late they come: state behind a watermark would forget them, and would drop
    repeats that the rejects have to name. A repeated batch after a failure first clears what its
    earlier attempt wrote, so it gives the same tables; its rejects are a ``lote`` folder that it
    overwrites. One store takes one checkpoint. Intermediate tables go with the batch. Call
    ``trigger(...).start()`` on the result and read the store with :func:`stored_measurements`.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        spark, log = batch.sparkSession, f"{store}/{LOG}"
        with temporary_tables(spark):
            numbered = materialize(
                batch.withColumn("indice", F.monotonically_increasing_id()).select(
                    "indice", *INGEST_COLUMNS, *[c for c in batch.columns if c == UNREADABLE]), "lote"
            )
            days = days_of(numbered)
            clear_batch(spark, store, log, batch_id)
            accepted, rejected = ingest_batch(
                numbered, stations, stored_on(spark, store, PAYLOAD_SCHEMA, days))
            add_batch(accepted.drop("indice"), store, log, batch_id, days)
            rejected.write.mode("overwrite").parquet(f"{rejects}/lote={batch_id}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)


def stored_measurements(spark: SparkSession, store: str) -> DataFrame:
    """Everything that batches have stored, with its day and batch; empty before the first."""
    return read_store(spark, store, PAYLOAD_SCHEMA)
