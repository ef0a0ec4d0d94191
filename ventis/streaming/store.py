"""Store of streamed measurements: a folder per day, and in it one per micro-batch.

``store/fecha=D/lote=N`` holds what batch N added on day D; ``registro/lote=N`` names the days that
batch N may have written. A batch is registered before its rows are written, so a repeat after a
failure knows which folders to clear, whatever the first attempt left there.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventis.operators.filters import DAY
from ventis.session import delete_path

LOT = "lote"


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def days_of(rows: DataFrame) -> list[date]:
    """Days of a micro-batch, one value each: as many as the calendar has at most."""
    day = F.to_date("fecha_hora")
    return [r[0] for r in rows.select(day.alias("d")).filter("d IS NOT NULL").distinct().collect()]


def stored_on(spark: SparkSession, store: str, schema: T.StructType,
              days: list[date]) -> DataFrame:
    """Stored rows of these days. No other folder is opened or listed."""
    full = T.StructType([*schema, T.StructField(DAY, T.DateType()), T.StructField(LOT, T.LongType())])
    paths = [p for p in (f"{store}/{DAY}={day.isoformat()}" for day in sorted(days)) if _exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", store).parquet(*paths)


def read_store(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """All stored rows; a store that no batch has added to yet is empty."""
    full = T.StructType([*schema, T.StructField(DAY, T.DateType()), T.StructField(LOT, T.LongType())])
    if not _exists(spark, store):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(store)


def clear_batch(spark: SparkSession, store: str, log: str, batch_id: int) -> None:
    """Remove what an earlier attempt of this batch wrote."""
    if not _exists(spark, f"{log}/{LOT}={batch_id}"):
        return
    # Registered days of one batch; as many as the calendar has at most.
    for row in spark.read.schema("dia date").json(f"{log}/{LOT}={batch_id}").collect():
        delete_path(spark, f"{store}/{DAY}={row['dia'].isoformat()}/{LOT}={batch_id}")


def add_batch(accepted: DataFrame, store: str, log: str, batch_id: int, days: list[date]) -> None:
    """Register the batch's days, then write its rows.

    Call :func:`clear_batch` first; a repeat then leaves the same files as a single run.
    """
    spark = accepted.sparkSession
    spark.createDataFrame([(day,) for day in days], "dia date").coalesce(1) \
        .write.mode("overwrite").json(f"{log}/{LOT}={batch_id}")
    (
        accepted.withColumns({DAY: F.to_date("fecha_hora"), LOT: F.lit(batch_id).cast("long")})
        .hint("rebalance", DAY)
        .sortWithinPartitions(DAY, "id_estacion", "fecha_hora")
        .write.mode("append").partitionBy(DAY, LOT).parquet(store)
    )
