"""Mean and category per municipality and time window, live or in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventis.functions.air import ica_category
from ventis.functions.numeric import round_half_up


def windowed_ica(measurements: DataFrame, places: DataFrame, width: str = "6 hours",
                 watermark: str | None = None) -> DataFrame:
    """Tumbling windows of measurements joined to their municipality.

    The same code runs on a batch frame and, with a ``watermark``, on a stream: the places are
    then the static side of the join. A watermark needs a zoned timestamp, so run streams in a
    UTC session, as :func:`ventis.session.build_session` sets it.
    """
    timed = measurements.withColumn("ts", F.col("fecha_hora"))
    if watermark is not None:
        timed = timed.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    located = timed.join(places.select("id_estacion", "comuna", "region"), "id_estacion")
    mean = round_half_up(F.col("media"))
    return (
        located.groupBy(F.window("ts", width).alias("w"), "comuna", "region")
        .agg(F.avg("mp25").alias("media"), F.count("*").alias("mediciones"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("desde"),
            F.col("w.end").cast("timestamp_ntz").alias("hasta"),
            "comuna", "region", mean.alias("mp25_promedio"), "mediciones",
            ica_category(mean).alias("categoria"),
        )
    )
