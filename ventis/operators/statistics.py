"""Descriptive statistics on any frame: quality, quantiles, correlation, trend, bins."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventis.functions.dates import calendar_parts
from ventis.functions.numeric import round_half_up
from ventis.schemas import CONTEXT, POLLUTANTS, WEATHER, require_columns
from ventis.session import materialize

CORRELATION_COLUMNS = [
    *POLLUTANTS, "velocidad_viento", "temperatura", "humedad", *CONTEXT,
]
DESCRIBE_COLUMNS = [*POLLUTANTS, *WEATHER, *CONTEXT]


def available(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [name for name in columns if name in df.columns]


def select_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Requested columns that exist, as DOUBLE; unreadable values become NULL."""
    present = available(df, columns)
    if not present:
        raise ValueError("El marco no trae ninguna de estas columnas: " + ", ".join(columns))
    return df.select(*[F.col(name).try_cast("double").alias(name) for name in present])


def unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, valor) rows of numeric columns."""
    pairs = [
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("valor"))
        for c in columns
    ]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def value_counts(df: DataFrame, column: str, count: str = "cantidad") -> DataFrame:
    """Rows per value, NULL included, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias(count)).orderBy(F.desc(count), column)


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (variable, valor, n, tramo) of every non-null value, written once.

    Counts are combined map-side. ``tramo`` numbers ordered value ranges of about equal size,
    taken from a range partitioning, so an odd distribution cannot fill one range.
    """
    counts = (
        unpivot(df, columns).filter(F.col("valor").isNotNull())
        .groupBy("variable", "valor").agg(F.count("*").alias("n"))
    )
    ranged = counts.repartitionByRange("variable", "valor").withColumn(
        "tramo", F.spark_partition_id()
    )
    return materialize(ranged, "frecuencias")


def _quantiles(frequencies: DataFrame, totals: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Quantiles by a two-level running total: over value ranges, then inside a range.

    ``totals`` has one row per variable and ``buckets`` one per variable and range, which bounds
    both broadcasts.
    """
    before = (Window.unboundedPreceding, -1)
    over_buckets = Window.partitionBy("variable").orderBy("tramo").rowsBetween(*before)
    buckets = frequencies.groupBy("variable", "tramo").agg(F.sum("n").alias("m")).select(
        "variable", "tramo", F.coalesce(F.sum("m").over(over_buckets), F.lit(0)).alias("previas")
    )
    inside = Window.partitionBy("variable", "tramo").orderBy("valor").rowsBetween(*before)
    placed = (
        frequencies.withColumn("antes", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(F.broadcast(buckets), ["variable", "tramo"])
        .join(F.broadcast(totals.select("variable", "total")), "variable")
        .withColumn("desde", F.col("previas") + F.col("antes"))
    )
    position = F.col("p") * (F.col("total") - 1)
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])

    def holds(rank: Column) -> Column:
        return (rank >= F.col("desde")) & (rank < F.col("desde") + F.col("n"))

    hits = (
        placed.withColumn("p", F.explode(wanted))
        .withColumn("pos", position).withColumn("low", F.floor("pos"))
        .withColumn("en_low", holds(F.col("low")))
        .withColumn("en_high", holds(F.least(F.col("low") + 1, F.col("total") - 1)))
        .filter(F.col("en_low") | F.col("en_high"))
    )
    ends = hits.groupBy("variable", "p").agg(
        F.max(F.when(F.col("en_low"), F.col("valor"))).alias("a"),
        F.max(F.when(F.col("en_high"), F.col("valor"))).alias("b"),
        F.max(F.col("pos") - F.col("low")).alias("f"),
    )
    value = F.col("a") + (F.col("b") - F.col("a")) * F.col("f")
    return ends.select("variable", "p", value.alias("cuantil"))


def _totals(frequencies: DataFrame) -> DataFrame:
    return frequencies.groupBy("variable").agg(
        F.min("valor").alias("lo"), F.max("valor").alias("hi"), F.sum("n").alias("total"),
        (F.sum(F.col("valor") * F.col("n")) / F.sum("n")).alias("media"),
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (variable, p, cuantil).

    Values are counted first and placed by ranges, so no task sees all the values of a variable,
    unlike a percentile aggregate.
    """
    frequencies = value_frequencies(df, columns)
    return _quantiles(frequencies, _totals(frequencies), probabilities)


def describe(df: DataFrame, columns: Sequence[str] = DESCRIBE_COLUMNS) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per variable.

    Everything comes from the value frequencies, so the data is read once. Variables without
    any value have no row.
    """
    frequencies = value_frequencies(df, available(df, columns))
    totals = _totals(frequencies)
    distance = F.col("valor") - F.col("media")
    spread = frequencies.join(F.broadcast(totals), "variable").groupBy("variable").agg(
        F.first("total").alias("count"), F.first("media").alias("mean"),
        F.sqrt(
            F.sum(distance * distance * F.col("n")) / F.nullif(F.sum("n") - 1, F.lit(0))
        ).alias("std"),
        F.first("lo").alias("min"), F.first("hi").alias("max"),
    )
    quartile = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    quantiles = _quantiles(frequencies, totals, list(quartile.values())).groupBy("variable").agg(*[
        F.max(F.when(F.col("p") == p, F.col("cuantil"))).alias(name)
        for name, p in quartile.items()
    ])
    return spread.join(quantiles, "variable").select(
        "variable", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def quality_summary(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False,
                    chunk: int = 8) -> DataFrame:
    """Type, nulls, percentage of nulls and distinct values of each column.

    Exact distinct counts expand each row once per counted column, so wide frames are done in
    chunks of columns. ``approx`` uses a sketch instead, in a single pass without a shuffle of
    values.
    """
    columns = list(columns or df.columns)
    distinct = F.approx_count_distinct if approx else F.countDistinct
    parts = []
    for start in range(0, len(columns), chunk):
        names = columns[start:start + chunk]
        row = df.agg(*[
            F.struct(
                F.lit(c).alias("columna"), F.lit(df.schema[c].dataType.simpleString()).alias("tipo"),
                F.count_if(F.col(c).isNull()).alias("nulos"),
                F.coalesce(round_half_up(
                    F.count_if(F.col(c).isNull()) * 100.0 / F.nullif(F.count("*"), F.lit(0))
                ), F.lit(0.0)).alias("porcentaje_nulos"),
                distinct(c).alias("valores_unicos"),
            ).alias(f"c{i}") for i, c in enumerate(names)
        ])
        parts.append(
            row.select(F.explode(F.array(*row.columns)).alias("c")).select("c.*")
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


_MOMENTS = ["n", "mx", "my", "cxx", "cyy", "cxy"]


def _pair_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of columns and task: rows with both, their means and centred second moments."""
    total = None
    for batch in batches:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
        there = ~np.isnan(x)
        # Centred at the batch's own means, so that large values lose no digits.
        n = there.sum(axis=0)
        middle = np.where(there, x, 0).sum(axis=0) / np.maximum(n, 1)
        x = np.where(there, x - middle, 0)
        there = there.astype(float)
        n, sx = there.T @ there, x.T @ there
        safe = np.maximum(n, 1)
        sxx, sxy = (x * x).T @ there, x.T @ x
        own = [n, middle[:, None] + sx / safe, middle + sx.T / safe,
               sxx - sx * sx / safe, sxx.T - sx.T * sx.T / safe, sxy - sx * sx.T / safe]
        if total is None:
            total = own
            continue
        both = np.maximum(total[0] + n, 1)
        dx, dy = own[1] - total[1], own[2] - total[2]
        share, mixed = n / both, total[0] * n / both
        total = [total[0] + n, total[1] + dx * share, total[2] + dy * share,
                 total[3] + own[3] + dx * dx * mixed, total[4] + own[4] + dy * dy * mixed,
                 total[5] + own[5] + dx * dy * mixed]
    if total is not None:
        i, j = np.triu_indices(len(total[0]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype("int32")), pa.array(j.astype("int32")),
             *(pa.array(t[i, j]) for t in total)], ["i", "j", *_MOMENTS])


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATION_COLUMNS) -> DataFrame:
    """Pearson correlation of each pair, over rows where both are present, in one scan.

    Rows (variable_x, variable_y, correlacion) hold the upper triangle and the diagonal.
    Variables without any value are left out, one that is constant or holds an infinite value has
    NULL. Each task hands on one row of centred moments per pair, so the rows themselves are
    neither repeated nor shuffled. NaN counts as absent.
    """
    columns = available(df, columns)
    if len(columns) < 2:
        raise ValueError("Una correlación compara dos variables presentes o más.")
    names = F.array(*[F.lit(c) for c in columns])
    numeric = df.select(*[F.col(c).try_cast("double").alias(c) for c in columns])
    parts = numeric.mapInArrow(
        _pair_moments, "i int, j int, " + ", ".join(f"{c} double" for c in _MOMENTS))
    # One row per task and pair; a task without the pair has n = 0 and adds nothing.
    pair = Window.partitionBy("i", "j")
    rows = F.sum("n").over(pair)
    mean_x, mean_y = (F.sum(F.col("n") * F.col(m)).over(pair) / F.nullif(rows, F.lit(0.0))
                      for m in ("mx", "my"))
    dx, dy = F.col("mx") - F.col("_x"), F.col("my") - F.col("_y")
    sums = parts.withColumns({"_x": mean_x, "_y": mean_y}).groupBy("i", "j").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("cxx") + F.col("n") * dx * dx).alias("xx"),
        F.sum(F.col("cyy") + F.col("n") * dy * dy).alias("yy"),
        F.sum(F.col("cxy") + F.col("n") * dx * dy).alias("xy"),
    )
    spread = F.sqrt(F.col("xx")) * F.sqrt(F.col("yy"))
    usable = (spread > 0) & (spread < float("inf"))
    correlation = F.greatest(F.lit(-1.0), F.least(
        F.lit(1.0), F.col("xy") / F.when(usable, spread)))
    return sums.filter("n > 0").select(
        F.get(names, F.col("i")).alias("variable_x"), F.get(names, F.col("j")).alias("variable_y"),
        F.when(usable, correlation).alias("correlacion"))


def linear_trend(df: DataFrame, x: str, y: str = "mp25") -> DataFrame:
    """Least-squares line y = pendiente * x + intercepto; NULL under two distinct x values."""
    require_columns(df, [x, y])
    pair = df.select(F.col(x).try_cast("double").alias("x"), F.col(y).try_cast("double").alias("y"))
    pair = pair.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    usable = F.min("x") < F.max("x")
    return pair.agg(
        F.count("*").alias("filas"),
        F.when(usable, F.regr_slope("y", "x")).alias("pendiente"),
        F.when(usable, F.regr_intercept("y", "x")).alias("intercepto"),
        F.min("x").alias("x_minimo"), F.max("x").alias("x_maximo"),
    )


def resample_mean(df: DataFrame, unit: str = "day", value: str = "mp25") -> DataFrame:
    """Mean per calendar bin (hour, day, week, month, ...); empty bins are absent."""
    require_columns(df, ["fecha_hora", value])
    start = F.date_trunc(unit, F.col("fecha_hora")).cast("timestamp_ntz")
    return (
        df.filter(F.col("fecha_hora").isNotNull() & F.col(value).isNotNull())
        .groupBy(start.alias("fecha_hora"))
        .agg(F.avg(value).alias(value))
        .orderBy("fecha_hora")
    )


def top_mean(df: DataFrame, key: str, top_n: int | None = 15, value: str = "mp25") -> DataFrame:
    """Highest means per key; rows without key or value are dropped. ``None`` keeps all keys."""
    require_columns(df, [key, value])
    if top_n is not None and top_n < 1:
        raise ValueError("top_n cuenta claves: pida una o más.")
    means = (
        df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key).agg(F.avg(value).alias(f"{value}_promedio"))
        .orderBy(F.desc(f"{value}_promedio"), key)
    )
    return means if top_n is None else means.limit(top_n)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum; the maximum is in the last bin."""
    value = F.col(column)
    # The column alone is written once, so bounds and bins do not evaluate ``df`` twice.
    present = materialize(df.select(column).filter(value.isNotNull()), "histogram")
    # Two numbers reach the driver.
    bounds = present.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    low, high = (F.lit(bound).cast("double") for bound in bounds)
    width = (high - low) / bins
    position = F.when(high == low, F.lit(0)).otherwise(
        F.least(F.floor((value - low) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    )
    return (
        present.groupBy(position.cast("int").alias("tramo"))
        .agg(F.count("*").alias("cantidad"))
        .withColumn("desde", low + F.col("tramo") * width)
        .withColumn("hasta", low + (F.col("tramo") + 1) * width)
        .orderBy("tramo")
    )


def modal_label(df: DataFrame, key: str = "cluster", label: str = "nivel_riesgo") -> DataFrame:
    """Most frequent non-null label per key, smallest label on ties, ``Cluster k`` when none.

    Counts come first, so only (key, label) pairs meet in the second aggregate.
    """
    counts = df.groupBy(key, label).agg(F.count("*").alias("n"))
    first = (
        counts.filter(F.col(label).isNotNull())
        .groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(label).alias("l"))).alias("m"))
        .select(key, F.col("m.l").alias("etiqueta"))
    )
    keys = counts.select(key).distinct()
    return keys.join(first, key, "left").withColumn(
        "etiqueta", F.coalesce("etiqueta", F.concat(F.lit("Cluster "), F.col(key)))
    )


def add_calendar(df: DataFrame) -> DataFrame:
    """Calendar columns from ``fecha_hora`` when the frame has it."""
    if "fecha_hora" not in df.columns:
        return df
    ts = F.col("fecha_hora")
    if isinstance(df.schema["fecha_hora"].dataType, T.StringType):
        df = df.withColumn("fecha_hora", ts.try_cast("timestamp_ntz"))
    return df.withColumns(calendar_parts("fecha_hora"))
