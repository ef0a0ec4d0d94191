"""Ranks, pages and positional windows that hold under skew.

A window partitioned by station sends a whole station to one task, which fails when a station
holds a third of the data. Here rows are counted per cell (a day, a station's day) first; running
totals over these small counts give ranks, pages and blocks of bounded size, whatever the size of
the groups. All of it is one lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ventis.session import materialize

BLOCK_ROWS = 200_000
_POSITION_BITS = 33


def _nulls_last(names: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def with_global_rank(df: DataFrame, order: Sequence[str | Column], rank: str = "_rank",
                     partitions: int | None = None) -> DataFrame:
    """Dense 0-based rank over the whole frame, without a single-partition window.

    Rows are range-partitioned and sorted by ``order`` (which must be a total order), written
    once, and numbered as partition offset + position. There are ``partitions`` of them, by default
    the session's shuffle partitions; a sorted partition may spill. The offsets table has one row
    per partition, so broadcasting it is bounded by the partition count, not by the data.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]
    placed = materialize(
        df.repartitionByRange(partitions, *columns)
        .sortWithinPartitions(*columns)
        .withColumn("_placed", F.monotonically_increasing_id()),
        "rank",
    )
    part = F.shiftright("_placed", _POSITION_BITS)
    position = F.col("_placed").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_offset") + position)
        .drop("_part", "_placed", "_offset")
    )


def positional_window(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    block_rows: int = BLOCK_ROWS,
    cell: Column | None = None,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``order`` must be a total order within a group. Rows are counted per group and cell (by
    default the day of the first order column; any expression that never falls along ``order``
    will do). Running totals over these counts put consecutive cells into blocks of about
    ``block_rows`` rows, and a cell whose rows are within reach of a neighbouring block is copied
    there, so every frame is complete and no task holds a whole group. A block has at most
    ``block_rows`` rows more than its last cell. Nothing runs and nothing is written here.
    """
    first = order[0]
    cell = F.to_date(first) if cell is None else cell
    keys = [*group, "_cell"]
    cut = df.withColumn("_cell", cell)
    along = Window.partitionBy(*group).orderBy(F.col("_cell").asc_nulls_last())
    counts = cut.groupBy(*keys).agg(F.count("*").alias("_rows"))
    last = F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, 0)) - 1
    placed = counts.withColumn("_last", last).withColumn("_first", F.col("_last") - F.col("_rows") + 1)
    placed = placed.withColumn("_home", F.floor(F.col("_first") / block_rows))
    # Cells hold a row at least, so a frame reaches no further than as many cells as it has rows.
    reach = [F.when(F.lead("_first", k).over(along) <= F.col("_last") + before,
                    F.lead("_home", k).over(along)) for k in range(1, before + 1)]
    reach += [F.when(F.lag("_last", k).over(along) >= F.col("_first") - after,
                     F.lag("_home", k).over(along)) for k in range(1, after + 1)]
    cells = placed.select(
        *keys, "_home",
        F.array_distinct(F.array_compact(F.array("_home", *reach))).alias("_blocks"))
    window = Window.partitionBy("_block", *group).orderBy(*_nulls_last(order))
    return (
        _join_on(cut, cells, keys)
        .withColumn("_block", F.explode("_blocks"))
        .withColumns(columns(window))
        .filter(F.col("_block") == F.col("_home"))
        .drop("_home", "_block", "_blocks", "_cell")
    )


# --- prefix counts ----------------------------------------------------------------------------

def _join_on(df: DataFrame, small: DataFrame, keys: Sequence[str], hint: bool = False) -> DataFrame:
    """Inner join on equal or both absent keys, each kept once."""
    other = small.withColumnsRenamed({k: f"_of{k}" for k in keys})
    match = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in keys))
    return df.join(F.broadcast(other) if hint else other, match).drop(*(f"_of{k}" for k in keys))


def _sorted_by(column: Column, up: bool) -> Column:
    return column.asc_nulls_last() if up else column.desc_nulls_last()


def cells_of(df: DataFrame, name: str) -> list[Column]:
    """Cells of a column, coarse to fine, that never fall along its order.

    Times: day, then the moment. Whole numbers: two sizes of ranges. Text: its start, then itself.
    """
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [F.to_date(column), column]
    if isinstance(kind, T.IntegralType):
        return [F.floor(column / 10**10), F.floor(column / 10**5)]
    if isinstance(kind, T.StringType):
        return [F.substring(column, 1, 3), column]
    if isinstance(kind, T.FractionalType):
        return [F.floor(column.cast("double")), column]
    return [column]


def prefix_index(df: DataFrame, levels: Sequence[str], up: Sequence[bool],
                 outer: Sequence[str] = ()) -> DataFrame:
    """Rows (outer, levels, _rows, _before, _all): rows per cell, rows in earlier cells, all rows.

    ``levels`` order the rows of each ``outer`` cell from coarse to fine. Counts are combined
    map-side; each level's running total runs inside the cell above it, only the coarsest one over
    all its values. So that level should have few: days, or ranges of numbers.
    """
    counts = [df.groupBy(*outer, *levels).agg(F.count("*").alias("_rows"))]
    for depth in range(len(levels) - 1, 0, -1):
        counts.append(counts[-1].groupBy(*outer, *levels[:depth]).agg(F.sum("_rows").alias("_rows")))
    index = None
    for depth, count in enumerate(reversed(counts)):
        above = [*outer, *levels[:depth]]
        inside = Window.partitionBy(*above)
        earlier = inside.orderBy(_sorted_by(F.col(levels[depth]), up[depth])).rowsBetween(
            Window.unboundedPreceding, -1)
        here = count.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        if index is None:
            index = here.withColumn("_all", F.sum("_rows").over(inside))
        else:
            totals = index.select(*above, F.col("_before").alias("_above"), "_all")
            index = _join_on(here, totals, above).withColumn(
                "_before", F.col("_before") + F.col("_above")).drop("_above")
    return index


def _with_levels(df: DataFrame, cells: Sequence[tuple[Column, bool]]) -> tuple[DataFrame, list[str], list[bool]]:
    names = [f"_level{k}" for k in range(len(cells))]
    return df.withColumns(dict(zip(names, (c for c, _ in cells)))), names, [up for _, up in cells]


def with_prefix_rank(df: DataFrame, order: Sequence[str], cells: Sequence[Column],
                     rank: str = "_rank", rows: str | None = None) -> DataFrame:
    """Dense 0-based rank by ``order`` (a total order, NULLs last), and the number of all rows.

    ``cells`` never fall along ``order`` and go from coarse to fine: the rank is the number of
    rows in earlier cells, from a :func:`prefix_index`, plus the row number inside the cell. Only
    rows of one finest cell have to meet in a task. Nothing runs and nothing is written here.
    """
    cut, names, up = _with_levels(df, [(c, True) for c in cells])
    # A struct is never absent, and absent parts of it are equal: join and window share one key and
    # with it one shuffle of the rows.
    cell = F.struct(*names)
    index = prefix_index(cut, names, up).select(cell.alias("_levels"), "_before", "_all")
    inside = Window.partitionBy("_levels").orderBy(*_nulls_last(order))
    ranked = cut.withColumn("_levels", cell).drop(*names).join(index, "_levels").withColumn(
        rank, F.col("_before") + F.row_number().over(inside) - 1)
    if rows is not None:
        ranked = ranked.withColumn(rows, F.col("_all"))
    return ranked.drop("_before", "_all", "_levels")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Filtering a row number lets Spark keep only ``n`` rows per key and map task before the
    shuffle (WindowGroupLimit), so a hot key never reaches one task whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= n).drop("_n")
    )


def page(df: DataFrame, order: Sequence[tuple[str, bool]], limit: int, offset: int = 0,
         max_limit: int = 1000, cells: dict[str, list[Column]] | None = None) -> DataFrame:
    """Rows ``offset`` .. ``offset + limit`` in a total order of (column, ascending) pairs.

    Column by column, a prefix index over the column's cells tells which of them the page touches,
    and only their rows go on to the next column; the rest is numbered inside its cells. Every
    cell holds a row at least, so a page touches at most ``limit`` cells: they are broadcast.
    ``cells`` replaces :func:`cells_of` for a column, e.g. by a coarser stored column and itself.
    NULLs come last.
    """
    if not 1 <= limit <= max_limit:
        raise ValueError(f"limit debe estar entre 1 y {max_limit}.")
    if offset < 0:
        raise ValueError("offset debe ser mayor o igual a 0.")
    # ``_page`` is the number of rows before the cells chosen so far.
    left, inside = df.withColumn("_page", F.lit(0).cast("long")), ["_page"]
    for name, up in order:
        chosen = (cells or {}).get(name) or cells_of(df, name)
        names = [f"_level{len(inside) + k}" for k in range(len(chosen))]
        left = left.withColumns(dict(zip(names, chosen)))
        before = F.col("_page") + F.col("_before")
        touched = prefix_index(left, names, [up] * len(names), inside).filter(
            (before < offset + limit) & (before + F.col("_rows") > offset))
        inside += names
        left = _join_on(left, touched.select(*inside, "_before"), inside, hint=True)
        left = left.withColumn("_page", F.col("_page") + F.col("_before")).drop("_before")
    columns = [_sorted_by(F.col(c), up) for c, up in order]
    place = F.col("_page") + F.row_number().over(Window.partitionBy(*inside).orderBy(*columns)) - 1
    return (
        left.withColumn("_place", place)
        .filter((F.col("_place") >= offset) & (F.col("_place") < offset + limit))
        .orderBy(*columns).select(*df.columns)
    )
