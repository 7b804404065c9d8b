"""Ordered operators that never put a whole series into one task.

A station may hold a third of all rows, so no window here is partitioned by
the station alone. A series is cut into *cells*, stretches of its order (a
calendar month by default). The order columns are unique within a key (that is
what ``align`` guarantees), so a cell of hourly rows holds at most 744 rows
whatever the size of the table, and a cell of integer ids ``CELL_IDS`` rows.

* :func:`with_position` numbers the rows of a series: row number inside the cell
  plus the rows in earlier cells. The cell counts come from a map-side combined
  ``groupBy``, and the only window partitioned by the key alone runs over them,
  one row per cell.
* :func:`over_rows` runs row windows that look back a bounded number of rows. It
  deals whole cells to blocks of some ``BLOCK_ROWS`` rows and copies the cells that
  hold the ``reach`` rows before a block to it, so that every window is complete and
  no block is longer than ``BLOCK_ROWS + reach`` rows and two cells.
* :func:`with_known` looks for the nearest known value at any distance: inside the
  cell by a window, beyond it by a value carried over the cell summaries.

Key columns must not be NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid.session import broadcast_bytes, stored

BLOCK_ROWS = 8192
CELL_IDS = 65536
SENT_ROWS = 1 << 18  # of facts that are broadcast

Cell = Callable[[str], Column]


def month_cell(ts: str) -> Column:
    """For series with at most one row per hour."""
    return F.trunc(F.col(ts).cast("date"), "month")


def day_cell(ts: str) -> Column:
    """For series with at most one row per second."""
    return F.col(ts).cast("date")


def id_cell(column: str) -> Column:
    """For unique whole numbers."""
    return F.floor(F.col(column) / F.lit(CELL_IDS))


def hash_cell(column: str) -> Column:
    """For 64-bit hashes: their upper 16 bits, which are spread evenly."""
    return F.shiftright(F.col(column), 48)


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cell: Cell = month_cell,
    tiebreak: Sequence[str] = (),
    position: str = "pos",
    total: str = "n_rows",
) -> DataFrame:
    """Add the row number within the key (from 1) and the key's row count."""
    keys = list(keys)
    celled = df.withColumn("__cell", cell(order))
    along = Window.partitionBy(*keys).orderBy("__cell")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    counts = (
        celled.groupBy(*keys, "__cell")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(
            *keys,
            "__cell",
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
            F.sum("__n").over(whole).alias(total),
        )
    )
    inside = Window.partitionBy(*keys, "__cell").orderBy(order, *tiebreak)
    return (
        celled.withColumn("__rn", F.row_number().over(inside))
        .join(counts, keys + ["__cell"])
        .withColumn(position, F.col("__before") + F.col("__rn"))
        .drop("__cell", "__rn", "__before")
    )


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    counted: Mapping[str, Column],
    cell: Cell = month_cell,
) -> DataFrame:
    """Number the rows of several conditions at once: ``pos_<name>`` and ``n_<name>``.

    The position counts only rows of the key for which the condition holds; other rows have
    none. All conditions share the same exchanges.
    """
    keys = list(keys)
    celled = df.withColumn("__cell", cell(order))
    for name, holds in counted.items():
        celled = celled.withColumn(f"__f_{name}", F.when(holds, 1).otherwise(0))
    along = Window.partitionBy(*keys).orderBy("__cell")
    before, whole = along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    counts = celled.groupBy(*keys, "__cell").agg(*[F.sum(f"__f_{n}").alias(f"__n_{n}") for n in counted])
    carried = [
        column
        for n in counted
        for column in (
            F.coalesce(F.sum(f"__n_{n}").over(before), F.lit(0)).alias(f"__b_{n}"),
            F.sum(f"__n_{n}").over(whole).alias(f"n_{n}"),
        )
    ]
    inside = Window.partitionBy(*keys, "__cell").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = celled.join(counts.select(*keys, "__cell", *carried), [*keys, "__cell"])
    placed = [
        F.when(F.col(f"__f_{n}") == 1, F.col(f"__b_{n}") + F.sum(f"__f_{n}").over(inside)).alias(f"pos_{n}")
        for n in counted
    ]
    return joined.select(*df.columns, *placed, *[f"n_{n}" for n in counted])


def cell_blocks(
    celled: DataFrame, keys: Sequence[str], reach: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Per cell its block, the blocks its rows are copied to, the rows before it and the key's rows.

    A block is the cells that start within one stretch of ``block_rows`` rows. A cell is also
    copied to each later block that starts less than ``reach`` rows after the cell's end. Built
    from counts: the windows run over one row per cell.
    """
    along = Window.partitionBy(*keys).orderBy("__cell")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    counts = celled.groupBy(*keys, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    placed = counts.select(
        *keys,
        "__cell",
        "__n",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(whole).alias("n_rows"),
    ).withColumn("__home", F.floor(F.col("__before") / block_rows))
    seen_by = F.floor((F.col("__before") + F.col("__n") + F.lit(reach - 1)) / block_rows)
    last = F.max("__home").over(whole)
    return placed.select(
        *keys,
        "__cell",
        "__before",
        "n_rows",
        "__home",
        F.sequence("__home", F.least(F.greatest(seen_by, "__home"), last)).alias("__blocks"),
    )


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    reach: int,
    columns: Callable[[Window], Mapping[str, Column]],
    cell: Cell = month_cell,
    block_rows: int = BLOCK_ROWS,
    keep_position: bool = False,
) -> DataFrame:
    """Add window columns that look back at most ``reach`` rows.

    ``columns`` gets the window (partition and order, no frame) and returns the
    new columns by name. All of them share one exchange and one sort. With
    ``keep_position`` the result has ``pos`` and ``n_rows`` as well, so that a split
    of the same rows needs no second numbering.

    Whole cells are dealt to blocks, so the rows need no numbers beforehand. The plan of the
    blocks has one row per cell and is written first: while Spark may broadcast it, the
    exchange by block is the only one the rows go through; beyond that they are also joined
    by cell, which no hot key can fill.
    """
    if reach > block_rows:
        raise ValueError("a block must hold at least as many rows as the windows look back")
    keys = list(keys)
    celled = df.withColumn("__cell", cell(order))
    blocks = stored(cell_blocks(celled, keys, reach, block_rows), "blocks")
    spread = celled.join(blocks, [*keys, "__cell"]).withColumn("__block", F.explode("__blocks"))
    window = Window.partitionBy(*keys, "__block").orderBy(order)
    made = dict(columns(window))
    if keep_position:
        made["pos"] = F.first("__before").over(window) + F.row_number().over(window)
    kept = [*df.columns, *made] + (["n_rows"] if keep_position else [])
    return spread.withColumns(made).filter("__block = __home").select(*dict.fromkeys(kept))


def with_known(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    last: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    cell: Cell = month_cell,
    include_current: bool = True,
) -> DataFrame:
    """Add, per row, the nearest non-null value of an expression.

    ``last`` looks backwards, ``following`` forwards, at any distance. Without
    ``include_current`` the row itself does not count.
    """
    keys = list(keys)
    last, following = dict(last or {}), dict(following or {})
    celled = df.withColumn("__cell", cell(order))
    for name, value in {**last, **following}.items():
        celled = celled.withColumn(f"__v_{name}", value)

    summaries, carried = [], []
    along = Window.partitionBy(*keys).orderBy("__cell")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    later = along.rowsBetween(1, Window.unboundedFollowing)
    for name in last:
        value = F.col(f"__v_{name}")
        summaries.append(
            F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias(f"__l_{name}")
        )
        carried.append(
            F.last(f"__l_{name}", ignorenulls=True).over(earlier).alias(f"__cl_{name}")
        )
    for name in following:
        value = F.col(f"__v_{name}")
        summaries.append(
            F.min_by(value, F.when(value.isNotNull(), F.col(order))).alias(f"__f_{name}")
        )
        carried.append(
            F.first(f"__f_{name}", ignorenulls=True).over(later).alias(f"__cf_{name}")
        )
    carry = (
        celled.groupBy(*keys, "__cell").agg(*summaries).select(*keys, "__cell", *carried)
    )

    edge = 0 if include_current else 1
    inside = Window.partitionBy(*keys, "__cell").orderBy(order)
    back = inside.rowsBetween(Window.unboundedPreceding, -edge)
    ahead = inside.rowsBetween(edge, Window.unboundedFollowing)
    found = {}
    for name in last:
        found[name] = F.coalesce(
            F.last(f"__v_{name}", ignorenulls=True).over(back), F.col(f"__cl_{name}")
        )
    for name in following:
        found[name] = F.coalesce(
            F.first(f"__v_{name}", ignorenulls=True).over(ahead), F.col(f"__cf_{name}")
        )
    joined = celled.join(carry, keys + ["__cell"])
    passed = [c for c in df.columns if c not in found]
    return joined.select(*passed, *[value.alias(name) for name, value in found.items()])


def _fits_broadcast(known: DataFrame) -> bool:
    """Whether a written table may be broadcast: files no larger than Spark's threshold, and few rows.

    Files hold sorted and repeated values in a small part of what the rows take in memory, so the
    size of the files alone does not bound what the driver would hold.
    """
    size = F.struct("_metadata.file_path", "_metadata.file_size")
    found = known.agg(F.count(F.lit(1)).alias("n"), F.collect_set(size).alias("files")).first()
    limit = broadcast_bytes(known.sparkSession)
    return found["n"] <= SENT_ROWS and sum(f["file_size"] for f in found["files"]) <= limit


def join_per_key(
    df: DataFrame, facts: DataFrame, keys: Sequence[str], spread: str, salts: int = 16
) -> DataFrame:
    """Left-join one row of facts per key without a hot task and, if possible, a shuffle.

    The facts are written first, so that their size is known when the join is planned:
    up to ``SENT_ROWS`` rows and ``spark.sql.autoBroadcastJoinThreshold`` they are broadcast, as
    they are, and ``df`` stays where it is. Above that the join shuffles, with each key spread
    over ``salts`` tasks by ``spread``, a column that differs within a key; only the facts are
    copied, and the copies are never broadcast.
    """
    known = stored(facts, "facts")
    if _fits_broadcast(known):
        return df.join(F.broadcast(known), list(keys), "left")
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = known.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [*keys, "__salt"], "left").drop("__salt")
