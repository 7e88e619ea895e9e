"""Running, bounded-frame and rank operators over an order, whatever the size of one group.

A plain window puts a whole group into one task. Here the rows are range-partitioned by
(group, order) into blocks, a summary of each block is carried forward to the blocks after it,
and the window then runs per (group, block). A group that holds a third of all rows is spread over
a third of the blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressbeat.storage import materialize, pieces_by_size

BLOCK = "_block"
HEAD = "_head"
BLOCK_BYTES = 128 * 1024 * 1024
FRAME_ROWS = 100_000


def block_count(df: DataFrame) -> int:
    """One block per 128 MB of estimated input, whatever the session's shuffle partitions are."""
    return pieces_by_size(df, BLOCK_BYTES)


def ordered_blocks(df: DataFrame, order: Sequence[str], part: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """Rows with the number of the range block they fall into.

    The blocks are frozen in a written table, since both the summaries and the rows read them.
    """
    ranged = df.repartitionByRange(blocks or block_count(df), *part, *order)
    return materialize(ranged.withColumn(BLOCK, F.spark_partition_id()), "blocks")


def running(
    df: DataFrame,
    outputs: dict[str, tuple[str, Column | str]],
    order: Sequence[str],
    part: Sequence[str] = (),
    reverse: bool = False,
    blocks: int | None = None,
) -> DataFrame:
    """Aggregates from the first row of the group to the current one.

    ``outputs`` maps a new column to ``(kind, value)`` with kind ``sum``, ``max``, ``min`` or ``last``
    (last value that is not NULL). ``reverse`` runs from the end of the order. ``order`` must be
    ascending columns that leave no ties, or ties must not matter.
    """
    held = {name: f"_v_{name}" for name in outputs}
    staged = df.withColumns(
        {held[name]: (F.col(value) if isinstance(value, str) else value) for name, (_, value) in outputs.items()}
    )
    rows = ordered_blocks(staged, order, part, blocks)
    position = F.struct(*order)

    def in_block(kind: str, column: str) -> Column:
        if kind == "last":
            pick = F.min_by if reverse else F.max_by
            return pick(F.col(column), F.when(F.col(column).isNotNull(), position))
        return getattr(F, kind)(column)

    def over(kind: str, column: str, window) -> Column:
        if kind == "last":
            return F.last(column, ignorenulls=True).over(window)
        return getattr(F, kind)(column).over(window)

    summary = rows.groupBy(*part, BLOCK).agg(*[in_block(kind, held[name]).alias(held[name]) for name, (kind, _) in outputs.items()])
    block_order = F.desc(BLOCK) if reverse else F.asc(BLOCK)
    # one row per (group, block): at most the number of blocks per group
    before = Window.partitionBy(*part).orderBy(block_order).rowsBetween(Window.unboundedPreceding, -1)
    heads = summary.select(
        *part, BLOCK, F.lit(0).alias(HEAD), *[over(kind, held[name], before).alias(held[name]) for name, (kind, _) in outputs.items()]
    )
    merged = rows.withColumn(HEAD, F.lit(1)).unionByName(heads, allowMissingColumns=True)
    sequence = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    upto = Window.partitionBy(*part, BLOCK).orderBy(HEAD, *sequence).rowsBetween(Window.unboundedPreceding, 0)
    done = merged.withColumns({name: over(kind, held[name], upto) for name, (kind, _) in outputs.items()})
    return done.filter(F.col(HEAD) == 1).drop(HEAD, BLOCK, *held.values())


def row_index(df: DataFrame, order: Sequence[str], part: Sequence[str] = (), name: str = "row_index") -> DataFrame:
    """1-based position of each row in its group."""
    return running(df, {name: ("sum", F.lit(1).cast("bigint"))}, order, part)


def bounded_frame(
    df: DataFrame,
    build: Callable[[object], dict[str, Column]],
    order: Sequence[str],
    part: Sequence[str] = (),
    before: int = 0,
    after: int = 0,
    frame_rows: int = FRAME_ROWS,
) -> DataFrame:
    """Window columns that look at most ``before`` rows back and ``after`` rows ahead.

    Groups are cut into runs of ``frame_rows`` rows; each run also gets the few rows around it that its
    frames reach, so no run needs more than its neighbours.
    """
    size = max(frame_rows, before, after, 1)
    indexed = row_index(df, order, part, "_rn")
    offset = F.col("_rn") - 1
    run, place = F.floor(offset / size), offset % size
    homes = F.array_compact(
        F.array(
            run,
            F.when(place >= size - before, run + 1),
            F.when((place < after) & (run > 0), run - 1),
        )
    )
    spread = indexed.withColumn("_run", run).withColumn("_home", F.explode(homes))
    window = Window.partitionBy(*part, "_home").orderBy("_rn")
    return spread.withColumns(build(window)).filter(F.col("_home") == F.col("_run")).drop("_rn", "_run", "_home")


def value_positions(df: DataFrame, column: str, part: Sequence[str] = ()) -> DataFrame:
    """Each distinct value with its count ``n``, the rows up to it ``upto`` and its dense position."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*part, column).agg(F.count(F.lit(1)).alias("n"))
    return running(counts, {"upto": ("sum", "n"), "dense": ("sum", F.lit(1).cast("bigint"))}, [column], part)


def join_same(df: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on the named columns in which NULL matches NULL."""
    renamed = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return df.join(renamed, condition, how).drop(*[f"_k_{k}" for k in keys])


def rank_by(df: DataFrame, column: str, part: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Adds ``rank``, ``dense_rank`` and ``rank_avg``; rows with a NULL value have no rank.

    Ranks are worked out on distinct values with their counts and joined back, so ties and large
    groups never meet in one window.
    """
    positions = value_positions(df, column, part)
    if descending:
        totals = positions.groupBy(*part).agg(F.max("upto").alias("_all"), F.max("dense").alias("_kinds"))
        if part:
            positions = join_same(positions, totals, part)
        else:
            positions = positions.withColumns(
                {"_all": totals.select("_all").scalar(), "_kinds": totals.select("_kinds").scalar()}
            )
        ranked = positions.select(
            *part, column,
            (F.col("_all") - F.col("upto") + 1).alias("rank"),
            (F.col("_kinds") - F.col("dense") + 1).alias("dense_rank"),
            "n",
        )
    else:
        ranked = positions.select(*part, column, (F.col("upto") - F.col("n") + 1).alias("rank"), F.col("dense").alias("dense_rank"), "n")
    ranked = ranked.withColumn("rank_avg", F.col("rank") + (F.col("n") - 1) / 2).drop("n")
    return join_same(df, ranked, [*part, column], "left")


def quantiles(df: DataFrame, column: str, probabilities: dict[str, float], part: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group (one row in all without groups)."""
    usable = df
    for name in part:
        usable = usable.filter(F.col(name).isNotNull())
    positions = materialize(value_positions(usable, column, part), "positions")
    totals = positions.groupBy(*part).agg(F.max("upto").alias("_all"))
    if part:
        placed = positions.join(totals, list(part))
    else:
        placed = positions.withColumn("_all", totals.scalar())
    outputs = []
    for name, p in probabilities.items():
        at = (F.col("_all") - 1) * F.lit(float(p))
        low, high = F.floor(at), F.ceil(at)
        first = F.col("upto") - F.col("n")
        low_value = F.max(F.when((first <= low) & (F.col("upto") > low), F.col(column)))
        high_value = F.max(F.when((first <= high) & (F.col("upto") > high), F.col(column)))
        share = F.max(at - low)
        outputs.append((low_value + (high_value - low_value) * share).alias(name))
    return placed.groupBy(*part).agg(*outputs)
