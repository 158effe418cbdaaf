"""Global order without a global window: positions, next rows and tied ranks at any size.

A window without a partition key puts every row into one task. These operators range-partition
the rows instead, work inside each slice, stage the result, and carry the boundaries between slices
in tables with one row per slice. The order must be total (end it with a unique key), so a value
shared by a third of the rows is still spread over many slices.

Staging matters: range boundaries come from a sample, and a second evaluation of the same plan could
draw others.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roleweave.session import stage

SLICE = "_slice"
# Rows of a slice.
SLICE_ROWS = 1 << 20


def _sliced(df: DataFrame, keys: Sequence[Column], staged: bool = False) -> DataFrame:
    """Range-partition on ascending `keys` and label the slices.

    Range partitioning reads its input twice, once for the sample; input that is not staged yet is
    staged, so that whatever computes it runs once.
    """
    rows = df if staged else stage(df, "unordered")
    return _ranged(rows, keys).withColumn(SLICE, F.spark_partition_id())


def _ranged(rows: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Range-partition staged rows into slices of about SLICE_ROWS rows at most; counting a staged table reads its footers.

    While the session's shuffle partitions are enough for that, the number of slices is left to the adaptive planner: small
    inputs get few, and neighbours are merged in order. Larger inputs get a number of slices that grows with them.
    """
    slices = -(-rows.count() // SLICE_ROWS)
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(slices, *keys) if slices > usual else rows.repartitionByRange(*keys)


def _per_slice(values: dict[int, object], element: str) -> Column:
    """The value of the row's slice, out of one small array literal."""
    filled = [values.get(i) for i in range(max(values, default=0) + 1)]
    return F.try_element_at(F.from_json(F.lit(json.dumps(filled)), f"array<{element}>"), F.col(SLICE) + 1)


def _rows_before(rows: dict[int, int]) -> dict[int, int]:
    """Running total of the slices before each slice."""
    order = sorted(rows)
    return dict(zip(order, accumulate([0] + [rows[s] for s in order])))


def numbered_in_order(rows: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Adds the slice of every row and its number there, with the range shuffle as the only one.

    Inside a sorted partition the generated ids count up from zero; their upper bits are the partition.
    """
    ordered = _ranged(rows, keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    return ordered.withColumns(
        {SLICE: F.shiftright("_id", 33).cast("int"), "_row": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1}
    ).drop("_id")


def with_position(
    df: DataFrame, keys: Sequence[Column], name: str = "position", staged: bool = False
) -> DataFrame:
    """Add the 1-based position of every row in the order of `keys`."""
    rows = df if staged else stage(df, "unordered")
    numbered = stage(numbered_in_order(rows, keys), "positions")
    counts = numbered.groupBy(SLICE).agg(F.max("_row").alias("n")).collect()  # one row per slice
    before = _per_slice(_rows_before({r[SLICE]: r.n for r in counts}), "bigint")
    return numbered.withColumn(name, before + F.col("_row")).drop(SLICE, "_row")


def with_next(df: DataFrame, keys: Sequence[Column], value: str, name: str) -> DataFrame:
    """Add the integer `value` of the following row in the order of `keys`; null on the last row."""
    order = Window.partitionBy(SLICE).orderBy(*keys)
    linked = stage(
        _sliced(df, keys).withColumns({name: F.lead(value).over(order), "_row": F.row_number().over(order)}), "links"
    )
    heads = linked.filter("_row = 1").select(SLICE, F.col(value).alias("head")).collect()  # one row per slice
    ordered = sorted((r[SLICE], r.head) for r in heads)
    following = {this[0]: after[1] for this, after in zip(ordered, ordered[1:])}
    return linked.withColumn(name, F.coalesce(name, _per_slice(following, "bigint"))).drop(SLICE, "_row")


def with_average_rank(
    df: DataFrame, value: str, unique: str, name: str, groups: Sequence[str] = (), staged: bool = False
) -> DataFrame:
    """Add the rank of `value`, ties sharing the mean of their positions.

    With `groups`, rows are ranked by group first: ranks of one group are shifted by the number of
    rows in the groups before it, which no correlation within a group can see.
    """
    tie = [F.col(g) for g in groups] + [F.col(value)]
    peers = Window.partitionBy(SLICE).orderBy(*tie)
    ranked = stage(
        _sliced(df, tie + [F.col(unique)], staged)
        .withColumn("_first", F.rank().over(peers))
        .withColumn("_last", F.count(F.lit(1)).over(peers))  # the range frame counts all ties
        .withColumn("_tie", F.struct(*tie)),
        "ranks",
    )
    edges = (
        ranked.groupBy(SLICE)
        .agg(
            F.min("_tie").alias("low"),
            F.min("_last").alias("low_last"),
            F.max("_tie").alias("high"),
            F.max("_first").alias("high_first"),
            F.max("_last").alias("n"),
        )
        .orderBy(SLICE)
        .collect()  # one row per slice
    )
    before = _rows_before({e[SLICE]: e.n for e in edges})
    # A tie that crosses slices is the highest value of one and the lowest of the next.
    spans: dict[tuple, tuple[int, int]] = {}
    for this, after in zip(edges, edges[1:]):
        if this.high == after.low:
            first, _ = spans.get(tuple(this.high), (before[this[SLICE]] + this.high_first, 0))
            spans[tuple(this.high)] = (first, before[after[SLICE]] + after.low_last)
    shift = _per_slice(before, "bigint")
    first, last = shift + F.col("_first"), shift + F.col("_last")
    if spans:
        schema = f"tie {ranked.schema['_tie'].dataType.simpleString()}, span_first bigint, span_last bigint"
        crossing = df.sparkSession.createDataFrame([(t, a, b) for t, (a, b) in spans.items()], schema)
        # Fewer rows than slices.
        ranked = ranked.join(F.broadcast(crossing), F.col("_tie") == F.col("tie"), "left")
        first, last = F.coalesce("span_first", first), F.coalesce("span_last", last)
    return ranked.withColumn(name, (first + last) / 2.0).select(*df.columns, name)
