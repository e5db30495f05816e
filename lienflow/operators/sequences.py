"""The previous value within a key, for keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A key with more rows than this is spread over several tasks.
HOT_ROWS = 1_000_000
# Rows that one piece of a hot key, or one task of the plain window, should hold.
PIECE_ROWS = 250_000
# Keys are first counted in so many buckets by their hash.
BUCKETS = 4096


def _order(columns: list[str]) -> list[Column]:
    return [F.col(c) for c in columns]


def hot_keys(rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys that hold more than ``hot_rows`` rows: counted before the shuffle.

    There can be no more than (all rows / ``hot_rows``) of them.
    """
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > hot_rows)


def with_previous(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    name: str = "previous",
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add struct ``name`` with ``value`` of the row before, in ``order`` within ``keys``; null for the first.

    The common case is one window on the keys.  Keys above ``hot_rows`` (measured on ``counted``,
    which may leave out parts that hold a key only once) go through ``_spread_previous``.
    Key columns must not be null.

    A bucket of keys holds all rows of each, so keys are only counted in buckets with enough rows for a hot one.  The
    window gets as many tasks as the rows need, whatever their size in the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*_order(order))
    plain = F.lag(F.struct(value)).over(window)
    counted = rows if counted is None else counted
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    buckets = counted.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows")).collect()
    total = sum(r["rows"] for r in buckets)
    full = [r["bucket"] for r in buckets if r["rows"] > hot_rows]
    hot = hot_keys(counted.filter(bucket.isin(full)), keys, hot_rows) if full else None
    totals = hot.agg(F.count("*").alias("keys"), F.sum("rows").alias("rows")).first() if full else {"keys": 0}
    if total > PIECE_ROWS:
        tasks = max(total // PIECE_ROWS + 1, rows.sparkSession.sparkContext.defaultParallelism)
        dealt = rows.repartition(tasks, *keys)
    else:
        dealt = rows
    if not totals["keys"]:
        return dealt.withColumn(name, plain)
    listed = hot.select(*keys)
    few = dealt.join(listed, keys, "left_anti").withColumn(name, plain)
    pieces = totals["rows"] // PIECE_ROWS + 8
    many = _spread_previous(rows.join(listed, keys, "left_semi"), keys, order, value, name, pieces)
    return few.unionByName(many)


def _spread_previous(
    rows: DataFrame, keys: list[str], order: list[str], value: str, name: str, pieces: int
) -> DataFrame:
    """The same result with each key cut into pieces along the order.

    Range partitioning puts consecutive rows of a key into one piece.  The first window works inside
    pieces; only the first row of a piece lacks its predecessor, which is the last row of an earlier
    piece.  The second window sees the border rows of a key together, at most two per piece, and the
    inner rows piece by piece, so no task ever holds a whole hot key.
    """
    placed = rows.repartitionByRange(pieces, *keys, *order).withColumn("_piece", F.spark_partition_id())
    inside = Window.partitionBy("_piece", *keys).orderBy(*_order(order))
    marked = placed.withColumns(
        {
            "_near": F.lag(F.struct(value)).over(inside),
            "_first": F.row_number().over(inside) == 1,
            "_last": F.lead(F.lit(1)).over(inside).isNull(),
        }
    )
    border = F.when(F.col("_first") | F.col("_last"), -1).otherwise(F.col("_piece"))
    across = Window.partitionBy(*keys, "_group").orderBy(*_order(order))
    joined = marked.withColumn("_group", border).withColumn("_far", F.lag(F.struct(value)).over(across))
    previous = F.when(F.col("_first"), F.col("_far")).otherwise(F.col("_near"))
    return joined.withColumn(name, previous).drop("_piece", "_near", "_first", "_last", "_group", "_far")
