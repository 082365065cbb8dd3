"""Operator 1: balanced shards by sampled splitters.

Records are ordered by a hash of their text, so equal texts are neighbours.
A size-weighted sample of keys gives quantile boundaries that cut the key
space into ranges; a range that turns out larger than ``range_bytes`` (a hot
text, or a poor sample) is subdivided by a hash of the document id.  Every
cell (subdivided range) is small enough for one task, and exact cell sizes
give each record its exact position in the whole order, which is then cut
into shards of equal bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm._store import materialize, without

OUT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
_KEY, _SPLIT, _CELL = "__shard_key", "__shard_split", "__shard_cell"
CELL_GROUP = 4096


def _keyed(docs: DataFrame) -> DataFrame:
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    return (without(docs, *OUT)
            .withColumn("size", (F.octet_length(data) + 8).cast("long"))
            .withColumn("text_crc32", F.crc32(data))
            .withColumn(_KEY, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
            .withColumn(_SPLIT, F.xxhash64(F.col("doc_id"), F.col(_KEY), F.lit("cell"))))


def splitters(keys: DataFrame, n_ranges: int, samples_per_range: int, total: int) -> np.ndarray:
    """Quantile boundaries of a sample that holds each record with probability
    in proportion to its size (at most about ``n_ranges * samples_per_range`` keys)."""
    rate = n_ranges * samples_per_range / max(total, 1)
    u = F.shiftrightunsigned(F.xxhash64(F.col(_SPLIT), F.lit("sample")), 11) / F.lit(float(1 << 53))
    sample = keys.where(u < F.col("size") * F.lit(rate)).select(_KEY).toPandas()[_KEY].to_numpy(np.int64)
    if not len(sample):
        return np.zeros(0, np.int64)
    sample.sort()
    return np.unique(sample[np.arange(1, n_ranges) * len(sample) // n_ranges])


def _running(sizes: DataFrame) -> DataFrame:
    """Bytes and rows of all cells before each one, of a table of cells with their bytes b and rows n.

    Sums in groups of neighbouring cells, then over the groups' totals.
    """
    sizes = materialize(sizes.withColumn("g", F.expr(f"{_CELL} div {CELL_GROUP}")), "shard-cell-sizes")
    so_far = Window.rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("g").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
    # One row for each CELL_GROUP cells.
    over = so_far.orderBy("g")
    groups = groups.select("g", F.coalesce(F.sum("b").over(over), F.lit(0)).alias("gb"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("gn"))
    inside = so_far.partitionBy("g").orderBy(_CELL)
    return sizes.join(groups, "g").select(
        _CELL, (F.col("gb") + F.coalesce(F.sum("b").over(inside), F.lit(0))).alias("__cell_bytes"),
        (F.col("gn") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("__cell_rows"))


def shard(docs: DataFrame, n_shards: int = 24, range_bytes: int = 32 << 20, min_ranges: int = 96,
          max_ranges: int = 4096, samples_per_range: int = 32) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, any others) with its shard and slot.

    Adds size (UTF-8 bytes of the text + 8), text_crc32 (unsigned), law
    ('bytes'), shard (0 to n_shards - 1), slot (gapless from 0 in the shard)
    and grown_shard (null under this law); input columns with these names are
    replaced.  Shards differ in bytes by at most about two records' sizes.
    Null text: size 8, CRC of no bytes (0).  Rows that agree in doc_id and
    text are interchangeable and get neighbouring slots.  Null doc_ids sort
    first.  An empty table gives no rows.

    Driver state: a sample of at most about max_ranges * samples_per_range
    keys and one number per range.  The cell table has at most max_ranges +
    total / range_bytes rows; it is joined without a hint, on the cells'
    own partitioning, and its running sums are taken in groups of
    ``CELL_GROUP`` cells, so one task sees a row for each group.  Rows equal
    in doc_id and text are never split over cells.
    """
    rows = _keyed(docs)
    keys = materialize(rows.select("doc_id", "size", _KEY, _SPLIT), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    n_ranges = int(min(max_ranges, max(min_ranges, total // range_bytes)))
    bounds = splitters(keys, n_ranges, samples_per_range, total)

    @F.pandas_udf("int")
    def range_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for key in batches:
            yield pd.Series(np.searchsorted(bounds, key.to_numpy(), side="right").astype(np.int32))

    # Pieces of each range: 1, or enough to bring an overfull one under range_bytes.
    sizes = dict(keys.groupBy(range_of(_KEY).alias("r")).agg(F.sum("size")).toPandas().itertuples(index=False))
    limit = max(1, min(range_bytes, 2 * total // n_ranges))
    pieces = np.array([-(-int(sizes.get(r, 0)) // limit) or 1 for r in range(len(bounds) + 1)], np.int64)
    first = np.concatenate([[0], np.cumsum(pieces)])

    @F.pandas_udf("long")
    def cell_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for key, split in batches:
            r = np.searchsorted(bounds, key.to_numpy(), side="right")
            yield pd.Series(first[r] + np.mod(split.to_numpy(), pieces[r]))

    def placed(df: DataFrame) -> DataFrame:
        """Rows with their global rank and shard."""
        inside = Window.partitionBy(_CELL).orderBy(_KEY, F.col("doc_id"), "size")
        upto = inside.rowsBetween(Window.unboundedPreceding, -1)
        return (df.withColumn(_CELL, cell_of(_KEY, _SPLIT))
                .withColumn("__shard_before", F.coalesce(F.sum("size").over(upto), F.lit(0)))
                .withColumn("__shard_rank", F.row_number().over(inside) - 1)
                .join(cells, _CELL, "left")
                .withColumn("__shard_rank", F.col("__shard_rank") + F.col("__cell_rows"))
                .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(
                    f"((2 * (__shard_before + __cell_bytes) + size) * {n_shards}) div {2 * max(total, 1)}")).cast("int")))

    cells = materialize(_running(keys.groupBy(cell_of(_KEY, _SPLIT).alias(_CELL)).agg(F.sum("size").alias("b"), F.count("*").alias("n"))),
                        "shard-cells")
    firsts = materialize(placed(keys).groupBy("shard").agg(F.min("__shard_rank").alias("__shard_first")), "shard-firsts")
    return (placed(rows).join(F.broadcast(firsts), "shard", "left")
            .withColumn("slot", (F.col("__shard_rank") - F.col("__shard_first")).cast("long"))
            .withColumn("law", F.lit("bytes"))
            .withColumn("grown_shard", F.lit(None).cast("int"))
            .select(*without(docs, *OUT).columns, *OUT))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write each shard as a folder ``shard=N`` of Parquet files, in slot order within a file.

    Rebalancing lets Spark write a large shard with several tasks.
    """
    sharded.hint("rebalance", "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
