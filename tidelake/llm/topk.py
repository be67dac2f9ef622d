"""Exact top-k inner products by histogram selection.

Everything is scored in blocks, several times, and no score is kept: each pass counts, per query, how many scores fall into
each of ``BINS`` equal bins of the query's interval, and the bin that holds the k-th highest score becomes the next
interval. Intervals shrink by ``BINS`` a pass, until the k-th score itself is known. A last pass keeps the scores above
it and, of those equal to it, the smallest ids that are still needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.base import settle

BINS = 256
#: Rows in a block of queries or candidates, and blocks of queries that one task meets.
QUERY_BLOCK = 512
ROW_BLOCK = 2048
QUERY_GROUP = 256

RESULT = "query_id long, rank int, vec_id long, score long"


def quantise(df: DataFrame, vector: str, scale: float) -> DataFrame:
    """Rows whose vector takes part, with ``v``: each component as double, times ``scale``, rounded down.

    Null vectors, and those holding a null, NaN or infinite component, take no part. An empty vector scores 0.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return df.where(F.col(vector).isNotNull()).where(~bad).withColumn(
        "v", F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    )


def _blocks(df: DataFrame, size: int, dims: int, kind: str) -> DataFrame:
    """Rows packed into blocks of at most ``size``: (block, ids, data); written, so that block numbers stay."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column("v")
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
                matrix = np.zeros((part.num_rows, dims), dtype=kind)
                matrix[np.arange(dims) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
                ids = part.column("id").to_numpy(zero_copy_only=False).astype("<i8")
                yield pa.RecordBatch.from_pydict({"ids": [ids.tobytes()], "data": [matrix.tobytes()]})

    packed = df.select("id", "v").mapInArrow(pack, "ids binary, data binary")
    return settle(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")


class _Pair:
    """A block of queries against a block of rows."""

    def __init__(self, row: dict, dims: int, kind: str, exact):
        self.ids, self.rows = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["row_ids"], "<i8")
        whole = np.int32 if exact is np.float32 else np.int64
        self.low, self.need = np.zeros((len(self.ids), 1), whole), np.zeros((len(self.ids), 1), np.int64)
        at = np.asarray(row["i"], np.int64)  # a query without candidates has no interval
        self.low[at, 0], self.need[at, 0] = row["low"], row["need"]
        asked = np.frombuffer(row["data"], kind).reshape(-1, dims).astype(exact)
        given = np.frombuffer(row["rows"], kind).reshape(-1, dims).astype(exact)
        order = np.argsort(self.rows, kind="stable")
        self.rows = self.rows[order]
        self.scores = (asked @ given[order].T).astype(whole)
        self.others = self.ids[:, None] != self.rows[None, :] if np.isin(self.ids, self.rows).any() else True


def _counter(dims: int, kind: str, exact, span: int):
    """Per query and bin of width ``span``, a power of two, the number of scores; summed over the blocks that a task meets."""
    shift = span.bit_length() - 1

    def flush(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for q, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), q, np.int64)), pa.array((at // BINS).astype(np.int32)), pa.array((at % BINS).astype(np.int32)), pa.array(counts[at].astype(np.int64))],
                ["q", "i", "bin", "n"],
            )
        sums.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                p = _Pair(row, dims, kind, exact)
                bins = (p.scores - p.low) >> shift
                inside = (bins >= 0) & (bins < BINS) & p.others
                bins += np.arange(len(p.ids), dtype=bins.dtype)[:, None] * BINS
                counts = np.bincount(bins[inside], minlength=len(p.ids) * BINS)
                sums[row["q"]] = sums.get(row["q"], 0) + counts
                if len(sums) > 32:
                    yield from flush(sums)
        yield from flush(sums)

    return count


def _keeper(dims: int, kind: str, exact):
    """Scores above the k-th, and of those equal to it the block's smallest ids, as many as are needed at most."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                p = _Pair(row, dims, kind, exact)
                at = np.flatnonzero((p.scores >= p.low) & p.others)
                qi, ri = at // len(p.rows), at % len(p.rows)
                scores = p.scores[qi, ri]
                equal = scores == p.low[qi, 0]
                before = np.concatenate([[0], np.cumsum(equal)])
                taken = ~equal | (before[1:] - before[np.searchsorted(qi, qi)] <= p.need[qi, 0])
                qi, ri = qi[taken], ri[taken]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.ids[qi].astype(np.int64)), pa.array(p.rows[ri].astype(np.int64)), pa.array(scores[taken].astype(np.int64))],
                    ["query_id", "vec_id", "score"],
                )

    return keep


def _narrowed(state: DataFrame, counts: DataFrame, span: int) -> DataFrame:
    """The next interval of each query: the bin in which its needed-th score from above lies.

    Where fewer scores are left than needed, the lowest bin that holds any is taken, with all its scores.
    """
    query = Window.partitionBy("q", "i")
    over = F.coalesce(F.sum("n").over(query.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counts.join(state.hint("merge"), ["q", "i"]).select(
        "q", "i", "bin", "n", "low", "need", over.alias("over"), F.min("bin").over(query).alias("lowest")
    )
    chosen = counted.where((F.col("over") < F.col("need")) & ((F.col("over") + F.col("n") >= F.col("need")) | (F.col("bin") == F.col("lowest"))))
    return chosen.select(
        "q", "i", (F.col("low") + F.col("bin") * F.lit(span).cast("long")).alias("low"),
        F.least(F.col("need") - F.col("over"), F.col("n")).alias("need"),
    )


def _groups(row_blocks: int, query_blocks: int, tasks: int) -> tuple[int, int]:
    """Row groups and query groups: four pairs of groups or more for a task as far as there are blocks, and so many of each that the least is copied.

    Each row block is copied once per query group, each query block once per row group.
    """
    row_blocks, query_blocks, pairs = max(1, row_blocks), max(1, query_blocks), 4 * tasks
    even = round(math.sqrt(pairs * query_blocks * QUERY_BLOCK / (row_blocks * ROW_BLOCK)))
    query_groups = min(query_blocks, max(even, -(-query_blocks // QUERY_GROUP), -(-pairs // row_blocks)))
    return min(row_blocks, -(-pairs // query_groups)), query_groups


def inner_product_topk(df: DataFrame, id_column: str, vector: str, asks: Column, k: int, scale: float = 64.0) -> DataFrame:
    """For each row where ``asks`` holds, the ``k`` highest scores over all other rows: query_id, rank, vec_id, score.

    Fewer rows than ``k`` give all of them; an empty table gives no rows. Ties go to the smaller id. Vectors of unequal
    length count as padded with zeros. Rows with a null id take no part. Each row of a repeated id is a candidate; of a
    repeated query id the smallest vector is the query, and no row of that id is its candidate. Other columns are not
    read. Products must fit a long, larger ones raise.

    Blocks meet under an equality key (row group, query group), so work is spread whatever the vectors hold and equal
    vectors form no group anywhere. A pass shuffles the blocks and at most ``BINS`` counts per query and task. Blocks and
    intervals are joined by merging: the planner does not know how often blocks are copied, nor how much intervals shrink
    when written, and would send them all through the driver.
    """
    spark = df.sparkSession
    read = df.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("x"), asks.alias("asks"))
    points = settle(quantise(read, "x", scale).select("id", "v", "asks"), "points")
    size = points.select(
        F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("norm"),
    ).first()
    dims, bound = max(size.dims or 0, 1), (size.norm or 0.0) * 1.0001 + 1
    if bound >= 2**62:
        raise ValueError("inner products of these vectors do not fit a long")
    largest = size.largest or 0
    kind = "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<i8"
    # Sums of products are exact in floating point as long as they stay below these powers.
    exact = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    queries = _blocks(points.where("asks").groupBy("id").agg(F.min("v").alias("v")), QUERY_BLOCK, dims, kind)
    rows = _blocks(points, ROW_BLOCK, dims, kind)
    row_groups, query_groups = _groups(rows.count(), queries.count(), tasks)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = rows.select(F.col("ids").alias("row_ids"), F.col("data").alias("rows"), F.pmod(F.xxhash64("block"), F.lit(row_groups)).cast("int").alias("g"), every(query_groups).alias("h"))
    asked = queries.select(F.col("block").alias("q"), "ids", "data", F.pmod(F.xxhash64("block"), F.lit(query_groups)).cast("int").alias("h"))

    top = int(bound) + 1
    span = 1
    while span * BINS < 2 * top + 1:
        span *= BINS
    state = queries.select(
        F.col("block").alias("q"), F.explode(F.sequence(F.lit(0), (F.octet_length("ids") / 8).cast("int") - 1)).alias("i")
    ).select("q", "i", F.lit(-top).cast("long").alias("low"), F.lit(k).cast("long").alias("need"))

    def pairs(state: DataFrame) -> DataFrame:
        """Row blocks beside query blocks, with the intervals and the places of their queries."""
        at = F.collect_list(F.struct("i", "low", "need")).alias("at")
        lists = state.groupBy("q").agg(at).select("q", F.col("at.i").alias("i"), F.col("at.low").alias("low"), F.col("at.need").alias("need"))
        placed = asked.join(lists.hint("merge"), "q").select("*", every(row_groups).alias("g"))
        return rows.join(placed.hint("merge"), ["g", "h"]).select("q", "ids", "data", "row_ids", "rows", "i", "low", "need")

    while True:
        counts = pairs(state).mapInArrow(_counter(dims, kind, exact, span), "q long, i int, bin int, n long")
        state = settle(_narrowed(state, counts.groupBy("q", "i", "bin").agg(F.sum("n").alias("n")), span), "intervals")
        if span == 1:
            break
        span //= BINS
    found = pairs(state).mapInArrow(_keeper(dims, kind, exact), "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(ranked).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
