"""Shards by weighted rendezvous hashing of a stable record key; native columns only.

Each shard draws a number from (key, shard name); the record goes where ``-ln(u) / weight`` is smallest. A shard that is
added can only take records, a shard that leaves only gives its own away, and a weight of 2 draws twice the records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.base import fresh, others, settle

#: 13 hex digits are 52 bits, which a double holds exactly.
DIGITS = 13


def shard_weights(shards: int | Sequence[int] | Mapping[int, float]) -> dict[int, float]:
    """Shard numbers and their weights; a count means 0 .. count - 1, all alike."""
    if isinstance(shards, int):
        shards = range(shards)
    weights = dict(shards) if isinstance(shards, Mapping) else dict.fromkeys(shards, 1.0)
    if not weights or min(weights.values()) <= 0:
        raise ValueError("at least one shard, and weights above zero")
    return {int(k): float(v) for k, v in weights.items()}


def shard_of(key: Column, shards: int | Sequence[int] | Mapping[int, float]) -> Column:
    """The shard of ``key``; ties, which need equal 52-bit draws, go to the smaller number. A null key is a key too."""
    weights = shard_weights(shards)
    options = F.array(*[F.struct(F.lit(str(n)).alias("name"), F.lit(n).alias("shard"), F.lit(w).alias("weight")) for n, w in weights.items()])
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n"))

    def draw(option: Column) -> Column:
        digits = F.substring(F.md5(F.concat_ws("|", text, option["name"]).cast("binary")), 1, DIGITS)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DIGITS)
        return F.struct((-F.log(u) / option["weight"]).alias("cost"), option["shard"].alias("shard"))

    return F.array_min(F.transform(options, draw))["shard"]


def rendezvous_shards(
    df: DataFrame, key: str, shards: int | Sequence[int] | Mapping[int, float], grown: int | Sequence[int] | Mapping[int, float] | None = None
) -> DataFrame:
    """``df`` with ``shard`` and, if a second shard set is given, ``grown_shard``.

    A row-wise expression: no shuffle, no state, every row is kept (nulls, repeated and empty rows included); an existing
    column of that name is replaced. Rows with equal keys share a shard.
    """
    out = df.withColumn("shard", shard_of(F.col(key), shards))
    return out if grown is None else out.withColumn("grown_shard", shard_of(F.col(key), grown))


#: Rows alike that are numbered in one piece (a power of two), and how far beyond the mean a bucket is cut into such pieces.
PIECE_BITS = 13
CROWDED = 4


def with_slots(df: DataFrame, order: Sequence[str], digits: int = 2) -> DataFrame:
    """``df`` with ``slot``: a gapless number from 0 in each ``shard``.

    No task holds a whole shard: rows are numbered by ``order`` inside (shard, bucket), where 16 ** ``digits`` buckets are
    drawn from the digest of all of ``order``, and each bucket starts where the counts of those before it end. Rows alike
    in all of ``order`` are interchangeable and fall into one bucket, so a bucket far beyond the mean is cut further: its
    rows alike are counted by pieces of the written table, and only inside a piece are rows numbered. The rows are written
    once, so that counts and numbers see the same ones. An input column called slot is replaced.
    """
    bucket, piece, start, row, n, alike = fresh(df, "_bucket", "_piece", "_start", "_row", "_n", "_alike")
    digest = F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in order]).cast("binary")), 1, digits)
    kept, place = others(df, ["slot"]), ["shard", bucket]
    rows = settle(df.withColumns({bucket: digest, piece: F.shiftright(F.monotonically_increasing_id(), PIECE_BITS)}), "shards")
    counts = settle(rows.groupBy(*place).agg(F.count(F.lit(1)).alias(n)), "bucket-counts")
    before = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*place, n, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    limit = max(CROWDED * (counts.agg(F.avg(n)).first()[0] or 0), 1 << PIECE_BITS)
    inside = F.row_number().over(Window.partitionBy(*place).orderBy(*order))
    slot = (F.col(start) + F.col(row) - 1).alias("slot")
    out = rows.join(starts.where(F.col(n) <= limit).drop(n), place).withColumn(row, inside).select(*kept, slot)
    crowded = starts.where(F.col(n) > limit).drop(n)
    if crowded.isEmpty():
        return out
    # Rows alike share a digest, so that null values meet as well.
    same = F.md5(F.to_json(F.struct(*order), {"ignoreNullFields": "false"}).cast("binary"))
    held = rows.join(crowded, place).withColumn(alike, same)
    pieces = held.groupBy(*place, *order, alike, piece).agg(F.count(F.lit(1)).alias(n), F.first(start).alias(start))
    upto = Window.partitionBy(*place).orderBy(*order, alike, piece).rowsBetween(Window.unboundedPreceding, -1)
    begins = pieces.select(*place, alike, piece, (F.col(start) + F.coalesce(F.sum(n).over(upto), F.lit(0))).alias(start))
    number = F.row_number().over(Window.partitionBy(*place, alike, piece).orderBy(F.lit(0)))
    cut = held.drop(start).join(begins, [*place, alike, piece]).withColumn(row, number)
    return out.unionByName(cut.select(*kept, slot))
