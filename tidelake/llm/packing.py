"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Partitions of some ten thousand pieces are packed best-fit, largest first, and emit the bins that are nearly full. The bins left underfull are
the items of the next round, over fewer partitions, until all that is left fits one chunk or rounds stop helping.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.base import fresh, others, process_value, settle, text_bytes

#: Items that a task packs at a time; bounds its memory.
CHUNK = 1 << 16
#: A bin with no more than this share of its room left is nearly full.
SLACK = 1 / 128


class ChunkIds(dict):
    """Token ids, as little-endian 32-bit numbers, of text chunks that no token crosses.

    A chunk begins at a space before a non-space, where the vocabulary's word pattern always begins a new word. Chunks met
    before are looked up. New ones go through the rank file of the same vocabulary if given, which is faster, as long as
    their characters are Latin; everything else, and text that spells a special token, goes through the tokenizer file.
    """

    CUT = re.compile(r"(?= \S)")
    LATIN = re.compile("[\x00-ɏ]*")

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None, kept: int = 200_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.kept, self.fast = Tokenizer.from_file(tokenizer), kept, None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def __missing__(self, chunk: str) -> bytes:
        if self.fast is not None and self.LATIN.fullmatch(chunk):
            ids = self.fast.encode_ordinary(chunk)
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        if len(chunk) <= 40 and len(self) < self.kept:
            self[chunk] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, self.CUT.split(text)))


def tokenise(docs: DataFrame, make_encoder: Callable[[], ChunkIds], encoder_key: str, capacity: int, text: str = "text", end: int = 0, with_ids: bool = True) -> DataFrame:
    """``docs`` without the text, a row per piece: piece, start, length, ids_crc32 and, if asked for, ids (little-endian 32-bit).

    A document is its ids and then ``end``; null and empty texts are ``end`` alone. Only documents longer than
    ``capacity`` are cut, from the back, so that all pieces but the first are whole sequences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, closing = process_value(encoder_key, make_encoder), np.array([end], "<u4").tobytes()
        for batch in batches:
            row, piece, start, length, crc, packed = [], [], [], [], [], []
            for i, value in enumerate(batch.column(batch.num_columns - 1)):
                value = value.as_py()
                ids = (encoder.encode(value.decode("utf-8", "replace")) if value else b"") + closing
                n = len(ids) // 4
                at, number = 0, 0
                while at < n:
                    size = n - at if n - at <= capacity else (n - at) % capacity or capacity
                    part = ids[4 * at : 4 * (at + size)]
                    for column, x in zip((row, piece, start, length, crc), (i, number, at, size, zlib.crc32(part))):
                        column.append(x)
                    if with_ids:
                        packed.append(part)
                    at, number = at + size, number + 1
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(c.take(rows) for c in batch.columns[:-1]), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()), *([pa.array(packed, pa.binary())] if with_ids else []),
                ],
                names,
            )

    added = T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long, ids binary")
    kept = others(docs, [text, *added.names])
    if not with_ids:
        added = T.StructType(added.fields[:-1])
    bare = docs.select(*kept, text_bytes(text).alias(fresh(docs, "_bytes")[0]))
    names = [*kept, *added.names]
    return bare.mapInArrow(run, T.StructType(bare.schema.fields[:-1] + added.fields))


def best_fit(fill: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin of each item and its offset there. Each item takes the fullest bin that has room.

    Bins are kept by the room left, and a bit per room tells which has any, so an item costs one shift.
    """
    bins, offset = np.zeros(len(fill), np.int64), np.zeros(len(fill), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n_bins = 0, 0
    for i in np.argsort(-fill, kind="stable").tolist():
        size = int(fill[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, n_bins
            n_bins += 1
        bins[i], offset[i] = chosen, capacity - room
        if room > size:
            if not by_room[room - size]:
                rooms |= 1 << (room - size)
            by_room[room - size].append(chosen)
    return bins, offset


def _packer(capacity: int, least: int):
    """A round inside a task: items (fill, items, offsets) to bins of the same form, with whether they are done."""

    def chunk(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        fill = table.column("fill").to_numpy().astype(np.int64)
        lists = table.column("items").combine_chunks()
        size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        items, offsets = lists.flatten().to_numpy(), table.column("offsets").combine_chunks().flatten().to_numpy().astype(np.int64)
        bins, base = best_fit(fill, capacity)
        owner = np.repeat(bins, size)
        place = offsets + np.repeat(base, size)
        order = np.lexsort((place, owner))
        starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=bins.max() + 1))]).astype(np.int32)
        filled = np.bincount(bins, weights=fill).astype(np.int32)
        ends = pa.array(starts, pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(filled), pa.ListArray.from_arrays(ends, pa.array(items[order])), pa.ListArray.from_arrays(ends, pa.array(place[order].astype(np.int32))),
                pa.array(filled >= least),
            ],
            ["fill", "items", "offsets", "done"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                yield chunk(held)
                held, n = [], 0
        if n:
            yield chunk(held)

    return run


def pack(items: DataFrame, item: str, length: str, capacity: int) -> DataFrame:
    """(item, sequence_id, offset) for items of 1 to ``capacity`` tokens with unique long ids.

    Sequences are gapless from offset 0. Items that fill a sequence are sequences at once. Underfull bins go through
    rounds over ever fewer partitions of ``CHUNK`` bins, as long as a round lowers their number by a fiftieth; the bins of
    every round are written, and members travel with their bin, at most ``capacity`` of them. An empty table gives no rows.
    """
    least = capacity - max(int(capacity * SLACK), 1)
    whole = items.where(F.col(length) >= capacity).select(F.col(item).alias("item"), F.col(item).alias("sequence_id"), F.lit(0).alias("offset"))
    short = items.where(F.col(length) < capacity)
    current = short.repartition(max(1, -(-short.count() // CHUNK))).select(F.col(length).cast("int").alias("fill"), F.array(F.col(item)).alias("items"), F.array(F.lit(0)).alias("offsets"))
    finished, before = [], None
    while True:
        bins = settle(current.mapInArrow(_packer(capacity, least), "fill int, items array<long>, offsets array<int>, done boolean"), "bins")
        under = bins.where(~F.col("done")).count()
        if before is not None and (before[0] == 1 or under > 0.98 * before[1]) or under == 0:
            finished.append(bins)
            break
        finished.append(bins.where("done"))
        parts = -(-under // CHUNK)
        before = (parts, under)
        current = bins.where(~F.col("done")).select("fill", "items", "offsets").repartition(parts)
    for bins in finished:
        members = bins.select(F.col("items")[0].alias("sequence_id"), F.explode(F.arrays_zip("items", "offsets")).alias("m"))
        whole = whole.unionByName(members.select(F.col("m.items").alias("item"), "sequence_id", F.col("m.offsets").alias("offset")))
    return whole


def pack_documents(
    docs: DataFrame, make_encoder: Callable[[], ChunkIds], encoder_key: str, capacity: int = 2048, text: str = "text", end: int = 0, with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with sequence_id and offset; with the ids themselves if asked for.

    Every row of ``docs`` yields a piece at least; rows that repeat are documents of their own. Input columns named as one of
    those added (in any case, ``ids`` included) are left out.
    """
    pieces = tokenise(docs, make_encoder, encoder_key, capacity, text, end, with_ids)
    item, *_ = fresh(docs, "item")
    pieces = pieces.select(*others(pieces, ["sequence_id", "offset"]))
    pieces = settle(pieces.withColumn(item, F.monotonically_increasing_id()), "pieces")
    packed = pack(pieces.select(item, "length"), item, "length", capacity)
    return pieces.join(packed.withColumnRenamed("item", item), item).drop(item)
