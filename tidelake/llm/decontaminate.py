"""Benchmark decontamination by winnowing.

Of each run of ``w`` consecutive k-grams the one with the least hash is kept, the last on ties. Two texts that share
``k + w - 1`` words share a kept k-gram at the same place of the shared span, so choosing ``k + w - 1`` as the window length
finds every shared window. Kept k-grams of documents and benchmark are joined, and each hit is extended to the whole window
word by word. Items shorter than the window are windows of their own length and get a k and w of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.base import filter_bits, fresh, others, process_value, settle, text_bytes, word_bytes

WINDOW = 13
#: Binary logarithm of the most bits the filter may have that spares the join document k-grams without a counterpart
#: (16 MB). It has 32 to 64 bits per benchmark hash up to 4 million of them; beyond that more k-grams pass to the join.
FILTER_BITS = 27
_BASE = np.uint64(0x9E3779B97F4A7C15)


def gram_length(window: int) -> int:
    """k for a window length: 8 of 13 words, and never less than half."""
    return max(1, -(-8 * window // 13))


class WordHashes(dict):
    """Hashes of the words met so far by a worker, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def winnow(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the kept k-grams; a sequence shorter than the window keeps none."""
    k = gram_length(window)
    n = len(hashes) - window + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(hashes) - k + 1
    gram = np.zeros(m, np.uint64)
    for j in range(k):
        gram = gram * _BASE + hashes[j : j + m]
    gram ^= gram >> np.uint64(31)
    gram *= _BASE
    gram ^= gram >> np.uint64(29)
    place = np.arange(n)
    least = gram[:n].copy()
    for j in range(1, window - k + 1):
        other = gram[j : j + n]
        later = other <= least
        least = np.where(later, other, least)
        place = np.where(later, np.arange(j, j + n), place)
    place = np.unique(place)
    return place, gram[place]


def _hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def benchmark_windows(items: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Distinct windows of the benchmark: (length, hash of the kept k-gram, its offset in the window, words, item)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = process_value("winnow-words", WordHashes)
        for batch in batches:
            out: dict[str, list] = {"item": [], "length": [], "hash": [], "offset": [], "words": []}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = word_bytes(value)
                if not words:
                    continue
                length = min(window, len(words))
                hashes = _hashes(words, known)
                for at in range(len(words) - length + 1):
                    place, gram = winnow(hashes[at : at + length], length)
                    out["item"].append(name)
                    out["length"].append(length)
                    out["hash"].append(int(gram.view(np.int64)[0]))
                    out["offset"].append(int(place[0]))
                    out["words"].append(words[at : at + length])
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("item", pa.string()), ("length", pa.int32()), ("hash", pa.int64()), ("offset", pa.int32()), ("words", pa.list_(pa.binary()))
            ]))

    named = items.where(F.col(item).isNotNull()).select(F.col(item).cast("string").alias("item"), text_bytes(text).alias("t"))
    return named.mapInArrow(run, "item string, length int, hash long, offset int, words array<binary>").distinct()


def _filter_bits(hashes: DataFrame) -> np.ndarray:
    return filter_bits(hashes, FILTER_BITS)


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Per row of ``docs``: its columns but the text, n_words, n_hit, n_items, items_sha256 and spans.

    A word is hit if it lies inside an occurrence of any benchmark window; spans are the merged runs of hit words as
    (start, end), and n_items counts the items that occur. Null and empty texts have no words; items of null id or
    without words have no windows; repeated items and windows count once. Every row is kept, repeated keys too.
    """
    spark = docs.sparkSession
    raised = settle(benchmark_windows(items, item, item_text, window), "item-windows")
    # A window that many items share is met once; who owns it is looked up at the end.
    windows = settle(raised.drop("item").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    owners = settle(raised.join(windows, ["length", "hash", "offset", "words"]).select("window", "item"), "owners")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())
    bits = spark.sparkContext.broadcast(_filter_bits(windows.select("hash").distinct()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, filled = process_value("winnow-words", WordHashes), bits.value
        mask = np.uint64(32 * len(filled) - 1)
        hit_type = pa.list_(pa.struct([("length", pa.int32()), ("hash", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("around", pa.list_(pa.binary()))]))
        for batch in batches:
            n_words, hits = [], []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                words = word_bytes(value)
                n_words.append(len(words))
                hits.append(found := [])
                if not words or not lengths:
                    continue
                hashes = _hashes(words, known)
                for length in lengths:
                    place, gram = winnow(hashes, length)
                    low = gram & mask
                    maybe = (filled[(low >> np.uint64(5)).astype(np.int64)] >> (low & np.uint64(31)).astype(np.uint32)) & 1 == 1
                    k = gram_length(length)
                    for at, h in zip(place[maybe].tolist(), gram[maybe].view(np.int64).tolist()):
                        first = max(0, at - (length - k))
                        found.append({"length": length, "hash": h, "at": at, "first": first, "around": words[first : at + length]})
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(hits, hit_type)], names)

    kept = others(docs, [text, "n_words", "n_hit", "n_items", "items_sha256", "spans"])
    # The kept columns travel as one struct, so that none of them can meet a name used here.
    bare = docs.select(F.struct(*kept, F.lit(0).alias(fresh(docs, "_")[0])).alias("kept"), text_bytes(text).alias("bytes"))
    names = ["kept", "n_words", "hits"]
    fields = bare.schema.fields[:-1] + T.StructType.fromDDL("n_words long, hits array<struct<length: int, hash: bigint, at: int, first: int, around: array<binary>>>").fields
    scanned = settle(bare.mapInArrow(scan, T.StructType(fields)).withColumn("row", F.monotonically_increasing_id()), "kept-grams")

    # A hit says that the window would start offset words before the k-gram; extend it over the whole window.
    hits = scanned.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*")
    start = F.col("at") - F.col("offset")
    window_words = F.slice("around", F.col("at") - F.col("offset") - F.col("first") + 1, F.col("length"))
    matched = hits.join(windows, ["length", "hash"]).where(start >= F.col("first")).where(window_words == F.col("words"))
    matched = settle(matched.select("row", start.alias("a"), (start + F.col("length")).alias("b"), "window").distinct(), "matches")

    # Documents that hold the same windows have the same items, so these are gathered once per set of windows.
    held = settle(matched.select("row", "window").distinct().groupBy("row").agg(F.array_sort(F.collect_list("window")).alias("set")), "held")
    sets = settle(held.select("set").distinct().withColumn("id", F.monotonically_increasing_id()), "window-sets")
    named = sets.select("id", F.explode("set").alias("window")).join(owners, "window").select("id", "item").distinct()
    named = named.groupBy("id").agg(F.array_sort(F.collect_list("item")).alias("names"))
    named = named.select("id", F.size("names").cast("long").alias("n_items"), _digest(F.col("names")).alias("items_sha256"))
    found = held.join(sets, "set").join(named, "id").select("row", "n_items", "items_sha256")
    hit = matched.groupBy("row", "a").agg(F.max("b").alias("b"))
    ordered = Window.partitionBy("row").orderBy("a")
    reach = F.max("b").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    runs = hit.withColumn("new", (reach.isNull() | (reach < F.col("a"))).cast("int")).withColumn("run", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("row", "run").agg(F.min("a").alias("start"), F.max("b").alias("end"))
    spans = spans.groupBy("row").agg(F.sum(F.col("end") - F.col("start")).cast("long").alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    return (
        scanned.drop("hits")
        .join(spans, "row", "left")
        .join(found, "row", "left")
        .select(
            *[F.col("kept")[c].alias(c) for c in kept], "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items_sha256", _digest(F.array().cast("array<string>"))).alias("items_sha256"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        )
    )


def _digest(names: Column) -> Column:
    return F.sha2(F.concat_ws(",", names).cast("binary"), 256)


def is_contaminated() -> Column:
    """Hit words make up a twentieth of all words or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def without_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows whose text is contaminated; all columns and repeated rows stay.

    Contamination depends on the text alone, so the texts to drop are named by their hash and length; only these names
    are joined with the documents.
    """
    names = fresh(docs, "_hash", "_size")
    named = docs.withColumns({names[0]: F.xxhash64(F.col(text)), names[1]: F.octet_length(F.col(text))})
    found = contamination(named.select(*names, text), items, text=text, window=window)
    bad = settle(found.where(is_contaminated()).select(*names).distinct(), "contaminated")
    return named.join(bad, names, "left_anti").select(*docs.columns)
