"""Near-duplicates by SimHash: 64-bit fingerprints within a small Hamming distance.

Links are found through a byte-position inverted index with count filtering. Fingerprints that differ in at most 3 bits
agree in at least 5 of their 8 bytes. Lists are kept per set of four byte positions and the bytes there; the fourteen sets
whose positions have exclusive-or 0 are such that any five positions contain one of them, so a pair with 5 shared bytes
meets in a list. There the shared positional bytes of each pair are tallied, pairs below the guaranteed count are
dropped, and the rest are verified by their bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.base import fresh, settle, text_bytes
from tidelake.llm.components import components

SEED = 42
POSITION_SETS = [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
#: Fingerprints of a list that one task compares with each other or with as many others.
BLOCK = 8192


def fingerprint(text: bytes | None, words: int) -> int:
    """A bit is 1 if it is set in over half the hashes of the ``words``-word shingles, repeats included.

    ASCII letters are lower-cased and words are split at ASCII white space. A text with fewer words is one shingle; one
    without words, or null, has fingerprint 0.
    """
    tokens = text.lower().split() if text else []
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map((b" ".join([b"%b"] * words)).__mod__, zip(*(tokens[i:] for i in range(words))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, column: str = "simhash") -> DataFrame:
    """``docs`` with the fingerprint as a signed long; a narrow step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, words) for x in batch.column(batch.num_columns - 1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64))], names)

    kept = [c for c in docs.columns if c != column]
    bare = docs.select(*kept, text_bytes(text).alias("_bytes"))
    names = [*kept, column]
    return bare.mapInArrow(run, T.StructType([*bare.schema.fields[:-1], T.StructField(column, T.LongType())]))


def list_links(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Links between ``left`` and ``right`` as (fingerprint, other), a forest with the components that all links have.

    Of each pair the positional bytes that differ are tallied, pairs with more than ``bits`` of them are dropped, and the
    rest are verified by their differing bits. Pairs inside a component already found add nothing and are passed over.
    """
    nodes = np.unique(np.concatenate([left, right]))
    label = np.arange(len(nodes))
    at_left, at_right = np.searchsorted(nodes, left), np.searchsorted(nodes, right)
    low, high = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
    for at in range(0, len(left), 64):
        differ = left[at : at + 64, None] ^ right[None, :]
        differing_bytes = np.bitwise_count((((differ & low) + low) | differ) & high)
        i, j = np.nonzero(differing_bytes <= bits)
        near = np.bitwise_count(differ[i, j]) <= bits
        a, b = at_left[at + i[near]], at_right[j[near]]
        while len(a):
            cross = label[a] != label[b]
            a, b = a[cross], b[cross]
            # One link per left row at a time, then look again at what is still apart.
            for x, y in {int(x): int(y) for x, y in zip(*(v[np.unique(a, return_index=True)[1]] for v in (a, b)))}.items():
                x, y = sorted((label[x], label[y]))
                if x != y:
                    label[label == y] = x
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    return np.column_stack([nodes[tied], nodes[label[tied]]])


def links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """(a, b) links between distinct fingerprints ``prints(simhash)`` that keep all components; ``bits`` is 3 at most.

    Lists with one fingerprint are dropped by their counts. Longer lists than ``BLOCK`` are cut into blocks by hash, and
    each pair of blocks is one unit of work, so neither a task nor a row grows with a list, and no pair is left out. What
    comes out of a unit is a forest, one link per fingerprint at most, never all pairs.
    """
    if not 0 <= bits <= 3:
        raise ValueError("five shared bytes are only guaranteed for up to 3 differing bits")
    masks = [sum(0xFF << (8 * p) for p in chosen) for chosen in POSITION_SETS]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    entries = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col("simhash").bitwiseAND(F.lit(m).cast("long")).alias("m")) for s, m in enumerate(signed)]))
    listed = prints.select("simhash", entries.alias("e")).select("simhash", "e.s", "e.m")
    counts = settle(listed.groupBy("s", "m").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "lists")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    placed = listed.join(counts, ["s", "m"]).select("simhash", "s", "m", blocks.alias("k"), F.pmod(F.xxhash64("simhash"), blocks).cast("int").alias("own"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    units = paired.groupBy("s", "m", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).agg(
        F.collect_list(F.when(F.col("own") <= F.col("other"), F.col("simhash"))).alias("left"), F.collect_list(F.when(F.col("own") >= F.col("other"), F.col("simhash"))).alias("right")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [
                list_links(np.asarray(a, np.int64).view(np.uint64), np.asarray(b, np.int64).view(np.uint64), bits)
                for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            joined = np.concatenate([np.zeros((0, 2), np.uint64), *pairs]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(joined[:, 0].copy()), pa.array(joined[:, 1].copy())], ["a", "b"])

    return units.select("left", "right").mapInArrow(run, "a long, b long").distinct()


def _classified(docs: DataFrame, key: str, text: str, words: int, bits: int) -> DataFrame:
    """key, text_hash, simhash, component_id and root, the component's smallest fingerprint, which names it."""
    read = docs.select(F.col(key), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text))
    rows = settle(fingerprints(read, text, words).select(key, "text_hash", "simhash"), "fingerprints")
    classes = settle(rows.groupBy("simhash").agg(F.min(key).alias("least")), "classes")
    tied = components(links(classes.select("simhash"), bits))
    named = classes.join(tied, F.col("simhash") == F.col("node"), "left").select("simhash", "least", F.coalesce("component", "simhash").alias("root"))
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    final = settle(named.join(roots, "root").select("simhash", "root", "component_id"), "components")
    return rows.join(final, "simhash").select(key, "text_hash", "simhash", "component_id", "root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: key, text_hash, simhash (signed long) and component_id.

    Texts whose fingerprints differ in ``bits`` or fewer bits are linked, and component_id is the smallest key that can be
    reached, its own included; null keys are passed over, and a component of null keys only has component_id null.
    Equal fingerprints are one node, so copies cost nothing beyond their fingerprint. Null and empty texts have
    fingerprint 0 and are linked like any other. Other columns are not read.
    """
    return _classified(docs, key, text, words, bits).drop("root")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest key, null keys last, then smallest text hash.

    If key and text repeat, one such row stays. Only rows that repeat in this way are ever compared; all others are
    kept or dropped by a join with the keys that stay.
    """
    found = _classified(docs, key, text, words, bits)
    choice = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("k"), F.col("text_hash").alias("h"))
    stay = settle(found.groupBy("root").agg(F.min(choice).alias("c")).select("c.k", "c.h"), "stay")
    repeated = settle(found.groupBy(F.col(key).alias("k"), F.col("text_hash").alias("h")).count().where("count > 1").select("k", "h"), "repeated")
    own = fresh(docs, "_hash")[0]
    hashed = docs.withColumn(own, F.xxhash64(F.col(text)))

    def among(names: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        return rows.join(names, rows[key].eqNullSafe(names["k"]) & (rows[own] == names["h"]), how)

    kept = among(stay, "left_semi", hashed)
    once = among(repeated, "left_anti", kept).unionByName(among(repeated, "left_semi", kept).dropDuplicates([key, own]))
    return once.select(*docs.columns)
