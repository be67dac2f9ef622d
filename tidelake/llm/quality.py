"""Quality as an ordinal grade: cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(threshold_k - w . x) with one weight vector for all grades and rising thresholds. The features are
hashed counts of words, of word shapes (case, digits and punctuation as they stand) and of how repetitive the text is.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.base import filter_bits, fresh, in_filter, others, process_value, settle, text_bytes

BITS = 16
SIZE = 1 << BITS
#: Tasks in which the weights learned by all tasks are summed up; each sends the driver half a megabyte.
MERGERS = 8
_LOWER, _UPPER, _DIGIT = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"\d+")


def shape(token: str) -> str:
    """Lower-case runs as a, upper-case runs as A, digits as 0; other characters as they stand."""
    return _DIGIT.sub("0", _UPPER.sub("A", _LOWER.sub("a", token)))


def token_codes(token: bytes) -> int:
    """The hashed word and the hashed shape of a token, in one number."""
    text = token.decode("utf-8", "replace")
    word = zlib.crc32(b"w" + text.lower().strip(".,;:!?").encode("utf-8", "replace")) % SIZE
    return word << BITS | zlib.crc32(b"s" + shape(text).encode("utf-8", "replace")) % SIZE


class Codes(dict):
    """Codes of the tokens met so far by a worker, up to a bound."""

    def __missing__(self, token: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[token] = code = token_codes(token)
        return code


def features(text: bytes | None, codes: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a whole text: index and value. Words and shapes have length 1 each; an empty text has a feature of its own."""
    tokens = text.split() if text else []
    if not tokens:
        return np.array([zlib.crc32(b"empty") % SIZE]), np.ones(1)
    code = np.fromiter(map(codes.__getitem__, tokens), np.int64, len(tokens))
    word, word_n = np.unique(code >> BITS, return_counts=True)
    form, form_n = np.unique(code & (SIZE - 1), return_counts=True)
    repeats = int(10 * np.mean(code[1:] == code[:-1])) if len(code) > 1 else 0
    variety = int(10 * len(word) / len(code))
    rest = [zlib.crc32(b"%b%d" % x) % SIZE for x in ((b"repeats", repeats), (b"variety", variety), (b"size", len(code).bit_length()))]
    index = np.concatenate([word, form, rest])
    value = np.concatenate([np.sqrt(word_n / len(code)), np.sqrt(form_n / len(code)), np.full(3, 0.5)])
    return index, value


@dataclass
class OrdinalModel:
    """``weights`` shared by all grades; ``grades`` ascending, with one threshold fewer."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k]) for k = 1 .. K - 1, a column each."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -30, 30)))

    def expected(self, score: np.ndarray) -> np.ndarray:
        steps = np.diff(self.grades.astype(np.float64))
        return float(self.grades[0]) + self.tails(score) @ steps


def descend(weights, thresholds, batches, rate: float, decay: float, epochs: int):
    """Adagrad over mini-batches of (index, value, row, grade position); the gaps between thresholds stay positive."""
    weights, thresholds = weights.copy(), thresholds.copy()
    squares, t_squares = np.full(SIZE, 1e-4), np.full(len(thresholds), 1e-2)
    for _ in range(epochs):
        for index, value, row, grade in batches:
            score = np.bincount(row, weights=weights[index] * value, minlength=len(grade))
            # The grade lies between two thresholds; the outer ones are infinite.
            bounds = np.concatenate([[-np.inf], thresholds, [np.inf]])
            high, low = bounds[grade + 1] - score, bounds[grade] - score
            above, below = 1 / (1 + np.exp(-np.clip(high, -30, 30))), 1 / (1 + np.exp(-np.clip(low, -30, 30)))
            above, below = np.where(np.isinf(high), 1.0, above), np.where(np.isinf(low), 0.0, below)
            p = np.maximum(above - below, 1e-9)
            d_high, d_low = above * (1 - above) / p, below * (1 - below) / p
            d_score = (d_high - d_low) / len(grade)
            g = np.bincount(index, weights=d_score[row] * value, minlength=SIZE) + decay * weights
            squares += g * g
            weights -= rate * g / np.sqrt(squares)
            d = np.zeros(len(bounds))
            np.add.at(d, grade + 1, -d_high / len(grade))
            np.add.at(d, grade, d_low / len(grade))
            t_squares += d[1:-1] ** 2
            thresholds -= rate * d[1:-1] / np.sqrt(t_squares)
            gaps = 1e-3 * np.arange(len(thresholds))
            thresholds = np.maximum.accumulate(thresholds - gaps) + gaps
    return weights, thresholds


def pack(table: pa.Table) -> pa.Table:
    """The ratings of a part as one row, in the order in which they are learned."""
    table = table.sort_by([("key", "ascending"), ("grade", "ascending")])
    table = table.take(np.random.default_rng(0).permutation(table.num_rows)).combine_chunks()
    index, value = (table.column(c).combine_chunks() for c in ("index", "value"))
    return pa.table({
        "part": table.column("part").slice(0, 1), "grade": [table.column("grade").to_numpy()], "length": [index.value_lengths().to_numpy(zero_copy_only=False)],
        "index": [index.flatten().to_numpy()], "value": [value.flatten().to_numpy()],
    })


def unpack(batch: pa.RecordBatch, row: int, grades: np.ndarray, size: int = 128) -> list[tuple]:
    """Mini-batches of a packed part, as ``descend`` takes them."""
    grade, length, index, value = (batch.column(c)[row].values.to_numpy() for c in ("grade", "length", "index", "value"))
    place, at = np.searchsorted(grades, grade), np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
    out = []
    for i in range(0, len(grade), size):
        own, cut = length[i : i + size], slice(at[i], at[min(i + size, len(grade))])
        out.append((index[cut].astype(np.int64), value[cut].astype(np.float64), np.repeat(np.arange(len(own)), own), place[i : i + size]))
    return out


def fit(
    docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "quality",
    parts: int = 4, part_rows: int = 5_000, rounds: int = 4,
) -> OrdinalModel:
    """The model from all rated documents.

    Null keys and grades are left out, of a key with several grades the lowest counts. Weights are learned in parts at a
    time, of about ``part_rows`` ratings each and ``parts`` at least, which start each of the ``rounds`` from the mean of
    the last. One grade alone, or none, gives a model that always answers it (or 0).

    Texts are never shuffled: a bounded bit filter of the rated keys picks those to be spelled, and their features meet the
    grades in a join, whose plan does not turn with the number of ratings. Features are dealt to their parts once and kept
    so for all rounds.
    """
    spark = docs.sparkSession
    rated = ratings.where(F.col(key).isNotNull() & F.col(grade).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(grade).cast("int").alias("_grade"))
    rated = settle(rated, "ratings")
    parts = max(parts, -(-rated.count() // part_rows))
    held = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.xxhash64(key).alias("_hash"), text_bytes(text).alias("_text"))
    # Equal keys of two types differ in their hashes: then all texts are spelled.
    alike = held.schema["_key"].dataType == rated.schema["_key"].dataType
    bits = spark.sparkContext.broadcast(filter_bits(rated.select(F.xxhash64("_key").alias("hash")))) if alike else None

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            if bits is not None:
                batch = batch.filter(pa.array(in_filter(bits.value, batch.column(1).to_numpy())))
            found = [features(x, codes) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))],
                ["_key", "index", "value"],
            )

    part = F.pmod(F.xxhash64("_key", F.lit(7)), F.lit(parts)).cast("int")
    spelled = held.mapInArrow(spell, T.StructType([held.schema["_key"], *T.StructType.fromDDL("index array<int>, value array<float>").fields]))
    joined = spelled.join(rated.hint("merge"), "_key")
    rows = settle(joined.select(F.col("_key").alias("key"), F.col("_grade").alias("grade"), "index", "value", part.alias("part")), "features")
    frequency = {r.grade: r["count"] for r in rows.groupBy("grade").count().collect()}
    grades = np.array(sorted(frequency), np.int64)
    if len(grades) < 2:
        return OrdinalModel(np.zeros(SIZE), np.zeros(0), grades if len(grades) else np.zeros(1, np.int64))

    total = sum(frequency.values())
    below = np.cumsum([frequency[g] for g in grades.tolist()])[:-1] / total
    weights, thresholds = np.zeros(SIZE), np.log(below / (1 - below))
    packed = settle(rows.groupBy("part").applyInArrow(pack, "part int, grade array<int>, length array<int>, index array<int>, value array<float>"), "parts")
    sums = "part int, weights binary, thresholds binary"

    def summed(found: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """The sum of all, under the number of the first; nothing of nothing."""
        first, w, t = None, np.zeros(SIZE), np.zeros(len(grades) - 1)
        for number, more_w, more_t in found:
            first = number if first is None else first
            w += more_w
            t += more_t
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int32()), pa.array([w.tobytes()]), pa.array([t.tobytes()])], ["part", "weights", "thresholds"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return summed((r["part"], np.frombuffer(r["weights"]), np.frombuffer(r["thresholds"])) for batch in batches for r in batch.to_pylist())

    for _ in range(rounds):
        start = spark.sparkContext.broadcast((weights, thresholds))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def each():
                for batch in batches:
                    for i in range(batch.num_rows):
                        w, t = descend(*start.value, unpack(batch, i, grades), rate=0.3, decay=1e-6, epochs=2)
                        share = len(batch.column("grade")[i]) / total
                        yield batch.column("part")[i].as_py(), share * w, share * t

            return summed(each())

        # Each task sends one sum, and these meet in a few tasks before the driver adds up what is left.
        learned = packed.mapInArrow(learn, sums).repartition(MERGERS, "part").sortWithinPartitions("part").mapInArrow(merge, sums).collect()
        weights = sum(np.frombuffer(r.weights) for r in learned)
        thresholds = sum(np.frombuffer(r.thresholds) for r in learned)
        start.unpersist()
    return OrdinalModel(weights, thresholds, grades)


def grade(docs: DataFrame, model: OrdinalModel, text: str = "text", least: int | None = None, accept: float = 0.3) -> DataFrame:
    """``docs`` with expected_grade, tail_probability (P(grade >= ``least``), by default the highest), grade and accepted.

    ``grade`` is the likeliest, ties to the lower; ``accepted`` says whether tail_probability reaches ``accept``.
    Every row is kept; null and empty texts are graded by the one feature they share. Columns of these names,
    in any case, are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cache_key = f"quality-{uuid.uuid4().hex}"
    added = T.StructType.fromDDL("expected_grade double, tail_probability double, grade int, accepted boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, codes = shared.value, process_value(cache_key, Codes)
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for i, value in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                index, weight = features(value, codes)
                score[i] = model.weights[index] @ weight
            tails = model.tails(score)
            ends = np.column_stack([np.ones(len(score)), tails, np.zeros(len(score))])
            top = len(model.grades) - 1 if least is None else int(np.searchsorted(model.grades, least))
            tail = ends[:, min(top, len(model.grades))]
            likeliest = model.grades[np.argmax(ends[:, :-1] - ends[:, 1:], axis=1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(model.expected(score)), pa.array(tail), pa.array(likeliest.astype(np.int32)), pa.array(tail >= accept)], names
            )

    kept = others(docs, added.names)
    bare = docs.select(*kept, text_bytes(text).alias(fresh(docs, "_bytes")[0]))
    names = [*kept, *added.names]
    return bare.mapInArrow(run, T.StructType(bare.schema.fields[:-1] + added.fields))
