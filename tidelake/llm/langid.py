"""Language identification with one interpolated Kneser-Ney character model per language.

A word is scored as the characters between its boundaries, so a text's cross-entropy is the sum over its words. A batch's
words are split and numbered by Arrow, lower-cased and without ASCII punctuation; every distinct one is looked up or scored
once, however it was written. The models of all languages share sorted arrays of n-gram hashes; beside each
hash stand the log probability of its last character and the log weight of backing off from it, per language.

No n-gram is left out. Models too large for the workers' memory stay in tables: all orders are counted and weighted by Spark,
and the distinct windows of the texts are scored by joins with them. The most frequent windows, as many as a worker can hold,
are sent out with their scores; words with any other window are scored by a join, and added to the sums of their texts.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.base import fresh, others, process_value, settle, text_bytes

ORDER = 5
#: Longer runs of letters (scripts without spaces) are scored in pieces of this length, each with boundaries of its own.
PIECE = 24
LETTERS = regex.compile(r"\p{L}+")
#: Words that are one piece as they stand.
_PLAIN = re.compile(f"[a-zß-öø-ÿ]{{1,{PIECE}}}")
# ASCII letters made lower and everything beyond ASCII; the rest separates.
_LETTER_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
UNKNOWN = "und"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_START, _END = "\x02", "\x03"


def pieces(token: str) -> list[str]:
    """The lower-cased letter runs of a token, in pieces."""
    runs = LETTERS.findall(token.lower())
    return [run[i : i + PIECE] for run in runs for i in range(0, len(run), PIECE)]


#: Text whose words are numbered at a time; bounds what a worker holds of a batch.
PART_BYTES = 1 << 21


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Some rows at a time, in order; one part of an empty batch."""
    rows = max(1, batch.num_rows * PART_BYTES // max(batch.nbytes, 1))
    for at in range(0, max(batch.num_rows, 1), rows):
        yield batch.take(pa.array(np.arange(at, min(at + rows, batch.num_rows))))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts in UTF-8, the number of each word in order, and where each text's words begin and end.

    The pieces of a text's words are those of the text. What is no letter in ASCII separates, unless a text of the batch has
    a capital sigma, whose lower case depends on what stands beside it: then only white space does.
    """
    data = texts.buffers()[2]
    if data is not None and b"\xce\xa3" not in (content := data.to_pybytes()):
        letters = pa.py_buffer(content.translate(_LETTER_TABLE))
        texts = pa.Array.from_buffers(texts.type, len(texts), [*texts.buffers()[:2], letters], offset=texts.offset)
    try:
        texts = texts.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        texts = pa.array([None if v is None else v.decode("utf-8", "replace") for v in texts.to_pylist()], pa.string())
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    ends = np.cumsum(split.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    return coded.dictionary, coded.indices.to_numpy(), np.concatenate([[0], ends])


def text_sums(rows: np.ndarray, number: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text the sum of its words' rows; ``number`` and ``bounds`` as :func:`split_words` gives them."""
    out = np.zeros((len(bounds) - 1, rows.shape[1]))
    some = bounds[1:] > bounds[:-1]
    if some.any():
        for column in range(rows.shape[1]):
            out[some, column] = np.add.reduceat(np.ascontiguousarray(rows[:, column])[number], bounds[:-1][some])
    return out


def windows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every character (and word end) with the ``ORDER - 1`` before it, as code points; and the word each belongs to."""
    padded = [_START * (ORDER - 1) + w + _END for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths - ORDER + 1)
    owner = np.repeat(np.arange(len(words)), lengths - ORDER + 1)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(lengths - ORDER + 1) - (lengths - ORDER + 1), lengths - ORDER + 1)
    at = (starts + offset).astype(np.int32)
    return np.column_stack([codes[at + i] for i in range(ORDER)]), owner


def gram_hash(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points."""
    h = np.full(len(grams), len(grams.T) + 1, np.uint64)
    for column in grams.T:
        h = (h ^ column.astype(np.uint64)) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct hash, and which of them each hash is."""
    index = pa.array(hashes).dictionary_encode().indices.to_numpy()
    place = np.empty(index.max() + 1, np.int64)
    place[index] = np.arange(len(index))
    return place, index


@dataclass
class Level:
    """One order: sorted hashes of its n-grams and contexts, with a column per language."""

    grams: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


@dataclass
class LanguageModel:
    languages: list[str]
    levels: list[Level] = field(repr=False)
    floor: float = math.log(1e-6)
    #: Calibration: P(right) from the margin, and where cross-entropy is out of the ordinary for a language.
    slope: float = 4.0
    offset: float = 0.0
    mean: np.ndarray | None = None
    cutoff: float = math.inf
    #: Of a model that stays in tables, per order: (gram, p) and (gram, b) with maps from language to log probability and weight.
    tables: list[tuple[DataFrame, DataFrame]] | None = field(default=None, repr=False)
    #: What is sent out of such a model: sorted hashes of frequent windows, and their scores per language.
    core: tuple[np.ndarray, np.ndarray] | None = field(default=None, repr=False)

    def logp(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of each window's last character, per language; NaN for a window that a core does not hold."""
        if self.core is not None:
            out = np.full((len(grams), len(self.languages)), np.nan)
            at, known = _find(self.core[0], gram_hash(grams))
            out[known] = self.core[1][at[known]]
            return out
        if self.tables is not None:
            raise ValueError("this model is in tables; score with predict()")
        out = np.zeros((len(grams), len(self.languages)), np.float64)
        rest = np.arange(len(grams))
        for order in range(len(self.levels), 0, -1):
            level, tail = self.levels[order - 1], grams[rest, ORDER - order :]
            at, known = _find(level.grams, gram_hash(tail))
            out[rest[known]] += level.logp[at[known]]
            rest, tail = rest[~known], tail[~known]
            if not len(rest):
                return out
            at, known = _find(level.contexts, gram_hash(tail[:, :-1]))
            out[rest[known]] += level.backoff[at[known]]
        out[rest] += self.floor
        return out

    def word_scores(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per token: minus its log probability in each language, and its number of letters and word ends."""
        total, count = np.zeros((len(tokens), len(self.languages))), np.zeros(len(tokens), np.int64)
        for at in range(0, len(tokens), 20_000):
            part = tokens[at : at + 20_000]
            owner = [i for i, token in enumerate(part) if _PLAIN.fullmatch(token)]
            words = [part[i] for i in owner]
            for i in sorted(set(range(len(part))).difference(owner)):
                words += (found := pieces(part[i]))
                owner += [i] * len(found)
            if words:
                grams, word = windows(words)
                token = np.asarray(owner)[word]
                first, index = _distinct(gram_hash(grams))
                logp = self.logp(grams[first])
                for column in range(len(self.languages)):
                    total[at : at + len(part), column] -= np.bincount(token, weights=np.ascontiguousarray(logp[:, column])[index], minlength=len(part))
                count[at : at + len(part)] += np.bincount(token, minlength=len(part))
        return total, count


class WordScores:
    """Scores of the words met by a worker, a row each, in an array that doubles. Beyond a bound the last ones make room.

    Words met first, most of them frequent, stay: up to half of the bound.
    """

    BOUND = 120_000

    def __init__(self, columns: int):
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1024, columns))

    def places(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def add(self, words: Collection[str], model: LanguageModel) -> None:
        """``words`` are distinct; all of them have a place afterwards."""
        missing = [w for w in words if w not in self.place]
        if len(self.place) + len(missing) > self.BOUND:
            left = max(self.BOUND - len(missing), self.BOUND // 2)
            while len(self.place) > left:
                self.place.popitem()
            missing = [w for w in words if w not in self.place]
        if missing:
            at, end = len(self.place), len(self.place) + len(missing)
            while len(self.rows) < end:
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            total, count = model.word_scores(missing)
            self.rows[at:end, :-1], self.rows[at:end, -1] = total, count
            self.place.update(zip(missing, range(at, end)))

    def of(self, words: list[str], model: LanguageModel) -> np.ndarray:
        """The rows of distinct words."""
        self.add(words, model)
        return self.rows[self.places(words)]

    def sums(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(self.rows.shape[1])
        return self.rows[self.places(words)].sum(axis=0)


def _find(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, hashes)
    at[at == len(table)] = 0
    return at, (table[at] == hashes) if len(table) else np.zeros(len(hashes), bool)


def build_levels(grams: np.ndarray, language: np.ndarray, counts: np.ndarray, n_languages: int) -> tuple[list[Level], float]:
    """Interpolated Kneser-Ney levels 1 .. ORDER from the counts of the longest n-grams.

    The longest order uses its counts; below it an n-gram counts once for every distinct character seen before it.
    Discounts are n1 / (n1 + 2 n2) per order and language.
    """
    tables = {ORDER: (grams, language, counts.astype(np.float64))}
    for order in range(ORDER - 1, 0, -1):
        above, lang, _ = tables[order + 1]
        suffix = above[:, 1:]
        key = gram_hash(np.column_stack([suffix, lang]))
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        tables[order] = (suffix[first], lang[first], n.astype(np.float64))
    characters = max(len(np.unique(tables[1][0][:, 0])), 1)
    uniform = 1.0 / (characters + 1)
    levels: list[Level] = []
    for order in range(1, ORDER + 1):
        rows, lang, n = tables[order]
        hashes = gram_hash(rows)
        names, at, index = np.unique(hashes, return_index=True, return_inverse=True)
        context, context_index = np.unique(gram_hash(rows[:, :-1]), return_inverse=True)
        count = np.zeros((len(names), n_languages))
        count[index, lang] = n
        total, types = np.zeros((len(context), n_languages)), np.zeros((len(context), n_languages))
        np.add.at(total, (context_index, lang), n)
        np.add.at(types, (context_index, lang), 1)
        once = np.bincount(lang[n == 1], minlength=n_languages)
        twice = np.bincount(lang[n == 2], minlength=n_languages)
        discount = np.clip(np.where(once + twice > 0, once / np.maximum(once + 2 * twice, 1), 0.5), 0.1, 0.95)
        backoff = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
        own_context = context_index[at]
        if order == 1:
            lower = np.full((len(names), n_languages), uniform)
        else:
            lower = np.exp(LanguageModel([""] * n_languages, levels, math.log(uniform)).logp(_right_aligned(rows[at, 1:])))
        held = total[own_context]
        p = np.where(held > 0, np.maximum(count - discount, 0) / np.maximum(held, 1), 0) + backoff[own_context] * lower
        levels.append(Level(names, np.log(p).astype(np.float32), context, np.log(backoff).astype(np.float32)))
    return levels, math.log(uniform)


def _right_aligned(rows: np.ndarray) -> np.ndarray:
    """Shorter n-grams as windows whose left part matches no longer n-gram."""
    out = np.full((len(rows), ORDER), 0xFFFFFFFF, rows.dtype)
    out[:, ORDER - rows.shape[1] :] = rows
    return out


#: Distinct words that a task counts before it spells them out.
HELD_WORDS = 120_000


def _gram_bytes(grams: np.ndarray) -> pa.Array:
    """Each row of code points as little-endian 32-bit numbers."""
    rows = pa.py_buffer(np.ascontiguousarray(grams, "<u4"))
    return pa.Array.from_buffers(pa.binary(4 * grams.shape[1]), len(grams), [None, rows]).cast(pa.binary())


def count_grams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Counts of the longest n-grams per language: (lang, gram, n).

    Tasks count distinct words first and spell each out once; what is shuffled are distinct n-grams per task.
    """

    def spelled(words: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for name, counter in words.items():
            grouped: Counter = Counter()
            for token, n in counter.items():
                for piece in (token,) if _PLAIN.fullmatch(token) else pieces(token):
                    grouped[piece] += n
            if grouped:
                grams, word = windows(list(grouped))
                first, index = _distinct(gram_hash(grams))
                n = np.bincount(index, weights=np.fromiter(grouped.values(), np.float64)[word]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(first)), _gram_bytes(grams[first]), pa.array(n)], ["lang", "gram", "n"])
        words.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for part in _parts(batch):
                found, number, bounds = split_words(part.column(0))
                found, names = found.to_pylist(), part.column(1).dictionary_encode()
                owner = np.repeat(names.indices.to_numpy(), np.diff(bounds))
                for i, name in enumerate(names.dictionary.to_pylist()):
                    n = np.bincount(number[owner == i], minlength=len(found))
                    counter, some = words.setdefault(name, Counter()), np.flatnonzero(n)
                    for at, k in zip(some.tolist(), n[some].tolist()):
                        counter[found[at]] += k
            if sum(map(len, words.values())) > HELD_WORDS:
                yield from spelled(words)
        yield from spelled(words)

    read = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text_bytes(text).alias("t"), F.col(lang).alias("lang"))
    return read.mapInArrow(run, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def table_levels(counts: DataFrame, names: list[str]) -> tuple[list[tuple[DataFrame, DataFrame]], float]:
    """What ``build_levels`` makes, as tables of every order: (gram, p) and (context, b), and the log of the uniform share."""
    lang = F.array_position(F.lit(names), F.col("lang")).cast("int") - 1
    tables = {ORDER: settle(counts.select("gram", lang.alias("l"), "n"), "grams")}
    for order in range(ORDER - 1, 0, -1):
        below = tables[order + 1].groupBy(F.expr("substring(gram, 5)").alias("gram"), "l").agg(F.count(F.lit(1)).alias("n"))
        tables[order] = settle(below, "grams")
    floor = -math.log(max(tables[1].select("gram").distinct().count(), 1) + 1)
    lower = tables[1].select("l").distinct().select(F.lit(b"").alias("_suffix"), "l", F.lit(math.exp(floor)).alias("lower"))
    levels = []
    for order in range(1, ORDER + 1):
        rows = tables[order].withColumn("_suffix", F.expr("substring(gram, 5)")).withColumn("_context", F.expr(f"substring(gram, 1, {4 * order - 4})"))
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        share = F.when(once + twice > 0, once / (once + 2 * twice)).otherwise(0.5)
        discount = [0.5] * len(names)
        for r in rows.groupBy("l").agg(F.least(F.greatest(share, F.lit(0.1)), F.lit(0.95)).alias("d")).collect():
            discount[r.l] = r.d
        d = F.get(F.lit(discount), F.col("l"))
        contexts = settle(rows.groupBy("_context", "l").agg(F.sum("n").alias("held"), (d * F.count(F.lit(1)) / F.sum("n")).alias("b")), "contexts")
        p = F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("held") + F.col("b") * F.col("lower")
        lower = settle(rows.join(contexts, ["_context", "l"]).join(lower, ["_suffix", "l"]).select("gram", "l", p.alias("p")), "level")

        def per_language(table: DataFrame, gram: str, value: str) -> DataFrame:
            return table.groupBy(F.col(gram).alias("gram")).agg(F.map_from_entries(F.collect_list(F.struct("l", F.ln(value).alias("v")))).alias(value))

        levels.append((settle(per_language(lower, "gram", "p"), "level"), settle(per_language(contexts, "_context", "b"), "level")))
        lower = lower.select(F.col("gram").alias("_suffix"), "l", F.col("p").alias("lower"))
    return levels, floor


def fit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", max_grams: int = 1_000_000, calibration_rows: int = 4096
) -> LanguageModel:
    """One model per value of ``lang`` from all rows of ``docs`` that have a text and a language.

    Counts cover every row and the model every n-gram. Up to ``max_grams`` of the longest n-grams (fewer with more than
    eight languages) make a model that is sent to the workers; a larger one stays in tables, with the same results.
    Confidence and rejection are calibrated on all distinct rows (of ``key`` and text) with a letter; ``calibration_rows``
    only says up to how many values of a language are sorted on the driver as they are, see :func:`_quantiles`. A table
    without rows to learn from gives a model that answers ``und`` to everything. Who goes on to predict the same rows has
    :func:`identify`, which scores them once.
    """
    model = _learned(docs, text, lang, max_grams)
    if model.languages:
        known = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("l"), F.xxhash64(key, text_bytes(text)).alias("h"), F.col(text).alias("t"))
        scored = predict(known, model, "t").select("l", "h", "lang_pred", "cross_entropy", "margin", "n_letters")
        _calibrate(model, settle(scored, "scored"), calibration_rows)
    return model


def identify(
    docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", max_grams: int = 1_000_000,
    calibration_rows: int = 4096, keep: list[str] | None = None,
) -> DataFrame:
    """:func:`predict` for all of ``docs``, or their columns ``keep``, by the model :func:`fit` makes of those that ``learn`` holds for; each text is scored once."""
    model = _learned(docs.where(learn), text, lang, max_grams)
    kept = others(docs, RESULT.names) if keep is None else keep
    taught, hashed = fresh(docs, "_taught", "_hash")
    marked = docs.withColumns({taught: F.when(learn, F.col(lang)), hashed: F.xxhash64(key, text_bytes(text))})
    scored = settle(predict(marked, model, text).select(*kept, taught, hashed, *RESULT.names), "scored")
    if model.languages:
        known = scored.where(F.col(taught).isNotNull()).select(F.col(taught).alias("l"), F.col(hashed).alias("h"), "lang_pred", "cross_entropy", "margin", "n_letters")
        _calibrate(model, known, calibration_rows)
    return _judged(scored, model).select(*kept, *RESULT.names)


def _learned(docs: DataFrame, text: str, lang: str, max_grams: int) -> LanguageModel:
    """The model without its calibration."""
    counts = settle(count_grams(docs, text, lang), "counts")
    names = sorted(r[0] for r in docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(lang).distinct().collect())
    if counts.count() > min(max_grams, 8 * max_grams // max(len(names), 1)):
        tables, floor = table_levels(counts, names)
        return LanguageModel(names, [], floor, tables=tables)
    rows = counts.toArrow()
    grams = np.frombuffer(b"".join(rows.column("gram").to_pylist()), "<u4").reshape(-1, ORDER)
    index = {name: i for i, name in enumerate(names)}
    language = np.fromiter((index[x] for x in rows.column("lang").to_pylist()), np.int64, rows.num_rows)
    levels, floor = build_levels(grams, language, rows.column("n").to_numpy(), max(len(names), 1))
    return LanguageModel(names, levels, floor)


def _quantiles(values: DataFrame, q: float, whole: int) -> dict:
    """The exact ``q`` quantile of ``v`` per ``g``, linear between neighbours as numpy's.

    Up to ``whole`` values of a group are sorted as they are. Of more, those between two estimates that enclose the quantile
    come to the driver (about two in a thousand to each side), and the rest is counted.
    """
    reach = 0.002 + 3 / whole
    ends = F.percentile_approx("v", [max(q - reach, 0.0), min(q + reach, 1.0)], 10_000)
    found = values.groupBy("g").agg(F.count("v").alias("n"), ends.alias("p")).collect()
    if not found:
        return {}
    bounds = [(r.g, *(r.p if r.n > whole else (-math.inf, math.inf))) for r in found]
    kind = T.StructType([T.StructField("g", values.schema["g"].dataType), *T.StructType.fromDDL("lo double, hi double").fields])
    placed = values.join(F.broadcast(values.sparkSession.createDataFrame(bounds, kind)), "g")
    near = placed.select("g", F.when(F.col("v") < F.col("lo"), -math.inf).when(F.col("v") <= F.col("hi"), F.col("v")).otherwise(math.inf).alias("v"))
    cells: dict = {}
    for r in near.groupBy("g", "v").count().collect():
        cells.setdefault(r.g, []).append((r.v, r["count"]))
    out = {}
    for r in found:
        v, n = (np.array(x) for x in zip(*sorted(cells[r.g])))
        at = (r.n - 1) * q
        low, high = v[np.searchsorted(np.cumsum(n), [math.floor(at), math.ceil(at)], side="right")]
        out[r.g] = float(low + (high - low) * (at - math.floor(at)))
    return out


def _calibrate(model: LanguageModel, scored: DataFrame, whole: int) -> None:
    """Fit confidence and rejection to all distinct rows (by ``l`` and ``h``) of scored texts of known language ``l``."""
    facts = F.first(F.struct("lang_pred", "cross_entropy", "margin", "n_letters")).alias("s")
    rows = settle(scored.where("n_letters > 0").groupBy("l", "h").agg(facts).select("l", "s.*"), "calibration")
    right = F.col("l") == F.col("lang_pred")
    yes, n = rows.agg(F.count_if(right), F.count(F.lit(1))).first()
    if not n:
        return
    # Platt's targets keep the fit finite when all answers are right.
    target = F.when(right, (yes + 1) / (yes + 2)).otherwise(1 / (n - yes + 2))
    margin = F.col("margin") * F.sqrt("n_letters")
    points = rows.select(margin.alias("x"), target.alias("y"))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.least(F.greatest(a * F.col("x") + b, F.lit(-30.0)), F.lit(30.0))))
        w, off = F.greatest(p * (1 - p), F.lit(1e-6)), p - F.col("y")
        r = points.agg(*[F.sum(c) for c in (off * F.col("x"), off, w * F.col("x") * F.col("x"), w * F.col("x"), w)]).first()
        step = np.linalg.solve(np.array([[r[2] + 1e-3, r[3]], [r[3], r[4] + 1e-3]]), np.array([r[0] + 1e-3 * a, r[1] + 1e-3 * b]))
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-9:
            break
    model.slope, model.offset = max(float(a), 0.05), float(b)
    # A language that no row is taken for has no usual cross-entropy; nothing is rejected by it.
    usual = _quantiles(rows.select(F.col("lang_pred").alias("g"), F.col("cross_entropy").alias("v")), 0.5, whole)
    model.mean = np.array([usual.get(name, math.nan) for name in model.languages])
    excess = _quantiles(rows.select(F.lit(0).alias("g"), _excess_column(model).alias("v")), 0.999, whole)
    # Half the way to characters drawn at random, or half as far again as all but a thousandth of the learned rows.
    model.cutoff = max(0.5, 1.5 * excess[0])


def _excess_column(model: LanguageModel) -> Column:
    """:func:`_excess` of scored texts; null where it was not measured."""
    mean = F.get(F.lit(model.mean.tolist()), F.array_position(F.lit(model.languages), F.col("lang_pred")).cast("int") - 1)
    mean = F.nullif(mean, F.lit(math.nan))
    return (F.col("cross_entropy") - mean - 2.0 / F.sqrt("n_letters")) / F.greatest(-model.floor - mean, F.lit(0.5))


def _judged(scored: DataFrame, model: LanguageModel) -> DataFrame:
    """Scored texts with the score and acceptance of a model that was calibrated since."""
    known = F.col("n_letters") > 0
    logit = model.slope * F.col("margin") * F.sqrt("n_letters") + model.offset
    score = 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30.0)), F.lit(30.0))))
    accepted = known if model.mean is None else known & ~F.coalesce(_excess_column(model) > model.cutoff, F.lit(False))
    return scored.withColumns({"score": F.when(known, score).otherwise(0.0), "accepted": accepted})


def _excess(entropy, letters, mean, uniform):
    """How far above the language's usual cross-entropy, as a share of the way to uniform characters; short texts may deviate more."""
    return (entropy - mean - 2.0 / np.sqrt(letters)) / np.maximum(uniform - mean, 0.5)


def _answers(sums: np.ndarray, model: LanguageModel) -> list[pa.Array]:
    """The columns of RESULT from rows of summed scores, with the number of letters in the last column."""
    n_languages = len(model.languages)
    letters = sums[:, -1]
    known = letters > 0
    if n_languages:
        entropy = sums[:, :-1] / np.maximum(letters, 1)[:, None]
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(best)), best]
        second = np.partition(entropy, 1, axis=1)[:, 1] if n_languages > 1 else low + 1.0
        margin = second - low
    else:
        known, best, low, margin = known & False, np.zeros(len(sums), int), np.zeros(len(sums)), np.zeros(len(sums))
    score = 1 / (1 + np.exp(-np.clip(model.slope * margin * np.sqrt(letters) + model.offset, -30, 30)))
    accepted = known.copy()
    if model.mean is not None:
        accepted &= ~(_excess(low, np.maximum(letters, 1), model.mean[best], -model.floor) > model.cutoff)
    return [
        pa.array([model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()), pa.array(np.where(known, score, 0.0)),
        pa.array(accepted), pa.array(np.where(known, low, 0.0)), pa.array(np.where(known, margin, 0.0)), pa.array(letters.astype(np.int64)),
    ]


RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType()),
        T.StructField("cross_entropy", T.DoubleType()), T.StructField("margin", T.DoubleType()), T.StructField("n_letters", T.LongType()),
    ]
)

#: Of a model in tables, scores of up to this many of the most frequent windows (fewer with more than eight languages) are
#: sent to the workers.
CORE_WINDOWS = 1_000_000


def _window_scores(read: DataFrame, model: LanguageModel) -> DataFrame:
    """Every distinct window of the texts ``t``: (gram, n, s) with how often it occurs and its log probability per language."""
    counts = count_grams(read.select("t", F.lit("").alias("lang")), "t", "lang").select("gram", "n")
    asked = {ORDER: settle(counts, "asked")}
    for order in range(ORDER - 1, 0, -1):
        asked[order] = settle(asked[order + 1].select(F.expr("substring(gram, 5)").alias("gram")).distinct(), "asked")
    n_languages = len(model.languages)
    lower = read.sparkSession.range(1).select(F.lit(b"").alias("_suffix"), F.array_repeat(F.lit(model.floor), n_languages).alias("s"))
    for order in range(1, ORDER + 1):
        known, contexts = model.tables[order - 1]
        rows = asked[order].withColumn("_suffix", F.expr("substring(gram, 5)")).withColumn("_context", F.expr(f"substring(gram, 1, {4 * order - 4})"))
        joined = rows.join(known, "gram", "left").join(contexts.withColumnRenamed("gram", "_context"), "_context", "left").join(lower, "_suffix")
        value = F.transform("s", lambda v, i: F.coalesce(F.try_element_at("p", i), F.coalesce(F.try_element_at("b", i), F.lit(0.0)) + v))
        level = settle(joined.select("gram", *(["n"] if order == ORDER else []), value.alias("s")), "scores")
        lower = level.select(F.col("gram").alias("_suffix"), "s")
    return level


def _core(scored: DataFrame, model: LanguageModel, bound: int) -> LanguageModel:
    """The model of at most ``bound`` windows, those that occur most often; of equally frequent ones all or none."""
    sizes = scored.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).count().orderBy(F.desc("n")).collect()
    held, least = 0, None
    for r in sizes:
        if held + r["count"] > bound:
            break
        held, least = held + r["count"], r.n
    chosen = scored.where(F.lit(False) if least is None else F.col("n") >= least).select("gram", "s").toArrow()
    grams = np.frombuffer(b"".join(chosen.column("gram").to_pylist()), "<u4").reshape(-1, ORDER)
    values = chosen.column("s").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(grams), len(model.languages))
    hashes = gram_hash(grams)
    order = np.argsort(hashes, kind="stable")
    return LanguageModel(model.languages, [], model.floor, model.slope, model.offset, model.mean, model.cutoff, core=(hashes[order], values[order]))


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of every word, as often as it comes."""
    for batch in batches:
        for word in batch.column(0).to_pylist():
            grams, _ = windows(pieces(word))
            yield pa.RecordBatch.from_arrays([pa.array([word] * len(grams), pa.string()), _gram_bytes(grams)], ["w", "gram"])


def _predict_by_tables(docs: DataFrame, model: LanguageModel, text: str, core_windows: int) -> DataFrame:
    """:func:`predict` for a model in tables."""
    n_languages = len(model.languages)
    scored = _window_scores(docs.where(F.col(text).isNotNull()).select(text_bytes(text).alias("t")), model)
    core = _core(scored, model, min(core_windows, 8 * core_windows // n_languages))
    shared = docs.sparkSession.sparkContext.broadcast(core)
    key = f"langid-{uuid.uuid4().hex}"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = shared.value
        words_of = process_value(key, lambda: WordScores(n_languages + 1))
        for batch in batches:
            words, number, bounds = split_words(batch.column(1))
            rows = words_of.of(words.to_pylist(), core)
            left = np.isnan(rows[:, 0])
            rows[left, :-1] = 0.0
            sums = text_sums(rows, number, bounds)
            at = np.flatnonzero(left[number])
            rare = pa.StructArray.from_arrays([words.take(pa.array(number[at])), pa.array(np.ones(len(at), np.int64))], ["w", "n"])
            rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(at, bounds).astype(np.int32)), rare)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(sums), pa.list_(pa.float64())), rare], ["kept", "s", "rare"])

    kept = others(docs, RESULT.names)
    bare = docs.select(F.struct(F.lit(None).cast("int").alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("kept"), text_bytes(text).alias("t"))
    fields = T.StructType([bare.schema["kept"], *T.StructType.fromDDL("s array<double>, rare array<struct<w: string, n: bigint>>").fields])
    parts = settle(bare.mapInArrow(part, fields).withColumn("row", F.monotonically_increasing_id()), "parts")
    # Only rows with such a word take part in the joins.
    some = parts.where(F.size("rare") > 0)
    rare = some.select("row", F.explode("rare").alias("r")).select("row", F.col("r.w").alias("w"), F.col("r.n").alias("times"))
    rare = settle(rare.groupBy("row", "w").agg(F.sum("times").alias("times")), "rare")
    spelled = rare.select("w").distinct().mapInArrow(_spell, "w string, gram binary")
    total = F.array(*[F.sum(-F.get("s", F.lit(i))) for i in range(n_languages)])
    words = settle(spelled.join(scored.select("gram", "s"), "gram").groupBy("w").agg(total.alias("more")), "rare-words")
    more = rare.join(words, "w").groupBy("row").agg(F.array(*[F.sum(F.get("more", F.lit(i)) * F.col("times")) for i in range(n_languages)], F.lit(0.0)).alias("more"))
    added = some.join(more, "row").select("kept", F.zip_with("s", "more", lambda a, b: a + b).alias("s"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = shared.value
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *_answers(np.array(batch.column(1).to_pylist()), core)], ["kept", *RESULT.names])

    answered = parts.where(F.size("rare") == 0).select("kept", "s").union(added).mapInArrow(answer, T.StructType([parts.schema["kept"], *RESULT.fields]))
    return answered.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(kept)], *RESULT.names)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", core_windows: int = CORE_WINDOWS) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1), accepted, cross_entropy, margin and n_letters; every row is kept.

    The language with the lowest cross-entropy per letter and word end wins, ties go to the first in sort order. A null
    text, or one without a letter, is ``und``, has score 0 and is rejected; so are texts whose cross-entropy is out of
    the ordinary for the language that wins, if that was measured. Columns of these names, in any case, are replaced, others
    stay as they are.
    """
    if model.tables is not None:
        return _predict_by_tables(docs, model, text, core_windows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    n_languages = len(model.languages)
    key = f"langid-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words_of = process_value(key, lambda: WordScores(n_languages + 1))
        for batch in batches:
            sums = []
            for part in _parts(batch.select([batch.num_columns - 1])):
                words, number, bounds = split_words(part.column(0))
                sums.append(text_sums(words_of.of(words.to_pylist(), model), number, bounds))
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + _answers(np.concatenate(sums), model), names)

    kept = others(docs, RESULT.names)
    bare = docs.select(*[F.col(f"`{c}`") for c in kept], text_bytes(text).alias(fresh(docs, "_bytes")[0]))
    names = [*kept, *RESULT.names]
    return bare.mapInArrow(run, T.StructType(bare.schema.fields[:-1] + RESULT.fields))
