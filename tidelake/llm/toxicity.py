"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, found in a block-max inverted index.

The examples are a bounded sample of labelled documents, over all their terms; terms that go with the label weigh more, and
none weighs nothing. A query looks at the blocks of examples with the highest possible cosine first and then at all others
that could still hold one of its k nearest, so the neighbours are those of a full comparison. Their votes, weighted by
similarity, become a probability on the examples' own leave-one-out votes.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.base import fresh, others, process_value, settle, spans, text_bytes, word_bytes

BLOCK = 32
#: Blocks that are looked at before the rest is judged by their bounds.
FIRST_BLOCKS = 12
#: A term that one of so many examples holds is kept as a row of weights.
FREQUENT = 32
NEIGHBOURS = 15
#: Votes of the whole sample's share that each document starts with, in units of one neighbour with cosine 1.
PRIOR = 0.25


#: A word counts as itself and as its beginnings of these lengths, which inflected and compound words share.
BEGINNINGS = (5, 7)
#: A term that makes up one of so many words at least, and comes twice, also counts as a term of its own.
DENSITIES = (256, 64)
#: What a term weighs that does not go with the label, against 1 of one that surely does.
LEAST_WEIGHT = 0.02
#: Likelihood-ratio statistic from which, and to which, the weight of a term grows.
SURE = (10.0, 40.0)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words of letters and digits; none for null or empty texts."""
    return word_bytes(text if text.isascii() else text.decode("utf-8", "replace").lower().encode()) if text else []


def terms_of(word: bytes) -> list[bytes]:
    """A word and its beginnings, which are marked by their length."""
    if word.isascii():
        return [word, *[b"%d:%b" % (k, word[:k]) for k in BEGINNINGS if len(word) >= k]]
    letters = word.decode("utf-8", "replace")
    return [word, *(f"{k}:{letters[:k]}".encode() for k in BEGINNINGS if len(letters) >= k)]


def add_dense(counts: dict[bytes, int], n_words: int) -> dict[bytes, int]:
    """Term counts with the terms for density added."""
    dense = {b"%b@%d" % (t, d): 1 for t, n in counts.items() if n > 1 for d in DENSITIES if n * d >= n_words}
    return {**counts, **dense}


def bag_of(text: bytes | None) -> dict[bytes, int]:
    """All terms of a text with their counts."""
    words, counts = words_of(text), Counter()
    for word, n in Counter(words).items():
        for term in terms_of(word):
            counts[term] += n
    return add_dense(counts, len(words))


class KnownTerms(dict):
    """Numbers of the terms of a word that an index knows, for words met so far, up to a bound."""

    def __init__(self, terms: dict[bytes, int]):
        self.terms = terms
        #: Per term, the numbers of the terms for its densities, or -1.
        self.dense = np.full((len(DENSITIES), len(terms)), -1, np.int64)
        for term, number in terms.items():
            plain, sign, density = term.partition(b"@")
            if sign:
                self.dense[DENSITIES.index(int(density)), terms[plain]] = number

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 200_000:
            self.clear()
        self[word] = found = tuple(t for t in map(self.terms.get, terms_of(word)) if t is not None)
        return found

    def counts(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """:func:`bag_of` for the terms that the index knows: their numbers, rising, and counts."""
        words = words_of(text)
        terms, n = np.unique(np.fromiter(chain.from_iterable(map(self.__getitem__, words)), np.int64), return_counts=True)
        more = [dense[terms[(n > 1) & (n * d >= len(words))]] for d, dense in zip(DENSITIES, self.dense)]
        more = np.concatenate([m[m >= 0] for m in more])
        terms, n = np.concatenate([terms, more]), np.concatenate([n, np.ones(len(more), n.dtype)]).astype(np.float64)
        order = np.argsort(terms)
        return terms[order], n[order]


@dataclass
class ExampleIndex:
    """Unit vectors of the examples, by term and block: postings, and the largest weight of each term in each of its blocks.

    The entries of term t are ``entry[t]`` to ``entry[t + 1]``; an entry names a block, its largest weight, and where the
    postings of the term in this block begin. A term that one of :data:`FREQUENT` examples holds has, in place of postings, a
    row of ``dense`` with its weight in every example, so that such terms are summed for many queries by one product. All of it
    grows with the examples, whose number is bounded.
    """

    terms: dict[bytes, int]
    scale: np.ndarray
    label: np.ndarray
    ids: list
    entry: np.ndarray
    block: np.ndarray
    largest: np.ndarray
    posting: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    row: np.ndarray
    dense: np.ndarray
    base: float = 0.0
    steps: np.ndarray | None = None
    levels: np.ndarray | None = None

    def __getstate__(self) -> dict:
        """The rows of frequent terms travel without their zeros."""
        at = np.flatnonzero(self.dense)
        return {**self.__dict__, "dense": (self.dense.shape, at.astype(np.int32) if self.dense.size < 2**31 else at, self.dense.ravel()[at])}

    def __setstate__(self, state: dict) -> None:
        shape, at, values = state["dense"]
        dense = np.zeros(shape)
        dense.ravel()[at] = values
        self.__dict__.update({**state, "dense": dense})

    def unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Weights (1 + ln tf) * idf * weight of a text's terms, of length 1."""
        weight = (1 + np.log(counts)) * self.scale[terms]
        norm = math.sqrt(float(weight @ weight))
        return weight / norm if norm else weight

    def nearest(self, query: tuple[np.ndarray, np.ndarray], k: int, leave: int = -1) -> list[tuple[float, int]]:
        """The ``k`` examples of highest cosine above 0, ties to the smaller number, as (cosine, example), for terms and their counts."""
        return self.nearest_of([query], k, [leave])[0]

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, leave: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """:meth:`nearest` of many queries; example ``leave[i]`` is passed over for query i."""
        out = []
        for at in range(0, len(queries), 64):
            vectors = [(terms, self.unit(terms, counts)) for terms, counts in queries[at : at + 64]]
            asked = np.zeros((len(vectors), len(self.dense)))
            for i, (terms, weight) in enumerate(vectors):
                row = self.row[terms]
                asked[i, row[row >= 0]] = weight[row >= 0]
            for i, (frequent, (terms, weight)) in enumerate(zip(asked @ self.dense, vectors)):
                out.append(self._search(frequent, terms, weight, k, -1 if leave is None else leave[at + i]))
        return out

    def _search(self, cosine: np.ndarray, terms: np.ndarray, weight: np.ndarray, k: int, leave: int) -> list[tuple[float, int]]:
        """``cosine`` holds the frequent terms' share; blocks that cannot reach the k-th highest keep it and are never looked at."""
        n = len(cosine)
        if not n:
            return []
        if leave >= 0:
            cosine[leave] = 0
        size = self.entry[terms + 1] - self.entry[terms]
        entries, weight = spans(self.entry[terms], size), np.repeat(weight, size)
        block = self.block[entries]
        blocks = -(-n // BLOCK)
        bound = np.maximum.reduceat(cosine, np.arange(0, n, BLOCK)) + np.bincount(block, weights=weight * self.largest[entries], minlength=blocks)
        whole = np.zeros(n, bool)

        def look(chosen: np.ndarray) -> float:
            """Complete the cosines of the chosen blocks; returns the k-th highest so far."""
            mine = chosen[block]
            at = entries[mine]
            held = self.posting[at + 1] - self.posting[at]
            place = spans(self.posting[at], held)
            cosine[:] += np.bincount(self.example[place], weights=np.repeat(weight[mine], held) * self.weight[place], minlength=n)
            whole[:] |= np.repeat(chosen, BLOCK)[:n]
            if leave >= 0:
                cosine[leave] = 0
            done = cosine[whole]
            return np.partition(done, -k)[-k] if len(done) > k else 0.0

        first = np.zeros(blocks, bool)
        first[np.argsort(-bound, kind="stable")[:FIRST_BLOCKS]] = True
        reached = look(first)
        # Rounding differs between bound and sum, so look at what comes within a hair.
        rest = ~first & (bound > 0) & (bound >= reached - 1e-9)
        if rest.any():
            reached = look(rest)
        found = np.flatnonzero(whole & (cosine > 0) & (cosine >= reached))
        order = found[np.lexsort((found, -cosine[found]))][:k]
        return list(zip(cosine[order].tolist(), order.tolist()))

    def vote(self, neighbours: list[tuple[float, int]]) -> float:
        """Share of label 1 among the neighbours, each weighted by its squared cosine, with the prior's share."""
        weight = np.array([c * c for c, _ in neighbours])
        label = self.label[[e for _, e in neighbours]] if neighbours else np.zeros(0)
        return float((weight @ label + PRIOR * self.base) / (weight.sum() + PRIOR))

    def calibrated(self, vote: float) -> float:
        """Probability of label 1: leave-one-out frequencies, made monotone, between their centres on a straight line."""
        if self.steps is None or not len(self.steps):
            return vote
        return float(np.interp(vote, self.steps, self.levels))


def monotone(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling neighbours: centres and, strictly rising through a small slope, their levels."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []
    for x, y in zip(votes[order].tolist(), labels[order].tolist()):
        pools.append([x, y, 1.0])
        while len(pools) > 1 and (pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]):
            x2, y2, n2 = pools.pop()
            x1, y1, n1 = pools.pop()
            pools.append([(x1 * n1 + x2 * n2) / (n1 + n2), y1 + y2, n1 + n2])
    centre = np.array([p[0] for p in pools])
    level = np.array([(p[1] + 0.5 * p[0]) / (p[2] + 0.5) for p in pools])
    grid = np.unique(np.concatenate([[0.0], centre, [1.0]]))
    smooth = np.interp(grid, centre, np.maximum.accumulate(level))
    return grid, 0.999 * smooth + 0.001 * grid


def label_weight(n: np.ndarray, hits: np.ndarray, total: int, positive: int) -> np.ndarray:
    """Weight of terms that ``n`` examples hold, ``hits`` of them with label 1: by how surely label 1 makes them frequent.

    The likelihood-ratio statistic (G) of presence and label, between :data:`SURE`, becomes a weight from :data:`LEAST_WEIGHT` to 1.
    """

    def cell(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-300) / np.maximum(expected, 1e-300)), 0.0)

    p = positive / max(total, 1)
    g = 2 * (cell(hits, n * p) + cell(n - hits, n * (1 - p)) + cell(positive - hits, (total - n) * p) + cell(total - positive - n + hits, (total - n) * (1 - p)))
    sure = np.clip((g - SURE[0]) / (SURE[1] - SURE[0]), 0, 1) * (hits * total > n * positive)
    return LEAST_WEIGHT + (1 - LEAST_WEIGHT) * sure


def build_index(ids: list, label: list[int], bags: list[dict[bytes, int]], base: float | None = None) -> ExampleIndex:
    """The index over examples given as term counts; see :func:`index_of`."""
    terms = pa.array([t for bag in bags for t in bag], pa.binary())
    return index_of(ids, label, np.array([len(b) for b in bags], np.int64), terms, np.array([n for bag in bags for n in bag.values()], np.float64), base)


def index_of(ids: list, label: list[int], size: np.ndarray, terms: pa.Array, count: np.ndarray, base: float | None = None) -> ExampleIndex:
    """The index over examples: ``size`` terms of each with their counts, one example after the other.

    Every term of every example takes part. idf is ln((n + 1) / (df + 1/2)), at least 0, over all examples. ``base`` is the
    share of label 1 that texts without neighbours get. Calibration is leave-one-out over the examples. Examples are put in
    the order of their heaviest term, so that blocks hold similar ones and bounds are tight.
    """
    coded = terms.dictionary_encode()
    number = {t: i for i, t in enumerate(coded.dictionary.to_pylist())}
    term, bags = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), size
    coded_term, owner = term, np.repeat(np.arange(len(size)), size)
    labels = np.array(label, np.float64)
    df = np.bincount(term, minlength=len(number)).astype(np.float64)
    hits = np.bincount(term, weights=labels[owner], minlength=len(number))
    idf = np.maximum(np.log((len(bags) + 1) / (df + 0.5)), 0.0)
    scale = idf * label_weight(df, hits, len(bags), int(labels.sum()))
    weight = (1 + np.log(count)) * scale[term]
    norm = np.sqrt(np.bincount(owner, weights=weight * weight, minlength=len(bags)))
    weight /= np.where(norm > 0, norm, 1)[owner]
    heaviest = np.full(len(bags), -1, np.int64)
    by_weight = np.lexsort((term, weight, owner))
    heaviest[owner[by_weight]] = term[by_weight]  # the last of each example stays
    place = np.empty(len(bags), np.int64)
    order = np.lexsort((np.arange(len(bags)), heaviest))
    place[order] = np.arange(len(bags))
    example = place[owner]
    by_term = np.lexsort((example, term))
    term, example, weight = term[by_term], example[by_term], weight[by_term]
    row = np.full(len(number), -1, np.int64)
    frequent = np.flatnonzero(df * FREQUENT >= max(len(bags), FREQUENT))
    row[frequent] = np.arange(len(frequent))
    common = row[term] >= 0
    dense = np.zeros((len(frequent), len(bags)))
    dense[row[term[common]], example[common]] = weight[common]
    term, example, weight = term[~common], example[~common], weight[~common]
    key = term * (len(bags) // BLOCK + 1) + example // BLOCK
    start = np.flatnonzero(np.diff(key, prepend=-1))
    largest = np.maximum.reduceat(weight, start) if len(start) else np.zeros(0)
    entry = np.concatenate([[0], np.cumsum(np.bincount(term[start], minlength=len(number)))])
    index = ExampleIndex(
        number, scale, labels[order], [ids[i] for i in order.tolist()], entry, (example[start] // BLOCK).astype(np.int32), largest,
        np.append(start, len(term)).astype(np.int32), example.astype(np.int32), weight, row.astype(np.int32), dense,
    )
    index.base = base if base is not None else float(labels.mean()) if len(bags) else 0.0
    if len(bags) and 0 < labels.mean() < 1:
        ends = np.cumsum(size)
        mine = [np.sort(np.rec.fromarrays([coded_term[a:b], count[a:b]])) for a, b in zip((ends - size)[order], ends[order])]
        queries = [(x.f0, x.f1) for x in mine]
        votes = np.array([index.vote(near) for near in index.nearest_of(queries, NEIGHBOURS, list(range(len(bags))))])
        index.steps, index.levels = monotone(votes, index.label)
    return index


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_examples: int = 2500) -> ExampleIndex:
    """An index over a bounded sample of the labelled documents; it holds every term of theirs.

    About ``max_examples`` labels are drawn by the hash of their key; rows with a null key or label are left out, of a
    key with several labels the highest counts, and a key that several documents bear takes part with each. Copies of a text
    count once. Drawn labels are few enough, by ``max_examples``, to be broadcast, so that the documents are not moved; the
    driver holds the drawn documents' term counts.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    share = min(1.0, max_examples / max(known.count(), 1))
    drawn = settle(known.where(F.pmod(F.xxhash64("_key"), F.lit(1 << 20)) < share * (1 << 20)), "examples")
    held = docs.select(F.col(key).alias("_key"), text_bytes(text).alias("_text")).join(F.broadcast(drawn), "_key")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [bag_of(x) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([list(b.keys()) for b in bags], pa.list_(pa.binary())), pa.array([list(b.values()) for b in bags], pa.list_(pa.int64()))], names
            )

    names = ["key", "label", "copy", "terms", "counts"]
    bare = held.select(F.col("_key").alias("key"), F.col("_label").cast("int").alias("label"), F.xxhash64("_text").alias("copy"), "_text")
    spelled = bare.mapInArrow(spell, T.StructType(bare.schema.fields[:-1] + T.StructType.fromDDL("terms array<binary>, counts array<long>").fields))
    # Copies of an example would fill the neighbourhood with one opinion, so equal texts count once.
    bags = settle(
        spelled.groupBy("copy").agg(F.min("key").alias("key"), F.max("label").alias("label"), F.first("terms").alias("terms"), F.first("counts").alias("counts")), "bags"
    )
    rows = bags.select("key", "label", "terms", "counts").orderBy("key", "label", "copy").toArrow().combine_chunks()
    label_list = rows.column("label").to_pylist()
    hits = sum(label_list)
    if not 0 < hits < len(label_list):
        return build_index([], [], [], (hits + 0.5) / (len(label_list) + 1.0))
    terms, counts = (rows.column(c).chunk(0) for c in ("terms", "counts"))
    size = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return index_of(rows.column("key").to_pylist(), label_list, size, terms.flatten(), counts.flatten().to_numpy(zero_copy_only=False).astype(np.float64))


def score(docs: DataFrame, index: ExampleIndex, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with score (0 to 1), predicted (1 from ``threshold`` on) and evidence (the nearest examples).

    Every row is kept; null and empty texts, and those without any term of the index, score its base rate and have no
    evidence. Columns of these names, in any case, are replaced. Of a text's terms those count that some example has; equal
    term counts are looked up once in a while per worker. The index is bounded by its fit, so it is shared as a broadcast.
    Evidence names examples by their key as text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)
    key = f"toxicity-{uuid.uuid4().hex}"
    added = T.StructType.fromDDL("score double, predicted int, evidence array<struct<doc_id: string, similarity: double, label: int>>")
    evidence_type = pa.list_(pa.struct([("doc_id", pa.string()), ("similarity", pa.float64()), ("label", pa.int32())]))

    def judge(texts: list[bytes | None], index: ExampleIndex, known: KnownTerms, cache: dict) -> list:
        if len(cache) > 5_000:
            cache.clear()
        counts = [known.counts(x) for x in texts]
        bags = [terms.tobytes() + n.tobytes() for terms, n in counts]
        new = {bag: c for bag, c in zip(bags, counts) if bag not in cache}
        for bag, near in zip(new, index.nearest_of(list(new.values()), NEIGHBOURS)):
            shown = [{"doc_id": str(index.ids[e]), "similarity": c, "label": int(index.label[e])} for c, e in near[:3]]
            cache[bag] = (index.calibrated(index.vote(near)) if near else index.base, shown)
        return [cache[bag] for bag in bags]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        known, cache = process_value(key, lambda: (KnownTerms(index.terms), {}))
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = [x for at in range(0, len(texts), 256) for x in judge(texts[at : at + 256], index, known, cache)]
            values = np.array([s for s, _ in found], np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values), pa.array((values >= threshold).astype(np.int32)), pa.array([e for _, e in found], evidence_type)], names
            )

    kept = others(docs, added.names)
    bare = docs.select(*[F.col(f"`{c}`") for c in kept], text_bytes(text).alias(fresh(docs, "_text")[0]))
    names = [*kept, *added.names]
    return bare.mapInArrow(run, T.StructType(bare.schema.fields[:-1] + added.fields))
