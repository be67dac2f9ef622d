"""Nearest labelled examples: exactness of the index, calibration, held-out results and edge cases."""

from __future__ import annotations

import math
import pickle
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidelake.llm import toxicity as tx
from tidelake.llm.base import ship

RUDE = ["blorg", "snark", "vile", "grob"]


def plain_terms(text):
    """All terms of a raw text with their counts, read off the definition."""
    words = [w for w in re.split(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.decode().lower().encode()) if w]
    out = Counter()
    for w in words:
        letters = w.decode()
        out.update([w] + [f"{k}:{letters[:k]}".encode() for k in (5, 7) if len(letters) >= k])
    for t, n in list(out.items()):
        out.update({t + b"@%d" % d: 1 for d in (256, 64) if n > 1 and n * d >= len(words)})
    return out


def plain_cosines(examples, query):
    """Cosine of a raw text with every example (text, label) over all terms of the examples."""
    bags = [plain_terms(t) for t, _ in examples]
    n, positive = len(bags), sum(y for _, y in examples)
    df, hits = Counter(t for b in bags for t in b), Counter(t for b, (_, y) in zip(bags, examples) if y for t in b)

    def scale(t):
        idf = max(math.log((n + 1) / (df[t] + 0.5)), 0)
        table = [(hits[t], positive), (df[t] - hits[t], n - positive)]
        g = 0.0
        for seen, of in table:
            for x, share in ((seen, df[t] / n), (of - seen, 1 - df[t] / n)):
                g += 2 * x * math.log(x / (of * share)) if x else 0
        sure = min(max((g - 10) / 30, 0), 1) if hits[t] * n > df[t] * positive else 0
        return idf * (0.02 + 0.98 * sure)

    def unit(bag):
        w = {t: (1 + math.log(c)) * scale(t) for t, c in bag.items() if t in df}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()} if norm else w

    q = unit(plain_terms(query))
    return [sum(q.get(t, 0) * x for t, x in unit(b).items()) for b in bags]


def raw_texts(n, seed, size=40):
    rng = random.Random(seed)
    words = [f"{rng.choice(['Wort', 'über', 'stem', 'é', 'x'])}{i}" for i in range(150)]
    out = []
    for _ in range(n):
        toxic = int(rng.random() < 0.25)
        text = " ".join(rng.choices(words, weights=range(1, 151), k=rng.randrange(1, size)) + (rng.sample(RUDE, 2) if toxic and rng.random() < 0.9 else []))
        out.append((text.encode(), toxic))
    return out


@pytest.mark.parametrize("frequent", [1, 4, 10**9])
def test_block_max_search_is_exact_over_all_terms(monkeypatch, frequent):
    monkeypatch.setattr(tx, "FREQUENT", frequent)
    monkeypatch.setattr(tx, "FIRST_BLOCKS", 2)
    examples = raw_texts(400, 0)
    index = tx.build_index(list(range(400)), [y for _, y in examples], [tx.bag_of(t) for t, _ in examples])
    assert set(index.terms) == {t for x, _ in examples for t in plain_terms(x)}
    known = tx.KnownTerms(index.terms)
    for query, _ in raw_texts(60, 1) + [(b"unseen words only", 0), (b"", 0), (b"vile", 1)] + examples[:5]:
        got = index.nearest(known.counts(query), 15)
        cosines = plain_cosines(examples, query)
        want = sorted((c for c in cosines if c > 0), reverse=True)[:15]
        assert np.allclose([c for c, _ in got], want, atol=1e-9)
        assert all(abs(cosines[index.ids[e]] - c) < 1e-9 for c, e in got)


def test_an_index_that_was_sent_answers_the_same():
    examples = raw_texts(150, 4)
    index = tx.build_index(list(range(150)), [y for _, y in examples], [tx.bag_of(t) for t, _ in examples])
    sent = pickle.loads(pickle.dumps(index))
    assert (sent.dense == index.dense).all() and len(index.dense) and (sent.row == index.row).all()
    known = tx.KnownTerms(sent.terms)
    assert [sent.nearest(known.counts(t), 5) for t, _ in examples[:10]] == [index.nearest(known.counts(t), 5) for t, _ in examples[:10]]


def test_left_out_example_and_ties():
    examples = raw_texts(100, 3) * 2
    index = tx.build_index(list(range(200)), [y for _, y in examples], [tx.bag_of(t) for t, _ in examples])
    known = tx.KnownTerms(index.terms)
    for text, _ in examples[:20]:
        counts = known.counts(text)
        near = index.nearest(counts, 5)
        assert near == sorted(near, key=lambda x: (-round(x[0], 12), x[1]))
        left = index.nearest(counts, 5, leave=near[0][1])
        assert near[0][1] not in {e for _, e in left} and abs(left[0][0] - 1) < 1e-9


def test_blocks_are_skipped(monkeypatch):
    """A query that one block answers well does not look at the rest."""
    monkeypatch.setattr(tx, "FIRST_BLOCKS", 2)
    monkeypatch.setattr(tx, "FREQUENT", 10**9)
    examples = [(f"topic{i // 40} filler{i}".encode(), i % 2) for i in range(760)]
    index = tx.build_index(list(range(760)), [y for _, y in examples], [tx.bag_of(t) for t, _ in examples])
    looked = []
    spans = tx.spans
    monkeypatch.setattr(tx, "spans", lambda start, size: looked.append(int(size.sum())) or spans(start, size))
    index.nearest(tx.KnownTerms(index.terms).counts(b"topic3"), 5)
    assert len(looked) == 2 and looked[1] <= 3 * 2 * tx.BLOCK


def test_fit_keeps_every_term_and_any_key(spark):
    ship(spark)
    examples = raw_texts(120, 7)
    rows = [(f"doc-{i}", t.decode(), y) for i, (t, y) in enumerate(examples)]
    docs = spark.createDataFrame([(k, t, 1.0, 2) for k, t, _ in rows], "doc_id string, text string, Score double, _text int")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id string, toxic int")
    index = tx.fit(docs, labels)
    assert set(index.terms) == {t for x, _ in examples for t in plain_terms(x)} and set(index.ids) <= {k for k, *_ in rows}
    out = tx.score(docs, index)
    assert out.columns == ["doc_id", "text", "_text", "score", "predicted", "evidence"]
    assert out.count() == 120 and out.first().evidence[0].doc_id.startswith("doc-")


def test_monotone_levels():
    rng = np.random.default_rng(0)
    votes = rng.random(400)
    grid, level = tx.monotone(votes, (rng.random(400) < votes).astype(float))
    assert (np.diff(grid) > 0).all() and (np.diff(level) > 0).all() and level.min() >= 0 and level.max() <= 1


def test_terms():
    assert tx.terms_of(b"abcd") == [b"abcd"]
    assert tx.terms_of("überlich".encode()) == ["überlich".encode(), "5:überl".encode(), "7:überlic".encode()]
    assert tx.terms_of(b"blorging") == [b"blorging", b"5:blorg", b"7:blorgin"]
    bag = tx.bag_of("Blorg blorg, BLORG! x É é".encode())
    assert bag[b"blorg"] == 3 and bag[b"5:blorg"] == 3 and bag[b"blorg@64"] == 1 and bag["é".encode()] == 2
    assert tx.bag_of(None) == {} == tx.bag_of(b"")


def documents(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(300)}" for _ in range(rng.randrange(20, 120))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    ship(spark)
    rows = documents(600, 0)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (3, rows[3][1]), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, "z") for i, _, y in rows] + [(900, 0, ""), (None, 1, ""), (5, None, ""), (9999, 1, ""), (3, rows[3][2], "")], "doc_id long, toxic int, text string")
    return tx.fit(docs, labels)


def test_held_out(spark, fitted):
    assert {w.encode() for w in RUDE} <= set(fitted.terms)
    rows = documents(300, 1)
    out = {r.doc_id: r for r in tx.score(spark.createDataFrame(rows, "doc_id long, text string, truth int"), fitted).collect()}
    assert sum(out[i].predicted == y for i, _, y in rows) >= 297
    for r in out.values():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert len(r.evidence) <= 3 and all(0 < e.similarity <= 1 + 1e-9 for e in r.evidence)
    assert all(e.label == 1 for i, _, y in rows if y for e in out[i].evidence[:1])


def test_edges(spark, fitted):
    rows = [(1, None, "c"), (2, "", "c"), (None, "zz1 yy2", "c"), (4, "vile " * 20_000, "c"), (4, "vile " * 20_000, "c"), (5, "!!!", "c")]
    out = tx.score(spark.createDataFrame(rows, "doc_id long, text string, score string"), fitted).collect()
    assert len(out) == 6
    assert {r.score for r in out if r.text is None or "vile" not in r.text} == {fitted.base}
    assert [r.predicted for r in out if r.doc_id == 4] == [1, 1]
    assert tx.score(spark.createDataFrame([], "doc_id long, text string"), fitted).collect() == []


def test_one_label_only(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    for labels, low, high in (([(1, 0), (2, 0)], 0, 0.5), ([(1, 1), (2, 1)], 0.5, 1), ([], 0.4, 0.6)):
        index = tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {low <= r.score <= high for r in tx.score(docs, index).collect()} == {True}
