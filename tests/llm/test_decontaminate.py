"""Winnowing against a search of all windows."""

from __future__ import annotations

import glob
import hashlib
import os
import random
import re

import numpy as np
import pytest

from tidelake.llm import decontaminate as dc
from tidelake.llm.base import ship

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, window=13):
    out = []
    for text in docs:
        w = words(text)
        hit, found = set(), set()
        for name, item in items:
            iw = words(item)
            n = min(window, len(iw))
            if name is None or not n:
                continue
            spans = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in spans:
                    hit.update(range(i, i + n))
                    found.add(str(name))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((len(w), len(hit), len(found), digest))
    return out


def run(spark, docs, items, **options):
    ship(spark)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(docs)], "doc_id long, text string, n_hit string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in dc.contamination(df, bench, **options).collect()}
    assert len(got) == len(docs)
    return [got[i] for i in range(len(docs))]


def random_case(seed, vocabulary, n_docs=60):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 9, 12, 13, 14, 30]))) for i in range(20)] + [(20, None), (21, ""), (22, "..."), (None, "null id here")]
    docs = [None, "", "-- !!"]
    for _ in range(n_docs):
        parts = [text(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            w = (rng.choice(items)[1] or "").split()
            at = rng.randrange(len(w) + 1)
            parts += [", ".join(w[at:] if rng.random() < 0.5 else w).upper(), text(rng.randrange(10))]
        docs.append(" ".join(parts))
    return docs, items


@pytest.mark.parametrize(("seed", "vocabulary"), [(1, [f"w{i}" for i in range(60)]), (2, ["a", "b"]), (3, ["Ünï", "x1", "y"])])
def test_against_brute_force(spark, seed, vocabulary):
    docs, items = random_case(seed, vocabulary)
    assert run(spark, docs, items) == brute(docs, items)


def test_runs_of_one_word_and_long_texts(spark):
    items = [(1, "la " * 40), (2, " ".join(f"t{i}" for i in range(25))), (3, "la " * 40)]
    docs = ["la " * 5000, " ".join(f"t{i}" for i in range(12)), "x " * 3000 + " ".join(f"t{i}" for i in range(5, 18)) + " y" * 3000]
    assert run(spark, docs, items) == brute(docs, items)


def test_every_shared_span_of_a_window_is_guaranteed():
    rng = np.random.default_rng(0)
    for length in range(1, 14):
        for _ in range(50):
            span = rng.integers(0, 4, length).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            around = rng.integers(0, 1 << 60, 40).astype(np.uint64)
            at = int(rng.integers(0, 28))
            whole = np.concatenate([around[:at], span, around[at:]])
            place, gram = dc.winnow(span, length)
            kept = dict(zip(*(x.tolist() for x in dc.winnow(whole, length))))
            assert kept[at + int(place[0])] == int(gram[0])


def test_a_filter_full_of_bits_changes_nothing(spark, monkeypatch):
    docs, items = random_case(4, [f"w{i}" for i in range(30)], 30)
    monkeypatch.setattr(dc, "FILTER_BITS", 6)
    assert run(spark, docs, items) == brute(docs, items)


def test_the_filter_grows_with_the_benchmark_up_to_its_bound(spark, monkeypatch):
    hashes = spark.range(5000).selectExpr("xxhash64(id) AS hash")
    bits = dc._filter_bits(hashes)
    assert len(bits) * 32 == 1 << 18
    expected = {r.hash & ((1 << 18) - 1) for r in hashes.collect()}
    assert {32 * w + b for w, v in enumerate(bits.tolist()) if v for b in range(32) if v >> b & 1} == expected
    monkeypatch.setattr(dc, "FILTER_BITS", 12)
    assert len(dc._filter_bits(hashes)) * 32 == 1 << 12
    assert not dc._filter_bits(hashes.limit(0)).any()


def test_a_passage_of_many_items_in_many_documents_is_matched_once_per_document(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    items = [(i, passage if i % 2 else passage + f" tail{i} more{i}") for i in range(120)]
    docs = [f"before{i % 3} {passage} after{i}" for i in range(150)] + [passage + " tail4 more4", "nothing here"]
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{folder}/**/*matches*", recursive=True))
    assert run(spark, docs, items) == brute(docs, items)
    written = [p for p in set(glob.glob(f"{folder}/**/*matches*", recursive=True)) - before if os.path.isdir(p)]
    assert len(written) == 1
    assert spark.read.parquet(written[0]).count() == 3 * 151 + 2  # three windows each, two more with the tail; not times the items


def test_without_contaminated(spark):
    ship(spark)
    passage = " ".join(f"q{i}" for i in range(14))
    filler = " ".join(f"f{i}" for i in range(400))
    rows = [(1, passage), (1, passage), (2, filler + " " + passage), (3, None), (4, ""), (5, "clean text")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _hash string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = dc.without_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5]
    assert dc.without_contaminated(df.limit(0), bench).collect() == []
    assert dc.without_contaminated(df, bench.limit(0)).count() == 6


def test_spans(spark):
    ship(spark)
    df = spark.createDataFrame([(1, "a b c d e f a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "e")], "item_id long, text string")
    row = dc.contamination(df, bench).first()
    assert [(s.start, s.end) for s in row.spans] == [(0, 3), (4, 5), (6, 8)] and row.n_hit == 6
