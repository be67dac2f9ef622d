"""SimHash near-duplicates against a full comparison of fingerprints."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidelake.llm import simhash
from tidelake.llm.base import ship
from tidelake.llm.components import components


def plain_fingerprint(text, words=3):
    tokens = (text or "").encode().lower().split()
    shingles = [b" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or ([b" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints, bits):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= bits:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [root(i) for i in range(len(prints))]


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if i > 4 and rng.random() < 0.6:
            words = out[rng.randrange(len(out))].split()
            if words and rng.random() < 0.7:
                words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
            out.append(" ".join(words))
        else:
            out.append(" ".join(f"W{rng.randrange(400)}" for _ in range(rng.randrange(0, 120))))
    return out


def test_position_sets_contain_any_five():
    assert len(simhash.POSITION_SETS) == 14
    assert all(any(set(s) <= set(five) for s in simhash.POSITION_SETS) for five in combinations(range(8), 5))


def test_fingerprint():
    for text in [None, "", " \n", "One", "one two", "A b C d e", "a b\x0bc  d\ta b c", "ÄÖ ü x", *texts(30, 3)]:
        assert simhash.fingerprint(None if text is None else text.encode(), 3) == plain_fingerprint(text)
    assert simhash.fingerprint(b"ABC d e", 3) == simhash.fingerprint(b"abc D E", 3)


def test_spark_hash_is_the_same_hash(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("one two three", seed=42)


def test_list_links_make_the_components_of_all_links():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 12).astype(np.uint64)
    flips = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 5), replace=False))) for b in base for _ in range(25)]
    values = np.unique(np.array(flips, np.uint64))
    for bits in (0, 1, 2, 3):
        got = simhash.list_links(values, values, bits)
        want = plain_components(values.tolist(), bits)
        parent = {int(a): int(b) for a, b in got}

        def root(x, parent=parent):
            while x in parent:
                x = parent[x]
            return x

        assert [root(v) for v in values.tolist()] == [int(values[w]) for w in want]
        assert len(got) < len(values)


@pytest.mark.parametrize("block", [8192, 16])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block):
    ship(spark)
    monkeypatch.setattr(simhash, "BLOCK", block)
    made = [*texts(150, 5), "", "", None, "same text here now"]
    rows = [(1000 - i, t, "x") for i, t in enumerate(made)] + [(5, "same text here now", "y"), (None, made[7], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = {(r.doc_id, r.simhash % (1 << 64)): r.component_id for r in simhash.near_duplicates(df).collect()}
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    roots = plain_components(prints, 3)
    for i, (key, _, _) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if roots[j] == roots[i] and rows[j][0] is not None]
        assert got[key, prints[i]] == (min(members) if members else None)


def test_keep_one(spark):
    ship(spark)
    a, b = "one two three four five six seven", "other words in another text altogether now"
    rows = [(3, a, "p"), (2, a, "q"), (9, b, "r"), (9, b, "s"), (2, b, "t"), (None, "alone in here", "u"), (None, None, "v"), (4, "", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _hash string")
    kept = simhash.keep_one(df).collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept if r.text) == [(-1, "alone in here"), (2, a), (2, b)]
    assert [r.doc_id for r in kept if not r.text] == [4]
    assert simhash.keep_one(df.limit(0)).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    df = spark.createDataFrame([*chain, *star, (7, 7), (5000, 5000), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[1000 + i] for i in range(300)} == {1000}
    assert set(got) == {*range(201), *range(1000, 1300)}
    assert components(df.limit(0)).collect() == []


def test_more_than_three_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "simhash long"), 4)
