"""Alignment of two tokenizers against a plain reading of its definition."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidelake.llm import alignment as al
from tidelake.llm.base import ship
from tidelake.llm.queries import tokenizer_pair as make_pair

P = pytest.importorskip("public_tokenizers")




def tokens(text):
    """(id, bytes) of both sides, by the tokenizer files alone and for the text in one piece."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(P.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    table = al.byte_alphabet()
    if not text:
        return [], []
    left = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    whole = (" " + text).encode()
    if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return [], []
    return left, right


def ranges(side):
    at, out = 0, []
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(rows):
    found, held = [], Counter()
    for key, text in rows:
        a, b = map(ranges, tokens(text))
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, before = [], 0
        for cut in cuts:
            groups.append(tuple(",".join(str(i) for i, s, e in side if before <= s and e <= cut) for side in (a, b)))
            before = cut
        found.append((key, len(a), len(b), links, groups))
        held.update(set(links))
    top = defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    out = []
    for key, n_a, n_b, links, groups in found:
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if n_a else ""
        out.append((key, n_a, n_b, len(groups), len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), digest))
    return sorted(out, key=repr)


def columns(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


ODD = [
    (1, "a plain line of words, with commas."), (2, None), (3, ""), (4, "   spaces   between  and after  "), (5, "tabs\tand\nlines\r\n\r\n x"),
    (6, "a <|endoftext|> inside, <s> and </s> and <unk> and <0x41>"), (7, "日本語の文章 と emoji 👩‍👩‍👧 ok"), (8, "holds ▁ the mark"), (9, "zero\x00byte and   hard space wide"),
    (10, "x" * 3000), (11, "don't we'll they're it's 3,141.59 #$%^&*() foo_bar--baz"), (12, "ﬁne Ａ é é ÅÄÖ ß Ǆ"), (1, "a plain line of words, with commas."), (None, "null key here"), (13, " "), (14, "\n"),
]


def test_against_definition(spark):
    ship(spark)
    frame = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    assert columns(al.align(frame, make_pair, "test-pair")) == brute(ODD)


def test_random_texts(spark):
    ship(spark)
    draw = random.Random(5)
    words = ["the", "Haus", "élan", "ing", ",", ".", "1234", "  ", "\n", "über", "x1", "(a)", "naïve", "…", "中", "re-do", "'s", " "]
    rows = [(i, "".join(draw.choice(words) + draw.choice([" ", "", " "]) for _ in range(draw.randrange(0, 60)))) for i in range(120)]
    assert columns(al.align(spark.createDataFrame(rows, "doc_id long, text string"), make_pair, "test-pair")) == brute(rows)


def test_undecodable_bytes_have_no_tokens(spark):
    ship(spark)
    frame = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    assert columns(al.align(frame, make_pair, "test-pair")) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_empty_table_and_clashing_names(spark):
    ship(spark)
    assert al.align(spark.createDataFrame([], "doc_id long, text string"), make_pair, "test-pair").count() == 0
    names = ["doc_id", "text", "kept", "N_A", "batch", "_", "c0", "a.b", "key"]
    frame = spark.createDataFrame([("k", "some words", 1, 2, 3, 4, 5, 6, 7)], "doc_id string, text string, kept int, x int, batch int, y int, c0 int, z int, key int").toDF(*names)
    got = al.align(frame, make_pair, "test-pair")
    assert got.columns == ["doc_id", "kept", "batch", "_", "c0", "a.b", "key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert columns(got)[0][:7] == ("k", 1, 3, 4, 5, 6, 7)
    assert al.links(frame, make_pair, "test-pair").columns[:3] == ["doc_id", "kept", "N_A"]


def test_a_forgetful_table_changes_nothing(spark, monkeypatch):
    pair = make_pair()
    monkeypatch.setattr(al.ChunkTable, "CHUNKS", 3)
    table = al.ChunkTable(pair)
    texts = [t for _, t in ODD]
    for part in (texts[:5], texts[5:9], texts[9:]):
        got, fresh = al.Batch([t.encode() if t is not None else None for t in part], table), al.Batch([t.encode() if t is not None else None for t in part], al.ChunkTable(pair))
        assert got.digest == fresh.digest and [f.tolist() for f in got.facts] == [f.tolist() for f in fresh.facts]


def test_links_of_a_text(spark):
    ship(spark)
    text = "naïve tokenisers… 日本"
    row = al.links(spark.createDataFrame([(1, text)], "doc_id long, text string"), make_pair, "test-pair").first()
    a, b = map(ranges, tokens(text))
    want = [(i, j, min(e, f) - max(s, t)) for i, (_, s, e) in enumerate(a) for j, (_, t, f) in enumerate(b) if s < f and t < e]
    assert [tuple(x) for x in row.links] == want
    assert (row.a_ids, row.b_ids) == ([i for i, *_ in a], [i for i, *_ in b])
    groups = [g.split("|") for g in row.groups.split(";")]
    assert row.n_group_links == sum(len(x.split(",")) * len(y.split(",")) for x, y in groups)


@pytest.mark.parametrize("expanded", [1, 7, 1 << 22])
def test_product_of_matrices(monkeypatch, expanded):
    monkeypatch.setattr(al, "EXPANDED", expanded)
    rng = np.random.default_rng(1)
    a, b = rng.random((9, 7)) < 0.3, rng.random((7, 5)) < 0.4
    left, right = ((np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1]) for m in (a, b))
    out = np.zeros((9, 5), int)
    for row, column, value in al.multiply(left, right, 5):
        out[row, column] += value
    assert (out == a.astype(int) @ b.astype(int)).all()
    back = al.transpose(al.transpose(left, 7), 9)
    assert (back[0] == left[0]).all() and (back[1] == left[1]).all()
