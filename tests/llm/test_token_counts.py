"""Token counts against the best segmentation of each pre-token on its own."""

from __future__ import annotations

import random

import pytest

from tidelake.llm import token_counts as tc
from tidelake.llm.base import ship

SCORES = {"▁": -2.0, "▁a": -1.5, "a": -2.5, "b": -2.0, "ab": -3.0, "ba": -3.5, "aba": -4.0, "▁ab": -3.0, "bb": -4.0, "é": -1.0, "🙂": -3.0}


def brute(pre_token, scores, unknown):
    best = [(0.0, 0)]
    for end in range(1, len(pre_token) + 1):
        options = [(best[end - 1][0] + unknown, -best[end - 1][1] - len(pre_token[end - 1].encode()))]
        options += [(best[s][0] + scores[pre_token[s:end]], -best[s][1] - 1) for s in range(end) if pre_token[s:end] in scores]
        score, n = max(options)
        best.append((score, -n))
    return best[-1][1]


@pytest.mark.parametrize("alphabet", ["ab", "abé漢🙂x"])
def test_against_brute_force(alphabet):
    pieces, rng = tc.Pieces.of(SCORES), random.Random(0)
    words = sorted({"▁" + "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 20))) for _ in range(800)})
    got = tc.trie_counts(words, pieces).tolist()
    assert got == [brute(w, SCORES, pieces.unknown) for w in words]
    assert got == [tc.long_count(w, pieces) for w in words]


def test_an_empty_vocabulary_counts_bytes():
    pieces = tc.Pieces.of({})
    assert tc.trie_counts(["▁aé", "▁"], pieces).tolist() == [3 + 1 + 2, 3]
    assert tc.trie_counts([], pieces).tolist() == []


def test_tables_with_everything(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(tc, "KEPT", 20)
    pieces = tc.Pieces.of(SCORES)
    texts = [None, "", " \n\t", "ab", "ab ab  ba\nab", "b" * 5000, "a" * 63 + " " + "a" * 64, "aé 漢🙂 x", *(" ".join("ab"[i % 2] * (i % 7 + 1) for i in range(n)) for n in range(40))]
    df = spark.createDataFrame([(i // 2, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = tc.count_tokens(df.withColumnRenamed("text", "t"), SCORES, "t").collect()
    assert len(got) == len(texts)
    want = sorted((i // 2, len((t or "").split()), sum(brute("▁" + w, SCORES, pieces.unknown) for w in (t or "").split())) for i, t in enumerate(texts))
    assert sorted((r.doc_id, r.n_pretokens, r.n_tokens) for r in got) == want
    assert tc.count_tokens(df.limit(0), SCORES).collect() == []


def test_the_plan_is_narrow(spark):
    df = tc.count_tokens(spark.createDataFrame([("a",)], "text string"), SCORES)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_the_library_agrees():
    """The unigram model of the tokenizers library, with the same pieces and scores, as far as its ties allow."""
    pytest.importorskip("public_tokenizers")
    import public_tokenizers
    from tokenizers import Tokenizer, models

    scores = tc.zipf_scores(public_tokenizers.path("piece_bpe_32k.model"))
    pieces = tc.Pieces.of(scores)
    model = Tokenizer(models.Unigram([("<unk>", pieces.unknown), *scores.items()], 0, False))
    words = ["▁" + w for w in "the quick brown fox jumps over lazy dogs internationalization ending onnshwhth thble straße être".split()]
    assert tc.trie_counts(words, pieces).tolist() == [len(model.encode(w).ids) for w in words]
