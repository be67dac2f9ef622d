"""Character models: probabilities against a plain implementation, languages on held-out texts."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidelake.llm import langid
from tidelake.llm.base import ship

SYLLABLES = {"aa": ["ka", "to", "mi", "re"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["eux", "oi", "que", "tion"]}


def sentence(lang, rng, n=12):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def plain_model(words):
    """Interpolated Kneser-Ney of one language by dictionaries."""
    order = langid.ORDER
    counts = {order: Counter()}
    for word, n in words.items():
        text = "\x02" * (order - 1) + word + "\x03"
        for i in range(len(text) - order + 1):
            counts[order][text[i : i + order]] += n
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    total, types, discount = {}, {}, {}
    for k, table in counts.items():
        total[k], types[k] = defaultdict(int), defaultdict(int)
        for g, n in table.items():
            total[k][g[:-1]] += n
            types[k][g[:-1]] += 1
        n1, n2 = sum(n == 1 for n in table.values()), sum(n == 2 for n in table.values())
        discount[k] = min(max(n1 / (n1 + 2 * n2) if n1 + n2 else 0.5, 0.1), 0.95)
    uniform = 1 / (len(counts[1]) + 1)

    def p(gram):
        k = len(gram)
        if k == 0:
            return uniform
        lower = p(gram[1:]) if k > 1 else uniform
        held = total[k][gram[:-1]]
        if not held:
            return lower
        return max(counts[k][gram] - discount[k], 0) / held + discount[k] * types[k][gram[:-1]] / held * lower

    return p


def grams_of(words):
    grams, word = langid.windows(list(words))
    n = np.array(list(words.values()), float)[word]
    _, first, index = np.unique(langid.gram_hash(grams), return_index=True, return_inverse=True)
    return grams[first], np.bincount(index, weights=n)


def test_probabilities_are_kneser_ney():
    words = Counter({"abra": 3, "kadabra": 2, "bra": 1, "cab": 5, "ü": 1})
    grams, n = grams_of(words)
    levels, floor = langid.build_levels(grams, np.zeros(len(grams), int), n, 1)
    model = langid.LanguageModel(["x"], levels, floor)
    p = plain_model(words)
    asked, _ = langid.windows(["abra", "cadab", "zz", "üa", "b"])
    want = [math.log(p("".join(map(chr, g)))) for g in asked]
    assert np.allclose(model.logp(asked)[:, 0], want, atol=1e-5)


def test_probabilities_sum_to_one():
    grams, n = grams_of(Counter({"abra": 3, "cab": 2}))
    levels, floor = langid.build_levels(grams, np.zeros(len(grams), int), n, 1)
    model = langid.LanguageModel(["x"], levels, floor)
    alphabet = [*sorted({c for g in grams for c in g[-1:].tolist()}), 0x7A]
    for context in ("\x02\x02\x02\x02", "\x02abr", "zzzz"):
        rows = np.array([[*map(ord, context), c] for c in alphabet], "<u4")
        assert abs(np.exp(model.logp(rows)[:, 0]).sum() - 1) < 1e-5


def test_pieces():
    assert langid.pieces("Ab1c-É") == ["ab", "c", "é"]
    assert langid.pieces("12 ²½_") == []
    assert [len(x) for x in langid.pieces("a" * 50)] == [24, 24, 2]


@pytest.fixture(scope="module")
def corpus(spark):
    ship(spark)
    rng = random.Random(0)
    rows = [(i, sentence(lang := ["aa", "bb", "cc"][min(i % 5, 2)], rng, rng.randrange(3, 40)), lang) for i in range(400)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "words without language", None), (1003, "1 2 3 ...", "aa")] + [(5, rows[5][1], rows[5][2])] * 100
    return rows


def test_held_out_accuracy_and_edges(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string")
    model = langid.fit(df)
    rng = random.Random(1)
    asked = [(i, sentence(lang, rng, 8), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    asked += [(500, None, ""), (501, "", ""), (502, "12 ... ²", ""), (503, "kato " * 30_000, "aa"), (504, "漢字かな交じり文" * 50, ""), (505, "KATO-MIRE, rekato!", "aa")]
    out = {r.doc_id: r for r in langid.predict(spark.createDataFrame(asked, "doc_id long, text string, score string"), model).collect()}
    assert len(out) == len(asked)
    assert all(out[i].lang_pred == lang and out[i].accepted for i, _, lang in asked if lang)
    for i in (500, 501, 502):
        assert (out[i].lang_pred, out[i].score, out[i].accepted) == ("und", 0.0, False)
    assert not out[504].accepted and out[504].lang_pred in ("aa", "bb", "cc")
    assert all(0 <= r.score <= 1 for r in out.values())


def test_counts_cover_all_rows(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string").repartition(5)
    got = {(r.lang, np.frombuffer(r.gram, "<u4").tobytes()): r.n for r in langid.count_grams(df, "text", "lang").collect()}
    want: Counter = Counter()
    for _, text, lang in corpus:
        if text and lang:
            for token in text.split():
                for piece in langid.pieces(token):
                    for g in langid.windows([piece])[0]:
                        want[lang, np.ascontiguousarray(g).tobytes()] += 1
    assert got == dict(want)


def test_nothing_to_learn_from_and_one_language(spark):
    ship(spark)
    none = spark.createDataFrame([(1, None, "aa"), (2, "text", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.predict(none, langid.fit(none)).collect()} == {"und"}
    one = spark.createDataFrame([(1, "kato mire", "aa"), (2, None, None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in sorted(langid.predict(one, langid.fit(one)).collect())] == ["aa", "und"]
    assert langid.predict(one.limit(0), langid.fit(one)).collect() == []


def test_many_batches_and_full_word_tables(spark, corpus, monkeypatch):
    ship(spark)
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string").coalesce(1)
    model = langid.fit(df)
    want = sorted((r.doc_id, r.lang_pred, round(r.cross_entropy, 9)) for r in langid.predict(df, model).collect())
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        got = sorted((r.doc_id, r.lang_pred, round(r.cross_entropy, 9)) for r in langid.predict(df, model).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    assert got == want
    monkeypatch.setattr(langid.WordScores, "BOUND", 40)
    table = langid.WordScores(len(model.languages) + 1)
    for _, text, _ in corpus[:200]:
        words = (text or "").split()
        table.add(set(words), model)
        total, count = model.word_scores(words)
        assert np.allclose(table.sums(words), [*total.sum(axis=0), count.sum()] if words else 0)


@pytest.mark.parametrize("core", [0, 60, 10**6])
def test_no_gram_is_left_out_beyond_the_bound(spark, corpus, core):
    """A model in tables answers as the one that is sent to the workers, whatever share of the windows is sent out."""
    ship(spark)
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string")
    whole, tables = langid.fit(df), langid.fit(df, max_grams=20)
    assert whole.tables is None and tables.tables is not None
    asked = df.select("doc_id", "lang", "text").union(
        spark.createDataFrame([(504, "aa", "漢字かな交じり文" * 50), (505, None, "KATO-MIRE, rekato! schung " + "x" * 50)], "doc_id long, lang string, text string")
    )
    got, want = (
        sorted((r.doc_id, r.text or "", r.lang or "", r.lang_pred, r.accepted, r.n_letters, r.cross_entropy, r.margin, r.score) for r in langid.predict(asked, m, core_windows=core).collect())
        for m in (tables, whole)
    )
    assert [r[:6] for r in got] == [r[:6] for r in want]
    assert np.allclose([r[6:] for r in got], [r[6:] for r in want], atol=1e-5)


def test_rare_languages_are_calibrated_on_rows_of_their_own(spark):
    """However many rows another language has, and whatever rows share a key."""
    ship(spark)
    rng = random.Random(2)
    rows = [(i, sentence("aa", rng), "aa") for i in range(3000)] + [(None, sentence("cc", rng), "cc") for i in range(30)] + [(None, "1 2", "cc")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, calibration_rows=16)
    own = [r.cross_entropy for r in langid.predict(df.where("lang = 'cc'"), model).collect() if r.lang_pred == "cc"]
    assert len(own) == 30
    assert math.isclose(model.mean[model.languages.index("cc")], np.median(own), rel_tol=1e-9)


def test_no_rejection_by_a_mean_that_was_not_measured(spark):
    ship(spark)
    rng = random.Random(3)
    texts = [sentence("aa", rng) for _ in range(20)]
    model = langid.fit(spark.createDataFrame([(i, t, lang) for i, t in enumerate(texts) for lang in ("aa", "bb")], "doc_id long, text string, lang string"))
    assert not np.isnan(model.mean[0]) and np.isnan(model.mean[1])  # ties go to the first
    far = -model.floor * 100
    accepted = langid._answers(np.array([[2 * far, far, 100.0], [far, 2 * far, 100.0]]), model)[2]
    assert accepted.to_pylist() == [True, False]


def test_calibration_sees_every_row(spark, monkeypatch):
    """The fit over all rows by plain numpy, with more rows than are ever sorted whole; one row is far from the others."""
    ship(spark)
    rng = random.Random(4)
    texts = [(lang := rng.choice(["aa", "bb"]), sentence(lang if rng.random() < 0.9 else "cc", rng, rng.randrange(1, 9))) for _ in range(2500)]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)] + [(7, texts[7][1], texts[7][0])] * 50, "doc_id long, text string, lang string")
    model = langid.fit(df, calibration_rows=64)
    out = langid.predict(df.dropDuplicates(["doc_id"]), model).toPandas()
    excess = np.empty(len(out))
    for i, name in enumerate(model.languages):
        own = (out.lang_pred == name).to_numpy()
        assert math.isclose(model.mean[i], np.median(out.cross_entropy[own]), rel_tol=1e-9)
        excess[own] = langid._excess(out.cross_entropy[own], out.n_letters[own], model.mean[i], -model.floor)
    assert math.isclose(model.cutoff, max(0.5, 1.5 * np.quantile(excess, 0.999)), rel_tol=1e-9)
    x, right = (out.margin * np.sqrt(out.n_letters)).to_numpy(), (out.lang == out.lang_pred).to_numpy()
    y = np.where(right, (right.sum() + 1) / (right.sum() + 2), 1 / ((~right).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w, off = np.maximum(p * (1 - p), 1e-6), p - y
        hessian = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(hessian, [(off * x).sum() + 1e-3 * a, off.sum() + 1e-3 * b]), -2, 2)
        a, b = a - step[0], b - step[1]
    assert np.allclose([model.slope, model.offset], [max(a, 0.05), b], rtol=1e-6)


def test_identify_is_fit_and_predict(spark, corpus):
    ship(spark)
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string")
    learn = langid.F.col("doc_id") % 4 != 2
    columns = ["doc_id", "lang_pred", "accepted", "n_letters", "score", "cross_entropy"]
    for grams in (10**6, 20):
        want = langid.predict(df, langid.fit(df.where(learn), max_grams=grams)).select(columns).toPandas().sort_values(columns).reset_index(drop=True)
        got = langid.identify(df, learn, max_grams=grams, keep=["doc_id"]).select(columns).toPandas().sort_values(columns).reset_index(drop=True)
        assert want[columns[:4]].equals(got[columns[:4]]) and np.allclose(want[columns[4:]], got[columns[4:]], atol=1e-9)


ODD = [
    "Ab1c-É the, The THE. (the)", "ΟΔΟΣ ΟΔΟΣ's ΑΣ.Β Σ", None, "", "  ", "a\u00a0b\u2003C\u3000d", "İstanbul \u212a ǅ", "漢字かな交じり文" * 50, "x" * 60, "\x00a\x1cb\x1fc\x85d", "²½ ªº ﬁ ß ẞ",
    "été, ÉTÉ! l'été", "e\u0301 E\u0301", "12 ... ²",
]


@pytest.mark.parametrize("texts", [ODD, [t for t in ODD if "Σ" not in (t or "")], [b"a\xffb C\xe2(\xa1 \xed\xa0\x80z", b"\xce\xa3 A\xc3", None], [None, ""], []])
def test_words_of_a_batch_have_the_pieces_of_its_texts(texts):
    raw = [t.encode() if isinstance(t, str) else t for t in texts]
    for array, asked in ((pa.array(raw, pa.binary()), raw), (pa.array([b"left out", *raw], pa.binary())[1:], raw)):
        words, number, bounds = langid.split_words(array)
        words = words.to_pylist()
        assert len(bounds) == len(asked) + 1 and len(set(words)) == len(words)
        for value, start, end in zip(asked, bounds, bounds[1:]):
            got = [p for i in number[start:end] for p in langid.pieces(words[i])]
            assert got == [p for token in (value or b"").decode("utf-8", "replace").split() for p in langid.pieces(token)]
        rows = np.arange(2.0 * len(words)).reshape(-1, 2)
        want = [rows[number[start:end]].sum(axis=0) for start, end in zip(bounds, bounds[1:])]
        assert np.allclose(langid.text_sums(rows, number, bounds), np.array(want).reshape(-1, 2))


def test_words_met_often_are_scored_once(spark, monkeypatch):
    """Neither case nor punctuation makes another word, and a full table keeps the words it began with."""
    grams, n = grams_of(Counter({"abra": 3, "cab": 2}))
    levels, floor = langid.build_levels(grams, np.zeros(len(grams), int), n, 1)
    model, asked = langid.LanguageModel(["x"], levels, floor), Counter()
    scores = model.word_scores
    monkeypatch.setattr(model, "word_scores", lambda words: (asked.update(words), scores(words))[1])
    monkeypatch.setattr(langid.WordScores, "BOUND", 60)
    table = langid.WordScores(2)
    often = {"w" * i for i in range(1, 21)}
    table.add(often, model)
    for i in range(20):
        table.add(often | {chr(97 + i) + "z" * (j % 23) + "a" * (j // 23) for j in range(25)}, model)
        assert all(np.allclose(table.sums([w]), [scores([w])[0][0, 0], scores([w])[1][0]]) for w in often)
    assert all(asked[w] == 1 for w in often) and len(table.place) <= 60
    asked.clear()
    words, _, _ = langid.split_words(pa.array([b"Cab, cab! (CAB) abra", b"'abra' Abra-cab."]))
    langid.WordScores(2).of(words.to_pylist(), model)
    assert {w: k for w, k in asked.items() if w} == {"cab": 1, "abra": 1}
