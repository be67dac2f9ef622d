"""Ordinal regression: gradients, ordered thresholds, graded texts and edge cases."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidelake.llm import quality
from tidelake.llm.base import ship


def graded(n, seed, grades=4):
    """The higher the grade, the fewer junk tokens."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = rng.randrange(grades)
        words = [f"w{rng.randrange(400)}" if rng.random() < (g + 1) / (grades + 0.5) else rng.choice(["###", "$$$x", "BUY!!"]) for _ in range(rng.randrange(30, 90))]
        rows.append((i, " ".join(words), g))
    return rows


def test_shape():
    assert [quality.shape(x) for x in ("Hello,", "ABC12x", "it's", "a|b", "É1", "x" * 99)] == ["Aa,", "A0a", "a'a", "a|a", "A0", "a"]
    assert quality.shape("a|b|c|d|e|f") != quality.shape("a|b|c|d|e|g|h") and quality.shape("x-" * 40) == "a-" * 40


def test_features_of_any_text():
    codes = quality.Codes()
    for text in (None, b"", b" \n"):
        assert quality.features(text, codes)[1].tolist() == [1.0]
    index, value = quality.features(b"a a b C!", codes)
    assert len(index) == len(value) and abs((value**2).sum() - 2.75) < 1e-9 and index.max() < quality.SIZE


def test_thresholds_stay_ordered_and_loss_falls():
    rng = np.random.default_rng(0)
    n, true = 400, rng.normal(size=50)
    index = np.tile(np.arange(50), n)
    value = rng.normal(size=n * 50) * 0.3
    row = np.repeat(np.arange(n), 50)
    score = np.bincount(row, weights=true[index] * value)
    grade = np.searchsorted([-1.0, 0.0, 1.5], score + rng.logistic(size=n) * 0.2)
    w, t = quality.descend(np.zeros(quality.SIZE), np.array([-0.1, 0.0, 0.1]), [(index, value, row, grade)], 0.3, 0.0, 60)
    assert (np.diff(t) > 0).all()
    assert np.corrcoef(w[:50], true)[0, 1] > 0.9


@pytest.fixture(scope="module")
def model(spark):
    ship(spark)
    rows = graded(700, 0)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "x"), (3, rows[3][1])], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, g, "t") for i, _, g in rows] + [(None, 1, ""), (4, None, ""), (9999, 2, "")], "doc_id long, quality int, text string")
    return quality.fit(docs, ratings)


def test_graded_texts(spark, model):
    assert model.grades.tolist() == [0, 1, 2, 3] and (np.diff(model.thresholds) > 0).all()
    rows = graded(200, 1)
    out = {r.doc_id: r for r in quality.grade(spark.createDataFrame(rows, "doc_id long, text string, truth int"), model).collect()}
    truth, expected = np.array([g for _, _, g in rows]), np.array([out[i].expected_grade for i, _, _ in rows])
    assert np.corrcoef(truth, expected)[0, 1] > 0.8
    assert expected.min() >= 0 and expected.max() <= 3
    assert np.mean([abs(out[i].grade - g) <= 1 for i, _, g in rows]) > 0.9
    tail = np.array([out[i].tail_probability for i, _, _ in rows])
    assert tail[truth == 3].mean() > tail[truth < 3].mean() + 0.3


def test_tails(spark, model):
    rows = spark.createDataFrame(graded(20, 2), "doc_id long, text string, truth int")
    got = [quality.grade(rows, model, least=g).orderBy("doc_id").collect() for g in (0, 1, 2, 3)]
    for a, b in zip(got, got[1:]):
        assert all(x.tail_probability >= y.tail_probability for x, y in zip(a, b))
    assert {r.tail_probability for r in got[0]} == {1.0}


def test_edges(spark, model):
    rows = [(1, None, "c"), (2, "", "c"), (None, "w1 w2", "c"), (4, "w3 " * 50_000, "c"), (4, "w3 " * 50_000, "c")]
    out = quality.grade(spark.createDataFrame(rows, "doc_id long, text string, grade string"), model).collect()
    assert len(out) == 5 and len({r.expected_grade for r in out if not r.text}) == 1
    assert quality.grade(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_one_grade_or_none(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    for ratings, answer in (([(1, 2)], 2), ([], 0)):
        fitted = quality.fit(docs, spark.createDataFrame(ratings, "doc_id long, quality int"))
        assert {(r.grade, r.expected_grade) for r in quality.grade(docs, fitted).collect()} == {(answer, float(answer))}


# ---- a plain cumulative-link model ----------------------------------------------------------------------------------


def sigmoid(x):
    return 1 / (1 + math.exp(-max(min(x, 700), -700)))


def plain_loss(weights, thresholds, rows):
    """Mean negative log likelihood of (features, grade position), term by term."""
    total = 0.0
    for features, g in rows:
        score = sum(weights[i] * v for i, v in features)
        upper = 1.0 if g == len(thresholds) else sigmoid(thresholds[g] - score)
        lower = 0.0 if g == 0 else sigmoid(thresholds[g - 1] - score)
        total -= math.log(max(upper - lower, 1e-300))
    return total / len(rows)


def small_problem(n=90, dims=5, seed=0):
    rng = np.random.default_rng(seed)
    true = rng.normal(size=dims)
    rows = []
    for _ in range(n):
        x = rng.normal(size=dims)
        grade = int(np.searchsorted([-0.7, 0.9], x @ true + rng.logistic()))
        rows.append((list(enumerate(x.tolist())), grade))
    return rows


def as_batch(rows):
    index = np.array([i for f, _ in rows for i, _ in f])
    value = np.array([v for f, _ in rows for _, v in f])
    return index, value, np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows]), np.array([g for _, g in rows])


def test_tails_and_expected_grade_against_the_definition():
    model = quality.OrdinalModel(np.zeros(quality.SIZE), np.array([-1.0, 0.5, 2.0]), np.array([1, 2, 4, 7]))
    scores = np.array([-3.0, 0.0, 0.7, 5.0])
    for score, tail, expected in zip(scores, model.tails(scores), model.expected(scores)):
        p = [1.0] + [1 - sigmoid(t - score) for t in (-1.0, 0.5, 2.0)] + [0.0]
        assert np.allclose(tail, p[1:-1])
        assert math.isclose(expected, sum(g * (p[i] - p[i + 1]) for i, g in enumerate((1, 2, 4, 7))), rel_tol=1e-9)


def test_a_step_follows_the_gradient_of_the_plain_loss():
    rows = small_problem()
    weights, thresholds = np.zeros(quality.SIZE), np.array([-0.4, 0.6])
    weights[:5] = [0.3, -0.2, 0.1, 0.0, 0.5]
    moved, shifted = quality.descend(weights, thresholds, [as_batch(rows)], rate=1e-3, decay=0.0, epochs=1)

    def numeric(change):
        return (plain_loss(*change(1e-5), rows) - plain_loss(*change(-1e-5), rows)) / 2e-5

    for i in range(5):
        g = numeric(lambda e, i=i: (np.where(np.arange(quality.SIZE) == i, weights + e, weights), thresholds))
        assert math.isclose(weights[i] - moved[i], 1e-3 * g / math.sqrt(1e-4 + g * g), rel_tol=1e-3, abs_tol=1e-9)
    for k in range(2):
        g = numeric(lambda e, k=k: (weights, np.where(np.arange(2) == k, thresholds + e, thresholds)))
        assert math.isclose(thresholds[k] - shifted[k], 1e-3 * g / math.sqrt(1e-2 + g * g), rel_tol=1e-3, abs_tol=1e-9)


def test_descent_reaches_a_plain_optimum():
    rows = small_problem(150)
    index, value, row, grade = as_batch(rows)
    x = np.zeros((len(rows), 5))
    x[row, index] = value
    point = np.array([0.0] * 5 + [-0.5, 0.5])

    def gradient(p):
        out = np.zeros(7)
        for i in range(7):
            for sign in (1, -1):
                q = p.copy()
                q[i] += sign * 1e-5
                out[i] += sign * plain_loss(q[:5], q[5:], rows) / 2e-5
        return out

    for _ in range(150):
        point -= 1.0 * gradient(point)
    best = plain_loss(point[:5], point[5:], rows)
    weights, thresholds = quality.descend(np.zeros(quality.SIZE), np.array([-0.5, 0.5]), [(index, value, row, grade)], rate=0.1, decay=0.0, epochs=400)
    assert plain_loss(weights[:5], thresholds, rows) < best + 0.01
    assert np.allclose(weights[:5], point[:5], atol=0.15) and np.allclose(thresholds, point[5:], atol=0.15)


def test_any_key_type_and_names_in_any_case(spark):
    ship(spark)
    rows = [(f"k{i}", t, g) for i, t, g in graded(200, 3, 3)]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t, _ in rows], "doc_id string, text string, Grade int, _bytes int")
    model = quality.fit(docs, spark.createDataFrame([(k, g) for k, _, g in rows], "doc_id string, quality int"))
    out = quality.grade(docs, model)
    assert out.columns == ["doc_id", "text", "_bytes", "expected_grade", "tail_probability", "grade", "accepted"] and out.count() == 200


def test_every_rating_is_learned_from(spark, monkeypatch):
    """Parts become more with the ratings; none is left out."""
    ship(spark)
    seen = {}

    def recorded(df, label="settled"):
        seen[label] = settle(df, label)
        return seen[label]

    settle = quality.settle
    monkeypatch.setattr(quality, "settle", recorded)
    docs = spark.createDataFrame([(i, "good words here" if i % 3 else "BAD !!! 000") for i in range(700)], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(700)], "doc_id long, quality int")
    model = quality.fit(docs, ratings, part_rows=100)
    assert seen["features"].count() == 700 and seen["features"].select("part").distinct().count() == 7
    wrong = quality.grade(docs, model).join(ratings, "doc_id").where("grade <> quality")
    assert wrong.count() == 0


def test_the_plan_does_not_turn_with_the_ratings_and_texts_stay_where_they_are(spark, tmp_path, monkeypatch):
    """Joins below and above the broadcast threshold are the same; features are shuffled for the join and once to their parts, no text is."""
    import contextlib
    import io

    ship(spark)
    plans = []
    settle = quality.settle

    def recorded(df, label="settled"):
        with contextlib.redirect_stdout(out := io.StringIO()):
            df.explain()
        plans.append((label, out.getvalue()))
        return settle(df, label)

    monkeypatch.setattr(quality, "settle", recorded)
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t) for i, t, _ in graded(300, 5)], "doc_id long, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    ratings = spark.createDataFrame([(i, i % 2) for i in range(0, 300, 3)], "doc_id long, quality int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    models = []
    try:
        for threshold in ("10m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            models.append(quality.fit(docs, ratings))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [plan for label, plan in plans if label == "features"]
    assert len(joins) == 2 and all("SortMergeJoin" in p and "Broadcast" not in p for p in joins)
    for plan in joins:  # from the top: the join, the exchange of what it gets, and below it texts made features
        assert plan.index("SortMergeJoin") < plan.index("Exchange") < plan.index("MapInArrow") < plan.index("FileScan parquet [doc_id")
    assert [label for label, _ in plans].count("parts") == 2
    assert np.allclose(models[0].weights, models[1].weights)


def test_tasks_without_ratings_send_no_weights(spark, monkeypatch):
    """However many tasks there are, the driver gets a sum from a few of them."""
    ship(spark)
    got = []

    def recorded(self):
        rows = collect(self)
        if "weights" in self.columns:
            got.append(len(rows))
        return rows

    docs = spark.createDataFrame([(i, t) for i, t, _ in graded(300, 6)], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, g) for i, _, g in graded(300, 6)], "doc_id long, quality int")
    collect = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", recorded)
    monkeypatch.setattr(quality, "MERGERS", 2)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        quality.fit(docs, ratings, part_rows=10)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 4 and max(got) <= 2


def test_packed_parts_hold_what_was_learned_from_rows():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n = rng.integers(1, 9, 300)
    rows = [(i, int(rng.integers(0, 2)), rng.integers(0, 99, k).astype(np.int32), rng.random(k).astype(np.float32), 5) for i, k in enumerate(n)]
    names = ["key", "grade", "index", "value", "part"]
    table = pa.table([pa.array([r[i] for r in rows], pa.int32() if i in (1, 4) else None) for i in range(5)], names)
    packed = quality.pack(pa.concat_tables([table.slice(170), table.slice(0, 170)]))
    batches = quality.unpack(packed.to_batches()[0], 0, np.array([0, 1]))
    order = np.random.default_rng(0).permutation(300)
    assert [len(b[3]) for b in batches] == [128, 128, 44] and packed["part"].to_pylist() == [5]
    for i, (index, value, row, place) in enumerate(batches):
        own = [rows[j] for j in order[128 * i : 128 * (i + 1)]]
        assert index.tolist() == [x for r in own for x in r[2]] and place.tolist() == [r[1] for r in own]
        assert value.tolist() == [float(x) for r in own for x in r[3]] and row.tolist() == [j for j, r in enumerate(own) for _ in r[2]]


def test_keys_of_two_types_and_beyond_the_filter(spark):
    """Equal keys that hash differently still meet; keys that share a filter bit with a rated one are left out by the join."""
    ship(spark)
    rows = graded(200, 8, 2)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id int, text string")
    wide = spark.createDataFrame([(i, g) for i, _, g in rows[:80]], "doc_id long, quality int")
    narrow = wide.withColumn("doc_id", wide["doc_id"].cast("int"))
    a, b = quality.fit(docs, wide), quality.fit(docs, narrow)
    assert np.abs(a.weights).max() > 0 and np.allclose(a.weights, b.weights) and np.allclose(a.thresholds, b.thresholds)


def test_the_pipeline_sends_the_driver_weights_of_few_tasks(spark, tmp_path, monkeypatch):
    """As on many partitions that are not coalesced: it was a row of weights for each, empty ones too."""
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    rows = graded(300, 9, 2)
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], "doc_id long, text string, source string")
    spark.createDataFrame([(i, g, 0) for i, _, g in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = []
    collect = type(docs).collect

    def recorded(self):
        found = collect(self)
        if "weights" in self.columns:
            got.append(len(found))
        return found

    monkeypatch.setattr(type(docs), "collect", recorded)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        kept = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, str(tmp_path)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 4 and max(got) <= 8
    assert np.mean([(i in kept) == (g == 1) for i, _, g in rows]) > 0.8
