"""The registered queries against their SQL, and the pipeline's stages against what each promises of its own input."""

from __future__ import annotations

import os

import pytest

duckdb = pytest.importorskip("duckdb")
pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from test_decontaminate import brute  # noqa: E402
from test_simhash import plain_components, plain_fingerprint  # noqa: E402
from tidelake.llm import queries  # noqa: E402
from tidelake.llm.base import settle, ship  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_query_against_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = db.execute(queries.oracles()[name])
    columns = [d[0] for d in result.description]
    frame = queries.QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(columns)
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    assert got == sorted(result.fetchall(), key=repr)


@pytest.mark.parametrize("name", ["op2_toxicity", "op4_ordinal_quality", "op5_language_id", "op10_token_counts"])
def test_query_returns_every_document(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    assert frame.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_near_duplicates_of_the_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    roots = plain_components(prints, 3)
    least: dict[int, int] = {}
    for r, root in zip(rows, roots):
        least[root] = min(r.doc_id, least.get(root, r.doc_id))
    want = sorted((r.doc_id, f"{p:016x}", least[root]) for r, p, root in zip(rows, prints, roots))
    assert sorted(tuple(r) for r in queries.QUERIES["op7_simhash"](spark, SF).collect()) == want


def test_stages(spark):
    """Every stage on its own input, and run() as their succession."""
    ship(spark)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_001, None, None, None, None), (10_002, "12 ...", "en", "s", 6), (3, "3 4 5", None, "s", 5)], docs.schema)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    inputs = [settle(docs.union(extra))]
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(settle(stage(spark, inputs[-1], SF), name))
    tables = [[tuple(r) for r in t.collect()] for t in inputs]
    assert all(t.columns == docs.columns for t in inputs[:-1])
    for before, after in zip(tables[:-2], tables[1:-1]):
        assert len(set(after) - set(before)) == 0

    assert set(tables[0]) - set(tables[1]) == {tuple(r) for r in extra.collect()}
    gone = set(tables[1]) - set(tables[2])
    good = [r for r in tables[1] if labels.get(r[0]) == 1]
    assert sum(r in gone for r in good) <= 0.02 * len(good)
    assert sum(labels.get(r[0]) == 0 for r in gone) >= 0.5 * sum(labels.get(r[0]) == 0 for r in tables[1])

    prints = [plain_fingerprint(r[1]) for r in tables[2]]
    least: dict[int, int] = {}
    roots = plain_components(prints, 3)
    for r, root in zip(tables[2], roots):
        least[root] = min(r[0], least.get(root, r[0]))
    assert sorted(r[0] for r in tables[3]) == sorted(least.values())

    found = brute([r[1] for r in tables[3]], [(r.item_id, r.text) for r in items])
    clean = [r for r, (n, hit, _, _) in zip(tables[3], found) if not (hit and 20 * hit >= n)]
    assert sorted(tables[4]) == sorted(clean)

    packed = inputs[-1].collect()
    assert {r.doc_id for r in packed} == {r[0] for r in tables[4]}
    total = sum(r.length for r in packed)
    assert len({r.sequence_id for r in packed}) <= -(-total // queries.CAPACITY) * 1.03 + 1
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("stage", [corpus_pipeline.language_id, corpus_pipeline.quality_classifier])
def test_stages_keep_columns_named_as_those_of_the_models(spark, stage):
    own = {"score": "7.0", "accepted": "'no'", "Margin": "'m'", "n_letters": "-1", "lang_pred": "'xx'", "cross_entropy": "doc_id", "grade": "'A'", "expected_grade": "0", "tail_probability": "null"}
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", *[f"{v} AS {c}" for c, v in own.items()])
    got = stage(spark, docs, SF)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    rows = got.collect()
    assert rows and {tuple(r) for r in rows} <= {tuple(r) for r in docs.collect()}
