"""Every operator over tables whose extra columns are called as its helpers or results, in other cases, with text and null keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidelake.llm import alignment, decontaminate, langid, packing, quality, sharding, simhash, token_counts, topk, toxicity, url_filter, warc, whitening
from tidelake.llm.base import ship
from tidelake.llm.queries import encoder, tokenizer_pair

# Names of helper and result columns of the operators, in a case of their own.
NAMES = [
    "Score", "Predicted", "EVIDENCE", "_Text", "_bytes", "_Key", "Kept", "Row", "row_", "_hash", "_Bucket", "_row", "_n", "Shard", "SLOT", "V", "x", "asks", "Id", "N_words", "Spans",
    "Grade", "Accepted", "Lang_pred", "Margin", "Simhash", "Text_hash", "Component_id", "Piece", "Start", "IDS", "Sequence_Id", "Offset", "Item", "N_Tokens", "Host", "path_", "Batch", "w",
    "Payload_", "_First", "with space",
]
KEYS = ["k1", None, "k3", "k3"]
TEXTS = ["some plain words here and there", "other words", "", None]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    base = spark.createDataFrame(list(zip(KEYS, TEXTS, ["aa", "bb", "aa", "bb"])), "doc_id string, text string, lang string")
    return base.select("*", *[F.lit(i).alias(name) for i, name in enumerate(NAMES)])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([("k1", 1, 0), ("k3", 0, 1), (None, 1, 1)], "doc_id string, toxic int, quality int")


def shards(spark, docs, labels):
    return sharding.with_slots(sharding.rendezvous_shards(docs, "doc_id", 3, 4), ["doc_id", "text"])


def toxic(spark, docs, labels):
    return toxicity.score(docs, toxicity.fit(docs, labels))


def grades(spark, docs, labels):
    return quality.grade(docs, quality.fit(docs, labels))


def languages(spark, docs, labels):
    return langid.predict(docs, langid.fit(docs))


def languages_in_tables(spark, docs, labels):
    return langid.predict(docs, langid.fit(docs, max_grams=2), core_windows=5)


def benchmark(spark, docs, labels):
    items = spark.createDataFrame([("i1", "plain words here", 1), (None, "x", 2), ("i2", None, 3)], "item_id string, text string, Hash int")
    return decontaminate.contamination(docs, items)


def cleaned(spark, docs, labels):
    return decontaminate.without_contaminated(docs, spark.createDataFrame([("i1", "nothing of this occurs", 1)], "item_id string, text string, b int"))


def near(spark, docs, labels):
    return simhash.near_duplicates(docs)


def one_each(spark, docs, labels):
    return simhash.keep_one(docs)


def records(spark, docs, labels):
    return warc.with_revisits(docs, "doc_id", F.col("text").cast("binary"))


def packed(spark, docs, labels):
    return packing.pack_documents(docs, encoder, "byte_bpe_50k", 16, with_ids=True)


def counted(spark, docs, labels):
    return token_counts.count_tokens(docs, {"▁some": -1.0, "▁": -2.0})


def judged(spark, docs, labels):
    pages = docs.withColumn("url", F.concat(F.lit("http://a.net/"), F.coalesce("doc_id", F.lit("es/"))))
    rules = spark.createDataFrame([("net", "/es/", "block", 1)], "host string, path string, verdict string, Rule int")
    return url_filter.judge(pages, rules, html="text")


def aligned(spark, docs, labels):
    return alignment.align(docs, tokenizer_pair, "byte_bpe_50k-piece_bpe_32k")


OPERATORS = [shards, toxic, grades, languages, languages_in_tables, benchmark, cleaned, near, one_each, records, packed, counted, judged, aligned]


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_clashing_names_and_any_keys(spark, docs, labels, operator):
    out = operator(spark, docs, labels)
    rows = out.collect()
    names = [c.lower() for c in out.columns]
    assert len(names) == len(set(names))
    expected = {"one_each": None, "packed": None}.get(operator.__name__, 4)
    assert expected is None or len(rows) == expected
    # What is not replaced is as it was.
    for i, name in enumerate(NAMES):
        if name in out.columns:
            assert {r[name] for r in rows} == {i}


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_empty_tables(spark, docs, labels, operator):
    assert operator(spark, docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("id_name", ["v", "id", "x", "Asks", "q", "g"])
def test_vector_operators(spark, id_name):
    ship(spark)
    frame = spark.createDataFrame([(i, [float(i % 3), 1.0 * i], 7, 8) for i in range(6)], f"{id_name} long, vec array<float>, _blocks int, N int")
    got = topk.inner_product_topk(frame, id_name, "vec", F.col(id_name) % 2 == 0, 3).collect()
    assert len(got) == 9 and {r.query_id for r in got} == {0, 2, 4}
    white = whitening.whiten(frame, "vec", 2)
    assert id_name in white.columns and white.count() == 12
