"""Packing: whole documents, gapless sequences, and how few there are."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tidelake.llm import base, packing
from tidelake.llm.base import settle, ship
from tidelake.llm.queries import encoder

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

ODD = [
    "", " ", "  ", "a  b", "a   b   ", "a \n b", "\n\n x \n", "a\t b  c", "it's  IT'S 's", "x" * 500, "日本語 テスト 文字", "naïve Ünï çà", "🙂 🙂🙂  a", "١٢٣ 45",
    "<|endoftext|> and <|endoftext|>", "a\x1c b\x1f c", "l'été  d’or", "ſ ǅ ɏ ɐ Ω", "é é", "   x ", "\r\n \r\n", "a " * 300, "tab\tend ", "​ x", "...!!! ??",
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizer(plain):
    own = encoder()
    rng = random.Random(0)
    parts = ["a", "B", " ", "  ", "\n", "\t", "'s", "é", "漢", "1", ".", "word", " ", "🙂", "ɐ", "\x85", "ß"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    for text in [*ODD, *made]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_best_fit_takes_the_fullest_bin_with_room():
    bins, offset = packing.best_fit(np.array([7, 6, 3, 2, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 7, 6, 8]
    rng = np.random.default_rng(1)
    for _ in range(20):
        size = rng.integers(1, 65, 300)
        bins, offset = packing.best_fit(size, 64)
        for b in set(bins.tolist()):
            own = sorted(zip(offset[bins == b].tolist(), size[bins == b].tolist()))
            assert [o for o, _ in own] == np.cumsum([0] + [s for _, s in own])[:-1].tolist()
            assert sum(s for _, s in own) <= 64


def check(rows, docs, plain, capacity):
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist()
        assert sum(n for _, n in own) <= capacity
    want = []
    for key, text in docs:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        cuts = [(0, first), *((a, a + capacity) for a in range(first, len(ids), capacity))]
        want += [(key, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(cuts)]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return len(sequences)


def test_pack_documents(spark, plain):
    ship(spark)
    rng = random.Random(2)
    docs = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "word " * rng.randrange(0, 90)) for i in range(300)] + [(7, "again"), (7, "again"), (None, None), (None, "x y")]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, piece string").repartition(6)
    for capacity in (16, 64):
        rows = packing.pack_documents(df, encoder, "test", capacity).collect()
        n = check(rows, docs, plain, capacity)
        assert n <= -(-sum(r.length for r in rows) // capacity) * 1.02 + 2
    assert packing.pack_documents(df.limit(0), encoder, "test", 16).collect() == []


def test_rounds_merge_what_partitions_leave(spark, monkeypatch):
    """Forty partitions that each leave a third of a bin come out as few sequences as one partition would need."""
    monkeypatch.setattr(packing, "CHUNK", 64)
    ship(spark)
    items = spark.createDataFrame([(i, 20 + i % 3) for i in range(40)], "item long, length long").repartition(40)
    rows = packing.pack(items, "item", "length", 64).collect()
    assert len(rows) == 40 and len({r.sequence_id for r in rows}) <= 14


def test_one_size_for_a_third_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 700)
    ship(spark)
    rng = random.Random(3)
    size = [40 if i % 3 == 0 else rng.randrange(1, 100) for i in range(2000)]
    rows = packing.pack(spark.createDataFrame(list(enumerate(size)), "item long, length long"), "item", "length", 100).collect()
    assert sorted(r.item for r in rows) == list(range(2000))
    whole, _ = packing.best_fit(np.array(size), 100)
    assert len({r.sequence_id for r in rows}) <= (whole.max() + 1) * 1.02 + 1


def test_ids_leave_the_workers_only_if_asked_for(spark, monkeypatch):
    ship(spark)
    docs = spark.createDataFrame([(1, "a b", 7), (2, None, 8)], "doc_id long, text string, IDS int")
    written = []
    monkeypatch.setattr(packing, "settle", lambda df, name: (written.append(df._jdf.queryExecution().analyzed().toString()), settle(df, name))[1])
    for with_ids in (False, True):
        written.clear()
        out = packing.pack_documents(docs, encoder, "byte_bpe_50k", 16, with_ids=with_ids)
        assert ("ids" in out.columns) == with_ids and "IDS" not in out.columns and out.count() == 2
        assert any("MapInArrow" in plan and "ids#" in plan for plan in written[:1]) == with_ids


def test_what_an_earlier_value_held_is_given_back(monkeypatch):
    given_back = []

    class Pool:
        def release_unused(self):
            given_back.append(dict(base._PROCESS))

    monkeypatch.setattr(base, "_PROCESS", {"earlier": 1})
    monkeypatch.setattr(base.pa, "default_memory_pool", Pool)
    assert [base.process_value("later", lambda: 2), base.process_value("later", lambda: 3)] == [2, 2]
    assert given_back == [{}] and base._PROCESS == {"later": 2}
