"""Which tokens of two tokenizers cover the same bytes.

Each side is a sparse matrix of tokens by bytes in compressed rows, built by hand: A has a one where a token covers a byte,
and so has B. A row of A·Bᵀ, taken as the sum of those rows of Bᵀ that the token's bytes name, holds the B tokens that
overlap it and by how many bytes. Where tokens of both sides end together the bytes fall into groups; tokens by groups give
two more such matrices, whose product links all tokens of a group.

No token of either side crosses a cut between a visible character and a space before another one, so texts are cut there
and a chunk is tokenised and multiplied once per worker as long as it is remembered. Sums over documents are sums over their chunks.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.base import process_value, settle, text_bytes

CUT = re.compile(r"(?<=[!-~\w])(?= [!-~\w])")
LATIN = re.compile("[\x00-ɏ]*")
#: Terms of a product that are expanded at a time.
EXPANDED = 1 << 22
#: Documents that are held, and ask for their pairs, together.
BATCH = 1000

Rows = tuple[np.ndarray, np.ndarray]  # where each row begins in the column numbers (one more than rows), the column numbers


def transpose(rows: Rows, columns: int) -> Rows:
    """The same matrix with rows and columns exchanged; a row's entries stay in order."""
    start, column = rows
    owner = np.repeat(np.arange(len(start) - 1), np.diff(start))
    return np.concatenate([[0], np.cumsum(np.bincount(column, minlength=columns))]), owner[np.argsort(column, kind="stable")]


def multiply(left: Rows, right: Rows, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The product of two matrices of ones, row by row (Gustavson): (row, column, value) in order, some rows at a time.

    A row's terms are the rows of ``right`` that its columns name. Rows are taken together while they have few terms in all;
    ``width`` is the number of columns of ``right``.
    """
    terms = np.diff(right[0])[left[1]]
    before = np.concatenate([[0], np.cumsum(terms)])
    upto = before[left[0]]
    at, n = 0, len(left[0]) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + EXPANDED, "right")) - 1)
        first, last = left[0][at], left[0][end]
        size = terms[first:last]
        row = np.repeat(np.repeat(np.arange(at, end), np.diff(left[0][at : end + 1])), size)
        place = np.arange(size.sum()) - np.repeat(before[first:last] - before[first], size) + np.repeat(right[0][left[1][first:last]], size)
        key = row * width + right[1][place]
        if len(key) > 1 and (key[1:] < key[:-1]).any():
            key.sort()
        new = np.flatnonzero(np.diff(key, prepend=-1))
        yield key[new] // width, key[new] % width, np.diff(np.append(new, len(key)))
        at = end


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: its own if visible, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class TokenizerPair:
    """A: a byte-level tokenizer file; B: a piece model that puts a space before the text. Special tokens are plain text.

    ``ranks`` and ``pattern``, the rank file of A's vocabulary, are used for Latin text where given, as they are faster.
    """

    def __init__(self, byte_level: str, pieces: str, ranks: str | None = None, pattern: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b, self.fast = Tokenizer.from_file(byte_level), sentencepiece.SentencePieceProcessor(model_file=pieces), None
        self.a.encode_special_tokens = True
        with open(byte_level, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * (self.a.get_vocab_size() + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(alphabet.get, token)) if all(c in alphabet for c in token) else token.encode()
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.vocab_size()))
        ]
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides for chunks that begin with a space; B sees them without it and adds it again."""
        if self.fast is None:
            a = [e.ids for e in self.a.encode_batch(chunks, add_special_tokens=False)]
        else:
            a = [self.fast.encode_ordinary(c) if LATIN.fullmatch(c) else self.a.encode(c, add_special_tokens=False).ids for c in chunks]
        return a, self.b.encode([c[1:] for c in chunks], num_threads=1)


class Aligned:
    """Links and groups of chunks, all at once: the chunks' bytes stand one after the other, and no group spans two."""

    def __init__(self, pair: TokenizerPair, chunks: list[str]):
        a, b = pair.encode(chunks)
        #: Chunks whose tokens spell them on both sides; the others are left without tokens.
        self.fit = np.array([
            b"".join([pair.a_bytes[i] for i in x]) == (raw := c.encode("utf-8", "surrogatepass")) == b"".join([pair.b_bytes[i] for i in y])
            for c, x, y in zip(chunks, a, b)
        ], bool)
        a, b = ([ids if ok else [] for ids, ok in zip(side, self.fit)] for side in (a, b))
        self.a_start, self.b_start = (np.concatenate([[0], np.cumsum([len(x) for x in side])]).astype(np.int64) for side in (a, b))
        self.a, self.b = (np.array([i for ids in side for i in ids], np.int64) for side in (a, b))
        a_end, b_end = (np.cumsum([len(table[i]) for i in ids], dtype=np.int64) for table, ids in ((pair.a_bytes, self.a.tolist()), (pair.b_bytes, self.b.tolist())))
        size = int(a_end[-1]) if len(a_end) else 0
        by_byte_a, by_byte_b = ((np.concatenate([[0], end]), np.arange(size)) for end in (a_end, b_end))
        found = list(multiply(by_byte_a, transpose(by_byte_b, size), max(len(self.b), 1)))
        #: Overlap links: places among all A and all B tokens, and the number of bytes shared.
        self.link_a, self.link_b, self.shared = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
        self.link_start = np.searchsorted(self.link_a, self.a_start)
        #: Tokens by groups.
        ends = np.intersect1d(a_end, b_end)
        self.group_a, self.group_b = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        self.groups = len(ends)
        self.group_start = np.append(self.group_a, self.groups)[self.a_start]

    def _by_group(self) -> tuple[Rows, Rows]:
        return tuple(transpose((np.arange(len(g) + 1), g), self.groups) for g in (self.group_a, self.group_b))

    def group_links(self) -> np.ndarray:
        """Links between tokens of the same group, counted per chunk."""
        by_token = (np.arange(len(self.group_a) + 1), self.group_a)
        count = np.zeros(len(self.a) + 1, np.int64)
        for row, _, _ in multiply(by_token, self._by_group()[1], max(len(self.b), 1)):
            np.add.at(count, row, 1)
        return np.diff(np.concatenate([[0], np.cumsum(count)])[self.a_start])

    def spelled(self) -> list[str]:
        """Per chunk its groups as ``a1,a2|b1;a3|b2,b3``."""
        (a_from, a_row), (b_from, b_row) = ((start.tolist(), row) for start, row in self._by_group())
        a, b = list(map(str, self.a[a_row].tolist())), list(map(str, self.b[b_row].tolist()))
        group = [f"{','.join(a[i:j])}|{','.join(b[k:m])}" for i, j, k, m in zip(a_from, a_from[1:], b_from, b_from[1:])]
        start = self.group_start.tolist()
        return [";".join(group[i:j]) for i, j in zip(start, start[1:])]


class ChunkTable:
    """What a worker knows of the chunks it met, up to a bound; beyond it the table is begun anew."""

    CHUNKS, LINKS = 120_000, 2_000_000

    def __init__(self, pair: TokenizerPair):
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.spelled: list[str] = []
        self.facts = np.zeros((0, 5), np.int64)  # fit, tokens of A, tokens of B, groups, links
        self.start, self.keys = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def add(self, chunks: list[str]) -> None:
        if len(self.place) > self.CHUNKS or len(self.keys) > self.LINKS:
            self.clear()
        missing = list({c: None for c in chunks if c not in self.place})
        for at in range(0, len(missing), 20_000):
            part = missing[at : at + 20_000]
            new = Aligned(self.pair, part)
            self.place.update(zip(part, range(len(self.spelled), len(self.spelled) + len(part))))
            self.spelled += new.spelled()
            facts = [new.fit, np.diff(new.a_start), np.diff(new.b_start), np.diff(new.group_start), np.diff(new.link_start)]
            self.facts = np.concatenate([self.facts, np.column_stack(facts).astype(np.int64)])
            self.keys = np.concatenate([self.keys, (new.a[new.link_a] << 32) | new.b[new.link_b]])
            self.start = np.concatenate([self.start, self.start[-1] + new.link_start[1:]])


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places start, start + 1, ... of each span, one span after the other."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


class Batch:
    """The texts of a batch by their chunks."""

    def __init__(self, texts: list[bytes | None], table: ChunkTable):
        self.chunks: list[list[str]] = []
        for value in texts:
            try:
                self.chunks.append(CUT.split(" " + value.decode()) if value else [])
            except UnicodeDecodeError:  # no tokens spell such bytes
                self.chunks.append([])
        table.add([c for chunks in self.chunks for c in chunks])
        # A chunk that is not spelled by its tokens may be so beside its neighbours: the whole text decides.
        at = [[table.place[c] for c in chunks] for chunks in self.chunks]
        doubtful = [i for i, places in enumerate(at) if places and not table.facts[places, 0].all()]
        if doubtful:
            table.add([c for chunks in self.chunks for c in chunks] + ["".join(self.chunks[i]) for i in doubtful])
            for i in doubtful:
                self.chunks[i] = ["".join(self.chunks[i])]
            at = [[table.place[c] for c in chunks] for chunks in self.chunks]
            for i in doubtful:
                if not table.facts[at[i][0], 0]:
                    self.chunks[i], at[i] = [], []
        self.doc = np.repeat(np.arange(len(at)), [len(places) for places in at])
        every = np.array([p for places in at for p in places], np.int64)
        #: Distinct chunks of the batch, the link keys of each, and which of them every document has.
        distinct, self.local = np.unique(every, return_inverse=True)
        size = table.facts[distinct, 4]
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.keys, self.links = np.unique(table.keys[spans(table.start[distinct], size)], return_inverse=True)
        facts = table.facts[every]
        self.facts = [np.bincount(self.doc, weights=facts[:, i], minlength=len(at)).astype(np.int64) for i in range(1, 5)]
        self.digest = [hashlib.sha256(";".join([table.spelled[p] for p in places]).encode()).hexdigest() if places else "" for places in at]

    def documents(self) -> np.ndarray:
        """Per key, the documents that hold it."""
        size = np.diff(self.start)[self.local]
        held = np.unique(np.repeat(self.doc, size) * len(self.keys) + self.links[spans(self.start[self.local], size)])
        return np.bincount(held % max(len(self.keys), 1), minlength=len(self.keys))


RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, make_pair: Callable[[], TokenizerPair], pair_key: str, text: str = "text") -> DataFrame:
    """``docs`` without the text (and without columns named like a result column, in any case), with the alignment of each row.

    ``n_a``, ``n_b``: tokens of space + text; ``n_groups``: runs of bytes between places where both sides end a token;
    ``n_links``: pairs of overlapping tokens. A pair of ids counts as many documents (rows) as hold it linked; ``n_best`` are
    the links whose count is the highest of their A id, ties included, ``count_sum`` the sum of the counts of all links,
    ``groups_sha256`` the digest of all groups' ids. Null, empty and undecodable texts, and those that their tokens do not
    spell on both sides, have zeros and an empty digest. Rows that are alike count once each.

    Documents are taken in batches. A batch asks once for each distinct pair of ids it holds; the
    answers are joined with its documents' chunk numbers again, so no row per document and pair is ever shuffled.
    """
    added = T.StructType.fromDDL(RESULT)
    lower = {text.lower(), *(n.lower() for n in added.names)}
    kept = [c for c in docs.columns if c.lower() not in lower]
    bare = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("kept"), text_bytes(text).alias("bytes"))
    fields = T.StructType([T.StructField("kept", bare.schema["kept"].dataType)] + T.StructType.fromDDL(
        "batch string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, chunks binary, keys array<long>, documents array<long>, starts binary, links binary"
    ).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = process_value(pair_key, lambda: ChunkTable(make_pair()))
        parts = (batch.slice(at, BATCH) for batch in batches for at in range(0, batch.num_rows, BATCH))
        for number, batch in enumerate(parts):
            name, n = f"{TaskContext.get().partitionId()}-{number}", batch.num_rows
            found = Batch(batch.column(1).to_pylist(), table)
            ends = np.cumsum(np.bincount(found.doc, minlength=n))[:-1]
            chunks = [part.astype("<u4").tobytes() for part in np.split(found.local, ends)]
            blank = [pa.nulls(n, t) for t in (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([name] * n, pa.string()), *map(pa.array, found.facts), pa.array(found.digest, pa.string()), pa.array(chunks, pa.binary()), *blank], names)
            if len(found.keys):
                blank = [pa.nulls(1, t) for t in (batch.column(0).type, *[pa.int64()] * 4, pa.string(), pa.binary())]
                own = [pa.array([x], pa.list_(pa.int64())) for x in (found.keys, found.documents())] + [pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (found.start, found.links)]
                yield pa.RecordBatch.from_arrays([blank[0], pa.array([name]), *blank[1:], *own], names)

    names = fields.names
    batches = settle(bare.mapInArrow(run, fields), "aligned")
    asked = batches.where("keys IS NOT NULL").select("batch", F.posexplode(F.arrays_zip("keys", "documents")).alias("place", "k")).select("batch", "place", F.col("k.keys").alias("key"), F.col("k.documents").alias("n"))
    counts = settle(asked.groupBy("key").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("key", 32)), "pairs")
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    known = counts.join(top, "a").select("key", "n", (F.col("n") == F.col("top")).alias("best"))
    answers = asked.select("batch", "place", "key").join(known, "key").select(F.col("batch").alias("asker"), "place", "n", "best")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        value = np.zeros((len(place), 2), np.int64)
        value[place, 0], value[place, 1] = right.column("best").to_numpy(), right.column("n").to_numpy()
        is_doc = left.column("starts").is_null()
        head = left.filter(left.column("starts").is_valid())
        docs_of = left.filter(is_doc)
        sums = np.zeros((docs_of.num_rows, 2), np.int64)
        if head.num_rows:
            start, links = (np.frombuffer(head.column(c)[0].as_py(), "<u4").astype(np.int64) for c in ("starts", "links"))
            total = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(value[links], axis=0)])
            per_chunk = total[start[1:]] - total[start[:-1]]
            for i, raw in enumerate(docs_of.column("chunks").to_pylist()):
                sums[i] = per_chunk[np.frombuffer(raw, "<u4")].sum(axis=0)
        return pa.table([docs_of.column("kept"), *(docs_of.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(sums[:, 0]), pa.array(sums[:, 1]), docs_of.column("groups_sha256")], ["kept", *added.names])

    packed = batches.drop("keys", "documents")
    out = T.StructType([packed.schema["kept"], *added.fields])
    summed = packed.groupBy("batch").cogroup(answers.groupBy("asker")).applyInArrow(answer, out)
    return summed.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(kept)], *added.names)


def links(docs: DataFrame, make_pair: Callable[[], TokenizerPair], pair_key: str, text: str = "text") -> DataFrame:
    """Per row of ``docs`` its tokens and how they meet: ids of both sides, overlap links and groups.

    Columns: all of ``docs`` but the text and those of the names added: ``a_ids``, ``b_ids``; ``links``, structs of places in
    the two and the bytes shared; ``n_group_links``, links between tokens of one group; ``groups`` as text. Texts without
    tokens have empty lists. A text is aligned in one piece.
    """
    added = T.StructType.fromDDL("a_ids array<int>, b_ids array<int>, links array<struct<a: int, b: int, bytes: int>>, n_group_links long, groups string")
    lower = {text.lower(), *(n.lower() for n in added.names)}
    kept = [c for c in docs.columns if c.lower() not in lower]
    bare = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("kept"), text_bytes(text).alias("bytes"))
    link_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = process_value(f"{pair_key}-whole", make_pair)
        for batch in batches:
            rows = []
            for value in batch.column(1).to_pylist():
                try:
                    one = Aligned(pair, [" " + value.decode()] if value else [])
                except UnicodeDecodeError:
                    one = Aligned(pair, [])
                met = [{"a": i, "b": j, "bytes": n} for i, j, n in zip(one.link_a.tolist(), one.link_b.tolist(), one.shared.tolist())]
                rows.append((one.a.tolist(), one.b.tolist(), met, int(one.group_links().sum()), "".join(one.spelled())))
            columns = list(zip(*rows)) or [[]] * 5
            types = (pa.list_(pa.int32()), pa.list_(pa.int32()), link_type, pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], ["kept", *added.names])

    found = bare.mapInArrow(run, T.StructType([bare.schema["kept"], *added.fields]))
    return found.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(kept)], *added.names)
