"""One query per operator over its whole table, with production parameters, and the SQL that states its rows where SQL can."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import alignment, decontaminate, langid, packing, quality, sharding, simhash, token_counts, topk, toxicity, url_filter, warc, whitening
from tidelake.llm.base import crc_split, scratch_dir, settle, ship, text_bytes

SHARDS = 40
CAPACITY = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_bytes("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law")
    )
    shards = sharding.rendezvous_shards(docs, "doc_id", SHARDS, SHARDS + 1)
    return sharding.with_slots(shards, ["doc_id", "text_crc32", "size"]).select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_split(F.col("doc_id"), 3, 1)
    index = toxicity.fit(docs, labels.where(~held_out))
    return toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), index).select("doc_id", "held_out", "score", "predicted", "evidence")


def op3_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return topk.inner_product_topk(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20)


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_split(F.col("doc_id"), 3, 1)
    model = quality.fit(docs, labels.where(~held_out))
    return quality.grade(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = crc_split(F.col("doc_id"), 4, 2)
    scored = langid.identify(docs.select("doc_id", "lang", held_out.alias("held_out"), "text"), ~F.col("held_out"), keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "lang_pred", "score", "accepted", "cross_entropy")


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs.select("doc_id", "text"), items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", decontaminate.is_contaminated().alias("contaminated"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    crawl, archives = scratch_dir(spark, "crawl"), scratch_dir(spark, "archives")
    warc.write_monolithic(pages, crawl, "page_id", "url", text_bytes("html"))
    index = settle(warc.normalise(spark, crawl, archives), "archive-index")
    records = warc.read_records(index)
    return records.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def encoder() -> packing.ChunkIds:
    import public_tokenizers

    return packing.ChunkIds(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack_documents(docs, encoder, "byte_bpe_50k", CAPACITY)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("long"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship(spark)
    scores = token_counts.zipf_scores(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), scores).select("doc_id", "n_pretokens", "n_tokens")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    white = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", 8)
    return white.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


#: (host, beginning of the path, verdict)
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def tokenizer_pair() -> alignment.TokenizerPair:
    import public_tokenizers

    byte_level, pieces, ranks = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))
    return alignment.TokenizerPair(byte_level, pieces, ranks, public_tokenizers.PATTERN)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_pair, "byte_bpe_50k-piece_bpe_32k")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_rendezvous_shards, op2_toxicity, op3_histogram_topk, op4_ordinal_quality, op5_language_id, op6_winnowing, op7_simhash, op8_warc,
        op9_best_fit_packing, op10_token_counts, op11_whitening, op12_url_filter, op13_token_alignment, pipeline,
    )
}

_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END))"


@functools.cache
def oracles() -> dict[str, str]:
    draw = "struct_pack(cost := -ln((('0x' || substr(md5(concat_ws('|', coalesce('k' || doc_id::VARCHAR, 'n'), s::VARCHAR)), 1, 13))::BIGINT + 0.5) / 4503599627370496.0), shard := s)"
    return {
        "op1_rendezvous_shards": f"""
            WITH crc_table AS (SELECT {_CRC_TABLE} AS t),
            hashed AS (
                SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 16 AS size,
                       CASE WHEN text IS NULL THEN NULL ELSE xor(list_reduce(
                           list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
                           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) END AS text_crc32,
                       list_sort(list_transform(range({SHARDS}), lambda s: {draw}))[1].shard AS shard,
                       list_sort(list_transform(range({SHARDS + 1}), lambda s: {draw}))[1].shard AS grown_shard
                FROM documents, crc_table),
            bucketed AS (SELECT *, substr(md5(concat_ws('|', doc_id, text_crc32, size)), 1, 2) AS bucket FROM hashed)
            SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
                   row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32 NULLS FIRST, size) - 1 AS slot,
                   grown_shard::INTEGER AS grown_shard
            FROM bucketed""",
        "op3_histogram_topk": """
            WITH points AS (
                SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            scored AS (
                SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
                FROM points q JOIN points c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
            SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20""",
        "op6_winnowing": """
            WITH doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
            item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
            sized AS (SELECT item_id, w, least(len(w), 13) AS n FROM item WHERE len(w) > 0),
            windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS span FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
            lengths AS (SELECT DISTINCT n FROM windows),
            spans AS (SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS span FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc, lengths)),
            matched AS (SELECT r, s, n, item_id FROM spans JOIN windows USING (n, span)),
            hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM matched) GROUP BY r),
            found AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM matched) GROUP BY r)
            SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
                   sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
            FROM doc LEFT JOIN hit USING (r) LEFT JOIN found USING (r)""",
        "op8_warc": """
            WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
            f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest),
            j AS (SELECT p.*, CASE WHEN payload_bytes >= 100 AND first <> coalesce(page_id, first - 1) THEN first END AS refers_to FROM p LEFT JOIN f USING (payload_digest))
            SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM j""",
        # Simply written canonical links and refreshes to absolute urls; the tests cover what only a parser reads.
        "op12_url_filter": f"""
            WITH RECURSIVE rules(host, path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
            found AS (
                SELECT url AS source, unnest(regexp_extract_all(html, '(?i)<link[^>]*rel="canonical"[^>]*href="([^"]*://[^"]*)"', 1)
                    || regexp_extract_all(html, '(?i)<meta[^>]*http-equiv="refresh"[^>]*content="[^";]*; *url=([^"]*://[^"]*)"', 1)) AS target FROM pages),
            urls AS (SELECT DISTINCT url FROM pages UNION SELECT target FROM found),
            parts AS (
                SELECT url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                       coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
                       lower(regexp_extract(url, '(?s)^(.*?)://', 1)) || '://' || host || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS node
                FROM urls),
            fits AS (SELECT p.host, p.path, arg_max({{'rule': r.host || r.path, 'verdict': r.verdict}}, length(r.host || r.path)) AS best
                     FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY ALL),
            judged AS (SELECT url, host, path, node, best.rule AS rule, best.verdict AS verdict FROM parts LEFT JOIN fits USING (host, path)),
            edges AS (SELECT a.node AS a, b.node AS b FROM found JOIN parts a ON a.url = source JOIN parts b ON b.url = target),
            both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
            reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
            fate AS (SELECT r.a AS node, min(j.verdict) AS verdict FROM reach r JOIN judged j ON j.node = r.b GROUP BY r.a)
            SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(j.verdict, fate.verdict, 'allow') AS verdict
            FROM pages LEFT JOIN judged j USING (url) LEFT JOIN fate USING (node)""",
    }
