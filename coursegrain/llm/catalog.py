"""The numbered queries, each over its whole table, with checking SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, html_text, language, mixing, neighbours, quality, resampling, secrets, setjoin, sharding, topk, warc
from .base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


_FILL = """
names AS (SELECT i, printf('shard-%02d', i) AS shard FROM range(10) t(i)),
h AS (SELECT i, shard, ('0x' || substr(md5('start:' || shard), 1, 15))::BIGINT % 1009 AS start,
             ('0x' || substr(md5('stride:' || shard), 1, 15))::BIGINT % 1008 + 1 AS stride FROM names),
pref AS (SELECT i, list((start + j * stride) % 1009 ORDER BY j) AS slots FROM h, range(1009) t(j) GROUP BY i),
fill AS (
  SELECT 0 AS turn, list_transform(range(1009), lambda x: -1) AS owner
  UNION ALL
  SELECT turn + 1, owner[:slot] || [i] || owner[slot + 2:]
  FROM (SELECT turn, owner, i, list_filter(slots, lambda s: owner[s + 1] < 0)[1] AS slot FROM fill JOIN pref ON i = turn % 10 WHERE turn < 1009)
),
lookup AS (SELECT unnest(range(1009)) AS slot, unnest(owner) AS shard_no FROM fill WHERE turn = 1009)
"""


@query("op6_sharding", f"""
WITH RECURSIVE {_FILL}
SELECT doc_id, l.slot::INT AS slot, l.shard_no::INT AS shard_no, printf('shard-%02d', l.shard_no) AS shard
FROM documents JOIN lookup l ON l.slot = ('0x' || substr(md5('key:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % 1009
""")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(secrets.span_text(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"),
    )


@query("op9_mixing", r"""
WITH sized AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS pos
  FROM documents
), per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, source_size * 3 AS cap FROM per),
levels AS (
  SELECT *, (SELECT sum(source_size) FROM per) - coalesce(sum(cap) OVER o, 0) AS words_left,
         (SELECT sum(w) FROM weighed) - coalesce(sum(w) OVER o, 0) AS weight_left
  FROM weighed WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT source, source_size, least(cap::DOUBLE, (SELECT max(words_left::DOUBLE / weight_left::DOUBLE) FROM levels) * w) AS target FROM weighed
), budget AS (
  SELECT *, round(target)::BIGINT AS b, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS e FROM goals
), ordered AS (
  SELECT s.*, g.source_size, g.target, g.b, g.e, g.b - g.e * g.source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY pos, doc_id NULLS FIRST, size, text NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN budget g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, (e * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM ordered
""")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"), F.xxhash64("text").alias("text_key"))
    return mixing.mix(docs, words="words").drop("source", "words", "text_key")


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


@query("op7_html_text")
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


@query("op3_warc", """
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
b AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(x, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest FROM d
), w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM w
""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.score(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op2_topk", """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE))) AS ints FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.ints, c.ints)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
""")
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


@query("op5_neighbours")
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = neighbours.usable(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return neighbours.nearest(vectors, F.col("vec_id") % 50 == 0)


@query("op4_jaccard", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM words
), tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common FROM tokens a JOIN tokens b USING (token) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM shared WHERE 100 * common >= 80 * (n + m - common)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.v) AS component_id FROM sets s JOIN reach r ON r.u = s.doc_id GROUP BY s.doc_id, len(s.s)
""")
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.link(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


@query("op11_resampling", r"""
WITH codes AS (
  SELECT list(v ORDER BY b) AS t
  FROM (SELECT b, list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(b))
), texts AS (
  SELECT 's' AS side, row_number() OVER () AS no, doc_id, text FROM documents UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark
), worded AS (
  SELECT side, no, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), grams AS (SELECT side, no, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM worded),
counted AS (SELECT side, no, gram, count(*) AS n FROM grams GROUP BY ALL),
bucketed AS (
  SELECT gram, xor(list_reduce([4294967295] || list_transform(range(octet_length(encode(gram))), lambda i: ('0x' || substr(hex(encode(gram)), 1 + 2 * i, 2))::BIGINT),
                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT gram FROM counted), codes
), sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM counted JOIN bucketed USING (gram) GROUP BY bucket
), totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln((t::DOUBLE + 1) * (s_all::DOUBLE + 10000) / ((s::DOUBLE + 1) * (t_all::DOUBLE + 10000))))::BIGINT AS gain FROM sums, totals
), weights AS (
  SELECT no, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM counted JOIN bucketed USING (gram) JOIN gains USING (bucket) WHERE side = 's' GROUP BY no
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS can,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM worded LEFT JOIN weights USING (no) WHERE side = 's'
), placed AS (SELECT *, row_number() OVER (PARTITION BY can ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY can) AS docs FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN can AND place <= 25 * docs // 100 THEN place END AS rank FROM placed
""")
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_language")
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs)
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "confident")
