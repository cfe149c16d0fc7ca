"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.chat import conversation_digests, format_conversations
from rivulet.llm.divergence import audit_sources
from rivulet.llm.exact import exact_groups
from rivulet.llm.language import predict_languages
from rivulet.llm.lm import score_documents
from rivulet.llm.mixing import mix
from rivulet.llm.near import near_classes
from rivulet.llm.packing import packed_documents
from rivulet.llm.pii import personal_data
from rivulet.llm.repeats import remove_repeats
from rivulet.llm.topk import top_k
from rivulet.llm.transducer import audit_filters
from rivulet.llm.vectors import near_vectors

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """The file of a public tokenizer, which every executor has at the same place."""
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CONTROL_TEXT = r"\### Assistant: </turn> ok"
CONTROL_CONVERSATION = -7


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(CONTROL_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return conversation_digests(format_conversations(turns.unionByName(control), tokenizer()))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter(F.pmod(F.col("vec_id"), F.lit(50)) == 0), 5)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), tokenizer())


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("n_chars")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), tokenizer())


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).drop("row")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_chat_format": op1_chat_format,
    "op2_lm_score": op2_lm_score,
    "op3_repeats": op3_repeats,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_mixing": op5_mixing,
    "op6_personal_data": op6_personal_data,
    "op7_packing": op7_packing,
    "op8_near_dedup": op8_near_dedup,
    "op9_top_k": op9_top_k,
    "op10_language": op10_language,
    "op11_source_divergence": op11_source_divergence,
    "op12_near_vectors": op12_near_vectors,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha256(body) AS text_sha256
        FROM plain
        WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST)
    """,
    "op9_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5
    """,
    "op11_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
            FROM documents
        ),
        words AS (
            SELECT n, lang, source,
                   translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
            FROM docs
        ),
        kept AS (
            SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT n) >= 10
        ),
        langs AS (SELECT lang, count(*) AS v, sum(c) AS total FROM kept GROUP BY lang),
        grp AS (SELECT DISTINCT lang, source FROM docs),
        counted AS (
            SELECT w.lang, w.source, w.term, count(*) AS c FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term
            GROUP BY w.lang, w.source, w.term
        ),
        totals AS (SELECT lang, source, sum(c) AS total FROM counted GROUP BY lang, source),
        shares AS (
            SELECT g.lang, g.source, k.term, coalesce(x.c, 0) AS c,
                   1 + (1000000000::HUGEINT * (coalesce(x.c, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.v)::HUGEINT AS p,
                   1 + (1000000000::HUGEINT * (k.c + 2)) // (l.total + 2 * l.v)::HUGEINT AS q
            FROM grp g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
            LEFT JOIN totals t ON g.lang = t.lang AND g.source = t.source
            LEFT JOIN counted x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term
        ),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY ALL
        ),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
            FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ),
        terms AS (
            SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
            FROM shares WHERE c > 0 AND p > q
        ),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        )
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
    "op12_near_vectors": """
        WITH RECURSIVE whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ),
        measured AS (
            SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS size FROM whole WHERE len(list_filter(v, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM measured a JOIN measured b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.95
        ),
        reach(a, b) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(d.n_links, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
        FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
    """,
    "op13_filter_audit": r"""
        WITH figures AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ),
        marks AS (
            SELECT f.part,
                   [w for w in [
                       CASE WHEN len(words) < 50 THEN 'A' END,
                       CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' END,
                       CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' END,
                       CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
                       CASE WHEN f.doc_id > min(f.doc_id) OVER (PARTITION BY text) THEN 'E' END
                   ] if w IS NOT NULL] AS fails,
                   coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
            FROM figures f
            LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l
            ON f.doc_id = l.doc_id
        ),
        cells AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM marks GROUP BY part, fails
        ),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ),
        steps AS (
            SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS own,
                   string_split(substr(filter_order, 1, step - 1), '') AS earlier
            FROM orders, (SELECT unnest(range(1, 6)) AS step)
        ),
        counts AS (
            SELECT part, filter_order, step, own,
                   sum(CASE WHEN NOT list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN list_contains(fails, own) AND list_has_any(fails, earlier) THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN fails = [own] THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, earlier) THEN toxic ELSE 0 END) AS toxic_lost
            FROM cells, steps GROUP BY part, filter_order, step, own
        )
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM counts
    """,
}
