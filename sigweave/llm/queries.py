"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.llm import (
    audit,
    conversations,
    edits,
    forest,
    langid,
    mixing,
    packing,
    quality,
    shards,
    simhash,
    topk,
    toxicity,
    urls,
)
from sigweave.session import prepare, run_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(modulus: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % modulus


# Production weights: the large source is held to a quarter, the others share the rest.
MIX_WEIGHTS = {"src0": 25, **{f"src{i}": 4 for i in range(1, 19)}}
MIX_REST = 3


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.filter("vec_id % 20 = 0"), k=20, scale=64)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs, MIX_WEIGHTS, MIX_REST)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, bits=4)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(_table(spark, sf_dir, "embeddings"), similarity=0.98)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_dir(spark, "shards")
    shards.write(_table(spark, sf_dir, "documents"), out)
    return shards.read(spark, out)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(_fold(4) != 2))
    return langid.identify(docs, model).select(
        "doc_id",
        F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").filter(_fold(5) != 0))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four edits of every document: its source put in, a stretch taken out, one replaced by
    the text's beginning, its language put at the end."""
    n = F.length("text")
    place = [F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(n, F.lit(1))) for k in range(3)]
    made = [
        (place[0], place[0], F.concat(F.lit(" "), F.col("source"), F.lit(" "))),
        (place[1], place[1] + 40, F.lit("")),
        (place[2], place[2] + 10, F.substring("text", 1, 25)),
        (n + 100, n + 100, F.concat(F.lit(" "), F.col("lang"))),
    ]
    parts = [
        F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"), t.alias("text"))
        for a, b, t in made
    ]
    docs = _table(spark, sf_dir, "documents").withColumn("edits", F.array(*parts))
    return edits.recount(docs).drop("leaf_chars", "leaf_tokens")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    # A withheld label leaves its document out: it is neither positive nor unlabelled.
    shown = F.when(_fold(3) != 1, F.col("quality"))
    model = quality.fit(docs, labels.select("doc_id", shown.alias("quality")))
    return quality.score(docs, model).select(
        "doc_id",
        F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with faults put in by a checksum of conversation and turn."""

    def known(name: str) -> F.Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat_ws(":", known("conv_id"), known("turn"))) % 20
    copies = F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return _table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(known("role")).alias("role"),
        F.when(fault == 1, "")
        .when(fault == 2, F.translate(known("text"), ".!?", ""))
        .otherwise(known("text"))
        .alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(copies).alias("copy"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(_damaged(spark, sf_dir), absent=F.col("dropped"))


QUERIES = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_mix_sources": op2_mix_sources,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_packing": op4_packing,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_token_shards": op7_token_shards,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_filter_audit": op11_filter_audit,
    "op12_quality": op12_quality,
    "op13_conversation_repair": op13_conversation_repair,
}

# Queries that SQL can express; the others are tested against brute force.
CHECKS = {
    "op1_exact_top_k": """
        WITH v AS (
            SELECT vec_id, i, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS q FROM (
                SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
                FROM embeddings
            )
        ),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, sum(a.q * b.q) AS score
            FROM v a JOIN v b ON a.i = b.i AND a.vec_id <> b.vec_id
            WHERE a.vec_id % 20 = 0
            GROUP BY a.vec_id, b.vec_id
        ),
        r AS (
            SELECT query_id, vec_id, CAST(score AS BIGINT) AS score, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op11_filter_audit": r"""
        WITH marks AS (
            SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
        ),
        texts AS (
            SELECT d.doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                coalesce(good, false) AS good, coalesce(m.toxic, false) AS toxic,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                    lambda w: w <> '') AS words
            FROM documents d LEFT JOIN marks m ON m.doc_id = d.doc_id
        ),
        cells AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good,
                count(*) FILTER (toxic) AS toxic
            FROM (
                SELECT part, good, toxic, list_filter([
                    CASE WHEN len(words) < 50 THEN 'A' END,
                    CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' END,
                    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' END,
                    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
                    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END
                ], lambda f: f IS NOT NULL) AS fails
                FROM texts
            )
            GROUP BY part, fails
        ),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
        orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
            FROM letters a JOIN letters b ON b.f <> a.f JOIN letters c ON c.f NOT IN (a.f, b.f)
            JOIN letters d ON d.f NOT IN (a.f, b.f, c.f) JOIN letters e ON e.f NOT IN (a.f, b.f, c.f, d.f)
        ),
        steps AS (
            SELECT filter_order, step, filter_order[step] AS f,
                string_split(left(filter_order, step - 1), '') AS earlier
            FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
        ),
        sums AS (
            SELECT part, filter_order, step::INTEGER AS step, any_value(s.f) AS f,
                sum(CASE WHEN gone OR now THEN 0 ELSE n END)::BIGINT AS kept,
                sum(CASE WHEN now AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
                sum(CASE WHEN now AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
                sum(CASE WHEN fails = [f] THEN n ELSE 0 END)::BIGINT AS unique_fails,
                sum(CASE WHEN now AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
                sum(CASE WHEN now AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
            FROM (
                SELECT c.*, s.*, list_has_any(fails, earlier) AS gone, list_contains(fails, s.f) AS now
                FROM cells c, steps s
            ) s
            GROUP BY part, filter_order, step
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
        FROM sums
    """,
    "op13_conversation_repair": r"""
        WITH RECURSIVE hashed AS (
            SELECT *, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(
                    string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                    lambda c: ascii(c)::BIGINT)),
                lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i:
                    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 20 AS fault
            FROM conversations
        ),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
                    ELSE coalesce(text, ' ') END AS text,
                unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
            FROM hashed WHERE fault <> 0
        ),
        placed AS (
            SELECT *, left(role, 1) AS initial, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
                lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS before
            FROM damaged
        ),
        faults AS (
            SELECT *, body = '' AS blank, body <> '' AND seen > 1 AS again,
                body <> '' AND seen = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS cut
            FROM placed
        ),
        walk AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS i,
                [{'s': 0, 'cost': 0, 'audit': '', 'lines': ''}] AS cells
            FROM conversations
            UNION ALL
            SELECT w.conv_id, f.i, list_filter(list_transform([0, 1, 2, 3], lambda s: list_sort(list_filter(
                flatten(list_transform(list_concat(
                    w.cells,
                    list_transform(list_filter(w.cells, lambda c: c.s <> 2), lambda c: {'s': 2,
                        'cost': c.cost + 3, 'audit': c.audit || 'I', 'lines': c.lines || chr(10) || 'user:'}),
                    list_transform(list_filter(w.cells, lambda c: c.s = 2), lambda c: {'s': 3,
                        'cost': c.cost + 3, 'audit': c.audit || 'I', 'lines': c.lines || chr(10) || 'assistant:'}),
                    list_transform(list_filter(w.cells, lambda c: c.s < 2), lambda c: {'s': 3,
                        'cost': c.cost + 6, 'audit': c.audit || 'II',
                        'lines': c.lines || chr(10) || 'user:' || chr(10) || 'assistant:'})
                ), lambda c: [
                    {'s': c.s, 'cost': c.cost + 4, 'audit': c.audit || 'D', 'lines': c.lines},
                    CASE WHEN NOT (f.blank OR f.again) AND (f.initial = 's' AND c.s = 0
                            OR f.initial = 'u' AND c.s <> 2 OR f.initial = 'a' AND c.s = 2)
                        THEN {'s': CASE f.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END,
                            'cost': c.cost + CASE WHEN f.cut THEN 3 ELSE 0 END, 'audit': c.audit || 'K',
                            'lines': c.lines || chr(10) || f.role || ':' || f.text} END,
                    CASE WHEN NOT (f.blank OR f.again)
                        THEN {'s': CASE c.s WHEN 2 THEN 3 ELSE 2 END,
                            'cost': c.cost + CASE WHEN f.cut THEN 6 ELSE 3 END, 'audit': c.audit || 'R',
                            'lines': c.lines || chr(10) || CASE c.s WHEN 2 THEN 'assistant' ELSE 'user' END
                                || ':' || f.text} END
                ])), lambda x: x IS NOT NULL AND x.s = s))[1]), lambda x: x IS NOT NULL)
            FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
        ),
        ends AS (
            SELECT conv_id, list_sort(flatten(list_transform(arg_max(cells, i), lambda c: [
                CASE WHEN c.s IN (0, 3) THEN {'cost': c.cost, 'audit': c.audit, 'lines': c.lines} END,
                CASE WHEN c.s = 2 THEN {'cost': c.cost + 3, 'audit': c.audit || 'I',
                    'lines': c.lines || chr(10) || 'assistant:'} END,
                CASE WHEN c.s = 1 THEN {'cost': c.cost + 6, 'audit': c.audit || 'II',
                    'lines': c.lines || chr(10) || 'user:' || chr(10) || 'assistant:'} END
            ])), 'ASC', 'NULLS LAST')[1] AS best
            FROM walk GROUP BY conv_id
        ),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
                count(*) FILTER (cut) AS truncated,
                count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faults GROUP BY conv_id
        )
        SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
            coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
            coalesce(illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost, best.audit AS audit,
            sha256(substr(best.lines, 2)) AS repaired_sha256
        FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
}
