"""Queries on passages: documents are passages, benchmark items are queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retrieval as r
from .base import table


def _corpus(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text", "source", "lang")


def _queries(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def chunk_pack(spark, sf_dir):
    d = _corpus(spark, sf_dir).select("chunk_id", F.posexplode(r.chunks(F.col("text"), 600, 80, "\n")).alias("n", "chunk"))
    return d.select("chunk_id", "n", F.length("chunk").alias("n_chars"), F.md5("chunk").alias("md5"))


CHUNKS = """WITH b AS (SELECT doc_id AS chunk_id, list_filter([trim(x, chr(32) || chr(9) || chr(10) || chr(13)) for x in string_split(text, chr(10))], lambda x: x <> '') AS blocks FROM documents),
f AS (SELECT chunk_id, list_reduce([{'out': []::VARCHAR[], 'cur': x} for x in blocks], lambda a, x: CASE WHEN length(a.cur) + length(x.cur) + 1 <= 600 THEN {'out': a.out, 'cur': a.cur || ' ' || x.cur}
  ELSE {'out': list_append(a.out, a.cur), 'cur': trim(right(a.cur, 80) || ' ' || x.cur)} END) AS s FROM b WHERE len(blocks) > 0),
c AS (SELECT chunk_id, list_append(s.out, s.cur) AS c FROM f), u AS (SELECT chunk_id, unnest(c) AS chunk, generate_subscripts(c, 1) - 1 AS n FROM c)
SELECT chunk_id, n::INTEGER AS n, length(chunk)::INTEGER AS n_chars, md5(chunk) AS md5 FROM u"""


def _pages(spark, sf_dir):
    heading = F.when(F.col("chunk_id") % 7 == 0, F.concat(F.lit("Chapter "), (F.col("chunk_id") % 120 + 1).cast("string"), F.lit(": Part "), F.col("lang"))).otherwise(F.col("source"))
    return _corpus(spark, sf_dir).select("chunk_id", "source", heading.alias("line"), F.floor(F.col("chunk_id") / 40).alias("page"))


def heading_carry_forward(spark, sf_dir):
    rows = _pages(spark, sf_dir).withColumn("chapter", r.chapter_parts(F.col("line"))["number"])
    return r.carried(rows, ["source"], ["chunk_id"], "chapter").select("chunk_id", "chapter")


_PAGES_SQL = "p AS (SELECT doc_id AS chunk_id, source, lang, doc_id // 40 AS page, CASE WHEN doc_id % 7 = 0 THEN (doc_id % 120 + 1)::INTEGER END AS number FROM documents)"
HEADINGS = f"WITH {_PAGES_SQL} SELECT chunk_id, last_value(number IGNORE NULLS) OVER (PARTITION BY source ORDER BY chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::INTEGER AS chapter FROM p"


def page_chapter_mode_fill(spark, sf_dir):
    rows = _corpus(spark, sf_dir).select("chunk_id", F.floor(F.col("chunk_id") / 40).alias("page"), F.when(F.col("chunk_id") % 5 == 0, F.lit(" ")).otherwise(F.col("lang")).alias("chapter"))
    known = r.most_common(rows.filter("trim(chapter) <> ''"), "page", ["chapter"], "chunk_id")
    return r.fill_blank(rows, known, "page", "chapter").select("chunk_id", "page", "chapter")


MODE_FILL = """WITH p AS (SELECT doc_id AS chunk_id, doc_id // 40 AS page, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS chapter FROM documents),
k AS (SELECT page, chapter, count(*) AS n, min(chunk_id) AS f FROM p WHERE chapter IS NOT NULL GROUP BY 1, 2),
m AS (SELECT page, chapter FROM k QUALIFY row_number() OVER (PARTITION BY page ORDER BY n DESC, f) = 1)
SELECT chunk_id, page, coalesce(p.chapter, m.chapter) AS chapter FROM p LEFT JOIN m USING (page)"""


def chapter_as_of(spark, sf_dir):
    rows = _corpus(spark, sf_dir).select("chunk_id", "source", F.col("chunk_id").alias("page"))
    starts = _corpus(spark, sf_dir).filter("chunk_id % 9 = 0").select("source", F.col("chunk_id").alias("page"), F.concat(F.lit("ch"), F.col("chunk_id")).alias("chapter"))
    return r.chapter_ranges(rows, starts).select("chunk_id", "chapter")


AS_OF = """SELECT d.doc_id AS chunk_id, 'ch' || s.doc_id AS chapter FROM documents d ASOF LEFT JOIN (SELECT doc_id, source FROM documents WHERE doc_id % 9 = 0) s
ON d.source = s.source AND d.doc_id >= s.doc_id"""


def bm25_stats(spark, sf_dir):
    s = r.corpus_stats(_corpus(spark, sf_dir))
    return s.select("n_docs", F.round("mean_len", 6).alias("mean_len"), "n_tokens")


_TOKEN_SQL = "[a-z0-9]+(?:[-_/][a-z0-9]+)*"
STATS = f"WITH t AS (SELECT len(regexp_extract_all(lower(text), '{_TOKEN_SQL}')) AS n FROM documents) SELECT count(*)::BIGINT AS n_docs, round(avg(n), 6) AS mean_len, sum(n)::BIGINT AS n_tokens FROM t"


def bm25_topk(spark, sf_dir):
    return r.bm25(_corpus(spark, sf_dir), _queries(spark, sf_dir), 8).select("query_id", "chunk_id", F.round("score", 6).alias("score"), "rank")


def _bm25_sql(k: int) -> str:
    return f"""t AS (SELECT doc_id AS chunk_id, regexp_extract_all(lower(text), '{_TOKEN_SQL}') AS t FROM documents),
l AS (SELECT chunk_id, len(t) AS len, unnest(t) AS term FROM t), st AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM t),
q AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '{_TOKEN_SQL}')) AS term FROM benchmark) GROUP BY 1, 2),
p AS (SELECT chunk_id, len, term, count(*) AS tf FROM l WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3), df AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
sc AS (SELECT query_id, chunk_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / mean)) * qtf), 9) AS score FROM q JOIN p USING (term) JOIN df USING (term), st GROUP BY 1, 2),
bm AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id)::INTEGER AS rank FROM sc QUALIFY rank <= {k})"""


BM25 = f"WITH {_bm25_sql(8)} SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM bm WHERE score > 0"


def dense_topk(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), r.unit(F.col("embedding").cast("array<double>")).alias("vector"))
    q = e.filter("chunk_id % 20 = 0").select(F.col("chunk_id").alias("query_id"), "vector")
    return r.dense(e, q, 5).select("query_id", "chunk_id", F.round("score", 6).alias("score"), "rank")


DENSE = """WITH v AS (SELECT vec_id, [x::DOUBLE for x in embedding] AS e FROM embeddings), u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS chunk_id, round(list_dot_product(q.e, c.e) / q.n / c.n, 9) AS score FROM u q, u c WHERE q.vec_id % 20 = 0)
SELECT query_id, chunk_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id)::INTEGER AS rank FROM s QUALIFY rank <= 5"""


def _hybrid(spark, sf_dir, with_focus: bool):
    corpus, queries = _corpus(spark, sf_dir), _queries(spark, sf_dir)
    words = r.bm25(corpus, queries, 9)
    vectors = r.dense(corpus.select("chunk_id", r.embedded(F.col("text")).alias("vector")), queries.select("query_id", r.embedded(F.col("text")).alias("vector")), 9)
    focus = corpus.select("chunk_id", _focus().alias("focus")) if with_focus else None
    return r.fused(words, vectors, focus)


def _focus():
    return r.focus_score(F.concat(F.col("text"), F.when(F.col("chunk_id") % 3 == 0, " MAP and blood pressure").when(F.col("chunk_id") % 3 == 1, " bis index").otherwise("")), F.array(F.lit("blood pressure low"), F.col("lang")))


def hybrid_rrf(spark, sf_dir):
    best = r.best_fused(_hybrid(spark, sf_dir, False), 3)
    return best.select("query_id", "chunk_id", F.round("score", 7).alias("score"), "rank")


def focus_rerank(spark, sf_dir):
    best = r.best_fused(_hybrid(spark, sf_dir, True), 3)
    return best.select("query_id", "chunk_id", F.round("score", 7).alias("score"), "rank")


def chapter_filter_fallback(spark, sf_dir):
    hits = _hybrid(spark, sf_dir, False).join(_corpus(spark, sf_dir).select("chunk_id", "source"), "chunk_id")
    best = r.best_fused(r.limited(hits, r.allowed(F.col("source"), ["src3", "7"])), 3)
    return best.select("query_id", "chunk_id", F.round("score", 7).alias("score"), "rank")


def hit_log_explode(spark, sf_dir):
    corpus, queries = _corpus(spark, sf_dir), _queries(spark, sf_dir)
    log = r.hit_log(r.hit_rows(queries, r.bm25(corpus, queries, 3), corpus))
    rows = log.select("query_id", F.explode("results").alias("h"))
    return rows.select("query_id", "h.rank", "h.chunk_id", F.md5("h.passage").alias("passage_md5"))


HIT_LOG = f"WITH {_bm25_sql(3)} SELECT query_id, rank, chunk_id, md5(left(text, 1200)) AS passage_md5 FROM bm JOIN documents ON doc_id = chunk_id WHERE score > 0"


def focus_scores(spark, sf_dir):
    return _corpus(spark, sf_dir).select("chunk_id", F.round(_focus(), 6).alias("focus"))


def _any(words) -> str:
    return "(" + " OR ".join(f"contains(t, '{w}')" for w in words) + ")"


_FOCUS_SQL = "f AS (SELECT chunk_id, lang, " + " + ".join(f"CASE WHEN {_any(w)} THEN {0.1 if x is None else x} ELSE 0.0 END" for w, x in r.FOCUS_GROUPS.values()) + f"""
  + least(0.25, 0.05 * (contains(t, 'blood')::INT + contains(t, 'pressure')::INT)) - CASE WHEN {_any(r.GENERIC_TERMS)} THEN 0.6 ELSE 0.0 END AS focus
  FROM (SELECT doc_id AS chunk_id, lang, lower(text || CASE doc_id % 3 WHEN 0 THEN ' MAP and blood pressure' WHEN 1 THEN ' bis index' ELSE '' END) AS t FROM documents))"""
FOCUS = f"WITH {_FOCUS_SQL} SELECT chunk_id, round(focus::DOUBLE, 6) AS focus FROM f"

_VECTORS_SQL = f"""hv AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'q', item_id, text FROM benchmark),
ht AS (SELECT side, id, [('0x' || left(md5(x), 4))::INTEGER % 64 for x in regexp_extract_all(lower(text), '{_TOKEN_SQL}')] AS s FROM hv),
hc AS (SELECT side, id, [len(list_filter(s, lambda y: y = i))::DOUBLE for i in range(64)] AS v FROM ht),
hu AS (SELECT side, id, v, CASE WHEN list_dot_product(v, v) = 0 THEN 1.0 ELSE sqrt(list_dot_product(v, v)) END AS n FROM hc),
ds AS (SELECT q.id AS query_id, d.id AS chunk_id, round(list_dot_product(q.v, d.v) / q.n / d.n, 9) AS score FROM hu q, hu d WHERE q.side = 'q' AND d.side = 'd'),
dn AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id)::INTEGER AS rank FROM ds QUALIFY rank <= 9)"""


def _fused_sql(focus: str, limit: str) -> str:
    return f"""WITH {_bm25_sql(9)}, {_VECTORS_SQL}, {_FOCUS_SQL},
fu AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.chunk_id, b.chunk_id) AS chunk_id, a.rank AS ar, b.rank AS br,
  coalesce(0.6 / (60.0 + a.rank), 0) + coalesce(0.4 / (60.0 + b.rank), 0) AS base FROM (SELECT * FROM bm WHERE score > 0) a FULL JOIN dn b ON a.query_id = b.query_id AND a.chunk_id = b.chunk_id),
fs AS (SELECT fu.*, d.source, round(base + {focus}, 9) AS score FROM fu JOIN f USING (chunk_id) JOIN documents d ON d.doc_id = fu.chunk_id),
fl AS (SELECT *, {limit} AS ok, max(({limit})::INT) OVER (PARTITION BY query_id) AS n_ok FROM fs)
SELECT query_id, chunk_id, round(score, 7) AS score, row_number() OVER (PARTITION BY query_id ORDER BY fl.score DESC, ar NULLS LAST, br NULLS LAST, chunk_id)::INTEGER AS rank
FROM fl WHERE ok OR n_ok = 0 QUALIFY rank <= 3"""


REGISTER = [
    ("chunk_pack", chunk_pack, CHUNKS),
    ("heading_carry_forward", heading_carry_forward, HEADINGS),
    ("page_chapter_mode_fill", page_chapter_mode_fill, MODE_FILL),
    ("chapter_as_of", chapter_as_of, AS_OF),
    ("bm25_stats", bm25_stats, STATS),
    ("bm25_topk", bm25_topk, BM25),
    ("dense_topk", dense_topk, DENSE),
    ("hybrid_rrf", hybrid_rrf, _fused_sql("0", "true")),
    ("focus_scores", focus_scores, FOCUS),
    ("focus_rerank", focus_rerank, _fused_sql("0.15 * focus", "true")),
    ("chapter_filter_fallback", chapter_filter_fallback, _fused_sql("0", "regexp_extract(source, '[0-9]{1,3}') IN ('3', '7')")),
    ("hit_log_explode", hit_log_explode, HIT_LOG),
]
