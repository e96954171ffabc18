"""Text plans over ``documents``: topics, tokenizers, vocabulary pruning,
TF-IDF and document similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import textops
from ..operators.common import top_k
from ..sources import Tables
from ..sources.files import materialise
from .catalog import register

# DuckDB forms of the tokenizers, shared by the oracles below.
_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in T.STOPWORDS) + "]"
_WS = "list_filter(list_transform(string_split(text, ' '), lambda t: lower(t)), lambda t: t <> '')"
_NW = r"list_filter(regexp_split_to_array(lower(text), '\W+'), lambda t: t <> '')"
_NORM = (f"list_filter({_NW}, lambda t: regexp_full_match(t, '[^0-9]*') "
         f"AND NOT list_contains({_STOP_SQL}, t) AND length(t) >= 2)")
_TF_SQL = f"""
toks AS (SELECT doc_id, unnest({_NORM}) AS term FROM documents),
cnt AS (SELECT term, count(*) AS n FROM toks GROUP BY term),
tf AS (SELECT t.doc_id, t.term, count(*) AS tf FROM toks t JOIN cnt c ON t.term = c.term
       WHERE c.n >= 2 GROUP BY t.doc_id, t.term)"""
_IS_NEW_SQL = "(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 200)"
_IDF_SQL = """
idf AS (SELECT term, count(*) AS df,
               ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf
        FROM tf GROUP BY term)"""


def _pruned_tf(docs):
    """(doc_id, term, tf, df) of the full tokenizer without rare terms
    (corpus count < 2), written once to the shared checkpoint folder.

    The (doc, term) counts are written first, so texts are tokenised once. One
    aggregate gives each term's corpus count and document frequency; one
    join on term, in tasks of bounded counts and without a sort, keeps the
    frequent terms and carries df along. Every later job (vocabulary size, IDF, model fits) scans the written table
    instead of re-tokenizing, and a lost executor re-reads files.
    """
    tf = materialise(textops.doc_terms(docs, "doc_id", kind="normalised"), "doc-terms")
    parts = max(-(-tf.count() // textops.TASK_COUNTS), docs.sparkSession.sparkContext.defaultParallelism)
    return materialise(textops.join_terms(tf, _vocabulary(tf), parts), "pruned-terms")


def _vocabulary(tf):
    """(term, df) of the terms that are not rare (corpus count < 2)."""
    return textops.corpus_counts(tf).filter(F.col("n") >= T.RARE_BELOW).select("term", "df")


def _tfidf(t):
    docs = t.documents
    tf = _pruned_tf(docs)
    n_docs = docs.agg(F.count(F.lit(1)).alias("_N"))
    return textops.tfidf_from_df(tf, n_docs)


@register("group_topic_counts", """
SELECT string_split('/corpus/' || source || '/' || CAST(doc_id AS VARCHAR), '/')[-2] AS topic, count(*) AS n
FROM documents GROUP BY topic
""")
def group_topic_counts(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    paths = d.select(F.concat(F.lit("/corpus/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"))
    return (paths.select(T.topic_from_path(F.col("path")).alias("topic"))
            .groupBy("topic").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "topic"))


@register("token_counts_whitespace", f"""
SELECT count(*) AS n_tokens, count(DISTINCT tok) AS n_distinct
FROM (SELECT unnest({_WS}) AS tok FROM documents)
""")
def token_counts_whitespace(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return textops.token_stats(d, textops.explode_tokens(d, None, "text", "whitespace", "tok"))


@register("token_counts_nonword", f"""
SELECT count(*) AS n_tokens, count(DISTINCT tok) AS n_distinct,
       count(DISTINCT CASE WHEN regexp_full_match(tok, '[^0-9]*') THEN tok END) AS n_distinct_no_digits
FROM (SELECT unnest({_NW}) AS tok FROM documents)
""")
def token_counts_nonword(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return textops.token_stats(d, textops.explode_tokens(d, None, "text", "nonword", "tok"),
                               {"n_distinct_no_digits": lambda c: ~c.rlike("[0-9]")})


@register("top_tokens", f"""
SELECT tok AS term, count(*) AS n FROM (SELECT unnest({_NORM}) AS tok FROM documents)
GROUP BY tok ORDER BY n DESC, term LIMIT 20
""")
def top_tokens(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    counts = (textops.explode_tokens(d, None, "text", "normalised")
              .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    return top_k(counts, [F.desc("n"), F.asc("term")], 20)


@register("rare_tokens", f"""
WITH {_TF_SQL}
SELECT term, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY term ORDER BY n, term LIMIT 20
""")
def rare_tokens(spark, sf_dir):
    tf = _pruned_tf(Tables(spark, sf_dir).documents)
    counts = tf.groupBy("term").agg(F.sum("tf").alias("n"))
    return top_k(counts, [F.asc("n"), F.asc("term")], 20)


@register("tokens_pruned", f"""
WITH {_TF_SQL}
SELECT d.doc_id, CAST(coalesce(sum(tf.tf), 0) AS BIGINT) AS n_tokens, count(tf.term) AS n_distinct
FROM documents d LEFT JOIN tf ON d.doc_id = tf.doc_id GROUP BY d.doc_id
""")
def tokens_pruned(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    per_doc = _pruned_tf(docs).groupBy("doc_id").agg(
        F.sum("tf").alias("n_tokens"), F.count(F.lit(1)).alias("n_distinct"))
    return (docs.select("doc_id").join(per_doc, "doc_id", "left")
            .select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"),
                    F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct")))


@register("tfidf_long", f"""
WITH {_TF_SQL}, {_IDF_SQL}
SELECT tf.doc_id, tf.term, tf.tf, round(idf.idf, 6) AS idf, round(tf.tf * idf.idf, 6) AS tfidf
FROM tf JOIN idf ON tf.term = idf.term
""")
def tfidf_long(spark, sf_dir):
    w = _tfidf(Tables(spark, sf_dir))
    return w.select("doc_id", "term", "tf", F.round("idf", 6).alias("idf"), F.round("tfidf", 6).alias("tfidf"))


@register("tfidf_minmax", f"""
WITH {_TF_SQL}, {_IDF_SQL}
SELECT round(min(tf.tf * idf.idf), 6) AS min_tfidf, round(max(tf.tf * idf.idf), 6) AS max_tfidf,
       count(*) AS n_entries
FROM tf JOIN idf ON tf.term = idf.term
""")
def tfidf_minmax(spark, sf_dir):
    w = _tfidf(Tables(spark, sf_dir))
    return w.agg(F.round(F.min("tfidf"), 6).alias("min_tfidf"), F.round(F.max("tfidf"), 6).alias("max_tfidf"),
                 F.count(F.lit(1)).alias("n_entries"))


@register("doc_cosine", f"""
WITH {_TF_SQL}, {_IDF_SQL},
w AS (SELECT tf.doc_id, tf.term, tf.tf * idf.idf AS w FROM tf JOIN idf ON tf.term = idf.term),
paths AS (SELECT doc_id, source AS topic, '/corpus/' || source || '/' || CAST(doc_id AS VARCHAR) AS path FROM documents),
q AS (SELECT min(doc_id) AS qid FROM paths WHERE contains(path, '/src0/')),
qv AS (SELECT term, w FROM w, q WHERE w.doc_id = q.qid),
qn AS (SELECT sqrt(sum(w * w)) AS qn FROM qv),
cn AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY doc_id),
dots AS (SELECT w.doc_id, sum(w.w * qv.w) AS dot FROM w JOIN qv ON w.term = qv.term GROUP BY w.doc_id),
sims AS (SELECT cn.doc_id, coalesce(dots.dot, 0) / (cn.nrm * qn.qn) AS cosine
         FROM cn LEFT JOIN dots ON cn.doc_id = dots.doc_id, qn, q WHERE cn.doc_id <> q.qid)
SELECT p.topic, count(*) AS n_docs, round(avg(s.cosine), 6) AS mean_cosine, round(max(s.cosine), 6) AS max_cosine
FROM sims s JOIN paths p ON s.doc_id = p.doc_id GROUP BY p.topic
""")
def doc_cosine(spark, sf_dir):
    """Cosine of one document's TF-IDF vector with every other document,
    summarised per topic (same topic vs other topics)."""
    t = Tables(spark, sf_dir)
    w = _tfidf(t).select("doc_id", "term", F.col("tfidf").alias("w"))
    paths = t.documents.select(
        "doc_id", F.col("source").alias("topic"),
        F.concat(F.lit("/corpus/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"))
    qid = paths.filter(F.col("path").contains("/src0/")).agg(F.min("doc_id").alias("doc_id"))
    query = w.join(qid, "doc_id").select("term", "w")
    cands = w.join(qid, "doc_id", "left_anti")
    sims = textops.sparse_cosine(query, cands, "doc_id", "w")
    return (sims.join(paths.select("doc_id", "topic"), "doc_id").groupBy("topic")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.round(F.avg("cosine"), 6).alias("mean_cosine"),
                 F.round(F.max("cosine"), 6).alias("max_cosine")))


@register("tfidf_apply_new", f"""
WITH {_TF_SQL.replace("FROM documents", "FROM documents WHERE NOT " + _IS_NEW_SQL)},
fit_df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n_fit AS (SELECT count(*) AS n FROM documents WHERE NOT {_IS_NEW_SQL}),
new_toks AS (SELECT doc_id, unnest({_NORM}) AS term FROM documents WHERE {_IS_NEW_SQL}),
new_tf AS (SELECT doc_id, term, count(*) AS tf FROM new_toks GROUP BY doc_id, term),
new_w AS (SELECT new_tf.doc_id, new_tf.tf * ln((n_fit.n + 1) / (fit_df.df + 1)) AS w
          FROM new_tf JOIN fit_df ON new_tf.term = fit_df.term, n_fit)
SELECT d.doc_id, count(w) AS n_terms, round(sum(w), 6) AS weight_sum, round(max(w), 6) AS weight_max
FROM documents d LEFT JOIN new_w ON d.doc_id = new_w.doc_id WHERE {_IS_NEW_SQL.replace("doc_id", "d.doc_id")}
GROUP BY d.doc_id
""")
def tfidf_apply_new(spark, sf_dir):
    """Vocabulary and IDF of the training documents alone, applied to new ones
    (a keyed hold-out). Terms outside the vocabulary do not count; a new
    document without any known term has no weights."""
    from ..operators import tune
    from ..operators.common import attach_row
    train_docs, new_docs = tune.hash_split(Tables(spark, sf_dir).documents, "doc_id", 0.2)
    # one row a term straight from the counts: the pruned (doc, term) rows are not needed here
    vocabulary = _vocabulary(textops.doc_terms(train_docs, "doc_id", kind="normalised"))
    n_fit = train_docs.agg(F.count(F.lit(1)).alias("_N"))
    known = textops.join_terms(textops.doc_terms(new_docs, "doc_id", kind="normalised"), vocabulary, textops.text_parts(new_docs))
    w = attach_row(known, n_fit).select(
        "doc_id", (F.col("tf") * F.log((F.col("_N") + 1) / (F.col("df") + 1))).alias("w"))
    sums = w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.round(F.sum("w"), 6).alias("weight_sum"),
                                   F.round(F.max("w"), 6).alias("weight_max"))
    return new_docs.select("doc_id").join(sums, "doc_id", "left").fillna(0, ["n_terms"])
