"""Text jobs: tokenising, vocabularies, term vectors, pruning, TF-IDF and
document similarity. Tokens live in long tables (doc, term) so that every
vocabulary-sized step is a distributed group-by or join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .indexing import dense_index


def title_terms(df: DataFrame, key: str, text: str) -> DataFrame:
    """Whitespace tokens with their position: (key, pos, term)."""
    return df.select(key, F.posexplode(F.split(F.col(text), " ")).alias("pos", "term"))


def term_dictionary(terms: DataFrame, term: str = "term") -> DataFrame:
    """Distinct terms -> 0..V-1 in sorted order."""
    return dense_index(terms.select(term), term, "term_index")


def binary_term_vectors(terms: DataFrame, dictionary: DataFrame, key: str = "item") -> DataFrame:
    """Sparse binary vectors in long form: (key, term_index, 1.0)."""
    return (terms.join(dictionary, "term").select(key, "term_index").distinct()
            .withColumn("value", F.lit(1.0)))


def explode_tokens(docs: DataFrame, key: str | None, text: str, kind: str, out: str = "term") -> DataFrame:
    """(key, term) rows of a tokenizer: ``whitespace``, ``nonword`` or
    ``normalised`` (non-word split, no digits, no stopwords, length >= 2).

    Tokens are exploded first and filtered with plain column predicates, which
    stay inside whole-stage codegen (array lambdas would not).
    """
    from ..functions import text as T
    raw = T.token_column(F.col(text), "whitespace" if kind == "whitespace" else "nonword")
    cols = ([key] if key else []) + [F.explode(raw).alias(out)]
    return docs.select(*cols).filter(T.keep_token(F.col(out), kind))


def token_stats(docs: DataFrame, tokens_expr, extra_filters: dict | None = None) -> DataFrame:
    """Total and distinct tokens of a tokenizer over all documents; each
    ``extra_filters`` entry adds a distinct count of tokens passing a predicate.
    ``tokens_expr`` is an array column, or a DataFrame of exploded ``tok``."""
    toks = tokens_expr if isinstance(tokens_expr, DataFrame) else docs.select(F.explode(tokens_expr).alias("tok"))
    per = toks.filter("tok is not null").groupBy("tok").agg(F.count(F.lit(1)).alias("_n"))
    aggs = [F.coalesce(F.sum("_n"), F.lit(0)).alias("n_tokens"), F.count(F.lit(1)).alias("n_distinct")]
    for name, pred in (extra_filters or {}).items():
        aggs.append(F.count_if(pred(F.col("tok"))).alias(name))
    return per.agg(*aggs)


#: Bytes of text whose terms one task counts.
TASK_TEXT = 8 << 20


def text_parts(docs: DataFrame, text: str = "text", task_bytes: int = TASK_TEXT) -> int:
    """Tasks for the texts of ``docs``: one for each ``task_bytes``, and no fewer than the session's cores."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(-(-size // task_bytes), docs.sparkSession.sparkContext.defaultParallelism)


def doc_terms(docs: DataFrame, key: str, tokens_expr=None, kind: str | None = None,
              text: str = "text") -> DataFrame:
    """(key, term, tf): term frequency per document, aggregated map-side.
    Give either an array column ``tokens_expr`` or a tokenizer ``kind``."""
    if kind is not None:
        # texts are dealt by key once; the count per (key, term) then needs no shuffle of its own. The number of
        # tasks follows the bytes, and adaptive execution does not join them, so the counts of a task stay small
        texts = docs.select(key, text)
        toks = explode_tokens(texts.repartition(text_parts(texts, text), key), key, text, kind)
    else:
        toks = docs.select(key, F.explode(tokens_expr).alias("term"))
    return toks.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def corpus_counts(tf: DataFrame) -> DataFrame:
    """(term, n, df): corpus frequency and document frequency per term."""
    return tf.groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))


#: (doc, term) counts that one task joins with their terms.
TASK_COUNTS = 4 << 20


def join_terms(tf: DataFrame, terms: DataFrame, parts: int) -> DataFrame:
    """``tf`` with the columns of ``terms`` (one row a term), joined on term in ``parts`` tasks.

    A task holds its share of ``terms`` in a hash table and streams its counts past
    it: a sort-merge join would sort them, and a sort's memory grows with the counts.
    ``parts`` should follow the counts, so that the share stays small as well.
    """
    return tf.repartition(parts, "term").join(terms.repartition(parts, "term").hint("shuffle_hash"), "term")


def prune_rare(tf: DataFrame, counts: DataFrame, rare_below: int) -> DataFrame:
    """Drop terms whose corpus count is below ``rare_below`` with a left anti
    join against the rare set (never collected to the driver)."""
    rare = counts.filter(F.col("n") < rare_below).select("term")
    return tf.join(rare, "term", "left_anti")


def idf_weights(tf: DataFrame, n_docs: DataFrame) -> DataFrame:
    """(term, df, idf) with idf = ln((N + 1) / (df + 1)) as ``ml.feature.IDF``.

    ``n_docs`` is a one-row count (documents with no tokens included).
    """
    from .common import attach_row
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return attach_row(df, n_docs).select(
        "term", "df", F.log((F.col("_N") + 1) / (F.col("df") + 1)).alias("idf"))


def tfidf(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """(key, term, tf, idf, tfidf) long table; join on term (AQE splits
    partitions of hot terms)."""
    return tf.join(idf.select("term", "idf"), "term").withColumn("tfidf", F.col("tf") * F.col("idf"))


def sparse_norms(weights: DataFrame, key: str, w: str) -> DataFrame:
    return weights.groupBy(key).agg(F.sqrt(F.sum(F.col(w) * F.col(w))).alias("norm"))


def sparse_cosine(query: DataFrame, candidates: DataFrame, key: str, w: str) -> DataFrame:
    """Cosine of one sparse query vector (term, w) with every candidate
    (key, term, w): a join on term sums the shared products; norms are
    per-key aggregates. Candidates with no shared term, or whose
    terms all weigh nothing, get 0."""
    qn = query.agg(F.sqrt(F.sum(F.col(w) * F.col(w))).alias("_qn"))
    q = query.select("term", F.col(w).alias("_qw"))
    dots = (candidates.join(q, "term")
            .groupBy(key).agg(F.sum(F.col(w) * F.col("_qw")).alias("_dot")))
    from .common import attach_row
    norms = sparse_norms(candidates, key, w)
    out = attach_row(norms.join(dots, key, "left"), qn)
    return out.select(key, F.coalesce(F.try_divide(F.col("_dot"), F.col("norm") * F.col("_qn")), F.lit(0.0))
                      .alias("cosine"))


def tfidf_from_df(tf: DataFrame, n_docs: DataFrame) -> DataFrame:
    """(doc, term, tf, df, idf, tfidf) from a term table that already carries
    each term's document frequency; ``n_docs`` is a one-row count ``_N``."""
    from .common import attach_row
    return attach_row(tf, n_docs).select(
        *[c for c in tf.columns],
        F.log((F.col("_N") + 1) / (F.col("df") + 1)).alias("idf")).withColumn(
        "tfidf", F.col("tf") * F.col("idf"))
