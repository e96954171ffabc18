"""Word vectors by counting: windows of tokens, positive pointwise mutual
information against the most frequent words, and a truncated factorisation.

Every step is an aggregate or a matrix product over rows, so the vectors
don't depend on the number of cores or partitions (but for the last digits of
sums), unlike those of a model updated in an order of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.files import materialise
from .common import attach_row, top_k
from .solvers import truncated_svd
from .textops import explode_tokens

#: A word's row is an array of this many numbers at most.
MOST_CONTEXTS = 4096
#: Tokens whose windows a task counts at once.
STEP = 1 << 20


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, n): how often each normalised token occurs, written once."""
    words = explode_tokens(docs, None, text, "normalised", "word")
    return materialise(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts")


def context_words(docs: DataFrame, text: str, contexts: int, counts: DataFrame | None = None) -> DataFrame:
    """(context, at): the ``contexts`` most frequent words, numbered from 0 in
    word order. ``counts`` is ``word_counts`` of the same texts, if it is there."""
    if not 1 <= contexts <= MOST_CONTEXTS:
        raise ValueError(f"contexts must be from 1 to {MOST_CONTEXTS}")
    counts = word_counts(docs, text) if counts is None else counts
    top = top_k(counts.withColumnRenamed("word", "context"), [F.desc("n"), F.asc("context")], contexts)
    listed = top.agg(F.array_sort(F.collect_list("context")).alias("w"))   # one row of at most MOST_CONTEXTS words
    return materialise(listed.select(F.posexplode("w").alias("at", "context")).select("context", "at"), "contexts")


def cooccurrence(docs: DataFrame, text: str, contexts: DataFrame, window: int = 5, min_count: int = 5,
                 counts: DataFrame | None = None) -> DataFrame:
    """(word, context, at, n): how often a context word stands within
    ``window`` tokens before or after a word that occurs ``min_count`` times.

    Windows run over the normalised tokens of a text; null texts have none.
    Tasks count the pairs with a context word, ``STEP`` tokens at a time, and
    only counts are shuffled. ``counts`` as for ``context_words``.
    """
    counts = word_counts(docs, text) if counts is None else counts
    known = [r["context"] for r in contexts.orderBy("at").select("context").collect()]   # at most MOST_CONTEXTS words
    tokens = docs.select(T.token_column(F.col(text), "nonword").alias("t")).filter("t is not null")
    pairs = tokens.mapInArrow(_near(known, window), "word string, at int, n long")
    counted = pairs.groupBy("word", "at").agg(F.sum("n").alias("n"))
    often = counts.filter(F.col("n") >= min_count).select("word")
    return (counted.join(F.broadcast(contexts), "at").join(often, "word", "left_semi")   # at most MOST_CONTEXTS rows
            .select("word", "context", "at", "n"))


def _near(known: list[str], window: int):
    """Batches of raw token lists -> counts of (word, place of the context word) of runs of whole lists."""
    contexts, stop = pa.array(known, pa.string()), pa.array(T.STOPWORDS, pa.string())

    def counted(lists: pa.ListArray) -> pa.RecordBatch:
        text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        coded = lists.flatten().dictionary_encode()
        # each word of the batch is looked at once; tokens that are no normalised ones leave the sequence
        words = coded.dictionary
        fine = pc.and_(pc.greater_equal(pc.utf8_length(words), T.MIN_TOKEN_LENGTH),
                       pc.invert(pc.or_(pc.match_substring_regex(words, "[0-9]"), pc.is_in(words, stop))))
        code = coded.indices.to_numpy(zero_copy_only=False)
        kept = fine.to_numpy(zero_copy_only=False).astype(bool)[code]
        code, text = code[kept].astype(np.int64), text[kept]
        place = pc.fill_null(pc.index_in(words, contexts), -1).to_numpy(zero_copy_only=False).astype(np.int64)[code]
        found, width = np.flatnonzero(place >= 0), max(len(known), 1)
        keys = []
        for d in range(-window, window + 1):
            at = found[(found + d >= 0) & (found + d < len(code))] if d else found[:0]
            at = at[text[at + d] == text[at]]
            keys.append(code[at + d] * width + place[at])
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        return pa.RecordBatch.from_arrays([words.take(pa.array(key // width)), pa.array(key % width, pa.int32()),
                                           pa.array(n, pa.int64())], names=["word", "at", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(0)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            lo = 0
            while lo < len(lists):   # whole lists of about STEP tokens in all, one at least
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + STEP, "right")))
                yield counted(lists.slice(lo, hi - lo))
                lo = hi
    return run


def positive_information(counts: DataFrame) -> DataFrame:
    """(word, context, at, n, ppmi) with ppmi = max(0, ln(n * total / (n of word * n of context)))."""
    of_word = counts.groupBy("word").agg(F.sum("n").alias("_w"))
    of_context = counts.groupBy("context").agg(F.sum("n").alias("_c"))   # at most MOST_CONTEXTS rows
    total = of_context.agg(F.sum("_c").alias("_t"))
    joined = attach_row(counts.join(of_word, "word").join(F.broadcast(of_context), "context"), total)
    share = F.col("n").cast("double") * F.col("_t") / (F.col("_w").cast("double") * F.col("_c"))
    return joined.select("word", "context", "at", "n", F.greatest(F.lit(0.0), F.log(share)).alias("ppmi"))


def word_vectors(docs: DataFrame, text: str = "text", k: int = 100, contexts: int = 512, window: int = 5,
                 min_count: int = 5, tol: float = 1e-8, counts: DataFrame | None = None) -> DataFrame:
    """(word, vector array<double>): rows of U S of the information matrix.

    ``k`` is cut to ``contexts``; with all of them the inner products of
    vectors are those of the rows themselves. Without any word the result is empty.
    """
    counts = word_counts(docs, text) if counts is None else counts
    known = context_words(docs, text, contexts, counts)
    width = known.count()
    # written once: the information needs the totals of words and contexts besides the counts
    info = positive_information(materialise(cooccurrence(docs, text, known, window, min_count, counts), "near-counts"))
    entries = info.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("at", "ppmi"))).alias("m"))
    row = F.transform(F.sequence(F.lit(0), F.lit(max(width - 1, 0))), lambda i: F.coalesce(F.col("m")[i], F.lit(0.0)))
    rows = materialise(entries.select("word", row.alias("row")), "word-rows")
    if not width or rows.isEmpty():
        return rows.select("word", F.col("row").alias("vector"))
    k = min(k, width)
    # all columns at once span the whole space after one pass, so nothing is left to converge
    svd = truncated_svd(rows, "row", k, centre=False, tol=2.0 if k == width else tol)
    scale = F.array(*[F.lit(float(s)) for s in svd.values])   # k numbers
    return svd.left(rows, "word", "row").select(
        "word", F.zip_with("u", scale, lambda u, s: u * s).alias("vector"))


def nearest_words(vectors: DataFrame, word: str, k: int = 20) -> DataFrame:
    """(query, word, similarity): the ``k`` words with the largest cosine, ties
    (at nine decimals) by word; the word itself and zero vectors are left out."""
    unit = vectors.withColumn("_l", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).filter("_l > 1e-12")
    own = unit.filter(F.col("word") == word).select(F.col("vector").alias("_q"), F.col("_l").alias("_ql")).limit(1)
    dot = F.aggregate(F.zip_with("vector", "_q", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scored = attach_row(unit.filter(F.col("word") != word), own).filter("_q is not null").select(
        F.lit(word).alias("query"), "word", F.round(dot / (F.col("_l") * F.col("_ql")), 9).alias("similarity"))
    return top_k(scored, [F.desc("similarity"), F.asc("word")], k)
