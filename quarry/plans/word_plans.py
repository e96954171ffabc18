"""Word vectors from counts: information of word pairs, nearest words."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import word_vectors as W
from ..operators.common import top_k
from ..sources import Tables
from ..sources.files import materialise
from .catalog import register
from .text_plans import _NORM

CONTEXTS, WINDOW, MIN_COUNT = 64, 5, 5
_PAIRS_SQL = f"""
docs AS (SELECT doc_id, {_NORM} AS t FROM documents),
toks AS (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS i FROM docs),
freq AS (SELECT word, count(*) AS n FROM toks GROUP BY word),
ctx AS (SELECT word AS context FROM freq ORDER BY n DESC, word LIMIT {CONTEXTS}),
near AS (SELECT a.word, b.word AS context, count(*) AS n
         FROM toks a JOIN toks b ON a.doc_id = b.doc_id AND b.i <> a.i AND b.i BETWEEN a.i - {WINDOW} AND a.i + {WINDOW}
         WHERE b.word IN (SELECT context FROM ctx) AND a.word IN (SELECT word FROM freq WHERE n >= {MIN_COUNT})
         GROUP BY a.word, b.word),
info AS (SELECT word, context, n, greatest(0.0, ln(CAST(n AS DOUBLE) * sum(n) OVER ()
             / (CAST(sum(n) OVER (PARTITION BY word) AS DOUBLE) * sum(n) OVER (PARTITION BY context)))) AS ppmi FROM near)"""


def _most_frequent(counts) -> str | None:
    first = top_k(counts, [F.desc("n"), F.asc("word")], 1).first()
    return first["word"] if first else None


@register("word_information", f"""
WITH {_PAIRS_SQL}
SELECT word, context, n, round(ppmi, 6) AS ppmi FROM info
""")
def word_information(spark, sf_dir):
    """Counts and positive information of every (word, context word) that stand within the window."""
    docs = Tables(spark, sf_dir).documents
    counts = W.word_counts(docs, "text")
    known = W.context_words(docs, "text", CONTEXTS, counts)
    info = W.positive_information(materialise(W.cooccurrence(docs, "text", known, WINDOW, MIN_COUNT, counts), "near-counts"))
    return info.select("word", "context", "n", F.round("ppmi", 6).alias("ppmi"))


@register("word_neighbours", f"""
WITH {_PAIRS_SQL},
q AS (SELECT word FROM freq ORDER BY n DESC, word LIMIT 1),
len AS (SELECT word, sqrt(sum(ppmi * ppmi)) AS l FROM info GROUP BY word HAVING sum(ppmi * ppmi) > 1e-24),
dots AS (SELECT i.word, sum(i.ppmi * j.ppmi) AS d FROM info i
         JOIN info j ON i.context = j.context AND j.word = (SELECT word FROM q) GROUP BY i.word)
SELECT (SELECT word FROM q) AS query, len.word, round(coalesce(d, 0) / (l * (SELECT l FROM len WHERE word = (SELECT word FROM q))), 6) AS similarity
FROM len LEFT JOIN dots ON len.word = dots.word WHERE len.word <> (SELECT word FROM q)
ORDER BY round(coalesce(d, 0) / (l * (SELECT l FROM len WHERE word = (SELECT word FROM q))), 9) DESC, len.word LIMIT 20
""")
def word_neighbours(spark, sf_dir):
    """The 20 nearest words of the most frequent one by the cosine of word
    vectors of full width, which the SQL takes from the information itself."""
    docs = Tables(spark, sf_dir).documents
    counts = W.word_counts(docs, "text")
    vectors = W.word_vectors(docs, "text", CONTEXTS, CONTEXTS, WINDOW, MIN_COUNT, counts=counts)
    near = W.nearest_words(vectors, _most_frequent(counts) or "", 20)
    return near.select("query", "word", F.round("similarity", 6).alias("similarity"))
