"""Word vectors by counting: plain counts, layout, and edge cases."""

import math
from collections import Counter

import numpy as np
import pytest

from quarry.operators import word_vectors as W

SENTENCES = ["red green blue red", "green blue yellow", None, "", "red yellow red blue green", "cyan red green",
             "blue blue blue", "yellow green red", "red green"] * 3


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(SENTENCES)], "doc_id long, text string")


def plain(window, contexts, least):
    texts = [(s or "").split() for s in SENTENCES]
    freq = Counter(w for t in texts for w in t)
    known = sorted(freq, key=lambda w: (-freq[w], w))[:contexts]
    n = Counter((a, b) for t in texts for i, a in enumerate(t) for j, b in enumerate(t)
                if i != j and abs(i - j) <= window and b in known and freq[a] >= least)
    total = sum(n.values())
    of_word, of_context = Counter(), Counter()
    for (a, b), c in n.items():
        of_word[a] += c
        of_context[b] += c
    return {k: (c, max(0.0, math.log(c * total / (of_word[k[0]] * of_context[k[1]])))) for k, c in n.items()}


@pytest.mark.parametrize("window,contexts,least", [(1, 3, 1), (2, 10, 4), (50, 2, 100)])
def test_information(docs, window, contexts, least):
    known = W.context_words(docs, "text", contexts)
    got = W.positive_information(W.cooccurrence(docs, "text", known, window, least)).collect()
    want = plain(window, contexts, least)
    assert len(got) == len(want)
    for r in got:
        n, ppmi = want[r.word, r.context]
        assert r.n == n and r.ppmi == pytest.approx(ppmi, abs=1e-12)


def test_full_width_keeps_inner_products(docs):
    rows = plain(2, 4, 1)
    words, context = sorted({a for a, _ in rows}), sorted({b for _, b in rows})
    a = np.array([[rows.get((w, c), (0, 0.0))[1] for c in context] for w in words])
    got = {r.word: r.vector for r in W.word_vectors(docs, "text", 4, 4, 2, 1).collect()}
    u = np.array([got[w] for w in words])
    assert np.allclose(u @ u.T, a @ a.T, atol=1e-9)


def test_layout_does_not_matter(spark):
    from conftest import SF_SMALL
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    a, b = ({r.word: np.array(r.vector) for r in W.word_vectors(d.repartition(n), "text", 8, 32).collect()} for n in (2, 13))
    assert a.keys() == b.keys() and len(a) > 50
    assert max(np.abs(a[w] - b[w]).max() for w in a) < 1e-5


def test_nearest_and_empty(spark, docs):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [2.0, 0.0]), ("c", [0.0, 1.0]), ("d", [3.0, 0.0]), ("z", [0.0, 0.0])],
                                    "word string, vector array<double>")
    assert [(r.word, r.similarity) for r in W.nearest_words(vectors, "a", 3).collect()] == [("b", 1.0), ("d", 1.0), ("c", 0.0)]
    assert W.nearest_words(vectors, "absent", 3).count() == 0 and W.nearest_words(vectors, "z", 3).count() == 0
    assert W.word_vectors(docs.filter("false"), "text", 4, 4).count() == 0
    with pytest.raises(ValueError):
        W.context_words(docs, "text", 0)


def test_pairs_are_counted_in_tasks(spark, docs):
    """No pair leaves a task uncounted: the plan generates no rows from token lists."""
    known = W.context_words(docs, "text", 3)
    plan = W.cooccurrence(docs, "text", known, 2, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan


def test_windows_of_runs_of_texts(spark, monkeypatch):
    """Digits, stop words, short words and empty tokens leave the windows; a text longer than a run is not cut."""
    texts = ["red, the blue a1 green x RED!", "  ", "blue red " * 40, None, "green"]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "doc_id long, text string").coalesce(1)
    known = W.context_words(rows, "text", 2)
    whole = sorted(W.cooccurrence(rows, "text", known, 2, 1).collect())
    monkeypatch.setattr(W, "STEP", 3)
    assert sorted(W.cooccurrence(rows, "text", known, 2, 1).collect()) == whole
    n = {(r["word"], r["context"]): r["n"] for r in whole}
    assert n["green", "red"] == 2 and n["green", "blue"] == 1 and n["blue", "red"] == 2 + 2 * 40 - 1
