"""Ids with several vectors, recall on planted links, and texts of signs that are no letters."""

import numpy as np
import pytest

from quarry.llm import embed_dedup, lang_id


def test_one_id_with_two_vectors(spark):
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((2, 16))
    rows = [(5, a), (5, b), (6, a * 1.001 + 1e-4), (7, b * 0.999 + 1e-4)]
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in embed_dedup.near_duplicates(df).collect())
    assert got == [(5, 1, 5, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 5, False)]


@pytest.mark.parametrize("dims", [64, 384])
def test_recall_on_planted_links(spark, dims):
    """Pairs at a cosine of 0.98 to 0.99, the hardest that count, among vectors without links."""
    rng = np.random.default_rng(dims)
    base = rng.standard_normal((600, dims))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    noise = rng.standard_normal((600, dims))
    noise -= np.sum(noise * base, axis=1, keepdims=True) * base
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cos = rng.uniform(0.9801, 0.99, (600, 1))
    twin = cos * base + np.sqrt(1 - cos * cos) * noise
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.vstack([base, twin]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_duplicates(df).collect()}
    found = sum(got[i + 600][1] == i for i in range(600))
    assert found >= 594 and sum(n for n, _ in got.values()) == 2 * found


def test_signs_are_no_letters(spark):
    assert lang_id.words_of("½ ² Ⅷ x²y 3rd") == ["x", "y", "rd"]
    sample = [("the cat sat on the mat and the dog", "en"), ("der hund und die katze auf der matte", "de")] * 5
    model = lang_id.train(sample)
    df = spark.createDataFrame([(1, "½ ²"), (2, "the dog ½"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in lang_id.predict(df, model).collect()}
    assert got == {1: "und", 2: "en", 3: "und"}
