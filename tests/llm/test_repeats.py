"""Rows that share id, source and text, in the mixture and the pipeline."""

from collections import Counter

import corpus_pipeline
from quarry.llm import mixture

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark):
    rows = [(None, "the same words", "en", "a", 14)] * 900 + [(7, "other words here", "en", "a", 16)] * 300
    rows += [(100 + i, f"text number {i}", "en", "a", 13) for i in range(300)] + [(None, None, None, None, None)] * 40
    rows += [(5_000 + i, "one more", "fr", "0", 8) for i in range(2_000)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def test_units_are_numbered_over_blocks(spark):
    rows = [(1, None, "s")] * 500 + [(1, 2, None)] * 70 + [(3, 4, "t")]
    df = spark.createDataFrame(rows, "unit long, doc_id long, source string").repartition(3)
    got = mixture.own_units(df, ["unit", "doc_id", "source"], block=16).collect()
    assert len(got) == len(set(got)) == 571 and Counter((r.doc_id, r.source) for r in got) == Counter((r[1], r[2]) for r in rows)
    again = mixture.own_units(df.repartition(7), ["unit", "doc_id", "source"], block=64).collect()
    assert set(again) == set(got)


def test_repeated_rows_are_rounded_one_by_one(spark):
    df = docs(spark)
    mixed = mixture.mix(df).collect()
    assert len(mixed) == len({(r.doc_id, r.source, r.unit) for r in mixed}) == 3_540
    want = {}
    for r in mixed:
        want[r.doc_id, r.source] = want.get((r.doc_id, r.source), 0) + r.copies
    got = Counter((r.doc_id, r.source) for r in corpus_pipeline.mix_sources(spark, df, "").collect())
    assert got == Counter({k: n for k, n in want.items() if n})
    own = [r for r in mixed if r.source == "a"]
    assert len({r.copies for r in own}) == 2 and len({r.copies for r in own if r.doc_id is None}) == 2


def test_null_ids_keep_one_row_of_a_fingerprint(spark):
    got = corpus_pipeline.near_duplicates(spark, docs(spark), "").filter("doc_id is null").collect()
    assert sorted(r.text or "" for r in got) == ["", "the same words"]


def test_null_ids_follow_their_component(spark):
    words = " ".join(f"word{i}" for i in range(400))
    rows = [(4, words, "en", "a", 1), (None, words, "en", "a", 1), (9, words, "fr", "b", 1),
            (None, "a text alone without any name", "en", "a", 1), (None, "a text alone without any name", "fr", "b", 2)]
    df = spark.createDataFrame(rows, DOCS).withColumnRenamed("n_chars", "source_row").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, df, "").collect()
    assert sorted((r.doc_id or -1, r.text) for r in got) == [(-1, "a text alone without any name"), (4, words)]
    assert got[0].asDict().keys() == {"doc_id", "text", "lang", "source", "source_row"}
