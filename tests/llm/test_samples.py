"""Training samples: long texts and many labels are not left out."""

from pyspark.sql import functions as F

from quarry.llm import lang_id, pii
from quarry.llm.common import passage

DOCS = "doc_id long, text string, lang string"


def test_a_language_of_long_texts_is_learned(spark):
    en, fr = "the house and the river with a stone ", "la maison et le fleuve avec une pierre "
    rows = [(i, en, "en") for i in range(20)] + [(100 + i, "12 34 " * 2_000 + fr * 400, "fr") for i in range(20)]
    rows += [(200, "7 " * 9_000, "digits")]
    sample = lang_id.training_sample(spark.createDataFrame(rows, DOCS), F.lit(True))
    assert len(sample) == 40 and {lang for _, lang in sample} == {"en", "fr"}
    assert all(len(t) <= 6_000 and lang_id.words_of(t) for t, _ in sample)
    assert {w for t, lang in sample if lang == "fr" for w in lang_id.words_of(t)} == set(fr.split())
    model = lang_id.train(sample, rounds=10)
    got = lang_id.predict(spark.createDataFrame(rows[-21:-1], DOCS), model).collect()
    assert {r.lang_pred for r in got} == {"fr"}


def test_every_label_is_sampled(spark):
    rows = [(i, "a text", f"big{i % 30}") for i in range(3_000)] + [(5_000 + i, "a text", f"small{i}") for i in range(30)]
    rows += [(9_000, "a text", "same")] * 50
    df = spark.createDataFrame(rows, DOCS)
    for most in (30, 200):
        sample = lang_id.training_sample(df, F.lit(True), most=most)
        assert len({lang for _, lang in sample}) == 61 and len(sample) <= max(61, most)


def test_personal_data_of_long_texts(spark):
    text = "🎉 nothing to see " * 600 + "mail jane.doe@example.com or call +1 (555) 555-1234 " + "and more words " * 900
    sample = pii.training_sample(spark.createDataFrame([(1, text, None)], DOCS))
    assert len(sample) == 1 and len(sample[0]) <= 8_000 and "jane.doe@example.com" in sample[0]
    assert pii.train(sample * 3) is not None


def test_passage_is_whole_words_around_the_mark(spark):
    text = "word " * 50 + "7 " + "word " * 50
    df = spark.createDataFrame([(text, h) for h in (-5, 0, 3, 249, 250, 251, 400, 1 << 60)] + [("short 7", 1), ("x" * 90 + "7", 2)],
                               "t string, h long")
    got = [r.p for r in df.select(passage(F.col("t"), F.col("h"), 40, "[0-9]").alias("p")).collect()]
    assert all(set(p.split()) == {"word", "7"} and 20 < len(p) <= 40 for p in got[:8])
    assert got[8] == "short 7" and got[9] == "x" * 39 + "7"
