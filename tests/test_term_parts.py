"""The number of tasks that count terms follows the bytes of the texts."""

from quarry.operators import textops


def test_tasks_follow_the_bytes(spark):
    rows = spark.range(400).selectExpr("id AS doc_id", "repeat(concat('word', chr(97 + id % 5), ' '), 50) AS text")
    cores = spark.sparkContext.defaultParallelism
    assert textops.text_parts(rows) == cores
    assert textops.text_parts(rows, task_bytes=1000) == 120          # 400 texts of 300 bytes
    assert textops.text_parts(rows.filter("false")) == cores
    plan = textops.doc_terms(rows, "doc_id", kind="normalised")._jdf.queryExecution().optimizedPlan().toString()
    assert f"RepartitionByExpression [doc_id" in plan and plan.rstrip().count(f"], {cores}") == 1


def test_counts_meet_their_terms_without_a_sort(spark, tmp_path):
    """Repeated rows of a (doc, term) stay, terms without a row of their own go, and the plan sorts no counts."""
    rows = [(1, "ab", 2), (1, "cd", 1), (2, "ab", 1), (2, "ab", 1), (None, "ef", 3), (3, "gone", 1)]
    terms = [("ab", 3), ("cd", 1), ("ef", 1), ("unused", 9)]
    for name, data, schema in (("tf", rows, "doc_id long, term string, tf long"), ("terms", terms, "term string, df long")):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}")
    tf, known = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("tf", "terms"))
    got = textops.join_terms(tf, known, 13)
    assert got.columns == ["term", "doc_id", "tf", "df"]
    df = dict(terms)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((t, d, n, df[t]) for d, t, n in rows if t in df), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort [" not in plan and "SortMergeJoin" not in plan
    assert got.rdd.getNumPartitions() == 13


def test_pruned_terms_are_dealt_by_their_number(spark, monkeypatch):
    from quarry.plans import text_plans
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('common other word', chr(97 + id % 20)) AS text")
    seen, join = [], textops.join_terms
    monkeypatch.setattr(textops, "TASK_COUNTS", 10)
    monkeypatch.setattr(textops, "join_terms", lambda tf, terms, parts: seen.append(parts) or join(tf, terms, parts))
    got = text_plans._pruned_tf(docs)
    assert seen == [18]                                               # 180 counts, ten a task
    assert got.count() == 180 and {r["term"]: r["df"] for r in got.collect()}["common"] == 60
