"""Stream = batch: after draining the replayed table the streaming results
equal the batch computations, whatever the number of micro-batches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import profile
from quarry.plans.stream_plans import ONLINE_MODELS, regression_points
from quarry.sources import Tables
from quarry.streaming import online, stats


def test_batch_stats_equal_batch_aggregate(spark):
    t = Tables(spark, SF_SMALL)
    p = t.purchases()
    streamed = stats.batch_stats(spark, p).drop("batch_id")
    batch = profile.purchase_stats_by(p.withColumn("day", F.date_format("ts", "yyyy-MM-dd")), "day")
    a = sorted((str(r.day), r.n_purchases, r.n_users, r.revenue, r.top_product) for r in streamed.collect())
    b = sorted((r.day, r.n_purchases, r.n_users, r.revenue, r.top_product) for r in batch.collect())
    assert a == b


def test_user_state_totals_cover_every_event(spark):
    t = Tables(spark, SF_SMALL)
    p = t.purchases()
    s = stats.user_state(spark, p)
    assert s.agg(F.sum("n_purchases")).first()[0] == p.count()


def test_online_regression_replays_numpy(spark):
    t = Tables(spark, SF_SMALL)
    pts = regression_points(t)
    weights, mets = online.online_regression(spark, pts, "ship_year", 3, ONLINE_MODELS)
    local = pts.toPandas()
    for m, step in ONLINE_MODELS.items():
        w = np.zeros(3)
        for batch_id, (_, g) in enumerate(sorted(local.groupby("ship_year"), key=lambda kv: kv[0])):
            x = np.vstack(g.features.to_numpy())
            y = g.label.to_numpy()
            mse = float(np.mean((x @ w - y) ** 2))
            got = mets.filter((F.col("model_id") == m) & (F.col("batch_id") == batch_id)).first()
            assert abs(got.mse - mse) < 1e-9 * max(1.0, mse)
            w = w - step * (x.T @ (x @ w - y)) / len(y)
        final = weights.filter(F.col("model_id") == m).orderBy(F.desc("batch_id")).first().weights
        assert np.allclose(final, w)


def test_text_stream_of_labelled_points(spark):
    """Text lines ``y TAB x1,x2,...`` written by Spark from lineitem, read as a
    line stream, parsed, and summarised into a memory sink."""
    import uuid
    from quarry.functions.parsing import format_labelled_point, parse_labelled_point
    from quarry.session import scratch_path
    from quarry.streaming.replay import read_text_stream
    pts = regression_points(Tables(spark, SF_SMALL))
    path = scratch_path(spark, f"lines-{uuid.uuid4().hex[:8]}")
    pts.select(format_labelled_point(F.col("label"), F.col("features")).alias("value")).write.text(path)
    label, feats = parse_labelled_point(F.col("value"))
    parsed = read_text_stream(spark, path, 2).select(label.alias("label"), feats.alias("features"))
    name = f"pts_{uuid.uuid4().hex[:8]}"
    q = (parsed.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s"))
         .writeStream.outputMode("complete").format("memory").queryName(name)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql(f"SELECT * FROM {name}").first()
    want = pts.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s")).first()
    assert got.n == want.n and abs(got.s - want.s) < 1e-6


def test_custom_state_equals_builtin_state(spark):
    t = Tables(spark, SF_SMALL)
    p = t.purchases()
    a = {r.user: (r.n_purchases, float(r.revenue)) for r in stats.user_state(spark, p).collect()}
    b = {r.user: (r.n_purchases, float(r.revenue)) for r in stats.user_state_custom(spark, p).collect()}
    assert a == b


def test_online_batch_that_fails_between_its_writes(spark, monkeypatch):
    from pyspark.errors import StreamingQueryException
    from quarry.streaming.replay import new_run_dir, write_by_key
    pts = spark.range(60).select((F.col("id") % 3).cast("int").alias("step"),
                                 F.array(F.col("id") / 60.0, F.lit(1.0)).alias("features"),
                                 (F.col("id") / 30.0).alias("label"))
    models = {"m": 0.1}
    want_w, want_m = online.online_regression(spark, pts, "step", 2, models)
    run = new_run_dir(spark, "online-broken")
    pts = pts.select("features", "label", "step")
    write_by_key(pts, "step", f"{run}/source")
    store, calls = online.store_batch, []

    def failing(rows, path):
        calls.append(path)
        if len(calls) == 4:   # second batch: its metrics are written, its weights are not
            raise OSError("lost")
        store(rows, path)
    monkeypatch.setattr(online, "store_batch", failing)
    with pytest.raises(StreamingQueryException):
        online.resume(spark, run, pts.schema, 2, models)
    got_w, got_m = online.resume(spark, run, pts.schema, 2, models)

    def rows(df, value):   # sums of floats depend on the order of the tasks in their last digits
        return sorted((r["model_id"], r["batch_id"], [round(x, 9) for x in (r[value] if value == "weights" else [r[value]])])
                      for r in df.collect())
    assert rows(got_w, "weights") == rows(want_w, "weights") and rows(got_m, "mse") == rows(want_m, "mse")
    assert got_m.count() == 3
