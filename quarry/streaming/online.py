"""Online linear regression on a stream, with per-batch model monitoring.

Every micro-batch, for every model: score the batch with the weights of the
previous batch (test), write MSE / RMSE to a metrics table under its batch_id, then take one
full-batch gradient step on the batch (train) and write the new weights the
same way. A batch with stored weights was done before a failure and is
skipped; one that failed between the two writes replaces its metrics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import linear
from .replay import key_folders, new_run_dir, only, read_stream, run_to_end, write_by_key
from .sinks import create_table, store_batch, stored

_WEIGHTS = "model_id string, weights array<double>, batch_id long"
_METRICS = "model_id string, n long, mse double, rmse double, batch_id long"


def _load_weights(spark, path: str, models: dict[str, float], d: int) -> tuple[dict, int]:
    """Latest stored weights per model (model-sized) and the last batch id;
    zero weights and -1 while the table is empty."""
    w = {m: [0.0] * d for m in models}
    last = -1
    df = stored(spark, path, _WEIGHTS)
    for r in df.groupBy("model_id").agg(F.max_by(F.struct("batch_id", "weights"), "batch_id").alias("s")).collect():
        w[r["model_id"]] = list(r["s"]["weights"])
        last = max(last, r["s"]["batch_id"])
    return w, last


def online_regression(spark: SparkSession, points: DataFrame, order_key: str, num_features: int,
                      models: dict[str, float], trigger: dict | None = None,
                      run_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``points`` has (order_key, features array<double>, label). Returns
    (weights per model and batch, metrics per model and batch)."""
    run = run_dir or new_run_dir(spark, "online-regression")
    points = points.select("features", "label", order_key)
    write_by_key(points, order_key, f"{run}/source")
    return resume(spark, run, points.schema, num_features, models, trigger)


def resume(spark: SparkSession, run: str, schema: StructType, num_features: int, models: dict[str, float],
           trigger: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Go on with the source, checkpoints and tables of folder ``run``, e.g.
    after a failed batch; ``schema`` ends with the order key.

    Each key value is one batch, numbered in key order: the query runs once
    per value over that value's folder, whatever its number of files. An empty
    source gives empty tables.
    """
    src = f"{run}/source"
    key = schema.names[-1]
    wpath, mpath = f"{run}/weights", f"{run}/metrics"
    create_table(spark, wpath, _WEIGHTS)
    create_table(spark, mpath, _METRICS)

    def per_batch(batch: DataFrame, batch_id: int):
        weights, last = _load_weights(spark, wpath, models, num_features)
        if batch_id <= last:
            return  # already processed before a restart
        data = batch.select("features", "label").persist()
        try:
            errs = []
            for m in models:
                model = linear.LinearModel(weights[m], False, "squared")
                errs.append((model.margin(F.col("features")) - F.col("label")).alias(m))
            scored = data.select(*errs)
            aggs = []
            for m in models:
                aggs += [F.count(F.col(m)).alias(f"{m}__n"), F.avg(F.col(m) * F.col(m)).alias(f"{m}__mse")]
            row = scored.agg(*aggs).first()
            mrows = [(m, batch_id, int(row[f"{m}__n"]), row[f"{m}__mse"]) for m in models]
            fits = linear.gd_fit_many(data, [dict(loss="squared", step=step, iters=1) for step in models.values()],
                                      starts=[weights[m] for m in models])
            new_w = [(m, batch_id, fit.weights) for m, fit in zip(models, fits)]
            store_batch(spark.createDataFrame(mrows, "model_id string, batch_id long, n long, mse double")
                        .withColumn("rmse", F.sqrt("mse")), mpath)
            # last: a batch counts as done once its weights are there
            store_batch(spark.createDataFrame(new_w, "model_id string, batch_id long, weights array<double>"), wpath)
        finally:
            data.unpersist()

    for number, folder in enumerate(key_folders(spark, src, schema, key)):
        batch = read_stream(spark, only([folder]), schema).writeStream.foreachBatch(
            lambda rows, _, number=number: per_batch(rows, number))
        run_to_end(batch.option("checkpointLocation", f"{run}/checkpoint/{number}"), trigger)
    return stored(spark, wpath, _WEIGHTS), stored(spark, mpath, _METRICS)
