"""Parquet test tables and the re-aimed data sets built from them.

The reference works on purchase logs, user / item / rating files, page
classification rows and newsgroup posts. Here those data sets are views over
the given tables, derived lazily with DataFrame operations so that Catalyst can
push filters and column pruning into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t = Tables(spark, dir); t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return load_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    # ---- re-aimed data sets -------------------------------------------------

    def purchases(self) -> DataFrame:
        """(user, product, price): purchase events; product is ``props.k``."""
        return purchases_from_events(self.events)

    def users(self) -> DataFrame:
        """(user, occupation, zip) from ``customer``."""
        return self.customer.select(
            F.col("c_custkey").alias("user"),
            F.col("c_mktsegment").alias("occupation"),
            F.col("c_nationkey").alias("zip"),
            F.col("c_acctbal").alias("balance"))

    def items(self) -> DataFrame:
        """(item, title, genre) from ``part``."""
        return self.part.select(
            F.col("p_partkey").alias("item"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("genre"),
            F.col("p_brand").alias("brand"))

    def ratings(self, materialised: bool = False) -> DataFrame:
        """Explicit ratings (user, item, rating 1..5) from orders x lineitem.

        ``materialised`` writes the result once to the shared checkpoint
        folder, for plans that run several jobs over it (model fits,
        rankings): the join and aggregate then run once, not per job.
        """
        r = ratings_from_orders(self.orders, self.lineitem)
        if materialised:
            from .files import materialise
            r = materialise(r, "ratings")
        return r

    def page_classification(self, materialised: bool = False) -> DataFrame:
        """Labelled documents with numeric text features (label = quality);
        ``materialised`` as for ``ratings``."""
        pc = page_classification(self.labels, self.documents)
        if materialised:
            from .files import materialise
            pc = materialise(pc, "page-features")
        return pc

    def hourly_demand(self) -> DataFrame:
        """Events per hour with calendar features (label = count)."""
        return hourly_demand(self.events)

    def posts(self) -> DataFrame:
        """(doc_id, topic, text): documents, topic = source."""
        return self.documents.select("doc_id", F.col("source").alias("topic"), "text", "lang")


def purchases_from_events(events: DataFrame) -> DataFrame:
    return (events
            .filter(F.col("event_type") == "purchase")
            .select(F.col("user_id").alias("user"),
                    F.get_json_object("props", "$.k").alias("product"),
                    F.col("value").alias("price"),
                    F.col("ts")))


def ratings_from_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One rating per (customer, part): ceil(mean quantity / 10), a value 1..5.

    The join is on ``o_orderkey``; both sides are large, so Catalyst / AQE pick
    the strategy (sort-merge, or broadcast when the runtime side is small). The
    aggregate is partial before the shuffle on (user, item).
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    od = orders.select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(F.ceil(F.avg("l_quantity") / 10).cast("double").alias("rating")))


def page_classification(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, label, category, f0..f3, features): length, words, lines and
    mean word length, scaled by fixed constants, as ``array<double>``."""
    d = documents.select(
        "doc_id", F.col("source").alias("category"),
        (F.col("n_chars") / 1000.0).alias("f0"),
        (F.size(F.filter(F.split("text", " "), lambda t: t != "")) / 100.0).alias("f1"),
        (F.size(F.split("text", "\n")) / 10.0).alias("f2"),
        (F.col("n_chars") / F.greatest(F.size(F.filter(F.split("text", " "), lambda t: t != "")), F.lit(1))
         / 10.0).alias("f3"))
    out = labels.select("doc_id", F.col("quality").cast("double").alias("label")).join(d, "doc_id")
    return out.withColumn("features", F.array("f0", "f1", "f2", "f3"))


def hourly_demand(events: DataFrame) -> DataFrame:
    """(hour_start, hr, weekday 0=Sunday, day, cnt, features) per event hour."""
    h = events.groupBy(F.date_trunc("hour", F.col("ts")).alias("hour_start")).agg(
        F.count(F.lit(1)).cast("double").alias("cnt"))
    h = h.select("hour_start",
                 F.hour("hour_start").alias("hr"),
                 (F.dayofweek("hour_start") - 1).alias("weekday"),
                 F.dayofmonth("hour_start").alias("day"),
                 "cnt")
    return h.withColumn("features", F.array(
        F.col("hr") / 23.0, F.col("weekday") / 6.0,
        F.when(F.col("weekday").isin(0, 6), 1.0).otherwise(0.0), F.col("day") / 31.0))
