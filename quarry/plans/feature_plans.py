"""Feature-preparation plans: encodings, term vectors, scaling, normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import encode, textops
from ..operators.common import attach_row
from ..sources import Tables
from .catalog import register


@register("category_index", """
SELECT p_type AS genre, row_number() OVER (ORDER BY p_type) - 1 AS category_index
FROM (SELECT DISTINCT p_type FROM part)
""")
def category_index(spark, sf_dir):
    return encode.category_index(Tables(spark, sf_dir).items(), "genre")


@register("category_onehot", """
WITH idx AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS category_index
             FROM (SELECT DISTINCT p_type FROM part)),
k AS (SELECT CAST(count(*) AS INTEGER) AS k FROM idx)
SELECT p.p_partkey AS item, p.p_type AS genre, idx.category_index,
       array_to_string(list_transform(range(k.k), lambda i: CASE WHEN i = idx.category_index THEN '1' ELSE '0' END), ',') AS onehot
FROM part p JOIN idx ON p.p_type = idx.p_type, k
""")
def category_onehot(spark, sf_dir):
    return encode.one_hot(Tables(spark, sf_dir).items(), "item", "genre")


@register("title_terms", """
SELECT p_partkey AS item, CAST(generate_subscripts(string_split(p_name, ' '), 1) - 1 AS INTEGER) AS pos,
       unnest(string_split(p_name, ' ')) AS term
FROM part
""")
def title_terms(spark, sf_dir):
    return textops.title_terms(Tables(spark, sf_dir).items(), "item", "title")


@register("term_dictionary", """
SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index
FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS term FROM part)
""")
def term_dictionary(spark, sf_dir):
    t = textops.title_terms(Tables(spark, sf_dir).items(), "item", "title")
    return textops.term_dictionary(t)


@register("binary_term_vectors", """
WITH t AS (SELECT p_partkey AS item, unnest(string_split(p_name, ' ')) AS term FROM part),
d AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index FROM (SELECT DISTINCT term FROM t))
SELECT DISTINCT t.item, d.term_index, 1.0 AS value FROM t JOIN d ON t.term = d.term
""")
def binary_term_vectors(spark, sf_dir):
    t = textops.title_terms(Tables(spark, sf_dir).items(), "item", "title")
    return textops.binary_term_vectors(t, textops.term_dictionary(t))


@register("row_l2_normalise", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm FROM e),
u AS (SELECT vec_id, nrm, CASE WHEN nrm = 0 THEN v ELSE list_transform(v, lambda x: x / nrm) END AS uv FROM n)
SELECT vec_id, round(nrm, 6) AS norm, round(sqrt(list_sum(list_transform(uv, lambda x: x * x))), 6) AS unit_norm,
       round(list_sum(uv), 6) AS unit_sum
FROM u
""")
def row_l2_normalise(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    u = encode.l2_normalise(e, "embedding", "unit")
    return u.select("vec_id",
                    F.round(V.norm(V.as_doubles(F.col("embedding"))), 6).alias("norm"),
                    F.round(V.norm(F.col("unit")), 6).alias("unit_norm"),
                    F.round(V.vsum(F.col("unit")), 6).alias("unit_sum"))


@register("flag_decode", """
WITH t AS (SELECT DISTINCT p_type FROM part)
SELECT p_partkey AS item,
       array_to_string(list_sort([p_type, 'size_' || CAST(least((p_size - 1) // 10, 4) AS VARCHAR)]), '|') AS flag_names,
       p_type = (SELECT min(p_type) FROM t) AS has_first_flag
FROM part
""")
def flag_decode(spark, sf_dir):
    items = Tables(spark, sf_dir).part.select(
        F.col("p_partkey").alias("item"), F.col("p_type").alias("genre"), "p_size")
    return encode_flags_and_decode(items)


def encode_flags_and_decode(items):
    """Build 0/1 flags (type one-hot ++ size-band one-hot) and decode them."""
    bands = 5
    idx = encode.category_index(items, "genre")
    k = idx.agg(F.count(F.lit(1)).cast("int").alias("_k"))
    band = F.least(F.floor((F.col("p_size") - 1) / 10), F.lit(bands - 1)).cast("int")
    rows = attach_row(items.join(idx, "genre"), k)
    flags = rows.select(
        "item",
        F.concat(encode.one_hot_array(F.col("category_index"), F.col("_k")),
                 encode.one_hot_array(band, F.lit(bands))).cast("array<int>").alias("flags"),
        F.col("_k"))
    # names dimension: categories at 0..k-1, size bands at k..k+4
    band_names = (k.select(F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("b"), "_k")
                  .select((F.col("_k") + F.col("b")).alias("pos"),
                          F.concat(F.lit("size_"), F.col("b").cast("string")).alias("name")))
    names = idx.select(F.col("category_index").cast("int").alias("pos"), F.col("genre").alias("name")) \
        .unionByName(band_names)
    decoded = encode.decode_flags(flags, "item", "flags", names)
    first = flags.select("item", (F.element_at("flags", 1) == 1).alias("has_first_flag"))
    return decoded.join(first, "item")


@register("column_summary", """
WITH x AS (SELECT unnest(range(len(embedding))) AS dim, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)
SELECT CAST(dim AS INTEGER) AS dim, round(avg(x), 6) AS mean, round(min(x), 6) AS min, round(max(x), 6) AS max,
       round(var_samp(x), 9) AS variance, count(CASE WHEN x <> 0 THEN 1 END) AS num_nonzeros
FROM x GROUP BY dim
""")
def column_summary(spark, sf_dir):
    s = encode.column_summary(Tables(spark, sf_dir).embeddings, "embedding")
    return s.select("dim", F.round("mean", 6).alias("mean"), F.round("min", 6).alias("min"),
                    F.round("max", 6).alias("max"), F.round("variance", 9).alias("variance"),
                    "num_nonzeros")


_SCALE_SQL = """
WITH x AS (SELECT vec_id, unnest(range(len(embedding))) AS dim, unnest(CAST(embedding AS DOUBLE[])) AS x
           FROM embeddings),
s AS (SELECT dim, avg(x) AS m, stddev_samp(x) AS sd FROM x GROUP BY dim)
SELECT x.vec_id, CAST(x.dim AS INTEGER) AS dim, round({expr}, 6) AS value
FROM x JOIN s ON x.dim = s.dim
"""


@register("standardise", _SCALE_SQL.format(expr="CASE WHEN s.sd = 0 THEN 0.0 ELSE (x.x - s.m) / s.sd END"))
def standardise(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    z = encode.standardise(e, "embedding", "z")
    return z.select("vec_id", F.posexplode("z").alias("dim", "value")) \
        .select("vec_id", "dim", F.round("value", 6).alias("value"))


@register("centre", _SCALE_SQL.format(expr="x.x - s.m"))
def centre(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    c = encode.centre(e, "embedding", "c")
    return c.select("vec_id", F.posexplode("c").alias("dim", "value")) \
        .select("vec_id", "dim", F.round("value", 6).alias("value"))


@register("image_round_trip", """
WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) AS j,
                  CAST(floor(abs(CAST(unnest(embedding) AS DOUBLE)) * 1000) AS BIGINT) % 256 AS v FROM embeddings)
SELECT vec_id, count(*) AS n_pixels, CAST(sum(v) AS DOUBLE) AS pixel_sum, CAST(sum(v * j) AS DOUBLE) AS weighted_sum
FROM x GROUP BY vec_id
""")
def image_round_trip(spark, sf_dir):
    """Embeddings as grey PNG images, written to the shared folder, read again,
    decoded and summed: every pixel with its place."""
    from ..sources import images
    from ..sources.files import materialise
    e = Tables(spark, sf_dir).embeddings
    grey = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 1000) % 256)
    rows = e.select(F.col("vec_id").cast("string").alias("path"), grey.alias("pixels"))
    stored = materialise(images.encode_images(rows, "pixels"), "images")
    read = images.pixel_vectors(images.decode_images(stored).filter("data is not null"), None, None)
    total = F.aggregate("pixels", F.lit(0.0), lambda s, x: s + x)
    placed = F.aggregate(F.transform("pixels", lambda x, i: x * (i + 1)), F.lit(0.0), lambda s, x: s + x)
    return read.select(F.col("path").cast("long").alias("vec_id"), F.size("pixels").cast("long").alias("n_pixels"),
                       total.alias("pixel_sum"), placed.alias("weighted_sum"))
