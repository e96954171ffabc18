"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import code_point_order, materialise

WORD = r"[^\x20\x09-\x0D]+"
_EPS = 1e-12


def source_targets(sized: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n, target) from rows (source, size).

    Sources in code-point order (null last) weigh ``weights`` in turn and
    share ``share`` times all words; a target stops at ``most`` times its
    source's size and the excess is shared again by weight until no target is
    above. In closed form: with sources ordered by cap / weight, the first k
    are capped, and the rest get a common level times their weight. The
    windows run over one row per source, never over documents.
    """
    src = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                  F.count(F.lit(1)).alias("n")), "sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(Window.orderBy(*code_point_order("source"))) - 1,
                             F.lit(len(weights))) + 1).cast("int"))
    ranked = src.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("w"), *code_point_order("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    ranked = (ranked.withColumn("level", level).withColumn("at", F.row_number().over(order))
              .withColumn("open", F.col("level") < F.col("cap") / F.col("w")))
    final = F.min(F.when(F.col("open"), F.struct("at", "level"))).over(everything)["level"]
    return ranked.select("source", "source_size", "n",
                         F.least("cap", F.coalesce(final, F.lit(float("inf"))) * F.col("w")).alias("target"))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` only."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def _settled(x: Column, extra: Column) -> Column:
    return F.struct(x["size"].alias("size"), x["u"].alias("u"), x["doc_id"].alias("doc_id"), extra.cast("int").alias("extra"))


def _carried(x: Column, p: Column) -> Column:
    return F.struct(x["size"].alias("size"), x["u"].alias("u"), x["doc_id"].alias("doc_id"),
                    F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p"))


def _against_rest(state: Column, unit: Column, level: int, seed: int, none: Column) -> Column:
    """One pivotal step of a leaf: a unit against all smaller ones of its group,
    which share one probability ``q`` and ``rest - size`` words.

    Words move from the one to the other until the unit or the rest is
    integral. The first is the rule, and the smaller units take up the
    difference; in the second the unit is held with what is left.
    """
    size, q, after = unit["size"], state["q"], state["rest"] - unit["size"]
    up, down = F.least(size * (1.0 - q), after * q), F.least(size * q, after * (1.0 - q))
    rises = _uniform(unit["u"], F.lit(level), F.lit(seed)) * (up + down) < down
    whole = F.when(rises, size * (1.0 - q) <= after * q).otherwise(size * q <= after * (1.0 - q))
    over = state["held"].isNotNull()
    last = after <= 0
    moved = F.when(rises, q - up / after).otherwise(q + down / after)
    held = (F.when(over, state["held"]).when(last, _carried(unit, q)).when(whole, none)
            .otherwise(_carried(unit, F.when(rises, q + up / size).otherwise(q - down / size))))
    extra = F.when(over, q).when(rises, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.struct(
        F.when(over | last, q).when(whole, F.greatest(F.lit(0.0), F.least(F.lit(1.0), moved)))
        .when(rises, F.lit(0.0)).otherwise(F.lit(1.0)).alias("q"),
        after.alias("rest"), held.alias("held"),
        F.when(over | (~last & whole), F.concat(state["done"], F.array(_settled(unit, extra)))).otherwise(state["done"]).alias("done"))


def _pair(state: Column, unit: Column, level: int, seed: int) -> Column:
    """One pivotal step above the leaves: words move between the carried unit
    and the next until one of them is integral; the other goes on."""
    held = state["held"]
    room, mass = held["size"] * (1.0 - held["p"]), held["size"] * held["p"]
    unit_room, unit_mass = unit["size"] * (1.0 - unit["p"]), unit["size"] * unit["p"]
    up, down = F.least(room, unit_mass), F.least(mass, unit_room)
    rises = _uniform(held["u"], unit["u"], F.lit(level), F.lit(seed)) * (up + down) < down
    held_stays = F.when(rises, unit_mass <= room).otherwise(unit_room <= mass)
    held_p = F.when(rises, held["p"] + up / held["size"]).otherwise(held["p"] - down / held["size"])
    unit_p = F.when(rises, unit["p"] - up / unit["size"]).otherwise(unit["p"] + down / unit["size"])
    first = held.isNull()
    return F.struct(
        F.when(first, unit).when(held_stays, _carried(held, held_p)).otherwise(_carried(unit, unit_p)).alias("held"),
        F.when(first, state["done"]).otherwise(F.concat(state["done"], F.array(
            F.when(held_stays, _settled(unit, F.when(rises, 0).otherwise(1)))
            .otherwise(_settled(held, F.when(rises, 1).otherwise(0)))))).alias("done"))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & a[k].eqNullSafe(b["_" + k])
    return same


def own_units(rows: DataFrame, keys: list[str], block: int = 8192) -> DataFrame:
    """The rows with a ``unit`` of their own: the j-th of several rows with
    equal ``keys`` (unit among them) gets a hash of unit and j, the first keeps it.

    Only repeated rows are numbered: written once, then counted in blocks of
    at most ``block`` rows, so a key of any size is not one task. Which of
    the equal rows gets which number is open.
    """
    often = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    often = materialise(often.select(*[F.col(k).alias("_" + k) for k in keys]), "repeated-units")
    if often.isEmpty():
        return rows
    same = _same(rows, often, keys)
    again = materialise(rows.join(often, same, "left_semi").withColumn("_at", F.monotonically_increasing_id()), "repeated-rows")
    again = again.withColumn("_part", F.floor(F.col("_at") / F.lit(block)))
    sizes = materialise(again.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n")), "repeated-parts")
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    ahead = sizes.select(*[F.col(k).alias("_" + k) for k in keys], F.col("_part").alias("__part"),
                         F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy("_at")) - 1
    again = again.withColumn("_j", within)
    again = (again.join(ahead, _same(again, ahead, [*keys, "_part"])).withColumn("_j", F.col("_j") + F.col("_before"))
             .withColumn("unit", F.when(F.col("_j") == 0, F.col("unit")).otherwise(F.xxhash64("unit", "_j"))))
    return rows.join(often, same, "left_anti").select(*rows.columns).unionByName(again.select(*rows.columns))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights=(3, 1, 2),
        share: float = 1.5, most: float = 2.0, seed: int = 11, fan_in: int = 256) -> DataFrame:
    """(doc_id, source, unit, size, source_size, target, copies, taken): one row per row of ``docs``.

    ``size`` is the number of words of the text (null: 0), ``copies`` how often
    the mix takes the document and ``taken`` = copies x size. Every document
    of a source has the expected number of copies target / source_size, at
    most ``most``; whole copies are certain and the fractions are rounded
    together by the pivotal method. A step moves words, not copies, so the
    words taken of a source differ from its target by less than the size of
    the unit that is left last. Draws come from hashes, so reruns agree.

    The units of a source are dealt by a hash to groups of about ``fan_in``
    and walked from the largest to the smallest: a unit is paired with all
    smaller ones of its group together, which then hold the difference, so the
    unit left over is as a rule a small one. Such units carry the
    remaining mass to the next level of the tree, where they meet in pairs,
    until a source has one unit left. A source of any size is thus many small
    groups, and each level is written to the shared folder. Only DataFrame
    functions run.

    Null sources form a source of their own, the last. A source of size 0 has
    target 0; a text without words is drawn alone. Null ids are kept; repeated rows are rounded one by one. An
    empty table gives an empty result. Other columns are ignored. ``unit`` is a
    hash of the text and the id; of rows that share id, source and text, the
    later ones get hashes of their own (``own_units``).
    """
    sized = materialise(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.xxhash64(text, id_col).alias("unit"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    numbered = own_units(sized, ["unit", "doc_id", "source"])
    sized = (sized if numbered is sized else materialise(numbered, "units")).withColumnRenamed("unit", "u")
    targets = materialise(source_targets(sized, weights, share, most), "targets")
    rate = F.least(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)),
                   F.lit(float(most)))
    sized = sized.withColumnRenamed("source", "_s")
    units = (sized.join(targets, sized["_s"].eqNullSafe(targets["source"])).drop("_s")
             .withColumn("rate", rate).withColumn("whole", F.floor(F.col("rate") + _EPS))
             .withColumn("p", F.when(F.col("rate") - F.col("whole") > _EPS, F.col("rate") - F.col("whole"))
                         .otherwise(F.lit(0.0))))
    group = ["source", "source_size", "target", "whole"]
    # without words a fraction moves no mass: those are drawn alone
    alone = F.when(_uniform(F.col("u"), F.lit(-2), F.lit(seed)) < F.col("p"), 1).otherwise(0)
    certain = units.filter("p = 0 or size = 0").select(*group, "doc_id", "u", "size", alone.alias("extra"))
    open_units = units.filter("p > 0 and size > 0").select(*group, "n", "size", "u", "doc_id", "p")
    settled, level = [certain], 0
    id_type = sized.schema["doc_id"].dataType.simpleString()
    none = F.lit(None).cast(f"struct<size:bigint,u:bigint,doc_id:{id_type},p:double>")
    no_units = F.array().cast(f"array<struct<size:bigint,u:bigint,doc_id:{id_type},extra:int>>")
    while True:
        if level == 0:
            start = F.struct(F.col("all")[0]["p"].alias("q"),
                             F.aggregate("all", F.lit(0).cast("bigint"), lambda n, x: n + x["size"]).alias("rest"),
                             none.alias("held"), no_units.alias("done"))
            walk = F.aggregate("all", start, lambda s, x: _against_rest(s, x, level, seed, none))
        else:
            start = F.struct(none.alias("held"), no_units.alias("done"))
            walk = F.aggregate("all", start, lambda s, x: _pair(s, x, level, seed))
        one = (open_units.withColumn("groups", F.ceil(F.col("n") / F.lit(fan_in)))
               .withColumn("g", F.pmod(F.xxhash64("u", F.lit(level)), F.col("groups")))
               .groupBy(*group, "groups", "g")
               .agg(F.reverse(F.array_sort(F.collect_list(F.struct("size", "u", "doc_id", "p")))).alias("all"))
               .withColumn("walk", walk))
        one = materialise(one.select(*group, "groups", "walk"), f"rounding-{level}")
        settled.append(one.select(*group, F.explode("walk.done").alias("d"))
                       .select(*group, "d.doc_id", "d.u", "d.size", "d.extra"))
        open_units = one.select(*group, F.col("groups").alias("n"), "walk.held.*").filter("p is not null")
        if (one.agg(F.max("groups")).first()[0] or 1) == 1:
            break
        level += 1
    last = open_units.select(*group, "doc_id", "u", "size",
                             F.when(_uniform(F.col("u"), F.lit(-1), F.lit(seed)) < F.col("p"), 1).otherwise(0).alias("extra"))
    out = last
    for s in settled:
        out = out.unionByName(s)
    copies = (F.col("whole") + F.col("extra")).cast("long")
    return out.select("doc_id", "source", F.col("u").alias("unit"), "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))
