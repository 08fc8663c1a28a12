"""Mixing of sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsboard.llm.common import SPACE_CLASS, fresh, landed, row_key, uniform

#: Residuals and documents that meet in one node of the reduction tree, on average.
FAN_IN = 64


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE_CLASS}]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) for sizes by (source, source_size).

    Sources by code point, NULL last, get ``weights`` in turn.  Together they
    share ``share`` times all sizes by weight; none gets more than ``cap``
    times its own size, and what is over is shared again by weight.  That
    settles at ``min(cap * size, level * weight)`` for one level: sources are
    filled in the order of cap / weight, and the level is that of the first
    source whose cap is above what remains for it and those after.

    The windows run over one short row per source.
    """
    w = F.array(*[F.lit(float(x)) for x in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_w", F.get(w, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))))
    fill = Window.orderBy(F.col("_most") / F.col("_w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    filled = (
        ranked.withColumn("_most", cap * F.col("source_size"))
        .withColumn("_before", F.coalesce(F.sum("_most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_weight", F.sum("_w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_all", share * F.sum("source_size").over(whole))
        .withColumn("_level", (F.col("_all") - F.col("_before")) / F.col("_weight"))
        .withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_most"))
        .withColumn("_at", F.max(F.when(F.col("_open"), F.col("_level"))).over(whole))
    )
    level = F.coalesce(F.least("_most", F.col("_at") * F.col("_w")), F.col("_most"))
    return filled.select("source", "source_size", level.cast("double").alias("target"))


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pair(carry: Column, unit: Column, seed: int) -> Column:
    """Move mass between two fractional units until one is integral.

    Returns (rest, done): ``done`` holds the units that became integral, with
    p 0 or 1, ``rest`` the one that did not, or NULL.  What one unit loses in
    p times mass the other one gains, and each keeps its expectation.
    """

    def moved(s: Column) -> Column:
        a, b, up, down = s["a"], s["b"], s["up"], s["down"]
        rise = uniform(a["key"], b["key"], F.lit(seed)) * (up + down) < down
        room_a, have_b = (1 - a["p"]) * a["mass"], b["p"] * b["mass"]
        have_a, room_b = a["p"] * a["mass"], (1 - b["p"]) * b["mass"]
        pa = F.when(rise, F.when(room_a <= have_b, 1.0).otherwise(a["p"] + up / a["mass"])).otherwise(
            F.when(have_a <= room_b, 0.0).otherwise(a["p"] - down / a["mass"])
        )
        pb = F.when(rise, F.when(have_b <= room_a, 0.0).otherwise(b["p"] - up / b["mass"])).otherwise(
            F.when(room_b <= have_a, 1.0).otherwise(b["p"] + down / b["mass"])
        )
        return F.array(a.withField("p", pa), b.withField("p", pb))

    values = F.struct(
        carry.alias("a"),
        unit.alias("b"),
        F.least((1 - carry["p"]) * carry["mass"], unit["p"] * unit["mass"]).alias("up"),
        F.least(carry["p"] * carry["mass"], (1 - unit["p"]) * unit["mass"]).alias("down"),
    )
    open_ = lambda x: (x["p"] > 0) & (x["p"] < 1)
    return _let(
        _let(values, moved),
        lambda both: F.struct(
            F.get(F.filter(both, open_), F.lit(0)).alias("rest"),
            F.filter(both, lambda x: ~open_(x)).alias("done"),
        ),
    )


def _round_node(units: Column, unit_type: str, seed: int) -> Column:
    """(rest, done) of all units of a node, paired one after the other."""
    start = F.struct(
        F.lit(None).cast(unit_type).alias("rest"), F.array().cast(f"array<{unit_type}>").alias("done")
    )

    def step(acc: Column, unit: Column) -> Column:
        met = _let(
            _pair(acc["rest"], unit, seed),
            lambda m: F.struct(m["rest"].alias("rest"), F.concat(acc["done"], m["done"]).alias("done")),
        )
        return F.when(acc["rest"].isNull(), F.struct(unit.alias("rest"), acc["done"].alias("done"))).otherwise(met)

    return F.aggregate(units, start, step)


def pivotal_rounding(units: DataFrame, group: str, seed: int, fan_in: int = FAN_IN) -> DataFrame:
    """(key, up) for units (``group``, key, mass, p) with 0 < p < 1, mass > 0:
    each unit goes up (1) with probability p or not (0), and a group's sum of
    ``mass * up`` differs from its sum of ``mass * p`` by less than one mass.

    A reduction tree: units are dealt to nodes of ``fan_in`` by a hash, so a
    group that holds a third of all rows fills a third of the nodes.  A node
    pairs its units and sends at most one residual on; ``fan_in`` neighbours
    meet in the next level, until a group has a single residual, which is
    settled by its own draw.  Levels are as many as the logarithm of the
    largest group, and each is written to the shared folder once.
    """
    unit_type = "struct<key:binary,mass:double,p:double>"
    sizes = units.groupBy(group).agg(F.ceil(F.count("*") / fan_in).alias("_nodes"))
    sizes = sizes.withColumn(group, F.col(group))
    most = sizes.agg(F.max("_nodes")).first()[0] or 0
    level = (
        units.join(sizes, units[group].eqNullSafe(sizes[group]), "left")
        .select(
            units[group],
            F.pmod(F.xxhash64("key", F.lit(seed)), F.col("_nodes")).alias("_node"),
            F.struct("key", F.col("mass").cast("double").alias("mass"), F.col("p").cast("double").alias("p")).alias("u"),
        )
    )
    settled, width = [], int(most)
    while most:
        nodes = landed(
            level.groupBy(group, "_node")
            .agg(F.sort_array(F.collect_list("u")).alias("us"))
            .select(group, "_node", _round_node(F.col("us"), unit_type, seed).alias("r")),
            "pivotal",
        )
        settled.append(nodes.select(F.inline("r.done")).select("key", F.col("p").cast("int").alias("up")))
        rest = nodes.filter(F.col("r.rest").isNotNull())
        if width <= 1:
            last = rest.select("r.rest.*")
            draw = uniform(F.col("key"), F.lit(seed), F.lit("last")) < F.col("p")
            settled.append(last.select("key", draw.cast("int").alias("up")))
            break
        level = rest.select(group, F.floor(F.col("_node") / fan_in).alias("_node"), F.col("r.rest").alias("u"))
        width = -(-width // fan_in)
    if not settled:
        return units.select("key", F.lit(0).alias("up")).limit(0)
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 42,
) -> DataFrame:
    """How often the mix takes each document.

    Returns one row per distinct (id, source, text): key, id, source, size (in
    words), rows (its number of rows in ``docs``), source_size, target, copies
    and taken, where ``taken = copies * size`` for each of its rows.

    A source's documents want ``target / source_size`` copies each.  The whole
    part is given to all of them; the fraction is settled by pivotal rounding
    weighted by size, so a source's taken words differ from its target by less
    than its largest unit.  Draws depend on content and ``seed`` only: reruns
    agree.

    Rows with equal id, source and text are one unit and share their number of
    copies.  A NULL text has size 0, a NULL source is a source of its own, a
    NULL id is a value like others.  Units of size 0 draw alone; they move no
    mass.  No rows give no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        row_key(F.col(id_col), F.col(source), F.col(text)).alias("key"),
    )
    units = landed(rows.groupBy("key", "id", "source", "size").agg(F.count("*").alias("rows")), "units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = landed(source_targets(sizes, weights, share, cap).coalesce(1), "targets")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    aimed = (
        units.alias("u")
        .join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source")), "left")
        .select("u.*", "source_size", "target", wanted.alias("wanted"))
        .withColumn("whole", F.floor("wanted"))
        .withColumn("p", F.col("wanted") - F.col("whole"))
    )
    aimed = landed(aimed, "aimed")
    paired = aimed.filter((F.col("p") > 0) & (F.col("size") > 0)).select(
        "source", "key", (F.col("size") * F.col("rows")).alias("mass"), "p"
    )
    ups = pivotal_rounding(paired, "source", seed)
    alone = (uniform(F.col("key"), F.lit(seed), F.lit("alone")) < F.col("p")).cast("int")
    copies = F.col("whole") + F.coalesce("up", alone)
    return (
        aimed.join(ups, "key", "left")
        .withColumn("copies", copies.cast("bigint"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("key", "id", "source", "size", "rows", "source_size", "target", "copies", "taken")
    )


def apply_mix(
    docs: DataFrame, mix: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """``docs`` with every row as often as ``mix`` (of ``mix_sources``) takes it."""
    key, copies, copy = fresh(docs, "key", "copies", "copy")
    taken = mix.filter(F.col("copies") > 0).select(F.col("key").alias(key), F.col("copies").alias(copies))
    return (
        docs.withColumn(key, row_key(F.col(id_col), F.col(source), F.col(text)))
        .join(taken, key)
        .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies))))
        .select(*docs.columns)
    )
