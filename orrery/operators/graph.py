"""Edge tables: what feeds a node, how deep it lies, who else uses it.

Edges are (src, dst) rows: src feeds or calls dst. Loops run until nothing is left
to do, and each round is written under one shared folder, so plans stay short and a
lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.workspace import materialise, new_folder, observed


class CycleError(ValueError):
    """Layers were asked of edges that run in a circle."""


def upstream(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """(target, upstream): every node that feeds a target, directly or through others.

    `targets` has one column `target`. Each round joins only the newly found nodes to
    the edges; pairs seen before are dropped, so circles end too.
    """
    spark = edges.sparkSession
    edges = materialise(edges.select("src", "dst"), "edges")
    frontier = targets.select("target", F.col("target").alias("node")).distinct()
    found, seen = new_folder(spark, "upstream"), None
    rounds = 0
    while True:
        step = (
            frontier.join(edges, F.col("node") == F.col("dst"))
            .select("target", F.col("src").alias("node"))
            .distinct()
        )
        if seen is not None:
            step = step.join(seen.select("target", "node"), ["target", "node"], "left_anti")
        step.write.parquet(f"{found}/round={rounds}")
        seen = spark.read.schema(step.schema.add("round", "long")).parquet(found)
        frontier = seen.filter(F.col("round") == rounds).select("target", "node")
        if frontier.isEmpty():
            return seen.select("target", F.col("node").alias("upstream"))
        rounds += 1


def _peeled(edges: DataFrame, end: str = "src", other: str = "dst") -> tuple[DataFrame, int, int]:
    """Edges round by round, the number of rounds, and how many edges never go.

    A round keeps the edges whose `end` is the `other` end of an edge that the round before
    kept. What is kept is stored, so a round costs as much as there is left, and the rounds
    end when nothing goes any more. Repeated edges play no part.
    """
    spark, schema = edges.sparkSession, edges.select("src", "dst").schema
    folder, before, kept, rounds = new_folder(spark, "peeled"), None, None, 0
    left = edges.select("src", "dst")
    while True:
        counted = Observation()
        left.observe(counted, F.count(F.lit(1)).alias("edges")).write.parquet(f"{folder}/round={rounds}")
        before, kept = kept, observed(counted, "edges")
        if not kept or kept == before:
            stored = spark.read.schema(schema.add("round", "integer")).parquet(folder)
            return stored, rounds, kept
        stored = spark.read.schema(schema).parquet(f"{folder}/round={rounds}")
        left = stored.join(stored.select(F.col(other).alias(end)).distinct(), end, "left_semi").select("src", "dst")
        rounds += 1


def dependency_layers(edges: DataFrame) -> DataFrame:
    """(node, layer): length of the longest path from a node without incoming edges.

    A round takes off the edges of nodes that nothing feeds any more; a node lies one layer
    behind the last round in which something fed it. What never goes runs in a circle or
    hangs on one, which is reported; `layers_of_circles` takes such edges.
    """
    stored, rounds, kept = _peeled(edges)
    if kept:
        left = stored.filter(F.col("round") == rounds).select("dst").distinct().count()
        raise CycleError(f"{left} nodes run in a circle or hang on one")
    fed = stored.select(F.col("dst").alias("node"), (F.col("round") + 1).alias("layer"))
    roots = stored.filter("round = 0").select(F.col("src").alias("node"), F.lit(0).alias("layer"))
    return fed.unionByName(roots).groupBy("node").agg(F.max("layer").alias("layer"))


def _without(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges that touch none of the nodes."""
    for end in ("src", "dst"):
        edges = edges.join(nodes.select(F.col("node").alias(end)), end, "left_anti")
    return edges


def _cyclic_core(edges: DataFrame) -> DataFrame:
    """Edges of circles and between them: neither end is free of circles behind or ahead of it.

    What leads nowhere goes first, then what nothing feeds; that makes no new dead ends.
    """
    for end, other in (("dst", "src"), ("src", "dst")):
        stored, rounds, _ = _peeled(edges, end, other)
        edges = stored.filter(F.col("round") == rounds).select("src", "dst")
    return edges


def _colours(edges: DataFrame) -> DataFrame:
    """(node, colour): the smallest node from which a node can be reached, itself included.

    A round offers only colours that changed in the one before; the smallest offer
    is found before the shuffle, so a node fed by many costs one row a task.
    """
    ends = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    colours = materialise(ends.select("node", F.col("node").alias("colour")), "colours")
    changed = colours
    while True:
        offers = (
            changed.join(edges, F.col("node") == F.col("src"))
            .groupBy(F.col("dst").alias("node"))
            .agg(F.min("colour").alias("offered"))
        )
        smaller = offers.join(colours, "node").filter("offered < colour")
        changed = materialise(smaller.select("node", F.col("offered").alias("colour")), "changed")
        if changed.isEmpty():
            return colours
        newer = changed.withColumnRenamed("colour", "newer")
        colours = materialise(
            colours.join(newer, "node", "left").select(
                "node", F.coalesce("newer", "colour").alias("colour")
            ),
            "colours",
        )


def circles(edges: DataFrame) -> DataFrame:
    """(node, component): the nodes on a circle, with the smallest node of those they share one with.

    Strongly connected components by forward colouring and backward search (Orzan 2004).
    What lies before or behind all circles is taken off first, by rounds that shrink. Then every node takes the
    smallest node that reaches it as its colour. A node of its own colour is the smallest
    of its component, which is what reaches it inside the colour; no component has two
    colours. What is left inside the colours is searched again. A node alone is on a
    circle only if it feeds itself. Edges with a null end are left out; repeated ones
    count once.
    """
    spark = edges.sparkSession
    stored = materialise(edges.select("src", "dst").dropna(), "edges")
    folder = new_folder(spark, "circles")
    own = stored.filter("src = dst").select(F.col("src").alias("node"), F.col("src").alias("component")).distinct()
    schema = own.schema
    stepped = T.StructType([*schema.fields, T.StructField("step", T.IntegerType())])
    own.write.parquet(f"{folder}/part=0")
    left, part = stored.filter("src <> dst"), 1
    while True:
        left = materialise(_cyclic_core(left).distinct(), "core")
        if left.isEmpty():
            break
        colours = _colours(left)
        of = lambda end: colours.select(F.col("node").alias(end), F.col("colour").alias(f"{end}_colour"))
        inside = materialise(
            left.join(of("src"), "src").join(of("dst"), "dst").filter("src_colour = dst_colour")
            .select("src", "dst", F.col("src_colour").alias("component")),
            "inside",
        )
        found = new_folder(spark, "members")
        roots = inside.filter("dst = component").select(F.col("dst").alias("node"), "component")
        roots.distinct().write.parquet(f"{found}/step=0")
        members = spark.read.schema(stepped).parquet(found)
        step = 0
        while not (frontier := members.filter(F.col("step") == step)).isEmpty():
            reached = (
                frontier.select("node").join(inside, F.col("node") == F.col("dst"))
                .select(F.col("src").alias("node"), "component").distinct()
                .join(members.select("node"), "node", "left_anti")
            )
            step += 1
            reached.write.parquet(f"{found}/step={step}")
            members = spark.read.schema(stepped).parquet(found)
        # a root that nothing of its colour reaches is alone; it has no edge inside
        members.select("node", "component").write.parquet(f"{folder}/part={part}")
        left = _without(inside.select("src", "dst"), members)
        part += 1
    # a node that feeds itself may be on a larger circle as well
    every = spark.read.schema(schema).parquet(folder)
    return every.groupBy("node").agg(F.min("component").alias("component"))


def layers_of_circles(edges: DataFrame) -> DataFrame:
    """(node, component, layer): longest path to a node where each circle counts as one node.

    `component` is the smallest node of those that reach each other, a node on no circle
    is its own. For edges without circles the layers are those of `dependency_layers`.
    """
    pairs = materialise(edges.select("src", "dst").dropna(), "edges")
    found = materialise(circles(pairs), "circles")
    of = lambda end: found.select(F.col("node").alias(end), F.col("component").alias(f"{end}_circle"))
    between = (
        pairs.join(of("src"), "src", "left").join(of("dst"), "dst", "left")
        .select(F.coalesce("src_circle", "src").alias("src"), F.coalesce("dst_circle", "dst").alias("dst"))
        .filter("src <> dst")
    )
    layers = dependency_layers(between).withColumnRenamed("node", "component")
    # a circle that nothing leads to or from has no edge between, all other nodes have one
    on = found.join(layers, "component", "left").select(
        "node", "component", F.coalesce("layer", F.lit(0)).alias("layer")
    )
    off = layers.join(found.select(F.col("node").alias("component")), "component", "left_anti")
    return on.unionByName(off.select(F.col("component").alias("node"), "component", "layer"))


def _distinct_calls(calls: DataFrame) -> DataFrame:
    """One row per caller and callee with the number of calls."""
    return calls.groupBy("caller", "callee").agg(F.count("*").alias("calls"))


def exclusive_callees(calls: DataFrame, group_from: int = 4) -> DataFrame:
    """Callees with a single caller; `grouped` tells whether the caller has enough to group.

    Sizes are counted per caller first and joined back, so no list of callees is
    ever gathered into one row. Both sides of that join are stored tables, which lets
    adaptive execution split a caller that owns much of them.
    """
    pairs = _distinct_calls(calls)
    single = materialise(
        pairs.groupBy("callee")
        .agg(F.count("*").alias("callers"), F.min("caller").alias("caller"))
        .filter("callers = 1")
        .select("caller", "callee"),
        "exclusive",
    )
    sizes = materialise(single.groupBy("caller").agg(F.count("*").alias("exclusive")), "sizes")
    return single.join(sizes, "caller").select(
        "caller", "callee", "exclusive", (F.col("exclusive") >= group_from).alias("grouped")
    )


def utility_callees(
    calls: DataFrame, services: DataFrame, repeated_from: int = 2
) -> DataFrame:
    """Services that one caller calls several times and that call no other service.

    `services` (column `service`) are the package's own; a callee outside it is none
    of them, and calling such a one, an adapter say, keeps a service a utility.
    """
    own = services.select(F.col("service").alias("callee")).distinct()
    repeated = (
        _distinct_calls(calls)
        .groupBy("callee")
        .agg(F.max("calls").alias("most_calls"), F.sum("calls").alias("calls"))
        .filter(F.col("most_calls") >= repeated_from)
    )
    busy = (
        calls.select(F.col("caller").alias("callee"), F.col("callee").alias("service"))
        .join(services.select("service").distinct(), "service", "left_semi")
        .select("callee")
        .distinct()
    )
    return repeated.join(own, "callee", "left_semi").join(busy, "callee", "left_anti")


def unfed(declared: DataFrame, edges: DataFrame) -> DataFrame:
    """Declared nodes (column `node`) that no edge feeds."""
    fed = edges.select(F.col("dst").alias("node")).distinct()
    return declared.select("node").distinct().join(fed, "node", "left_anti")
