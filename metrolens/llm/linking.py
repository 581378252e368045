"""Connected groups of rows that share buckets, without all pairs of a bucket.

``link`` gets entries (bucket key, node) and a check of pairs. Rounds: each bucket elects a hub; every node is checked
against HUBS hubs of other groups, the least of its buckets' hubs by a hash that changes with the round, and groups
are joined. When few pairs of different groups are left in the buckets, or a round finds no link, all of these
are checked. So no pair of one bucket goes untested unless both rows are in one group already: the groups are those
that all pairs would give, while a bucket of n near copies costs about HUBS * n checks a round.

Groups only grow, so a bucket whose rows are all of one group is left behind for good, and a round's links are joined
between groups, not between all their rows. Frames of the rounds are written in as many files as their rows ask for:
late rounds over few rows would else write a small file for each shuffle partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from metrolens.llm.common import written, written_count

#: Hub rounds go on while the untested pairs number more than this for each node in shared buckets.
PAIRS_PER_NODE = 4
MAX_ROUNDS = 5
HUBS = 3
ROWS_A_FILE = 100_000
PAIRS_A_FILE = 2_000  # of the check, which reads the rows themselves


def files_for(rows: int, a_file: int = ROWS_A_FILE) -> int:
    return 6 + rows // a_file


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """(node, component) of all nodes in ``edges`` (a, b): component is the smallest node reachable."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), files)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component"))
    labels = written(labels, files)
    while True:
        heard = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                 .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard")))
        lower = labels.join(heard, "node").select("node", "component", F.least("component", "heard").alias("lower"))
        jump = labels.select(F.col("node").alias("lower"), F.col("component").alias("beyond"))
        step = lower.join(jump, "lower").select("node", F.least("lower", "beyond").alias("component"),
                                                (F.least("lower", "beyond") != F.col("component")).alias("moved"))
        seen = Observation()
        step = written(step.observe(seen, F.count(F.when(F.col("moved"), 1)).alias("moved")), files)
        labels = step.select("node", "component")
        if not seen.get["moved"]:
            return labels


def shared_buckets(entries: DataFrame) -> DataFrame:
    """The entries whose bucket holds at least two."""
    many = entries.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k")
    return written(entries.join(many, "k", "left_semi"))


def link(live: DataFrame, details: DataFrame, check: Callable[[DataFrame], DataFrame], may: Callable[[str, str], Column],
         sketches: DataFrame | None = None, alike: Callable[[str, str], Column] | None = None,
         pairs_per_node: int = PAIRS_PER_NODE) -> DataFrame | None:
    """Groups of the nodes in ``live`` (k, node), a written frame of shared buckets.

    ``check`` returns the rows of pairs (a, b) that are linked. ``may(x, y)`` is a cheap condition that linked pairs
    meet, on the columns of ``details`` (node, ...) of two aliased rows; ``alike`` is a further one on the wide rows
    of ``sketches``, used on the buckets left in the end; ``pairs_per_node`` is what may be left to it. Returns (node, component) or None if nothing is linked.
    """
    extras = [c for c in details.columns if c != "node"]
    nodes = live.select("node").distinct().count()
    now, rows = written_count(live.join(details, "node").select("k", "node", F.col("node").alias("comp"), *extras))
    tested, steps, idle = None, [], False
    for turn in range(MAX_ROUNDS + 1):
        own = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", *extras)).alias("own")
        per = now.groupBy("k", "comp").agg(F.count(F.lit(1)).cast("double").alias("m"), own)
        per = per.groupBy("k").agg(((F.sum("m") * F.sum("m") - F.sum(F.col("m") * F.col("m"))) / 2).alias("pairs"),
                                   F.min(F.struct("own.h", "own.node", "comp", *(f"own.{c}" for c in extras))).alias("hub"))
        seen = Observation()
        open_ = written(per.filter("pairs > 0").observe(seen, F.sum("pairs").alias("pairs")), files_for(rows))
        left = seen.get["pairs"] or 0
        if not left:
            break
        final = left <= pairs_per_node * nodes or turn == MAX_ROUNDS or idle
        if final:
            wide, fits = now.join(open_.select("k"), "k", "left_semi"), may
            if sketches is not None:
                wide = wide.join(sketches, "node")
                fits = lambda a, b: may(a, b) & alike(a, b)
            x, y = wide.alias("x"), wide.alias("y")
            pairs = x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.comp") != F.col("y.comp")) & fits("x", "y"))
            pairs = pairs.select("x.node", "x.comp", F.struct(F.col("y.node").alias("node"), F.col("y.comp").alias("comp")).alias("hub"))
        else:
            x, y = now.alias("x"), open_.select("k", "hub.*").alias("y")
            near = x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.comp") != F.col("y.comp")) & may("x", "y"))
            least = F.slice(F.array_sort(F.collect_set(F.struct("y.h", "y.node", "y.comp"))), 1, HUBS)  # of a node's few buckets
            pairs = near.groupBy("x.node", "x.comp").agg(least.alias("least")).select("node", "comp", F.explode("least").alias("hub"))
        first = F.col("node") < F.col("hub.node")
        pairs = pairs.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"),
                             F.when(first, F.col("comp")).otherwise(F.col("hub.comp")).alias("ca"),
                             F.when(first, F.col("hub.comp")).otherwise(F.col("comp")).alias("cb")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs, n = written_count(pairs, files_for(rows))
        idle = not n
        if not idle:
            found, links = written_count(check(pairs.select("a", "b")).select("a", "b"), files_for(n, PAIRS_A_FILE))
            tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))  # written already
            idle = not links
            if not idle:
                between = pairs.join(found, ["a", "b"], "left_semi").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
                steps.append(components(between, files_for(links)))
        if final:
            break
        now = now.join(open_.select("k"), "k", "left_semi")
        if not idle:
            now = now.join(steps[-1].withColumnRenamed("node", "comp"), "comp", "left").withColumn("comp", F.coalesce("component", "comp"))
        now, rows = written_count(now.select("k", "node", "comp", *extras), files_for(rows))
    if not steps:
        return None
    labels = live.select("node", F.col("node").alias("component")).distinct()
    for step in steps:  # a few written maps from groups to the groups that hold them
        beyond = step.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        labels = labels.join(beyond, "component", "left").select("node", F.coalesce("beyond", "component").alias("component"))
    return written(labels)
