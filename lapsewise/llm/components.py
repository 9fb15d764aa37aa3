"""Connected components, and the linking of ids that share keys without listing all pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lapsewise.llm.store import drop, written


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every id in ``links`` (a, b).

    Links are drawn ever closer to the smallest neighbour until they are stars around the smallest
    ids, in some log n rounds. A round is two minima per id, which combine before they are
    shuffled, and two equi-joins; its links are written, so no lineage grows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, state = _kept(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        far = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        far = far.where("a <> b").distinct()
        near = far.groupBy("a").agg(F.min("b").alias("low"))
        close = far.join(near, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        nearer, now = _kept(close.select("e.a", "e.b").where("a <> b").distinct())
        drop(edges)
        if now == state:
            break
        edges, state = nearer, now
    roots = nearer.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return roots.unionAll(nearer.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _kept(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges as a table, and a count and sum by which equal sets of edges are known."""
    seen = Observation()
    check = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    edges = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), check.alias("sum")), "links")
    return edges, seen.get


def link(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    rounds: int = 1,
    alike: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """id and component of all ids that are linked with another.

    ``members`` (key, id, rank; each id once under a key): ids that share a key may be linked. ``confirm`` takes pairs (a, b),
    a < b, and returns those that are; in
    the last round they have ``common``, the number of keys that both have. A key's group is led by the id of the
    smallest rank, and every id is first paired with one leader only, the one of the smallest rank
    among those of all its keys; further rounds pair, key by key, those that are not yet in the group's
    largest component with other leaders out of it. What then still lies in different components is
    paired in full, so every link between components is found, while ids that hang together
    cost a pair each, whatever number of keys they share. Where members have a ``mark``,
    ``alike`` says of two marks whether their ids can be linked at all.
    """
    marks = [] if alike is None else [F.col("mark").alias("mark2")]
    members = written(members, "members")
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = written(members.join(sizes, "key").drop("n"), "shared-keys")
    leaders = members.groupBy("key").agg(F.min(F.struct("rank", "id")).alias("lead"))
    led = members.join(leaders, "key").groupBy("id").agg(F.min("lead").alias("lead"))
    tried = written(_ordered(led, "id", "lead.id"), "pairs")
    labels = components(written(confirm(tried), "links"))
    for turn in range(rounds + 1):
        labels = written(labels, "labels")
        spread, outside = _outside(members, labels)
        if outside.isEmpty():
            return labels
        if turn < rounds:
            inside = spread.where("component = major")
            order = F.struct(F.xxhash64("id", F.lit(turn)), "id")
            lead = inside.groupBy("key").agg(F.min(order).alias("lead"))
            pairs = _ordered(outside.join(lead, "key"), "id", "lead.id")
        else:
            same = [F.col("id").alias("id2"), F.col("component").alias("component2"), *marks]
            other = spread.select("key", *same)
            once = (F.col("component2") == F.col("major")) | (F.col("id") < F.col("id2"))
            apart = (F.col("component") != F.col("component2")) & once
            if alike is not None:
                apart = apart & alike(F.col("mark"), F.col("mark2"))
            # Each key counts once for a pair, also where both lie outside the largest component.
            pairs = outside.join(other, "key").where(apart).groupBy(
                F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")
            )
            pairs = pairs.agg(F.count("*").alias("common"))
        pairs = written(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        # What is connected already goes on as stars: each id with its component.
        stars = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
        labels = components(stars.unionAll(confirm(pairs).select("a", "b")))
        tried = tried.unionAll(pairs.select("a", "b"))
    return labels


def _outside(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of groups that lie in several components, and those outside the group's largest."""
    marked = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    parts = marked.groupBy("key", "component").agg(F.count("*").alias("n"))
    major = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("m"), F.count("*").alias("parts"))
    major = major.where("parts > 1").select("key", F.col("m.component").alias("major"))
    spread = written(marked.join(major, "key"), "spread")
    return spread, spread.where("component <> major")


def _ordered(rows: DataFrame, one: str, other: str) -> DataFrame:
    pairs = rows.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b"))
    return pairs.where("a <> b").distinct()
