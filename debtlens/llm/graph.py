"""Connected components of a distributed graph, and links found within buckets of nodes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from debtlens.llm.hot import join_counted
from debtlens.llm.scratch import stored, tidy


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it can reach.

    Alternates two rewritings that keep components: each node hands its larger neighbours to
    its smallest one, then each hands its smaller neighbours to the smallest. The edges become
    stars round the smallest nodes in about as many steps as the logarithm of the longest path,
    and no step makes more edges than it was given. One pass over the nodes tells when they are stars.
    """
    pairs = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while not _stars(pairs):
        both = pairs.select("u", "v").union(pairs.select("v", "u"))
        # An aggregate and a join instead of collected neighbour lists: a hub's list is unbounded.
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        pairs = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _stars(pairs: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, or only larger ones."""
    up, down = (pairs.select(F.col(c).alias("node"), F.lit(n).alias("up")) for c, n in (("u", 1), ("v", 0)))
    seen = up.union(down).groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return seen.where("ups > 1 OR (ups = 1 AND least = 0)").isEmpty()


def linked(
    members: DataFrame,
    near: str,
    test: Callable[[DataFrame], DataFrame],
    labels: DataFrame | None = None,
    rounds: int | None = None,
    growth: int = 4,
) -> tuple[DataFrame | None, DataFrame]:
    """Labels (node, component) over links between nodes that share a bucket, and what is open.

    ``members`` has bucket, node, rank and what the condition ``near`` reads of both ends (columns
    of the hub are prefixed ``hub_``). ``test`` keeps the edges (a, b) that are links. In every
    bucket the nodes of least rank are hubs, joined to the nodes after them: stars, not pairs. A
    bucket is done when the nodes after its hubs are one component already, as links between them
    can't change anything; the others get a star round each of the next hubs, ``growth`` times as
    many as before. Edges never join nodes that are one component.

    With ``rounds`` it stops after so many; the members of buckets that aren't done are returned.
    Without, no link between components is left out, however large the bucket. ``labels`` are
    those known from before, None if there are no links.
    """
    rows = stored(members, "members")
    extra = [c for c in rows.columns if c not in ("bucket", "node", "rank")]
    links = None if labels is None else labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    # A hub is named by its place in its bucket's order.
    order = F.struct("rank", "node")
    hubs, done = 1, 0
    while True:
        if labels is None:
            current = rows.withColumn("component", F.col("node"))
        else:
            current = rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
            current = stored(current, "members")
        # One row per bucket: whether it is mixed, its first hub, and how many members meet there.
        first = F.min(F.struct(order.alias("place"), "component", *extra)).alias("hub")
        mixed = current.groupBy("bucket").agg(
            first, F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("many")
        )
        mixed = stored(mixed.where("low < high").drop("low", "high"), "hubs")
        if done == rounds or mixed.isEmpty():
            return labels, join_counted(rows, mixed.select("bucket", "many"), "bucket", "many", "node").select(*rows.columns)
        if hubs == 1:
            chosen = mixed.select("bucket", "many", "hub.*")
            last = chosen.select("bucket", "many", F.col("place").alias("last"))
        else:
            current = join_counted(current, mixed.select("bucket", "many"), "bucket", "many", "node").drop("many")
            number = F.row_number().over(Window.partitionBy("bucket").orderBy("rank", "node"))
            chosen = current.withColumn("number", number).where(F.col("number") <= hubs)
            chosen = stored(chosen.withColumn("place", order).drop("number", "rank", "node"), "hubs")
            last = chosen.groupBy("bucket").agg(F.max("place").alias("last")).join(mixed.select("bucket", "many"), "bucket")
            last = stored(last, "last")
        named = chosen.select("bucket", "place", *([] if hubs > 1 else ["many"]), *(F.col(c).alias(f"hub_{c}") for c in ["component", *extra]))
        # Every member of a large bucket meets its hubs in pieces of the bucket.
        met = join_counted(current, named, "bucket", "many", "node") if hubs == 1 else current.join(named, "bucket")
        stars = (
            met.where(order > F.col("place"))
            .where("component <> hub_component")
            .where(near)
            .select(F.least("place.node", "node").alias("a"), F.greatest("place.node", "node").alias("b"))
            .distinct()
        )
        found = stored(test(stars), "links")
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            labels = stored(components(links), "labels")
            links = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        # Hubs have met every node after them; buckets that weren't mixed are done.
        rows = join_counted(rows, last, "bucket", "many", "node").where(order > F.col("last")).select("bucket", "node", "rank", *extra)
        hubs, done = hubs * growth, done + 1
        tidy(rows.sparkSession)
