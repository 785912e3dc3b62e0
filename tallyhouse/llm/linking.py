"""Connected groups over verified links, for candidates that share bucket keys. DataFrame code only.

Members of a bucket are not paired with each other. A round compares each member with one leader of
its bucket; what the links join needs no further comparison. Buckets whose members still belong to
several groups stay open for the next round, with other leaders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage

Verify = Callable[[DataFrame], DataFrame]


def components(links: DataFrame) -> DataFrame:
    """Group of each node of ``links`` (a, b: long), named by its smallest node: columns id, comp.

    Nodes hook onto their smallest neighbour, the hooks are shortened by pointer jumping, and the
    links are drawn between the groups made so far, until none is left. Each step is a table in
    the shared folder. The number of steps grows with the logarithm of the longest chain.
    """

    def between(a: F.Column, b: F.Column, df: DataFrame) -> DataFrame:
        pairs = df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        return cut_lineage(pairs.where("a < b").distinct(), "links")

    edges = between(F.col("a"), F.col("b"), links)
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = cut_lineage(
            both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("to")), "hooks"
        )
        while True:
            onward = hooks.select(F.col("id").alias("to"), F.col("to").alias("onward"))
            jumped = hooks.join(onward, "to").select("id", F.col("onward").alias("to"), (F.col("onward") != F.col("to")).alias("moved"))
            jumped = cut_lineage(jumped, "hooks")
            hooks = jumped.select("id", "to")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = hooks.select("id", F.col("to").alias("comp"))
        else:
            moved = hooks.select(F.col("id").alias("comp"), "to")
            labels = cut_lineage(
                labels.join(moved, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "labels"
            )
        a, b = hooks.select(F.col("id").alias("a"), F.col("to").alias("ta")), hooks.select(F.col("id").alias("b"), F.col("to").alias("tb"))
        edges = between(F.col("ta"), F.col("tb"), edges.join(a, "a").join(b, "b"))
    if labels is None:
        return links.select(F.col("a").alias("id"), F.col("a").alias("comp")).limit(0)
    return labels


def shared(members: DataFrame) -> DataFrame:
    """The members (key, id) of buckets that hold two or more different ids. The rows move once."""
    bucket = Window.partitionBy("key")
    ids = members.withColumns({"lo": F.min("id").over(bucket), "hi": F.max("id").over(bucket)})
    return ids.where("lo < hi").select("key", "id")


def labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with the group that each id has so far; alone, it is its own group."""
    return members.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def open_buckets(members: DataFrame) -> DataFrame:
    """The members (key, id, comp) of buckets that hold more than one group."""
    split = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    return members.join(cut_lineage(split.select("key"), "split"), "key")


def with_leader(members: DataFrame, rank: F.Column) -> DataFrame:
    """Pairs (a, b): each member with the highest ranked one of its bucket, unless they are of one
    group already. One row per pair, however many buckets it shares."""
    return with_best(members, members.groupBy("key").agg(F.max(F.struct(rank.alias("r"), F.col("id").alias("b"), F.col("comp").alias("to"))).alias("best")))


def with_best(members: DataFrame, best: DataFrame) -> DataFrame:
    """As ``with_leader``, for leaders (key, best) that are found already."""
    met = members.join(cut_lineage(best, "leaders"), "key").where(F.col("comp") != F.col("best.to"))
    return met.select(F.col("id").alias("a"), F.col("best.b").alias("b")).distinct()


def link(members: DataFrame, verify: Verify, rest: Verify, rounds: int = 3, few: int = 0) -> DataFrame:
    """Groups (id, comp) of the ids that share a bucket and whose link ``verify`` confirms.

    ``members`` (key, id) is a stored table. ``verify`` gets pairs (a, b) and returns those that
    are links. The first round's leaders are the members with the most company over all their
    buckets, as the middle of a cloud of copies has; later ones belong to the largest group and
    differ by bucket. ``rest`` gets the members (key, id, comp) of buckets that are open after
    that and returns all links between their groups, so no link within a bucket is lost. Buckets of
    at most ``few`` members, which have few pairs, go from the first round straight to ``rest``.
    """
    members = cut_lineage(shared(members), "members")
    company = cut_lineage(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "company")
    degree = cut_lineage(members.join(company, "key").groupBy("id").agg(F.sum("n").alias("degree")), "degree")
    ranked = members.join(degree, "id").withColumn("comp", F.col("id"))
    links = cut_lineage(verify(with_leader(ranked, F.struct("degree", -F.col("id")))), "verified")
    labels = cut_lineage(components(links), "labels")
    still = cut_lineage(open_buckets(labelled(members, labels)), "open")
    small, moved = still.limit(0), False
    if few:
        large = cut_lineage(still.groupBy("key").agg(F.count(F.lit(1)).alias("all")).where(F.col("all") > few).select("key"), "large")
        small, still = still.join(large, "key", "left_anti"), cut_lineage(still.join(large, "key", "left_semi"), "open")
    for i in range(1, rounds):
        if still.isEmpty():
            break
        size = cut_lineage(still.groupBy("comp").agg(F.count(F.lit(1)).alias("size")), "sizes")
        # A group's own best member first, so that sizes are joined to the groups of a bucket, not to its members.
        own = still.groupBy("key", "comp").agg(F.max(F.struct(F.xxhash64("key", "id", F.lit(i)).alias("r"), F.col("id").alias("b"))).alias("own")).join(size, "comp")
        best = own.groupBy("key").agg(F.max(F.struct("size", F.col("comp").alias("to"), "own.r", "own.b")).alias("best"))
        new = cut_lineage(verify(with_best(still, best)), "verified")
        if new.isEmpty():
            continue
        links = cut_lineage(links.union(new), "verified")
        labels = cut_lineage(components(links), "labels")
        moved = True
        still = cut_lineage(open_buckets(labelled(still.select("key", "id"), labels)), "open")
    if few:
        small = open_buckets(labelled(small.select("key", "id"), labels)) if moved else small
        still = cut_lineage(still.unionByName(small), "open")
    if still.isEmpty():
        return labels
    return components(links.union(rest(still)))
