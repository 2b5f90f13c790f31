"""Connected groups of nodes that share buckets and pass a test, without all pairs of a bucket.

Two nodes may be linked only if some bucket holds both. Testing all pairs of a bucket would be
quadratic in a group of copies, so each of some star rounds tests every node against one
centre of its buckets, if it isn't connected to it already. The first centre is the
member with the largest weight, the next ones are any.
Pairs that are still in different components after that are tested one by one; pairs within a
component need no test, since they can't change it. No possible link between components is left
out, so the components are those of all links.

Components come from alternating large and small stars: every node's edges are moved to its
smallest neighbour, with aggregates and joins only, until nothing changes.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import settle

STAR_ROUNDS = 2


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node of links(a, b) but roots."""
    edges = settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        small = moved.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        edges = settle(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def connect(postings: DataFrame, verify: Callable[[DataFrame], DataFrame], compatible, links: DataFrame | None = None, rounds: int = STAR_ROUNDS, last=None) -> DataFrame:
    """node and root of all nodes in components, but roots; `links` are known beforehand.

    `rounds` star rounds come before pairs are tested one by one; one is enough where compatible
    rejects nearly all that aren't linked.

    postings: bucket, node, size, weight (larger for nodes that are likely linked to many); must
    give the same rows each time it is read. compatible(x, y): a condition on two sizes, which may
    tell of the bucket, too; a link must meet it in one bucket at least. verify: of pairs a, b,
    those that are linked. last, if given, does the round after the stars on its own: of bucket, node,
    size and root, the links in each bucket between different roots.
    """
    roots = None if links is None else components(links)
    for number in range(rounds + 1):
        if roots is None:
            members = postings.withColumn("root", F.col("node"))
        else:
            members = postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            mixed = members.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("bucket")
            members = members.join(mixed, "bucket")
        if number == rounds and last is not None:
            new = settle(last(members).select("a", "b"))
            if new.isEmpty():
                break
            links = new if links is None else links.unionByName(new)
            roots = components(links)
            break
        if number < rounds:
            weight = -F.col("weight") if number == 0 else F.lit(0)
            chosen = F.struct(weight.alias("w"), F.xxhash64("node", F.lit(number)).alias("x"), "node", "size", "root")
            others = members.groupBy("bucket").agg(F.min(chosen).alias("h")).select("bucket", "h", "h.node", "h.size", "h.root")
        else:
            others = members.withColumn("h", F.lit(None))
        others = others.select("bucket", "h", F.col("node").alias("other"), F.col("size").alias("other_size"), F.col("root").alias("other_root"))
        first = F.col("node") < F.col("other")
        joined = members.join(others, "bucket").filter(F.col("root") != F.col("other_root"))
        if number < rounds:
            # Each member tries one centre, the first of those that its buckets have.
            tried = joined.filter(compatible(F.col("size"), F.col("other_size"))).groupBy("node")
            pairs = tried.agg(F.min("h").alias("h")).select("node", F.col("h.node").alias("other"))
        else:
            pairs = joined.filter(first & compatible(F.col("size"), F.col("other_size"))).select("node", "other")
        pairs = pairs.select(
            F.when(first, F.col("node")).otherwise(F.col("other")).alias("a"),
            F.when(first, F.col("other")).otherwise(F.col("node")).alias("b"),
        ).distinct()
        new = settle(verify(pairs).select("a", "b"))
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            roots = components(links)
    return components(links if links is not None else new) if roots is None else roots
