"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.tables import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node that has a link to another; root is the smallest node reachable.

    Rounds of two steps: hang the larger neighbours of a node under the smallest node next to it, then a node and its
    smaller neighbours under the smallest of them. Both take one minimum for each key, combined before the shuffle, and
    one join that may split a hot key. Each round is written, so lost executors repeat one round. Rounds grow with the
    logarithm of the size of a component. Null nodes and links to itself count for nothing.
    """
    pairs = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b")
    now, seen = stored(pairs.distinct(), "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        seen = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        hung = now.join(low, now.a == low.u).select(F.least("a", "low").alias("a"), "b").distinct()
        hung = stored(hung, "links")
        low = hung.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("low"))
        joined = hung.join(low, hung.b == low.u)
        ends = F.explode(F.array(F.struct(F.col("a").alias("n")), F.struct(F.col("b").alias("n")))).alias("e")
        now = stored(joined.select("low", ends).select(F.col("low").alias("a"), F.col("e.n").alias("b")).filter("a < b").distinct(), "links")
