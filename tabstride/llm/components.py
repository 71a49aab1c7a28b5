"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabstride.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def with_least(rows: DataFrame, key: str, value: str, name: str, parts: int) -> DataFrame:
    """Each row with the least ``value`` of all rows that have the same ``key``, as ``name``.

    A key's rows are dealt into ``parts`` parts by their value; only the parts' minima meet, so
    no task holds all rows of a frequent key.  Rows with a null key are left out, null values
    are no minimum.
    """
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(value), F.lit(parts)))
    minima = dealt.groupBy(key, "_part").agg(F.min(value).alias("_least"))
    whole = minima.withColumn(name, F.min("_least").over(Window.partitionBy(key))).drop("_least")
    return dealt.join(whole, [key, "_part"]).drop("_part")


def join_classes(
    rows: DataFrame, classes: DataFrame, copies: str, total: int, hot: int = 10_000
) -> DataFrame:
    """``rows`` joined with the row of ``classes`` (stored, one row per ``class``) of their class.

    A class that holds more than one in ``hot`` of the ``total`` rows is broadcast: there are
    fewer than ``hot`` of them, whatever the size.  The others are shuffled.
    """
    frequent = F.col(copies) * hot > total
    few = F.broadcast(classes.filter(frequent))
    spread = rows.join(few.select("class"), "class", "left_anti")
    return rows.join(few, "class").unionByName(spread.join(classes.filter(~frequent), "class"))


def _star(neighbours: DataFrame, large: bool, parts: int) -> DataFrame:
    """Link the larger (or the smaller) neighbours of each node to the smallest node around it."""
    around = with_least(neighbours, "a", "b", "m", parts).withColumn("m", F.least("a", "m"))
    if large:
        chosen = around.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        ends = [F.struct(F.col(c).alias("a"), F.col("m").alias("b")) for c in ("a", "b")]
        chosen = around.select(F.inline(F.array(*ends)))
    return chosen.filter("a != b").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node with a link; the component is its smallest node.

    Works on any ordered type.  Each round is two grouped minima and joins over the links,
    stored in the shared folder; a chain of n nodes takes about log n rounds.  The links of a
    hub are dealt into parts, as many as the root of the number of links.  Nulls are left
    out; links may repeat or lead from a node to itself (such a node alone is not returned).
    """
    now = stored(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b").distinct(), "links"
    )
    size, before, last = now.count(), -1, None
    # A round that leaves the number of links as it was may have changed them all the same.
    while size and (size != before or not now.join(last, ["a", "b"], "left_anti").isEmpty()):
        before, last, parts = size, now, math.isqrt(size)
        large = _star(_both_ways(now), large=True, parts=parts)
        downward = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        now = stored(_star(downward, large=False, parts=parts), "links")
        size = now.count()
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
