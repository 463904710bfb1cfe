"""Next-page links of listings, and how far each page is from its seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from crawlfold.functions import html as H
from crawlfold.operators.skew import SALTS, salted_lookup
from crawlfold.session import written


def next_links(pages: DataFrame) -> DataFrame:
    """Edges url -> next_url of all listing pages that have a next-page link.

    Of a page fetched several times the newest counts, even if it has no link any more.
    """
    pager = H.block(F.col("html"), "div", "class", "page")
    link = H.first(pager, H.opening("a", "class", "next"), 0)
    links = H.once(pages.select("url", "fetched_at", H.attribute(link, "href").alias("next_url")))
    newest = links.groupBy("url").agg(F.max(F.struct("fetched_at", "next_url")).alias("_last"))
    found = newest.select("url", F.col("_last.next_url").alias("next_url"))
    return H.unescaped(found.filter(F.col("next_url") != ""), "next_url")


def depth(edges: DataFrame, seeds: DataFrame, salts: int = SALTS) -> DataFrame:
    """Fewest next-page steps from a seed to every page reached, as `(url, depth)`.

    Links are doubled: round k knows the pages 2^k steps ahead and extends the reached pages
    to distance 2^(k+1) - 1. A chain of n pages takes log2(n) rounds instead of n, and cycles
    end once nothing new is reached. Every edge counts, also several of one page. Each round
    is stored, so a lost executor does not replay the earlier ones.
    """
    jump = written(edges.select("url", F.col("next_url").alias("ahead")).distinct())
    reached = written(seeds.select("url", F.lit(0).alias("depth")).distinct())
    known, step = -1, 1
    while True:
        ahead = reached.join(jump, "url").select(
            F.col("ahead").alias("url"), (F.col("depth") + step).alias("depth")
        )
        # Counted while it is written.
        seen = Observation()
        reached = written(
            reached.unionByName(ahead).groupBy("url").agg(F.min("depth").alias("depth")).observe(seen, F.count(F.lit(1)).alias("n"))
        )
        if seen.get["n"] == known:
            return reached
        known, step = seen.get["n"], step * 2
        # Many pages may point to the same page, so the lookup of its next page is salted.
        table = jump.select(F.col("url").alias("ahead"), F.col("ahead").alias("_further"))
        jump = written(
            salted_lookup(jump, table, "ahead", "url", salts)
            .select("url", F.col("_further").alias("ahead")).distinct()
        )
