"""Seed and detail URLs, and the way back from a seed URL to its labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlfold.functions import html as H
from crawlfold.operators import detail
from crawlfold.params import SITE, Site
from crawlfold.sources import dims


def areas_of_level(areas: DataFrame, level: int) -> DataFrame:
    """Areas of exactly one level."""
    return areas.filter(F.col("level") == level)


def areas_up_to(areas: DataFrame, level: int, repeat: bool = False) -> DataFrame:
    """Areas of all levels up to `level`.

    With `repeat`, every pass emits the earlier levels again, so an area of level k comes
    out level - k + 1 times.
    """
    chosen = areas.filter(F.col("level") <= level)
    if not repeat:
        return chosen
    passes = F.sequence(F.col("level"), F.lit(level))
    return chosen.withColumn("pass", F.explode(passes)).drop("pass")


def seed_urls(areas: DataFrame, site: Site = SITE) -> DataFrame:
    """One URL per area and cuisine.

    The cuisine list is fixed and short, so it is exploded from a literal: a narrow step
    that scales with the areas, with neither a join nor a shuffle.
    """
    codes = F.array(*[F.lit(code) for code in dims.CUISINES.values()])
    return areas.select("area_code", F.explode(codes).alias("cuisine_code")).select(
        "area_code", "cuisine_code",
        F.concat(F.lit(site.seed_base), "area_code", "cuisine_code").alias("url"),
    )


def decode_seed_urls(pages: DataFrame, areas: DataFrame) -> DataFrame:
    """Label rows that carry a seed URL with area, district and cuisine."""
    tail = r"([rc]\d+)(g\d+)[^/]*$"
    cuisine_names = F.create_map(*[F.lit(x) for name, code in dims.CUISINES.items() for x in (code, name)])
    coded = pages.withColumns({
        "area_code": F.regexp_extract("url", tail, 1),
        "cuisine_code": F.regexp_extract("url", tail, 2),
    })
    labels = areas.select("area_code", "area", "district")
    return coded.join(labels, "area_code", "left").withColumn(
        "cuisine", F.try_element_at(cuisine_names, F.col("cuisine_code"))
    )


def detail_url(shop_id: Column, site: Site = SITE) -> Column:
    return F.concat(F.lit(site.detail_base), shop_id)


def search_url(name: Column, encode: bool = True, site: Site = SITE) -> Column:
    """Search URL of a shop name; encoded unless the raw form is wanted."""
    return F.concat(F.lit(site.search_base), F.url_encode(name) if encode else name)


def new_shop_searches(pages: DataFrame, site: Site = SITE) -> DataFrame:
    """Search URLs for shops found through inner links."""
    found = search_url(F.col("name"), site=site)
    return detail.with_heading(pages).select(
        H.last_segment(F.col("url")).alias("id"), found.alias("search_url")
    )
