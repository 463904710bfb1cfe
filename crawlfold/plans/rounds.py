"""The listing round, the detail round and the pool round as logical plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlfold import sinks
from crawlfold.functions import html as H
from crawlfold.operators import claims, detail, listing, pool as pool_ops, seeds, shops as shop_ops, verdict
from crawlfold.params import FETCHED, FREE, PAGE_OK, SITE, PoolParams, Site

LISTING_FIELDS = [
    "name", "address", "type_", "tag", "comments_n", "consumption_per_capita", "stars",
    "flavor", "envir", "service",
]
DETAIL_FIELDS = ["lon", "lat", "key_words"]


def listing_requests(areas: DataFrame, level: int, inclusive: bool = False, site: Site = SITE) -> DataFrame:
    """Seed URLs of a listing crawl."""
    chosen = seeds.areas_up_to(areas, level) if inclusive else seeds.areas_of_level(areas, level)
    return seeds.seed_urls(chosen, site)


def listing_observations(pages: DataFrame) -> DataFrame:
    """Observations of usable listing pages, in arrival order of page and card."""
    # A card's place in the arrival order: page time, then position on the page.
    return listing.extract(verdict.usable(pages)).withColumnRenamed("pos", "seq")  # the page's URL breaks ties


def detail_requests(shops: DataFrame, pool: DataFrame, n: int, params: PoolParams = PoolParams(),
                    site: Site = SITE) -> DataFrame:
    """Claims of the next detail batch.

    Empty when no shop qualifies, or when members are required and none is eligible: the
    sign to stop.
    """
    batch = claims.claim_batch(shops, n, *shop_ops.WORK_PREDICATES, site=site)
    if params.pool_n > 0 and pool_ops.eligible(pool, params).isEmpty():
        return batch.limit(0)
    return batch


def detail_round(shops: DataFrame, pages: DataFrame) -> DataFrame:
    """Shop table after a batch of detail pages: extracted fields merged, locks released.

    One pass over the pages, one fold per id that holds the fields and the lock, one join with
    the shops. Pages that are not usable bring no fields and free their id.
    """
    visited = verdict.with_verdict(pages.filter(F.col("meta")["shopId"].isNotNull()))
    read = H.once(detail.with_details(visited).select(
        F.col("meta")["shopId"].alias("id"), F.col("fetched_at").alias("ts"), "url", "status", *DETAIL_FIELDS))
    usable = F.col("status") == PAGE_OK
    seen = read.select(
        "id", "ts", F.lit(0).alias("seq"), "url",
        *[F.when(usable, F.col(f)).alias(f) for f in DETAIL_FIELDS],
        F.when(usable, FETCHED).otherwise(FREE).alias("lock_"))
    fields = [*DETAIL_FIELDS, "lock_"]
    merged = shop_ops.upsert(shops, seen, fields)
    # A page that is refused does not make a shop.
    found = F.coalesce(*[F.col(f).cast("string") for f in DETAIL_FIELDS]).isNotNull()
    return merged.filter((F.col("action") != "insert") | found | (F.col("lock_") == FETCHED))


def store_round(merged: DataFrame, root: str, version: int) -> dict[str, int]:
    """Write a merged shop table as a new version; rows, inserts and updates are counted while it is written."""
    counted, seen = sinks.counted(merged, f"round-{version}")
    sinks.write_snapshot(counted.drop("action"), root, version)
    return seen.get


def pool_round(members: DataFrame, state: DataFrame, now: dt.datetime, today: dt.datetime,
               params: PoolParams = PoolParams()) -> tuple[DataFrame, DataFrame]:
    """Swept pool, and births, members alive and shortfall after the sweep."""
    swept = pool_ops.sweep(pool_ops.apply_state(members, state), now, params)
    return swept, pool_ops.gap(swept, today, params)
