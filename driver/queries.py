"""Every registered query: one operator of the engine over one binding."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlfold import sql
from crawlfold.functions import html as H
from crawlfold.functions.timing import lifetime_class, minutes_between
from crawlfold.operators import (
    claims, detail, frontier, leases, listing, outcomes as oc, pool as pool_ops, seeds,
    shops as shop_ops, verdict,
)
from crawlfold.params import PoolParams, Site
from crawlfold.plans import mixed, rounds
from crawlfold.session import new_folder, written
from crawlfold.sources import dims, feeds
from crawlfold.streaming import expiry, jobs
from driver import bindings as b

AS_OF = dt.datetime(2024, 1, 11)
LATER = dt.datetime(2024, 2, 1)
NOW = dt.datetime(2024, 1, 31)
NOMINAL = PoolParams(pool_n=1000)
CLAIMS_PER_BATCH = 100


# Dimensions and seeds

def dim_areas(spark, sf):
    return b.areas(spark, sf)


def dim_districts(spark, sf):
    """Areas per district, with its code."""
    found = b.areas(spark, sf).groupBy("district").agg(F.count(F.lit(1)).alias("n"))
    return found.join(F.broadcast(dims.districts(spark)), "district")


def dim_cuisines(spark, sf):
    """Rows per cuisine, decoded from the code in their URL."""
    found = b.seeded(spark, sf).groupBy(F.regexp_extract("url", r"(g\d+)$", 1).alias("code"))
    return found.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(dims.cuisines(spark)), "code")


def area_codes_level(spark, sf):
    return seeds.areas_of_level(b.areas(spark, sf), 2).select("area_code")


def area_codes_inclusive(spark, sf):
    return seeds.areas_up_to(b.areas(spark, sf), 3, repeat=True).select("area_code")


def area_codes_up_to(spark, sf):
    return seeds.areas_up_to(b.areas(spark, sf), 2).select("area_code")


def seed_urls(spark, sf):
    return rounds.listing_requests(b.areas(spark, sf), 1).select("url")


def seed_url_decode(spark, sf):
    return seeds.decode_seed_urls(b.seeded(spark, sf), b.areas(spark, sf)).select(
        "id", "area_code", "cuisine_code", "area", "district", "cuisine"
    )


def detail_urls(spark, sf):
    return b.shops(spark, sf).select("id", seeds.detail_url(F.col("id")).alias("url"))


def search_urls(spark, sf):
    return b.shops(spark, sf).select("id", seeds.search_url(F.col("name")).alias("search_url"))


# Feeds

def lease_feed(spark, sf):
    return feeds.leases(b.lease_replies(spark, sf))


def lease_rejects(spark, sf):
    return feeds.lease_rejects(b.lease_replies(spark, sf))


def probe_verdicts(spark, sf):
    return feeds.probe_verdicts(b.probe_replies(spark, sf), "k")


# Pages and extraction

def page_scan(spark, sf):
    return b.table(spark, sf, "pages").select(
        "page_id", "url", F.length("html").alias("n_chars")
    )


def page_verdict(spark, sf):
    """The stored pages show no captcha; a run of stars in the title stands for it."""
    site = Site(captcha_title="***")
    return b.table(spark, sf, "pages").select(
        "page_id", verdict.page_verdict(F.col("html"), site).alias("status")
    )


def page_verdict_custom(spark, sf):
    """A classifier that only knows pages with an ampersand in the title."""
    marked = verdict.with_verdict(
        b.table(spark, sf, "pages"),
        lambda pages: F.when(H.block(pages["html"], "title").contains("&"), F.lit(404)),
    )
    return marked.select("page_id", "status")


def cards_explode(spark, sf):
    return listing.cards(b.listing_pages(spark, sf)).select("url", "pos")


def _cards(spark, sf, *columns):
    return listing.extract(b.listing_pages(spark, sf)).select("id", *columns)


def listing_extract(spark, sf):
    return _cards(spark, sf, "url", *rounds.LISTING_FIELDS)


def listing_extract_nested(spark, sf):
    """Two lists, a sort bar, lists and blocks inside cards, escaped currency signs."""
    return listing.extract(b.listing_pages(spark, sf, nested=True)).select("id", "url", "pos", *rounds.LISTING_FIELDS)


def listing_extract_odd(spark, sf):
    """Comments, scripts, styles and values that hold tags, items without end tags."""
    return listing.extract(b.listing_pages(spark, sf, odd=True)).select("id", "url", "pos", *rounds.LISTING_FIELDS)


def detail_extract_odd(spark, sf):
    """Comments that hold end tags, scripts and other keywords, a span inside a span."""
    pages = b.detail_pages(spark, sf, odd=True)
    return detail.with_heading(detail.with_details(pages)).select("url", "name", "lon", "lat", "key_words")


def listing_optional_fields(spark, sf):
    return _cards(spark, sf, "comments_n", "consumption_per_capita")


def listing_tags(spark, sf):
    return _cards(spark, sf, "type_", "tag")


def stars_decode(spark, sf):
    return _cards(spark, sf, "stars")


def listing_ratings(spark, sf):
    return _cards(spark, sf, "flavor", "envir", "service")


def listing_rejects(spark, sf):
    return listing.rejects(b.listing_pages(spark, sf, faults=True))


def geo_extract(spark, sf):
    return detail.with_position(b.detail_pages(spark, sf)).select("url", "lon", "lat")


def detail_extract(spark, sf):
    return detail.extract(verdict.usable(b.detail_pages(spark, sf))).drop("url")


def detail_keywords(spark, sf):
    """Keywords in two blocks, with other links around them and a foreign block behind."""
    return detail.extract(b.detail_pages(spark, sf, nested=True)).select("id", "key_words")


def detail_heading(spark, sf):
    return detail.with_heading(b.detail_pages(spark, sf)).select("url", "name")


def page_status_verdict(spark, sf):
    """A stored refusal stands; the text decides about the others."""
    return verdict.with_verdict(b.detail_pages(spark, sf, statuses=True)).select("url", "status")


def detail_round(spark, sf):
    return rounds.detail_round(b.full_shops(spark, sf), b.detail_pages(spark, sf, statuses=True)).select(
        "id", "lon", "lat", "lock_", "action")


def new_shop_extract(spark, sf):
    return detail.extract_new(b.detail_pages(spark, sf))


def new_shop_searches(spark, sf):
    return seeds.new_shop_searches(b.detail_pages(spark, sf))


def keywords_join(spark, sf):
    sections = b.table(spark, sf, "pages").select("page_id", H.block(F.col("html"), "nav").alias("nav"))
    return sections.select("page_id", detail.link_words(F.col("nav")).alias("key_words"))


def heading_extract(spark, sf):
    raw = b.table(spark, sf, "pages").select("page_id", H.text(F.col("html"), "h1").alias("name"))
    return H.unescaped(raw, "name").select("page_id", H.strip(F.col("name")).alias("name"))


def url_last_segment(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", H.last_segment(F.col("url")).alias("id"))


# Shops

def claimable_ids(spark, sf):
    return shop_ops.claimable(b.shops(spark, sf), *shop_ops.WORK_PREDICATES)


def completeness_codes(spark, sf):
    return shop_ops.completeness(b.observations(spark, sf), b.shops(spark, sf))


def completeness_by_code(spark, sf):
    """Stored shops after a listing round and a detail round, counted by code."""
    listed = shop_ops.upsert(
        b.full_shops(spark, sf), rounds.listing_observations(b.listing_pages(spark, sf)), rounds.LISTING_FIELDS,
    ).drop("action")
    merged = rounds.detail_round(listed, b.detail_pages(spark, sf))
    return merged.groupBy(shop_ops.completeness_code().alias("code"), "lock_").agg(
        F.count(F.lit(1)).alias("n")
    )


def _upserted(spark, sf):
    return shop_ops.upsert(b.shops(spark, sf), b.observations(spark, sf), b.OBSERVED)


def upsert_merge(spark, sf):
    return _upserted(spark, sf)


def upsert_inserts(spark, sf):
    return _upserted(spark, sf).filter("action = 'insert'").select("id", *b.OBSERVED)


def upsert_updates(spark, sf):
    return _upserted(spark, sf).filter("action = 'update'").select("id", *b.OBSERVED)


def dup_listing_count(spark, sf):
    same = b.table(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) id", "c_mktsegment name", "cast(c_nationkey as string) address"
    )
    return shop_ops.same_listing_count(same)


# Claims

def claim_batch(spark, sf):
    return claims.claim_batch(b.shops(spark, sf), CLAIMS_PER_BATCH, *shop_ops.WORK_PREDICATES)


def lock_state(spark, sf):
    return claims.lock_state(b.claims(spark, sf))


def lock_state_late(spark, sf):
    return claims.lock_state(b.late_claims(spark, sf))


def lock_state_ttl(spark, sf):
    return claims.lock_state(b.claims(spark, sf), NOW, dt.timedelta(days=5)).select("id", "lock_")


def locked_shops(spark, sf):
    return claims.apply_locks(b.shops(spark, sf), claims.lock_state(b.claims(spark, sf))).select("id", "lock_")


def requeue(spark, sf):
    return claims.requeue(b.attempts(spark, sf))


def fetched_no_geo(spark, sf):
    return claims.fetched_without_position(b.shops(spark, sf))


# Outcomes and pool

def pool_state(spark, sf):
    return oc.member_state(b.as_outcomes_with_kills(b.table(spark, sf, "events")))


def pool_state_by_lease(spark, sf):
    """Outcomes count for the lease that held the key at the time; a key leased again starts anew."""
    held = leases.history(b.user_leases(spark, sf))
    return oc.member_state(oc.by_lease(b.outcomes(spark, sf), held)).select("key", "score", "ban", "ban_death_time")


def outcomes_with_lease(spark, sf):
    """Every outcome with the lease that held its key; users' keys change hands every ten days."""
    held = leases.history(b.user_leases(spark, sf))
    return oc.with_lease(b.outcomes(spark, sf), held).select("key", "seq", "lease")


def ban_streak_running(spark, sf):
    return oc.running_streak(b.outcomes(spark, sf)).select("key", "seq", "streak")


def first_death(spark, sf):
    return oc.first_death(b.outcomes(spark, sf))


def pool_in_use(spark, sf):
    return oc.in_use(b.usage(spark, sf))


def pool_eligible(spark, sf):
    return pool_ops.eligible(b.pool(spark, sf, swept=False)).select("proxy", "score", "ban")


def pool_eligible_count(spark, sf):
    return pool_ops.eligible(b.pool(spark, sf, swept=False)).agg(F.count(F.lit(1)).alias("n"))


def pool_sweep(spark, sf):
    return pool_ops.sweep(b.pool(spark, sf, swept=False), NOW).select(
        "proxy", "swept", "death", "death_time", "ban"
    )


def births_today(spark, sf):
    return pool_ops.births_today(b.pool(spark, sf), AS_OF)


def pool_gap(spark, sf):
    return pool_ops.gap(b.pool(spark, sf), AS_OF, NOMINAL)


def pool_gap_current(spark, sf):
    """The gap over leases that still hold their key; older ones no longer count as alive."""
    return pool_ops.gap(leases.current(b.leases(spark, sf)), AS_OF, NOMINAL)


def dead_members(spark, sf):
    return pool_ops.dead_members(b.pool(spark, sf), AS_OF)


def lifetime_classes(spark, sf):
    expire = F.expr("birth_time + make_dt_interval(0, 0, cast(proxy as int)*37%1500, 0)")
    return b.pool(spark, sf).select(
        "proxy", lifetime_class(minutes_between(F.col("birth_time"), expire)).alias("lifetime_class")
    )


def pool_report(spark, sf):
    return pool_ops.report(b.pool(spark, sf), AS_OF)


def pool_report_empty(spark, sf):
    return pool_ops.report(b.pool(spark, sf), LATER)


def pool_report_lenient(spark, sf):
    return pool_ops.report(b.pool(spark, sf), LATER, all_or_nothing=False)


def random_pick(spark, sf):
    return pool_ops.pick(b.pool(spark, sf), "2024-01-11", n=5).select("proxy")


def balanced_assignment(spark, sf):
    work = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("item"))
    return pool_ops.assign(work, b.pool(spark, sf))


def lease_history(spark, sf):
    return leases.history(b.leases(spark, sf))


def lease_current(spark, sf):
    return leases.current(b.leases(spark, sf))


# Frontier

def next_page_links(spark, sf):
    return frontier.next_links(b.listing_pages(spark, sf))


def listing_depth(spark, sf):
    pages = b.listing_pages(spark, sf)
    number = F.regexp_extract("url", r"(\d+)$", 1).cast("bigint")
    first_pages = pages.select("url").filter(number % b.CHAIN == 0)
    return frontier.depth(frontier.next_links(pages), first_pages)


# Streams: files of the given tables are the input, a shared folder takes the output.

def _stored_stream(df: DataFrame, folder: str, batches: int, by, files: int = 1) -> DataFrame:
    """`df` stored in several parts, then read as a stream of one part per batch. Parts of several files are made and read by
    as many tasks; where some of a part's files stay empty, the next part fills its batch."""
    for i in range(batches):
        rows = df.filter(by == i)
        rows = rows.coalesce(1) if files == 1 else rows.repartition(files)
        rows.write.mode("append").parquet(folder)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _deliveries(df: DataFrame, folder: str, batches: int, by):
    """`df` stored in several parts, by many tasks; after each a stream of all parts so far, for a job that goes on at its checkpoint."""
    for i in range(batches):
        df.filter(by == i).repartition(b.tasks(df.sparkSession)).write.mode("append").parquet(folder)
        yield df.sparkSession.readStream.schema(df.schema).parquet(folder)


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = b.table(spark, sf, name).schema
    # A file source wants a folder or a pattern; the pattern fits a table of either form.
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def stream_extract(spark, sf):
    folder = new_folder(spark, "extract")
    pages = b.as_detail_pages(_stream(spark, sf, "customer"))
    jobs.extract_details(pages, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").drop("url")


def stream_listing(spark, sf):
    folder = new_folder(spark, "listing")
    pages = b.listing_pages(spark, sf, nested=True)
    stream = _stored_stream(pages, f"{folder}/pages", 3, F.pmod(F.xxhash64("url"), F.lit(3)), b.tasks(spark))
    jobs.extract_listings(stream, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").select("id", "url", F.col("seq").alias("pos"), *rounds.LISTING_FIELDS)


def stream_upsert(spark, sf):
    folder = new_folder(spark, "upsert")
    observed = b.as_observations(_stream(spark, sf, "orders"))
    jobs.upsert_shops(observed, b.OBSERVED, f"{folder}/log", f"{folder}/checkpoint")
    updates = jobs.read_shop_updates(spark, f"{folder}/log", b.OBSERVED)
    return shop_ops.merge(b.shops(spark, sf), updates, b.OBSERVED)


def stream_pool(spark, sf):
    folder = new_folder(spark, "pool")
    outcomes = b.as_outcomes_with_kills(_stream(spark, sf, "events"))
    jobs.fold_pool(outcomes, f"{folder}/log", f"{folder}/checkpoint")
    return jobs.read_pool_state(spark, f"{folder}/log")


def stream_pool_late(spark, sf):
    """Three files, each with every third event, so that every batch reaches back behind the one before."""
    folder = new_folder(spark, "late")
    outcomes = b.as_outcomes_with_kills(b.table(spark, sf, "events"))
    stream = _stored_stream(outcomes, f"{folder}/in", 3, F.col("seq") % 3)
    jobs.fold_pool(stream, f"{folder}/log", f"{folder}/checkpoint")
    return jobs.read_pool_state(spark, f"{folder}/log")


#: How late rows may be in streams whose files are in no order, and a moment after all of them.
LATE, END = "60 days", dt.datetime(2024, 12, 1)


def stream_extract_dedup(spark, sf):
    """Every page delivered twice, the second time in later files; the job is restarted between these."""
    folder = new_folder(spark, "dedup")
    pages = b.detail_pages(spark, sf)
    again = pages.withColumn("fetched_at", F.expr("fetched_at + interval 10 minutes"))
    half = F.pmod(F.xxhash64("url"), F.lit(2))

    def run() -> None:
        stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        jobs.extract_details(stream, f"{folder}/out", f"{folder}/checkpoint", dedup_within="2 days")

    for part in (pages, again.filter(half == 0)):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    run()
    again.filter(half == 1).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    run()
    return spark.read.parquet(f"{folder}/out").drop("url")


def stream_counts(spark, sf):
    """Pages, usable pages, cards and rejects of every batch, counted while the stream ran."""
    folder = new_folder(spark, "counts")
    pages = b.listing_pages(spark, sf, faults=True)
    number = F.regexp_extract("url", r"(\d+)$", 1).cast("bigint")
    for stream in _deliveries(pages, f"{folder}/pages", 3, number % 3):
        jobs.extract_listings(stream, f"{folder}/out", f"{folder}/checkpoint", counts=f"{folder}/counts")
    return jobs.read_counts(spark, f"{folder}/counts")


def stream_claims_ttl(spark, sf):
    """Claims and releases in three files, each with every third event, and a tick at the end of the time."""
    folder = new_folder(spark, "ttl")
    rows = b.claims(spark, sf)
    _stored_stream(rows, f"{folder}/in", 3, F.col("seq") % 3)
    tick = spark.createDataFrame([(None, 0, NOW + dt.timedelta(days=60), 0)], "id string, seq long, ts timestamp_ntz, code int")
    tick.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    expiry.expire_claims(stream, f"{folder}/out", f"{folder}/checkpoint", dt.timedelta(days=5), LATE)
    return claims.lock_state(spark.read.parquet(f"{folder}/out")).select("id", "lock_")


def stream_unanswered(spark, sf):
    """Requests and answers as two streams of files in no order; what nobody answered within half an hour."""
    folder = new_folder(spark, "unanswered")
    streams = []
    for rows, name, tick in ((b.handouts(spark, sf), "h", (expiry.TICK, None, None, END)), (b.answers(spark, sf), "o", (expiry.TICK, END))):
        _stored_stream(rows, f"{folder}/{name}", 3, F.pmod(F.xxhash64("request"), F.lit(3)))
        spark.createDataFrame([tick], rows.schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        streams.append(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{name}"))
    expiry.release_unanswered(*streams, f"{folder}/out", f"{folder}/checkpoint", "30 minutes", LATE)
    return spark.read.parquet(f"{folder}/out")


def pool_in_use_timeouts(spark, sf):
    """Open hand-outs per member when those that nobody answered are taken back."""
    given = b.handouts(spark, sf)
    ended = expiry.unanswered(given, b.answers(spark, sf), "30 minutes")
    answered = given.join(ended.select("request"), "request", "left_anti").select("key", F.lit("ok").alias("kind"))
    log = given.select("key", F.lit("handout").alias("kind")).unionByName(expiry.as_outcomes(ended).select("key", "kind")).unionByName(
        answered.filter("cast(key as bigint) % 7 <> 0"))
    return oc.in_use(log)


# Names in SQL

def _sql(spark, sf, query: str) -> DataFrame:
    b.pool(spark, sf).createOrReplaceTempView("crawlfold_pool")
    b.detail_pages(spark, sf).createOrReplaceTempView("crawlfold_pages")
    sql.register(spark, "crawlfold_pool")
    return spark.sql(query)


def sql_pool_report(spark, sf):
    return _sql(spark, sf, "SELECT * FROM pool_report(TIMESTAMP_NTZ'2024-01-11')")


def sql_dead_members(spark, sf):
    return _sql(spark, sf, "SELECT * FROM dead_members(TIMESTAMP_NTZ'2024-01-11')")


def sql_detail_extract(spark, sf):
    return _sql(spark, sf, "SELECT url_id(url) AS id, shop_lon(html) AS lon, shop_lat(html) AS lat, page_status(html) AS status FROM crawlfold_pages")


def mixed_round(spark, sf):
    """Listing and detail pages in one table, read once; cards, rejects, records and refused pages as four tables."""
    pages = written(b.listing_pages(spark, sf, faults=True).unionByName(b.detail_pages(spark, sf, statuses=True)))
    tables = mixed.write_tables(mixed.routed(pages), new_folder(spark, "mixed"))
    columns = ["id", "url", "pos", "name", "stars", "lon", "key_words", "missing", "status"]
    rows = [t.select(F.lit(kind).alias("kind"), *[c if c in t.columns else F.lit(None).alias(c) for c in columns]) for kind, t in tables.items()]
    return functools.reduce(DataFrame.unionByName, rows)


ALL = {
    f.__name__: f
    for f in (
        dim_areas, dim_districts, dim_cuisines, area_codes_level, area_codes_inclusive,
        area_codes_up_to, seed_urls, seed_url_decode, detail_urls, search_urls,
        lease_feed, lease_rejects, probe_verdicts,
        page_scan, page_verdict, page_verdict_custom, cards_explode, listing_extract,
        listing_extract_nested, listing_extract_odd, detail_extract_odd, listing_optional_fields, listing_tags, stars_decode, listing_ratings, listing_rejects,
        geo_extract, detail_extract, detail_keywords, detail_heading, page_status_verdict, detail_round, new_shop_extract, new_shop_searches, keywords_join,
        heading_extract, url_last_segment,
        claimable_ids, completeness_codes, completeness_by_code, upsert_merge, upsert_inserts,
        upsert_updates, dup_listing_count,
        claim_batch, lock_state, lock_state_late, lock_state_ttl, locked_shops, requeue, fetched_no_geo,
        pool_state, pool_state_by_lease, outcomes_with_lease, ban_streak_running, first_death, pool_in_use, pool_eligible,
        pool_eligible_count, pool_sweep, births_today, pool_gap, pool_gap_current, dead_members, lifetime_classes,
        pool_report, pool_report_empty, pool_report_lenient, random_pick, balanced_assignment,
        lease_history, lease_current,
        next_page_links, listing_depth, stream_extract, stream_listing, stream_upsert, stream_pool, stream_pool_late,
        stream_extract_dedup, stream_counts, stream_claims_ttl, stream_unanswered, pool_in_use_timeouts,
        sql_pool_report, sql_dead_members, sql_detail_extract, mixed_round,
    )
}
ALL["lifetime_class"] = ALL.pop("lifetime_classes")
