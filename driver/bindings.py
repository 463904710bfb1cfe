"""The given tables seen as shops, observations, pages, outcomes, leases and claims.

The engine itself knows none of these tables. Listing and detail pages are rendered from
`customer`, so that extraction can be checked against plain SQL that never sees HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlfold.operators import outcomes as oc, seeds
from crawlfold.params import SITE
from crawlfold.schemas import SHOPS
from crawlfold.session import written
from crawlfold.sources import dims

CARDS_PER_PAGE = 15
CHAIN = 50
LIST_HOST = "http://list.example/p/"
START = "timestamp_ntz'2024-01-01 00:00:00'"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    """Tasks for rows that are few bytes and much work, a few for every core. Files are cut by bytes, which leaves such
    rows to one task."""
    return 3 * spark.sparkContext.defaultParallelism


# Shops and observations

def shops(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) id",
        "c_name name",
        "case when c_custkey%7=0 then null else c_mktsegment end type_",
        "cast(c_nationkey as string) tag",
        "cast(c_custkey%6*10 as int) stars",
        "case when c_acctbal>0 then c_acctbal end consumption_per_capita",
        "case when c_custkey%3=0 then null else 121+c_custkey%1000/cast(1000 as double) end lon",
        "case when c_custkey%3=0 or c_custkey%11=0 then null"
        " else 31+c_custkey%1000/cast(1000 as double) end lat",
        "cast(case c_custkey%10 when 0 then 1 when 1 then 20 else 0 end as int) lock_",
    )


def full_shops(spark: SparkSession, sf: str) -> DataFrame:
    """The same shops with every declared column."""
    few = shops(spark, sf)
    return few.select(*[
        (F.col(f.name) if f.name in few.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SHOPS.fields])


OBSERVED = ["type_", "consumption_per_capita"]


def as_observations(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "cast(o_custkey + case when o_orderkey%50=0 then 1000000 else 0 end as string) id",
        "o_orderdate ts",
        "o_orderkey seq",
        "case when o_orderstatus='O' then null else o_orderpriority end type_",
        "case when o_orderstatus='P' then null else o_totalprice/1000 end consumption_per_capita",
    )


def observations(spark: SparkSession, sf: str) -> DataFrame:
    return as_observations(table(spark, sf, "orders"))


# Pages

def _tag(condition: str, *parts: Column) -> Column:
    """The parts as one text, empty where the condition does not hold."""
    return F.when(F.expr(condition), F.concat(*parts)).otherwise("")


def _card(faults: bool, nested: bool, odd: bool = False) -> Column:
    """A card of the list. `nested`: blocks inside its blocks, a list inside it, an escaped currency sign. `odd`: tags in
    values, comments and scripts, an item without an end tag."""
    k = F.col("k").cast("string")
    text = F.lit
    sign = F.expr("case when k%2=0 then '&#xA5;' else '&yen;' end") if nested else text("￥")
    tip = text('<div class="tip"><p>x</p><div>y</div></div>' if nested else "")
    inner = text('<ul><li><div class="txt"><div class="tit">no card</div></div></li></ul>' if nested else "")
    one_tag, no_id, no_rank = (("k%13=0", "k%17=0", "k%19=0") if faults else ("false",) * 3)
    picture, hidden = "<img src=\"x.png\">", ""
    if odd:
        picture = "<img alt=\"<div><li>\" data-x=it's title='</ul>' src=x.png>"
        hidden = '<!-- </div></li> <div class="tit"> --><script>document.write("</div><li><div class=\\"txt\\">")</script>'
    return F.concat(
        text(f'<li><div class="pic"><a href="#">{picture}</a></div>\n<div class="txt">{hidden}'
             '<div class="tit"><a data-hippo-type="shop"'),
        _tag(f"not ({no_id})", text(' data-shopid="'), k, text('"')),
        text("><h4>"), F.col("name"), text('</h4></a></div>\n<div class="comment">'), tip,
        _tag(f"not ({no_rank})", text('<span class="sml-rank-stars sml-str'),
             F.expr("cast(k%6*10 as string)"), text('"></span>')),
        _tag("k%3<>0", text('<a href="#" onclick="shopreview()"><b>'), F.expr("cast(k*7 as string)"),
             text("</b> 条点评</a>")),
        _tag("k%4<>0", text("<a>人均 <b>"), sign, F.expr("cast(k%500 as string)"), text("</b></a>")),
        text("</div>\n"), inner, text('<div class="tag-addr"><a href="#"><span class="tag">'), F.col("segment"),
        text("</span></a>"),
        _tag(f"not ({one_tag})", text('<a href="#"><span class="tag">T'), F.col("nation").cast("string"),
             text("</span></a>")),
        text('<span class="addr">A'), k, text("</span></div>"),
        _tag("k%5<>0", text('<span class="comment-list"><span>口味<b>'),
             F.expr("cast((k%90+10)/cast(10 as double) as string)"), text("</b></span><span>环境<b>"),
             F.expr("cast((k%80+10)/cast(10 as double) as string)"), text("</b></span><span>服务<b>"),
             F.expr("cast((k%70+10)/cast(10 as double) as string)"), text("</b></span></span>")),
        text("</div></li>"),
    )


def listing_pages(spark: SparkSession, sf: str, faults: bool = False, nested: bool = False, odd: bool = False) -> DataFrame:
    """Listing pages of 15 cards. 50 pages make a chain; every fifth chain is a ring.

    `nested`: a sort bar in front, the cards in two lists, and another list behind the shop list.
    `odd`: comments, scripts and styles that hold tags, before the list and between its cards.
    """
    cards = table(spark, sf, "customer").selectExpr(
        "c_custkey k", "c_name name", "c_mktsegment segment", "c_nationkey nation"
    ).select(F.expr(f"k div {CARDS_PER_PAGE}").alias("page"), "k", _card(faults, nested, odd).alias("card"))
    pages = cards.groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct("k", "card"))).alias("cards")
    )
    ahead = F.expr(
        f"case when page%{CHAIN} < {CHAIN}-1 then page+1"
        f" when (page div {CHAIN})%5=0 then page-({CHAIN}-1) end"
    )
    pager = F.when(
        ahead.isNotNull(),
        F.concat(F.lit(f'<a class="next" href="{LIST_HOST}'), ahead.cast("string"), F.lit('">next</a>')),
    ).otherwise("")
    rows = F.col("cards.card")
    bar, between, behind = "", F.lit(""), ""
    if nested:
        bar = '<div class="sort"><ul><li><div class="txt">sort</div></li></ul></div><p>all</p>'
        between = F.lit("</ul><p>more</p><ul>")
        behind = '<ul><li><div class="txt">not a shop</div></li></ul>'
    before = ""
    if odd:
        before = '<!-- <div id="shop-all-list"><ul><li><div class="txt">old</div></li></ul></div> -->'
        bar = '<!-- <div class="old"> --><!-- </div> --><script>var s = "<div class=x><ul><li>";</script><style>ul > li { }</style>'
        between = F.lit("<!-- </ul> </div> -->")
    html = F.concat(
        F.lit(f'<html><head><title>list</title></head><body>{before}<div id="shop-all-list">{bar}<ul>'),
        F.array_join(F.slice(rows, 1, 7), ""), between, F.array_join(F.slice(rows, 8, CARDS_PER_PAGE), ""),
        F.lit(f'</ul></div>{behind}<div class="page"><a class="prev" href="#">prev</a>'), pager,
        F.lit("</div></body></html>"),
    )
    return pages.select(
        F.concat(F.lit(LIST_HOST), F.col("page").cast("string")).alias("url"),
        html.alias("html"),
        F.lit(200).alias("status"),
        F.expr(f"{START} + make_dt_interval(0, 0, 0, page)").alias("fetched_at"),
        F.expr("cast(map() as map<string,string>)").alias("meta"),
    )


def as_detail_pages(customers: DataFrame, nested: bool = False, statuses: bool = False, odd: bool = False) -> DataFrame:
    """One detail page per customer; every 23rd is a block notice. Customers are dealt out before their pages are made.

    `nested`: keywords in two blocks, with other links around them and a foreign block behind.
    `statuses`: some pages are stored with a refusal, some without a status.
    `odd`: comments that hold end tags, a heading, a script and other keywords; a span inside a span.
    """
    key = customers.selectExpr("c_custkey k", "c_name name", "c_nationkey nation").repartition(tasks(customers.sparkSession))
    aside = second = foreign = ""
    if nested:
        aside = '<div class="sub"><a>no word</a></div>'
        second = '</div><div class="head"><a>no</a></div><div class="content"><b><a>bold</a></b><span><a>B</a></span>'
        foreign = '<div class="content"><span><a>foreign</a></span></div>'
    hidden, inner = "", ""
    if odd:
        hidden = ('<!-- <div id="basic-info"><h1 class="shop-name">old</h1></div>'
                  '<script>window.cfg = {shopGlat: "11.1", shopGlng: "111.1"}</script><div id="summaryfilter-wrapper"></div> -->')
        aside = "<!-- </div></div> --><script>'</div></div>'</script>"
        inner = "<span>n</span>"
    digits = "lpad(cast(k%1000 as string), 3, '0')"
    lon = F.expr(f"concat(case when k%13=0 then '121x' else '121.' end, {digits})")
    lat = F.expr(f"concat('31.', {digits})")
    html = F.concat(
        F.lit("<html><head><title>"), F.expr("case when k%23=0 then '验证中心' else name end"),
        F.lit(f'</title></head><body>{hidden}<div id="basic-info"><h1 class="shop-name">\n  '), F.col("name"),
        F.lit(" <a>more</a></h1></div><script>var shopGlat = null;</script>"),
        _tag("k%9<>0", F.lit('<script>window.cfg = {shopGlat: "'), lat, F.lit('" , shopGlng: " '), lon,
             F.lit('"}</script>')),
        F.lit('<div id="summaryfilter-wrapper"><div class="content">'),
        _tag("k%6<>0", F.lit(f"<span>{inner}<a>W"), F.expr("cast(k%7 as string)"), F.lit("</a></span>"), F.lit(aside),
             F.lit("<span><a>N"), F.col("nation").cast("string"), F.lit("</a></span>"), F.lit(second)),
        F.lit(f"</div></div>{foreign}</body></html>"),
    )
    status = F.expr(STORED_STATUS) if statuses else F.lit(200)
    shop_id = F.col("k").cast("string")
    return key.select(
        seeds.detail_url(shop_id).alias("url"),
        html.alias("html"),
        status.alias("status"),
        F.expr(f"{START} + make_dt_interval(0, 0, 0, k)").alias("fetched_at"),
        F.create_map(F.lit("shopId"), shop_id).alias("meta"),
    )


STORED_STATUS = "cast(case when k%29=0 then 403 when k%31=0 then 500 when k%37=0 then null else 200 end as int)"


def detail_pages(spark: SparkSession, sf: str, nested: bool = False, statuses: bool = False, odd: bool = False) -> DataFrame:
    return as_detail_pages(table(spark, sf, "customer"), nested, statuses, odd)


# Dimensions and seeds

def areas(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as areas, spread over the districts."""
    names = F.array(*[F.lit(d) for d in dims.DISTRICTS])
    return dims.with_level(table(spark, sf, "supplier").select(
        F.element_at(names, F.expr("cast(s_suppkey%16+1 as int)")).alias("district"),
        F.col("s_name").alias("area"),
        F.concat(F.lit("r"), F.col("s_suppkey").cast("string")).alias("area_code"),
    ))


def seeded(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as rows found under a seed URL."""
    codes = F.array(*[F.lit(c) for c in dims.CUISINES.values()])
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(
            F.lit(SITE.seed_base), F.lit("r"), F.expr("cast(c_custkey%1000 as string)"),
            F.element_at(codes, F.expr("cast(c_custkey%37+1 as int)")),
        ).alias("url"),
    )


# Outcomes, leases, claims

def _outcomes(events: DataFrame, key: str, kind: str) -> DataFrame:
    return events.selectExpr(f"cast({key} as string) key", "event_id seq", "ts", f"{kind} kind")


def as_outcomes(events: DataFrame) -> DataFrame:
    """Errors are blocks, everything else a success."""
    return _outcomes(events, "user_id", "case when event_type='error' then 'block' else 'ok' end")


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return as_outcomes(table(spark, sf, "events"))


def as_outcomes_with_kills(events: DataFrame) -> DataFrame:
    """As above, with expensive signups as failed probes."""
    return _outcomes(
        events, "user_id",
        "case when event_type='error' then 'block'"
        " when event_type='signup' and value>100 then 'kill' else 'ok' end",
    )


def usage(spark: SparkSession, sf: str) -> DataFrame:
    """Views and clicks are hand-outs, purchases and errors completed outcomes."""
    return _outcomes(
        table(spark, sf, "events"), "user_id",
        "case when event_type in ('view','click') then 'handout' when event_type='purchase' then 'ok'"
        " when event_type='error' then 'block' else 'probe' end",
    )


def handouts(spark: SparkSession, sf: str) -> DataFrame:
    """Views and clicks as requests handed to a member, each for a shop."""
    return table(spark, sf, "events").filter("event_type in ('view','click')").selectExpr(
        "cast(event_id as string) request", "cast(user_id as string) key", "cast(event_id%1000 as string) id", "ts")


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """Two of three requests are answered, after 0 to 49 minutes."""
    return table(spark, sf, "events").filter("event_type in ('view','click') and event_id%3<>0").selectExpr(
        "cast(event_id as string) request", "ts + make_dt_interval(0, 0, cast(event_id%50 as int)) at")


LEASE = "user_id*10+least(cast(floor((day(ts)-1)/10) as int),2)"


def pool(spark: SparkSession, sf: str, swept: bool = True) -> DataFrame:
    """Members from events: one per user and ten days, a last signup being a failed probe.

    Unswept, members over the block threshold have not been declared dead yet.
    """
    events = table(spark, sf, "events")
    state = oc.member_state(_outcomes(events, LEASE, "case when event_type='error' then 'block' else 'ok' end"))
    life = events.groupBy(F.expr(f"cast({LEASE} as string)").alias("key")).agg(
        F.min("ts").alias("birth_time"),
        F.min("event_id").alias("seq"),
        F.max_by(F.struct("event_type", "ts"), "event_id").alias("last"),
    )
    ban_death = F.col("ban_death_time") if swept else F.lit(None).cast("timestamp_ntz")
    natural = F.col("last.event_type") == "signup"
    return life.join(state.select("key", "score", "ban", "ban_death_time"), "key").select(
        F.col("key").alias("proxy"),
        "seq", "birth_time",
        F.expr("birth_time + interval 20 days").alias("expire_time"),
        "score",
        F.coalesce(ban_death, F.when(natural, F.col("last.ts"))).alias("death_time"),
        F.when(ban_death.isNotNull() | natural, 1).otherwise(0).alias("death"),
        (F.when(ban_death.isNotNull(), 3).otherwise(F.col("ban"))).cast("bigint").alias("ban"),
    )


def leases(spark: SparkSession, sf: str) -> DataFrame:
    """Successive leases of one key: the members above under their user's id, stored once."""
    return written(pool(spark, sf).select(
        F.expr("cast(cast(proxy as bigint) div 10 as string)").alias("proxy"), "seq", "birth_time", "death"
    ))


def user_leases(spark: SparkSession, sf: str) -> DataFrame:
    """Successive leases of every user's key: one per ten days, born with its first event."""
    return table(spark, sf, "events").groupBy(
        F.col("user_id").cast("string").alias("proxy"), F.expr(LEASE).alias("_lease")
    ).agg(F.min("ts").alias("birth_time"), F.min("event_id").alias("seq")).drop("_lease")


def late_claims(spark: SparkSession, sf: str) -> DataFrame:
    """The claims below under numbers that run against time, as two sources with numbers of their own give."""
    return claims(spark, sf).withColumn("seq", -F.col("seq"))


def claims(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter("event_type in ('view','purchase','error')").selectExpr(
        "cast(user_id as string) id", "event_id seq", "ts",
        "cast(case event_type when 'view' then 1 when 'purchase' then 20 else 0 end as int) code",
    )


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter("event_type in ('purchase','error')").select(
        seeds.detail_url(F.col("user_id").cast("string")).alias("url"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", 403).otherwise(200).alias("status"),
    )


# Recorded replies

def lease_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Events packed into JSON replies of at most 100 leases.

    Every fifth reply is refused, every seventh has another HTTP status, every eleventh is
    cut off.
    """
    lease = F.struct(
        F.expr("concat('10.0.', cast(user_id%256 as string), '.', cast(event_id%256 as string))").alias("ip"),
        F.expr("cast(8000+event_id%1000 as string)").alias("port"),
        F.expr("date_format(ts + interval 20 minutes, 'yyyy-MM-dd HH:mm:ss')").alias("expire_time"),
    )
    feeds = table(spark, sf, "events").groupBy(F.expr("event_id div 100").alias("feed_id")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", lease.alias("lease")))).alias("data"),
        F.min("ts").alias("received_at"),
    )
    body = F.to_json(F.struct(
        F.expr("feed_id%5<>0").alias("success"),
        F.concat(F.lit("reply "), F.col("feed_id").cast("string")).alias("msg"),
        F.col("data.lease").alias("data"),
    ))
    return feeds.select(
        "feed_id",
        F.expr("case when feed_id%7=0 then 502 else 200 end").alias("status"),
        "received_at",
        F.when(F.expr("feed_id%11=0"), F.expr("concat('{', feed_id)")).otherwise(body).alias("body"),
    )


def probe_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties as probe bodies; every tenth failed, every seventeenth has no answer."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("probe_id"),
        F.expr("case when event_id%17=0 then null when event_id%10=0 then 502 else 200 end").alias("status"),
        F.col("props").alias("body"),
    )
