"""SQL twins of the registered queries, written against the given tables.

The twins of the extraction queries compute the expected fields from `customer` and never
see the rendered HTML.
"""

from __future__ import annotations

from crawlfold.params import SITE
from crawlfold.sources import dims
from driver.bindings import CARDS_PER_PAGE, CHAIN, LIST_HOST


def _list(items) -> str:
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


def _values(pairs) -> str:
    return ", ".join(f"('{a}', '{c}')" for a, c in pairs)


DISTRICT_NAMES = _list(dims.DISTRICTS)
CUISINE_NAMES, CUISINE_CODES = _list(dims.CUISINES), _list(dims.CUISINES.values())

AREAS = f"""
areas0 AS (SELECT {DISTRICT_NAMES}[CAST(s_suppkey % 16 + 1 AS INT)] AS district, s_name AS area,
                  'r' || s_suppkey AS area_code FROM supplier),
areas AS (SELECT *, CASE WHEN district IN ({_list(dims.LEVEL_3)[1:-1]}) THEN 3
                         WHEN district IN ({_list(dims.LEVEL_2)[1:-1]}) THEN 2 ELSE 1 END AS level
          FROM areas0)"""

SHOPS = """
shops AS (SELECT CAST(c_custkey AS VARCHAR) id, c_name AS name,
  CASE WHEN c_custkey%7=0 THEN NULL ELSE c_mktsegment END type_, CAST(c_nationkey AS VARCHAR) tag,
  CAST(c_custkey%6*10 AS INT) stars, CASE WHEN c_acctbal>0 THEN c_acctbal END consumption_per_capita,
  CASE WHEN c_custkey%3=0 THEN NULL ELSE 121+c_custkey%1000/CAST(1000 AS DOUBLE) END lon,
  CASE WHEN c_custkey%3=0 OR c_custkey%11=0 THEN NULL ELSE 31+c_custkey%1000/CAST(1000 AS DOUBLE) END lat,
  CAST(CASE c_custkey%10 WHEN 0 THEN 1 WHEN 1 THEN 20 ELSE 0 END AS INT) lock_
FROM customer)"""

OBSERVATIONS = """
obs AS (SELECT CAST(o_custkey + CASE WHEN o_orderkey%50=0 THEN 1000000 ELSE 0 END AS VARCHAR) id,
  o_orderdate ts, o_orderkey seq,
  CASE WHEN o_orderstatus='O' THEN NULL ELSE o_orderpriority END type_,
  CASE WHEN o_orderstatus='P' THEN NULL ELSE o_totalprice/1000 END cpc
FROM orders)"""

UPSERTED = f"""
WITH {SHOPS}, {OBSERVATIONS},
upd AS (SELECT id, arg_max(type_, row(ts, seq)) FILTER (WHERE type_ IS NOT NULL) type_,
               arg_max(cpc, row(ts, seq)) FILTER (WHERE cpc IS NOT NULL) cpc FROM obs GROUP BY id),
merged AS (SELECT coalesce(s.id, u.id) id, s.name, coalesce(u.type_, s.type_) type_, s.tag, s.stars,
  coalesce(u.cpc, s.consumption_per_capita) consumption_per_capita, s.lon, s.lat,
  coalesce(s.lock_, 0) lock_,
  CASE WHEN s.id IS NULL THEN 'insert' WHEN u.id IS NOT NULL THEN 'update' ELSE 'keep' END AS "action"
  FROM shops s FULL OUTER JOIN upd u ON s.id = u.id)"""

CARDS = f"""
cards AS (SELECT c_custkey k, CAST(c_custkey AS VARCHAR) id,
  '{LIST_HOST}' || (c_custkey // {CARDS_PER_PAGE}) AS url, CAST(c_custkey % {CARDS_PER_PAGE} AS INT) AS pos,
  c_name AS name, 'A' || c_custkey AS address, c_mktsegment AS type_, 'T' || c_nationkey AS tag,
  CAST(CASE WHEN c_custkey%3=0 THEN NULL ELSE c_custkey*7 END AS INT) comments_n,
  CAST(CASE WHEN c_custkey%4=0 THEN NULL ELSE c_custkey%500 END AS DOUBLE) consumption_per_capita,
  CAST(c_custkey%6*10 AS INT) stars,
  CASE WHEN c_custkey%5=0 THEN NULL ELSE (c_custkey%90+10)/CAST(10 AS DOUBLE) END flavor,
  CASE WHEN c_custkey%5=0 THEN NULL ELSE (c_custkey%80+10)/CAST(10 AS DOUBLE) END envir,
  CASE WHEN c_custkey%5=0 THEN NULL ELSE (c_custkey%70+10)/CAST(10 AS DOUBLE) END service
FROM customer)"""

DETAILS = f"""
details AS (SELECT c_custkey k, CAST(c_custkey AS VARCHAR) id, '{SITE.detail_base}' || c_custkey AS url,
  c_name AS name,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS ts,
  CASE WHEN c_custkey%9=0 OR c_custkey%13=0 THEN NULL
       ELSE CAST('121.' || lpad(CAST(c_custkey%1000 AS VARCHAR), 3, '0') AS DOUBLE) END lon,
  CASE WHEN c_custkey%9=0 THEN NULL
       ELSE CAST('31.' || lpad(CAST(c_custkey%1000 AS VARCHAR), 3, '0') AS DOUBLE) END lat,
  CASE WHEN c_custkey%6=0 THEN NULL ELSE 'W' || (c_custkey%7) || '|N' || c_nationkey END key_words,
  c_custkey%23=0 AS blocked
FROM customer)"""

MEMBERS = """
o1 AS (SELECT event_id, user_id*10+least(CAST(floor((day(ts)-1)/10) AS INT),2) lease, ts, event_type,
              event_type<>'error' ok FROM events),
o2 AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END)
                 OVER (PARTITION BY lease, g ORDER BY event_id ROWS UNBOUNDED PRECEDING) ban_run
       FROM (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END)
                       OVER (PARTITION BY lease ORDER BY event_id ROWS UNBOUNDED PRECEDING) g FROM o1)),
life AS (SELECT CAST(lease AS VARCHAR) proxy, min(event_id) seq, min(ts) birth_time,
                count(*) FILTER (WHERE ok) score, CAST(arg_max(ban_run, event_id) AS BIGINT) ban_last,
                min(ts) FILTER (WHERE ban_run>=3) ban_death, max(ts) last_ts,
                arg_max(event_type, event_id) last_type
         FROM o2 GROUP BY lease),
pool AS (SELECT proxy, seq, birth_time, birth_time + INTERVAL 20 DAY expire_time, score,
                coalesce(ban_death, CASE WHEN last_type='signup' THEN last_ts END) death_time,
                CAST(CASE WHEN ban_death IS NOT NULL OR last_type='signup' THEN 1 ELSE 0 END AS INT) death,
                CAST(CASE WHEN ban_death IS NOT NULL THEN 3 ELSE ban_last END AS BIGINT) ban FROM life),
unswept AS (SELECT proxy, score, CASE WHEN last_type='signup' THEN last_ts END death_time,
                   CAST(CASE WHEN last_type='signup' THEN 1 ELSE 0 END AS INT) death, ban_last ban FROM life)"""

DEAD = """
dead AS (SELECT proxy, birth_time, death_time, expire_time,
                date_sub('second', birth_time, death_time)/60 AS lifetime_min,
                date_sub('second', death_time, expire_time)/60 AS unused_min, score, ban
         FROM pool WHERE birth_time > TIMESTAMP '{as_of} 00:00:00' AND death = 1)"""


def _report(as_of: str, lenient: bool = False) -> str:
    """The six measures from the six derived tables of the view, joined as scalars."""
    measures = f"""
      (SELECT count(*) FROM pool WHERE birth_time > TIMESTAMP '{as_of} 00:00:00') AS download_n,
      (SELECT count(*) FROM dead WHERE ban < 3) AS nd_n,
      (SELECT round(avg(score), 6) FROM dead) AS avg_score,
      (SELECT round(avg(lifetime_min), 6) FROM dead) AS avg_lifetime,
      (SELECT round(avg(score), 6) FROM dead WHERE ban < 3) AS avg_score_nd,
      (SELECT round(avg(lifetime_min), 6) FROM dead WHERE ban < 3) AS avg_lifetime_nd"""
    head = f"WITH {MEMBERS}, {DEAD.format(as_of=as_of)}, six AS (SELECT {measures})"
    if lenient:
        return f"{head} SELECT * FROM six"
    names = ("download_n", "nd_n", "avg_score", "avg_lifetime", "avg_score_nd", "avg_lifetime_nd")
    present = "(SELECT count(*) FROM dead) > 0 AND nd_n > 0"
    columns = ", ".join(f"CASE WHEN {present} THEN {n} END AS {n}" for n in names)
    return f"{head} SELECT {columns} FROM six"


def _streaks(kind: str) -> str:
    return f"""
k AS (SELECT CAST(user_id AS VARCHAR) AS "key", event_id AS seq, ts, {kind} AS kind FROM events),
r AS (SELECT *, CAST(sum(CASE WHEN kind='block' THEN 1 ELSE 0 END)
                OVER (PARTITION BY "key", g ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) run
      FROM (SELECT *, sum(CASE WHEN kind='ok' THEN 1 ELSE 0 END)
                      OVER (PARTITION BY "key" ORDER BY seq ROWS UNBOUNDED PRECEDING) g FROM k))"""


PLAIN = "CASE WHEN event_type='error' THEN 'block' ELSE 'ok' END"
KILLS = ("CASE WHEN event_type='error' THEN 'block'"
         " WHEN event_type='signup' AND value>100 THEN 'kill' ELSE 'ok' END")

STATE = f"""
WITH {_streaks(KILLS)},
a AS (SELECT "key", count(*) FILTER (WHERE kind='ok') score, arg_max(run, seq) ban,
             CAST(-count(*) FILTER (WHERE kind IN ('ok','block')) AS BIGINT) using_n,
             count(*) FILTER (WHERE kind='kill') kills, min(seq) FILTER (WHERE kind='kill') first_kill,
             max(ts) FILTER (WHERE kind='kill') last_kill,
             min(seq) FILTER (WHERE kind='block' AND run>=3) ban_seq,
             min(ts) FILTER (WHERE kind='block' AND run>=3) ban_ts
      FROM r GROUP BY "key")
SELECT "key", score, ban, using_n,
       CAST(kills + CASE WHEN ban_seq IS NOT NULL AND (first_kill IS NULL OR ban_seq < first_kill)
                         THEN 1 ELSE 0 END AS BIGINT) AS death,
       coalesce(last_kill, ban_ts) AS death_time, ban_ts AS ban_death_time FROM a"""

LOCKS = """
locks AS (SELECT CAST(user_id AS VARCHAR) id, arg_max(CAST(CASE event_type WHEN 'view' THEN 1
            WHEN 'purchase' THEN 20 ELSE 0 END AS INT), event_id) lock_, max(ts) since
          FROM events WHERE event_type IN ('view','purchase','error') GROUP BY 1)"""

CLAIMABLE = ("lock_ = 0 AND stars > 0 AND consumption_per_capita IS NOT NULL"
             " AND lon IS NULL AND lat IS NULL")

UNESCAPE = "replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&apos;', ''''), '&nbsp;', chr(160)), '&amp;', '&')"

CODE = """CASE WHEN type_ IS NULL AND lon IS NOT NULL AND lat IS NOT NULL THEN 499
     WHEN type_ IS NULL THEN 400 WHEN lon IS NULL OR lat IS NULL THEN 301 ELSE 200 END"""

HISTORY = f"""
WITH {MEMBERS},
held AS (SELECT CAST(CAST(proxy AS BIGINT) // 10 AS VARCHAR) proxy, seq, birth_time, death FROM pool),
hist AS (SELECT *, lead(birth_time) OVER (PARTITION BY proxy ORDER BY birth_time) superseded_at FROM held)"""

LINKS = f"""
listing AS (SELECT DISTINCT c_custkey // {CARDS_PER_PAGE} AS page FROM customer),
links AS (SELECT page, CASE WHEN page % {CHAIN} < {CHAIN} - 1 THEN page + 1
                            WHEN (page // {CHAIN}) % 5 = 0 THEN page - ({CHAIN} - 1) END AS ahead
          FROM listing)"""

STATUS = """CAST(CASE WHEN k % 29 = 0 THEN 403 WHEN k % 31 = 0 THEN 500
                  WHEN blocked THEN 403 ELSE 200 END AS INT)"""

GOOD_FEED = "event_id // 100 % 5 <> 0 AND event_id // 100 % 7 <> 0 AND event_id // 100 % 11 <> 0"

SQL: dict[str, str] = {
    # Dimensions and seeds
    "dim_areas": f"WITH {AREAS} SELECT district, area, area_code, level FROM areas",
    "dim_districts": f"""WITH {AREAS}, d(district, code) AS (VALUES {_values(dims.DISTRICTS.items())})
        SELECT district, count(*) AS n, code FROM areas JOIN d USING (district) GROUP BY district, code""",
    "dim_cuisines": f"""WITH d(cuisine, code) AS (VALUES {_values(dims.CUISINES.items())})
        SELECT code, count(*) AS n, cuisine FROM customer
        JOIN d ON d.code = {CUISINE_CODES}[CAST(c_custkey % 37 + 1 AS INT)] GROUP BY code, cuisine""",
    "area_codes_level": f"WITH {AREAS} SELECT area_code FROM areas WHERE level = 2",
    "area_codes_inclusive": f"""WITH {AREAS} SELECT area_code FROM areas
        UNION ALL SELECT area_code FROM areas WHERE level <= 2
        UNION ALL SELECT area_code FROM areas WHERE level <= 1""",
    "area_codes_up_to": f"WITH {AREAS} SELECT area_code FROM areas WHERE level <= 2",
    "seed_urls": f"""WITH {AREAS} SELECT '{SITE.seed_base}' || area_code || unnest({CUISINE_CODES}) AS url
        FROM areas WHERE level = 1""",
    "seed_url_decode": f"""WITH {AREAS},
        s AS (SELECT CAST(c_custkey AS VARCHAR) id, 'r' || (c_custkey % 1000) AS area_code,
                     CAST(c_custkey % 37 + 1 AS INT) AS c FROM customer)
        SELECT id, area_code, {CUISINE_CODES}[c] AS cuisine_code, area, district, {CUISINE_NAMES}[c] AS cuisine
        FROM s LEFT JOIN areas USING (area_code)""",
    "detail_urls": f"SELECT CAST(c_custkey AS VARCHAR) id, '{SITE.detail_base}' || c_custkey AS url FROM customer",
    "search_urls": f"""SELECT CAST(c_custkey AS VARCHAR) id,
        '{SITE.search_base}' || replace(c_name, '#', '%23') AS search_url FROM customer""",
    # Feeds
    "lease_feed": f"""SELECT feed_id, CAST(n AS INT) AS pos, 'http://' || ip || ':' || port AS proxy, ip, port, 'http' AS scheme,
          1 AS lifetime_class, min(ts) OVER (PARTITION BY feed_id) AS birth_time,
          date_trunc('second', ts + INTERVAL 20 MINUTE) AS expire_time
        FROM (SELECT event_id // 100 AS feed_id, event_id % 100 AS n, '10.0.' || (user_id % 256) || '.' || (event_id % 256) AS ip,
                     CAST(8000 + event_id % 1000 AS VARCHAR) AS port, ts FROM events WHERE {GOOD_FEED})""",
    "lease_rejects": """SELECT feed_id, CASE WHEN feed_id % 11 = 0 THEN 'malformed' ELSE 'refused' END AS reason,
          CASE WHEN feed_id % 11 = 0 THEN NULL ELSE 'reply ' || feed_id END AS msg
        FROM (SELECT DISTINCT event_id // 100 AS feed_id FROM events)
        WHERE feed_id % 7 <> 0 AND (feed_id % 11 = 0 OR feed_id % 5 = 0)""",
    "probe_verdicts": """SELECT event_id AS probe_id,
          CASE WHEN event_id % 17 = 0 THEN false WHEN event_id % 10 = 0 THEN NULL ELSE true END AS valid,
          CASE WHEN event_id % 17 <> 0 AND event_id % 10 <> 0
               THEN regexp_extract(props, '"k": *(\\d+)', 1) END AS origin FROM events""",
    # Pages and extraction
    "page_scan": "SELECT page_id, url, CAST(length(html) AS INT) AS n_chars FROM pages",
    "page_verdict": """SELECT page_id, CASE WHEN regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)
          LIKE '%***%' THEN 403 ELSE 200 END AS status FROM pages""",
    "page_verdict_custom": """SELECT page_id, CASE WHEN regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)
          LIKE '%&%' THEN 404 ELSE 200 END AS status FROM pages""",
    "cards_explode": f"WITH {CARDS} SELECT url, pos FROM cards",
    "listing_extract": f"""WITH {CARDS} SELECT id, url, name, address, type_, tag, comments_n,
          consumption_per_capita, stars, flavor, envir, service FROM cards""",
    "listing_extract_nested": f"""WITH {CARDS} SELECT id, url, pos, name, address, type_, tag, comments_n,
          consumption_per_capita, stars, flavor, envir, service FROM cards""",
    "listing_optional_fields": f"WITH {CARDS} SELECT id, comments_n, consumption_per_capita FROM cards",
    "listing_tags": f"WITH {CARDS} SELECT id, type_, tag FROM cards",
    "stars_decode": f"WITH {CARDS} SELECT id, stars FROM cards",
    "listing_ratings": f"WITH {CARDS} SELECT id, flavor, envir, service FROM cards",
    "listing_rejects": f"""WITH {CARDS} SELECT url, pos, CASE WHEN k % 17 = 0 THEN NULL ELSE id END AS id,
          concat_ws(',', CASE WHEN k % 17 = 0 THEN 'id' END, CASE WHEN k % 13 = 0 THEN 'tags' END,
                    CASE WHEN k % 19 = 0 THEN 'stars' END) AS missing
        FROM cards WHERE k % 17 = 0 OR k % 13 = 0 OR k % 19 = 0""",
    "geo_extract": f"WITH {DETAILS} SELECT url, lon, lat FROM details",
    "detail_extract": f"WITH {DETAILS} SELECT id, ts, lon, lat, key_words FROM details WHERE NOT blocked",
    "detail_keywords": f"WITH {DETAILS} SELECT id, key_words || '|B' AS key_words FROM details",
    "detail_extract_odd": f"WITH {DETAILS} SELECT url, name, lon, lat, key_words FROM details",
    "detail_heading": f"WITH {DETAILS} SELECT url, name FROM details",
    "page_status_verdict": f"WITH {DETAILS} SELECT url, {STATUS} AS status FROM details",
    "detail_round": f"""WITH {SHOPS}, {DETAILS}, j AS (SELECT *, {STATUS} AS status FROM details)
        SELECT s.id, CASE WHEN status = 200 THEN coalesce(d.lon, s.lon) ELSE s.lon END AS lon,
               CASE WHEN status = 200 THEN coalesce(d.lat, s.lat) ELSE s.lat END AS lat,
               CAST(CASE WHEN status = 200 THEN 20 ELSE 0 END AS INT) AS lock_, 'update' AS "action"
        FROM shops s JOIN j d ON d.id = s.id""",
    "new_shop_extract": f"WITH {DETAILS} SELECT id, name, lon, lat FROM details",
    "new_shop_searches": f"""WITH {DETAILS} SELECT id, '{SITE.search_base}' || replace(name, '#', '%23') AS search_url
        FROM details""",
    "keywords_join": f"""SELECT page_id, nullif({UNESCAPE.format(
        "array_to_string(regexp_extract_all(regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1), "
        "'(?s)<a[^>]*>([^<]+)<', 1), '|')")}, '') AS key_words FROM pages""",
    "heading_extract": f"""SELECT page_id, trim({UNESCAPE.format(
        "regexp_extract(html, '(?s)<h1[^>]*>([^<]+)<', 1)")}) AS name FROM pages""",
    "url_last_segment": "SELECT page_id, regexp_extract(url, '[^/]*$') AS id FROM pages",
    # Shops
    "claimable_ids": f"WITH {SHOPS} SELECT DISTINCT id FROM shops WHERE {CLAIMABLE}",
    "completeness_codes": f"""WITH {SHOPS}, {OBSERVATIONS}
        SELECT i.id, CASE WHEN s.id IS NULL THEN 100 ELSE {CODE} END AS code
        FROM (SELECT DISTINCT id FROM obs) i LEFT JOIN shops s ON s.id = i.id""",
    "completeness_by_code": f"""WITH {SHOPS}, {CARDS}, {DETAILS},
        m AS (SELECT coalesce(c.type_, s.type_) type_,
                     CASE WHEN d.blocked THEN s.lon ELSE coalesce(d.lon, s.lon) END lon,
                     CASE WHEN d.blocked THEN s.lat ELSE coalesce(d.lat, s.lat) END lat,
                     CAST(CASE WHEN d.blocked THEN 0 ELSE 20 END AS INT) lock_
              FROM shops s JOIN cards c ON c.id = s.id JOIN details d ON d.id = s.id)
        SELECT {CODE} AS code, lock_, count(*) AS n FROM m GROUP BY 1, 2""",
    "upsert_merge": f"{UPSERTED} SELECT * FROM merged",
    "upsert_inserts": f"""{UPSERTED} SELECT id, type_, consumption_per_capita FROM merged
        WHERE "action" = 'insert'""",
    "upsert_updates": f"""{UPSERTED} SELECT id, type_, consumption_per_capita FROM merged
        WHERE "action" = 'update'""",
    "dup_listing_count": """SELECT CAST(c_custkey AS VARCHAR) id, c_mktsegment AS name,
          CAST(c_nationkey AS VARCHAR) AS address,
          count(*) OVER (PARTITION BY c_mktsegment, c_nationkey) AS n FROM customer""",
    # Claims
    "claim_batch": f"""WITH {SHOPS} SELECT id, 1 AS code, '{SITE.detail_base}' || id AS url
        FROM (SELECT DISTINCT id FROM shops WHERE {CLAIMABLE}) ORDER BY id LIMIT 100""",
    "lock_state": f"WITH {LOCKS} SELECT id, lock_, since FROM locks",
    "lock_state_late": """SELECT id, arg_max(code, row(ts, -event_id, code)) AS lock_, max(ts) AS since
        FROM (SELECT CAST(user_id AS VARCHAR) id, event_id, ts, CAST(CASE event_type WHEN 'view' THEN 1
                WHEN 'purchase' THEN 20 ELSE 0 END AS INT) code
              FROM events WHERE event_type IN ('view','purchase','error')) GROUP BY id""",
    "lock_state_ttl": f"""WITH {LOCKS} SELECT id, CASE WHEN lock_ = 1
          AND since < TIMESTAMP '2024-01-26 00:00:00' THEN 0 ELSE lock_ END AS lock_ FROM locks""",
    "locked_shops": f"""WITH {SHOPS}, {LOCKS} SELECT s.id, coalesce(l.lock_, s.lock_) AS lock_
        FROM shops s LEFT JOIN locks l ON l.id = s.id""",
    "requeue": f"""SELECT '{SITE.detail_base}' || user_id AS url, count(*) FILTER (WHERE event_type='error') AS blocks
        FROM events WHERE event_type IN ('purchase','error') GROUP BY user_id
        HAVING arg_max(event_type, event_id) = 'error'""",
    "fetched_no_geo": f"WITH {SHOPS} SELECT id FROM shops WHERE lock_ = 20 AND (lon IS NULL OR lat IS NULL)",
    # Outcomes and pool
    "pool_state": STATE,
    "pool_state_by_lease": f"""WITH {MEMBERS}
        SELECT CAST(CAST(proxy AS BIGINT) // 10 AS VARCHAR) || '@' || strftime(birth_time, '%Y%m%d%H%M%S.%f') AS "key",
               score, ban_last AS ban, ban_death AS ban_death_time FROM life""",
    "outcomes_with_lease": """SELECT CAST(user_id AS VARCHAR) AS "key", event_id AS seq,
          user_id || '@' || strftime(min(ts) OVER (PARTITION BY user_id, least(CAST(floor((day(ts)-1)/10) AS INT), 2)),
                                     '%Y%m%d%H%M%S.%f') AS lease FROM events""",
    "ban_streak_running": f'WITH {_streaks(PLAIN)} SELECT "key", seq, run AS streak FROM r',
    "first_death": f'WITH {_streaks(PLAIN)} SELECT "key", min(ts) AS death_time FROM r WHERE run >= 3 GROUP BY "key"',
    "pool_in_use": """SELECT CAST(user_id AS VARCHAR) AS "key",
          CAST(sum(CASE WHEN event_type IN ('view','click') THEN 1
                        WHEN event_type IN ('purchase','error') THEN -1 ELSE 0 END) AS BIGINT) AS using_n
        FROM events GROUP BY 1""",
    "pool_eligible": f"WITH {MEMBERS} SELECT proxy, score, ban FROM unswept WHERE death < 1 AND ban < 3",
    "pool_eligible_count": f"WITH {MEMBERS} SELECT count(*) AS n FROM unswept WHERE death < 1 AND ban < 3",
    "pool_sweep": f"""WITH {MEMBERS} SELECT proxy, death < 1 AND ban >= 3 AS swept,
          CASE WHEN death < 1 AND ban >= 3 THEN 1 ELSE death END AS death,
          CASE WHEN death < 1 AND ban >= 3 THEN TIMESTAMP '2024-01-31 00:00:00' ELSE death_time END AS death_time,
          ban FROM unswept""",
    "births_today": f"WITH {MEMBERS} SELECT count(*) AS n FROM pool WHERE birth_time > TIMESTAMP '2024-01-11 00:00:00'",
    "pool_gap": f"""WITH {MEMBERS} SELECT
          count(*) FILTER (WHERE birth_time > TIMESTAMP '2024-01-11 00:00:00') AS born_today,
          count(*) FILTER (WHERE death < 1) AS alive,
          greatest(1000 - count(*) FILTER (WHERE death < 1), 0) AS gap FROM pool""",
    "pool_gap_current": f"""{HISTORY} SELECT
          count(*) FILTER (WHERE birth_time > TIMESTAMP '2024-01-11 00:00:00') AS born_today,
          count(*) FILTER (WHERE death < 1) AS alive,
          greatest(1000 - count(*) FILTER (WHERE death < 1), 0) AS gap FROM hist WHERE superseded_at IS NULL""",
    "dead_members": f"WITH {MEMBERS}, {DEAD.format(as_of='2024-01-11')} SELECT * FROM dead",
    "lifetime_class": f"""WITH {MEMBERS} SELECT proxy, CASE WHEN m < 5 THEN NULL WHEN m < 25 THEN 1
          WHEN m < 180 THEN 2 WHEN m < 360 THEN 3 WHEN m < 720 THEN 4 WHEN m <= 1440 THEN 5 END AS lifetime_class
        FROM (SELECT proxy, CAST(proxy AS INT) * 37 % 1500 AS m FROM pool)""",
    "pool_report": _report("2024-01-11"),
    "pool_report_empty": _report("2024-02-01"),
    "pool_report_lenient": _report("2024-02-01", lenient=True),
    "random_pick": f"""WITH {MEMBERS} SELECT proxy FROM pool WHERE death < 1 AND ban < 3
        ORDER BY md5('2024-01-11|' || proxy), proxy LIMIT 5""",
    "balanced_assignment": f"""WITH {MEMBERS},
        e AS (SELECT proxy, row_number() OVER (ORDER BY md5(proxy), proxy) - 1 AS n,
                     count(*) OVER () AS total FROM pool WHERE death < 1 AND ban < 3)
        SELECT o_orderkey AS item, e.proxy FROM orders
        JOIN e ON e.n = CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT)
                        % (SELECT max(total) FROM e)""",
    "lease_history": f"""{HISTORY} SELECT proxy, seq, birth_time, death, superseded_at,
          superseded_at IS NULL AS is_current,
          CASE WHEN superseded_at IS NULL THEN proxy
               ELSE proxy || '_' || (epoch_us(superseded_at) // 10000) END AS stored_key FROM hist""",
    "lease_current": f"{HISTORY} SELECT proxy, seq, birth_time, death FROM hist WHERE superseded_at IS NULL",
    # Frontier
    "next_page_links": f"""WITH {LINKS} SELECT '{LIST_HOST}' || page AS url, '{LIST_HOST}' || ahead AS next_url
        FROM links WHERE ahead IS NOT NULL""",
    "listing_depth": f"""WITH RECURSIVE {LINKS},
        walk(page, depth) AS (SELECT page, 0 FROM listing WHERE page % {CHAIN} = 0
          UNION ALL SELECT l.ahead, w.depth + 1 FROM walk w JOIN links l ON l.page = w.page
          WHERE l.ahead IS NOT NULL AND w.depth < {CHAIN})
        SELECT '{LIST_HOST}' || page AS url, CAST(min(depth) AS INT) AS depth FROM walk GROUP BY page""",
}

# Streams must end with what the batch operators give.
SQL["stream_extract"] = SQL["detail_extract"]
SQL["stream_upsert"] = SQL["upsert_merge"]
SQL["stream_pool"] = SQL["pool_state"]
SQL["stream_pool_late"] = SQL["pool_state"]
SQL["listing_extract_odd"] = SQL["listing_extract_nested"]
SQL["stream_listing"] = SQL["listing_extract_nested"]
SQL["stream_extract_dedup"] = SQL["detail_extract"]
SQL["stream_claims_ttl"] = SQL["lock_state_ttl"]
SQL["stream_counts"] = f"""WITH {CARDS},
    c AS (SELECT k // {CARDS_PER_PAGE} % 3 AS batch_id, k, k % 17 = 0 OR k % 13 = 0 OR k % 19 = 0 AS faulty FROM cards),
    s AS (SELECT batch_id, count(DISTINCT k // {CARDS_PER_PAGE}) AS pages, count(*) AS cards, count(*) FILTER (WHERE faulty) AS rejected
          FROM c GROUP BY batch_id)
    SELECT batch_id, 'pages.seen' AS name, pages AS n FROM s UNION ALL SELECT batch_id, 'pages.usable', pages FROM s
    UNION ALL SELECT batch_id, 'cards.seen', cards FROM s UNION ALL SELECT batch_id, 'cards.rejected', rejected FROM s"""
SQL["stream_unanswered"] = """SELECT CAST(event_id AS VARCHAR) AS request, CAST(user_id AS VARCHAR) AS "key",
    CAST(event_id % 1000 AS VARCHAR) AS id, ts + INTERVAL 30 MINUTE AS ts FROM events
    WHERE event_type IN ('view', 'click') AND (event_id % 3 = 0 OR event_id % 50 > 30)"""
SQL["pool_in_use_timeouts"] = """SELECT CAST(user_id AS VARCHAR) AS "key",
    CAST(count(*) FILTER (WHERE user_id % 7 = 0 AND NOT (event_id % 3 = 0 OR event_id % 50 > 30)) AS BIGINT) AS using_n
    FROM events WHERE event_type IN ('view', 'click') GROUP BY 1"""

# Names in SQL, and one scan for several tables.
SQL["sql_pool_report"] = SQL["pool_report"]
SQL["sql_dead_members"] = SQL["dead_members"]
SQL["sql_detail_extract"] = f"""WITH {DETAILS} SELECT id, lon, lat, CAST(CASE WHEN blocked THEN 403 ELSE 200 END AS INT) AS status FROM details"""
SQL["mixed_round"] = f"""WITH {CARDS}, {DETAILS},
    c AS (SELECT *, concat_ws(',', CASE WHEN k % 17 = 0 THEN 'id' END, CASE WHEN k % 13 = 0 THEN 'tags' END,
                              CASE WHEN k % 19 = 0 THEN 'stars' END) AS lacks FROM cards),
    d AS (SELECT *, {STATUS} AS status FROM details)
    SELECT 'card' AS kind, id, url, pos, name, stars, CAST(NULL AS DOUBLE) AS lon, CAST(NULL AS VARCHAR) AS key_words,
           CAST(NULL AS VARCHAR) AS missing, CAST(NULL AS INT) AS status FROM c WHERE lacks = ''
    UNION ALL SELECT 'reject', CASE WHEN k % 17 = 0 THEN NULL ELSE id END, url, pos, NULL, NULL, NULL, NULL, lacks, NULL FROM c WHERE lacks <> ''
    UNION ALL SELECT 'record', id, url, NULL, NULL, NULL, lon, key_words, NULL, NULL FROM d WHERE status = 200
    UNION ALL SELECT 'refused', NULL, url, NULL, NULL, NULL, NULL, NULL, NULL, status FROM d WHERE status <> 200"""
