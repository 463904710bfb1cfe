"""The reports and extraction rules under names of their own in SQL.

`register` makes them functions of the session: the two pool views as table functions of the day they look at, the
rules for pages and shops as scalar functions. They are SQL text themselves, so Catalyst inlines them: a filter on
the result reaches the scan, and a query that asks for two columns reads two.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from crawlfold.functions import markup as M
from crawlfold.operators.detail import LAT, LON
from crawlfold.params import BAN_N, SITE, Site


def _text(value: str) -> str:
    """A SQL literal of a text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _minutes(begin: str, end: str) -> str:
    """Whole elapsed seconds over 60."""
    return f"timestampdiff(SECOND, {begin}, {end}) / 60D"


def scalar_functions(site: Site = SITE) -> dict[str, str]:
    """Signature and body of each scalar function."""
    script = (f"try_element_at(filter(regexp_extract_all(html, {_text(M.SCRIPT)}, 1), "
              "s -> contains(s, 'shopGlat') AND contains(s, 'shopGlng')), 1)")
    title = "regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)"
    button = r"regexp_extract_all(html, '(?s)<button\\b[^>]*>([^<]+)<', 1)"
    return {
        "star_tenths(css STRING) RETURNS INT": "try_cast(CASE WHEN substring(css, -2, 1) = 'r' THEN substring(css, -1, 1) ELSE substring(css, -2, 2) END AS INT)",
        "shop_lon(html STRING) RETURNS DOUBLE": f"try_cast(regexp_extract({script}, {_text(LON)}, 1) AS DOUBLE)",
        "shop_lat(html STRING) RETURNS DOUBLE": f"try_cast(regexp_extract({script}, {_text(LAT)}, 1) AS DOUBLE)",
        "page_status(html STRING) RETURNS INT": f"CASE WHEN contains({title}, {_text(site.captcha_title)}) OR array_contains({button}, {_text(site.landing_button)}) THEN 403 ELSE 200 END",
        "url_id(url STRING) RETURNS STRING": "element_at(split(url, '/'), -1)",
        "detail_url(id STRING) RETURNS STRING": f"concat({_text(site.detail_base)}, id)",
        "completeness_code(type_ STRING, lon DOUBLE, lat DOUBLE) RETURNS INT":
            "CASE WHEN type_ IS NULL AND lon IS NOT NULL AND lat IS NOT NULL THEN 499 WHEN type_ IS NULL THEN 400"
            " WHEN lon IS NULL OR lat IS NULL THEN 301 ELSE 200 END",
    }


def table_functions(pool: str, ban_n: int = BAN_N) -> dict[str, str]:
    """Signature and query of each table function over the table or view `pool`."""
    dead = (f"SELECT proxy, birth_time, death_time, expire_time, {_minutes('birth_time', 'death_time')} AS lifetime_min,"
            f" {_minutes('death_time', 'expire_time')} AS unused_min, score, ban FROM {pool} AS p"
            " WHERE p.birth_time > {0}.as_of AND p.death = 1")
    measures = ", ".join(
        f"round(avg({value}) FILTER (WHERE {rows}), 6) AS {name}" for name, value, rows in (
            ("avg_score", "score", "is_dead"), ("avg_lifetime", _minutes("birth_time", "death_time"), "is_dead"),
            ("avg_score_nd", "score", f"is_dead AND ban < {ban_n}"),
            ("avg_lifetime_nd", _minutes("birth_time", "death_time"), f"is_dead AND ban < {ban_n}")))
    names = ("download_n", "nd_n", "avg_score", "avg_lifetime", "avg_score_nd", "avg_lifetime_nd")
    # One pass with filtered aggregates. A natural death is a death, so its count alone says whether an input is empty.
    report = (f"SELECT {', '.join(f'CASE WHEN nd_n > 0 THEN {n} END AS {n}' for n in names)} FROM ("
              f"SELECT count(*) AS download_n, count_if(is_dead AND ban < {ban_n}) AS nd_n, {measures} FROM ("
              f"SELECT *, p.death = 1 AS is_dead FROM {pool} AS p WHERE p.birth_time > pool_report.as_of))")
    return {
        "dead_members(as_of TIMESTAMP_NTZ) RETURNS TABLE (proxy STRING, birth_time TIMESTAMP_NTZ, death_time TIMESTAMP_NTZ, "
        "expire_time TIMESTAMP_NTZ, lifetime_min DOUBLE, unused_min DOUBLE, score BIGINT, ban BIGINT)": dead.format("dead_members"),
        "pool_report(as_of TIMESTAMP_NTZ) RETURNS TABLE (download_n BIGINT, nd_n BIGINT, avg_score DOUBLE, avg_lifetime DOUBLE, "
        "avg_score_nd DOUBLE, avg_lifetime_nd DOUBLE)": report,
    }


def register(spark: SparkSession, pool: str | None = None, site: Site = SITE, ban_n: int = BAN_N) -> list[str]:
    """Define the functions in the session, those over the pool if a table or view of that name is given; returns their names."""
    functions = scalar_functions(site) | (table_functions(pool, ban_n) if pool else {})
    for signature, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(")[0] for s in functions]
