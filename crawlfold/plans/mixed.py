"""Pages of several kinds in one table: read once, each by its own parser, written as several tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlfold.functions import html as H, markup as M
from crawlfold.operators import detail, listing, verdict
from crawlfold.params import PAGE_OK
from crawlfold.plans.rounds import DETAIL_FIELDS, LISTING_FIELDS

LISTING, DETAIL = "listing", "detail"
#: Rows of the result: a card, a card that lacks a field, a detail record, a page that may not be parsed.
CARD, REJECT, RECORD, REFUSED = "card", "reject", "record", "refused"
COLUMNS = {
    CARD: ["id", "url", "ts", "pos", *LISTING_FIELDS],
    REJECT: ["id", "url", "ts", "pos", "missing"],
    RECORD: ["id", "url", "ts", *DETAIL_FIELDS],
    REFUSED: ["url", "ts", "status"],
}


def kind_of(pages: DataFrame) -> Column:
    """A page that was asked for a shop is its detail page, any other a listing page."""
    return F.when(F.col("meta")["shopId"].isNotNull(), DETAIL).otherwise(LISTING)


def routed(pages: DataFrame, kind: Column | None = None) -> DataFrame:
    """Rows of all parsers over one scan, each with its `kind` and the columns of all kinds, NULL where not its own.

    A page goes to the parser of its `kind` (`kind_of` by default); the patterns of the others do not run on it. A
    page of another kind than these gives no row. Cards, rejects and records equal those of the separate rounds.
    """
    asked = pages.withColumn("_kind", kind_of(pages) if kind is None else kind)
    judged = verdict.with_verdict(asked)
    ok = F.col("status") == PAGE_OK
    shown = H.once(judged.select(
        "url", F.col("fetched_at").alias("ts"), "status", F.col("meta")["shopId"].alias("_shop"),
        F.when(ok, F.col("_kind")).alias("_kind"), (F.col("_kind").isin(LISTING, DETAIL) & ~ok).alias("_refused"), "html",
        F.when(ok & F.col("_kind").isin(LISTING, DETAIL), M.visible(F.col("html"))).alias("_html")))
    is_detail = F.col("_kind") == DETAIL
    words = H.once(shown.withColumn("_words", F.when(is_detail, F.array_join(detail.key_words(F.col("_html")), "|"))))
    placed = detail.with_position(words.withColumn("html", F.when(is_detail, F.col("html"))))
    known = H.once(placed.select(
        "url", "ts", "status", "_shop", "_kind", "_refused", "lon", "lat", H.known(H.unescape(F.col("_words"))).alias("key_words"),
        F.when(F.col("_kind") == LISTING, F.col("_html")).alias("_html")))
    kept = [c for c in known.columns if c != "_html"]
    parsed = listing.parse_cards(listing.split_cards(known, kept, outer=True), keep=[c for c in kept if c not in ("url", "ts")])
    row = (
        F.when(F.col("_refused"), REFUSED)
        .when(F.col("_kind") == DETAIL, RECORD)
        .when(F.col("pos").isNull(), F.lit(None))  # a listing page without cards
        .when(F.col("missing").isNotNull(), REJECT)
        .otherwise(CARD)
    )
    tagged = parsed.withColumns({"kind": row, "id": F.coalesce("id", F.when(F.col("_kind") == DETAIL, F.col("_shop")))})
    names = list(dict.fromkeys(c for columns in COLUMNS.values() for c in columns))
    return tagged.filter(F.col("kind").isNotNull()).select("kind", *names)


def write_tables(rows: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Store `routed` rows, one folder per kind, in one job; returns the stored table of each kind with its own columns."""
    rows.write.partitionBy("kind").parquet(folder)
    schema = rows.drop("kind").schema
    stored = rows.sparkSession.read.schema(rows.schema).option("basePath", folder).parquet(folder)
    return {kind: stored.filter(F.col("kind") == kind).select(*[c for c in schema.names if c in columns]) for kind, columns in COLUMNS.items()}
