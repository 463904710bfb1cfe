"""Page verdicts: is a stored page usable or a block notice?"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlfold.functions import html as H
from crawlfold.params import PAGE_BLOCKED, PAGE_OK, SITE, Site


def page_verdict(page: Column, site: Site = SITE) -> Column:
    """403 when the title or a button shows a block notice, else 200."""
    asked = H.block(page, "title").contains(site.captcha_title)
    landed = F.array_contains(H.texts(page, "button"), site.landing_button)
    return F.when(asked | landed, PAGE_BLOCKED).otherwise(PAGE_OK)


def status_column(pages: DataFrame, classifier: Callable[[DataFrame], Column] | None) -> Column:
    """Verdict of a classifier of the caller; what is not an integer counts as 200."""
    if classifier is None:
        return F.lit(PAGE_OK)
    verdict = classifier(pages)
    if not isinstance(pages.select(verdict.alias("v")).schema["v"].dataType, T.IntegralType):
        return F.lit(PAGE_OK)
    return F.coalesce(verdict.try_cast("int"), F.lit(PAGE_OK))


def default_classifier(pages: DataFrame, site: Site = SITE) -> Column:
    return page_verdict(pages["html"], site)


def judged_status(pages: DataFrame, classifier: Callable[[DataFrame], Column] | None = default_classifier) -> Column:
    """The stored HTTP status where it is known and not 200, else the classifier's verdict."""
    verdict = status_column(pages, classifier)
    if "status" not in pages.columns:
        return verdict
    stored = pages["status"]
    return F.when(stored.isNotNull() & (stored != PAGE_OK), stored).otherwise(verdict)


def with_verdict(pages: DataFrame, classifier: Callable[[DataFrame], Column] | None = default_classifier) -> DataFrame:
    """Pages with `status` judged: a page stored as refused stays so, the others go by their text."""
    return pages.withColumn("status", judged_status(pages, classifier))


def usable(pages: DataFrame, classifier: Callable[[DataFrame], Column] | None = default_classifier) -> DataFrame:
    """Pages that may be parsed."""
    return pages.filter(judged_status(pages, classifier) == PAGE_OK).withColumn("status", F.lit(PAGE_OK))
