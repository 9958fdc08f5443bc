"""Tagging expressions: the reference's per-row Python rules as CASE columns.

First matching rule wins, as in the original if-chains. NULL input gives NULL
output (the original raised on None).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from trafficlens.functions.columns import as_col

# ---------------------------------------------------------------------------
# Output labels and URL fragments equal to the reference's.
# ---------------------------------------------------------------------------
CITY_MSK = "MSK"
CITY_SPB = "SPB"
CITY_MSK_PATTERNS = ("%mosk%",)
CITY_SPB_PATTERNS = ("%sankt-%", "%lening%")
CAMPAIGN_SECONDARY = "УП реклама"
CAMPAIGN_NEW_BUILD = "Новосторойки реклама"
CAMPAIGN_NON_AD = "Не рекламные"
CAMPAIGN_OTHER = "Другие рекламные кампании"
CAMPAIGN_NOT_SET = "(not set)"
GEO_MSK = ("moskva-i-oblast", "moskva", "moskovskaya-oblast")
GEO_SPB = ("sankt-peterburg", "leningradskaya-oblast", "sankt-peterburg-i-oblast")
# ---------------------------------------------------------------------------


def _like_any(c: Column, patterns) -> Column:
    cond = None
    for p in patterns:
        cond = c.like(p) if cond is None else (cond | c.like(p))
    return cond


def _contains_any(c: Column, fragments) -> Column:
    cond = None
    for frag in fragments:
        cond = c.contains(frag) if cond is None else (cond | c.contains(frag))
    return cond


def city_bucket(c, default: str = "REG") -> Column:
    """Path -> MSK / SPB / ``default`` (NULL path -> ``default``)."""
    c = as_col(c)
    return (F.when(_like_any(c, CITY_MSK_PATTERNS), CITY_MSK)
            .when(_like_any(c, CITY_SPB_PATTERNS), CITY_SPB)
            .otherwise(default))


def campaign_type(c) -> Column:
    """Utm campaign -> ad type (case-sensitive)."""
    c = as_col(c)
    return (F.when(c.contains("second"), CAMPAIGN_SECONDARY)
            .when(c.contains("new-building"), CAMPAIGN_NEW_BUILD)
            .when(c == CAMPAIGN_NOT_SET, CAMPAIGN_NON_AD)
            .when(c.isNotNull(), CAMPAIGN_OTHER))


def tag_location(c) -> Column:
    """Label -> SERP / CARD / NULL (case-insensitive)."""
    low = F.lower(as_col(c))
    return F.when(low.contains("serp"), "SERP").when(low.contains("card"), "CARD")


def tag_product(c) -> Column:
    """Label -> protection / onlinebuy / NULL (case-insensitive)."""
    low = F.lower(as_col(c))
    return (F.when(low.contains("protection") | low.contains("guarantee"), "protection")
            .when(low.contains("onlinebuy"), "onlinebuy"))


def tag_action(c) -> Column:
    """U4: label -> click / view / NULL (case-insensitive)."""
    low = F.lower(as_col(c))
    return F.when(low.contains("click"), "click").when(low.contains("view"), "view")


def tag_geo(c) -> Column:
    """Page -> MSK / SPB / NULL (case-sensitive substring match)."""
    c = as_col(c)
    return F.when(_contains_any(c, GEO_MSK), CITY_MSK).when(_contains_any(c, GEO_SPB), CITY_SPB)


def regex_prefix(c, sep: str = "_") -> Column:
    """Text before the first ``sep``; NULL when ``sep`` does not occur
    (the warehouse's REGEXP_EXTRACT gives NULL on no match, Spark gives '')."""
    c = as_col(c)
    pattern = f"(.*?){re.escape(sep)}.*?"
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def length_positive(c) -> Column:
    """P12 as a predicate: ``length(x) > 0`` (NULL -> not kept)."""
    return F.length(as_col(c)) > 0


def lower_contains(c, fragment: str) -> Column:
    """P14."""
    return F.lower(as_col(c)).contains(fragment.lower())
