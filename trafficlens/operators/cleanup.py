"""Clean-up pipelines (U6, U7): the reference's pandas ``purify`` steps as
column expressions over a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.calendar import iso_week, parse_iso_date
from trafficlens.functions.columns import cast_metrics, drop_columns, normalize_columns
from trafficlens.functions.tagging import campaign_type, tag_action, tag_location, tag_product


def purify_calls(df: DataFrame) -> DataFrame:
    """Campaign type, parsed date, ISO week, integer event counts.

    Input: ``date`` (DATE or ISO text), ``utm_campaign``, ``totalEvents``,
    ``uniqueEvents`` and any other columns, which pass through.
    """
    out = df.withColumn("cpc_type", campaign_type("utm_campaign"))
    date_type = dict(out.dtypes)["date"]
    if date_type == "string":
        out = out.withColumn("date", parse_iso_date("date"))
    out = out.withColumn("week", iso_week("date"))
    return cast_metrics(out, ["totalEvents", "uniqueEvents"])


def purify_banners(df: DataFrame) -> DataFrame:
    """Normalise names, tag product / location / action, drop category and
    action, integer counts, keep rows with a product."""
    out = normalize_columns(df, prefix="ga:", lower=True)
    out = (out.withColumn("product", tag_product("eventlabel"))
              .withColumn("card_serp", tag_location("eventlabel"))
              .withColumn("action_type", tag_action("eventlabel")))
    out = drop_columns(out, ["eventcategory", "eventaction"])
    out = cast_metrics(out, ["totalevents", "users"])
    return out.where(F.col("product").isNotNull())
