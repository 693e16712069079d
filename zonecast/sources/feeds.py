"""Trip feed discovery and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.schemas import FEEDS, ZONE_LOOKUP

# File name of each feed, followed by the month.
FEED_FILES = {"yellow": "yellow", "green": "green", "hvfhv": "fhvhv"}

NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']([^"']*)["']"""


def scan_feed(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """Read only the columns of a feed that the panel needs."""
    schema = FEEDS[feed].schema
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def scan_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ZONE_LOOKUP).csv(path, header=True)


def extract_links(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """Link targets of the anchors of each page, with their place on it."""
    text = F.regexp_replace(html, NOT_MARKUP, "")
    links = F.regexp_extract_all(text, F.lit(ANCHOR), F.lit(1))
    return pages.select(page, F.posexplode(links).alias("position", "href")).withColumn(
        "href", F.replace("href", F.lit("&amp;"), F.lit("&"))
    )


def select_feed_files(
    links: DataFrame, feed: str, month: str, host: str = "", page: str = "page_id"
) -> DataFrame:
    """The file of ``feed`` for ``month`` (``YYYY-MM``) on each page; the last link to one wins.

    Relative links get ``host`` in front.
    """
    name = rf"(?i){FEED_FILES[feed]}_tripdata_(\d{{4}}-\d{{2}})\.parquet"
    url = F.when(F.col("href").startswith("http"), F.col("href")).otherwise(
        F.concat(F.lit(host), "href")
    )
    return (
        links.where(F.regexp_extract("href", name, 1) == month)
        .groupBy(page)
        .agg(F.max_by(url, "position").alias("url"))
    )
