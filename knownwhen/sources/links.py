"""Find archive links in page HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ZIP_LINK = r'href="([^"]+\.zip)"'
QUARTER_ZIP = r"(\d{4}q[1-4])\.zip$"


def discover(pages: DataFrame, base: str, html: str = "html", link: str = ZIP_LINK,
             token: str = QUARTER_ZIP) -> DataFrame:
    """Distinct absolute links with the token their name ends in, in link order.

    Links without a token are not archives of this series and are left out.
    """
    found = F.explode(F.regexp_extract_all(F.col(html), F.lit(link), F.lit(1)))
    absolute = F.when(F.col("link").startswith("http"), F.col("link")).otherwise(
        F.concat(F.lit(base), F.col("link")))
    return (
        pages.select(found.alias("link")).select(absolute.alias("zip_url")).distinct()
        .withColumn("quarter", F.regexp_extract("zip_url", token, 1))
        .where(F.col("quarter") != "")
        .select("quarter", "zip_url").orderBy("zip_url")
    )


def require_some(links: DataFrame) -> DataFrame:
    """An empty discovery means the page changed, not that there is nothing to do."""
    if links.isEmpty():
        raise LookupError("no archive links found; has the page layout changed?")
    return links
