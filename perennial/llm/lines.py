"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial.llm import names
from perennial.session import stage

# A line is boilerplate of its site when more than this share of the site's pages carry it ...
RATIO = 0.1
# ... and at least this many pages do. Small sites would otherwise lose lines that one page has.
MIN_PAGES = 5


def _line_keys(text: Column) -> Column:
    """Hashes of the trimmed lines, zero for lines without text (they are never boilerplate)."""
    trimmed = lambda line: F.btrim(line, F.lit(" \t\r"))
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1),
        lambda line: F.when(trimmed(line) == "", F.lit(0).cast("long")).otherwise(F.xxhash64(trimmed(line))),
    )


def site_of(url: Column) -> Column:
    """The host of a page's address in lower case; null without one."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def between_tags(html: Column) -> Column:
    """A page's source with each tag replaced by a line break, so that what stands between tags is a line."""
    return F.regexp_replace(html, "<[^>]*>", "\n")


def boilerplate(
    docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """Per site: its page total and the keys of its boilerplate lines.

    A page counts once for each line it has. Counting is partial in each task,
    so a site with a third of all pages meets as counts, not as pages. Lines
    above the ratio number at most (lines per page) / ratio for a site, which
    bounds the array whatever the number of pages. A null site is a site of its
    own, null and empty texts have no lines, repeated rows are pages each, and
    other columns play no part.
    """
    pages = docs.groupBy(F.col(site).alias("_site")).agg(F.count(F.lit(1)).alias("n_pages"))
    lines = (
        docs.select(F.col(site).alias("_site"), F.explode(F.array_distinct(_line_keys(F.col(text)))).alias("key"))
        .where("key <> 0")
        .groupBy("_site", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    return (
        lines.join(pages, lines["_site"].eqNullSafe(pages["_site"]))
        .where(F.col("n") > F.col("n_pages") * F.lit(ratio))
        .select(pages["_site"], "n_pages", "key")
        .groupBy("_site", "n_pages")
        .agg(F.collect_list("key").alias("keys"))
    )


def drop_boilerplate(
    docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """Documents without the boilerplate lines of their site, with ``n_lines`` and ``n_dropped``.

    All rows stay, also those that lose every line (empty text). Null texts
    stay null and have no lines. A null site is a site of its own. Repeated
    rows count as pages of their own. Columns named ``n_lines`` or
    ``n_dropped`` are replaced, the others stay. Dropped lines go with their
    line break; the rest of the text stays byte for byte. The table of sites
    is stored first, so its size is known: Catalyst broadcasts it when small
    and otherwise shuffles, where adaptive execution splits a hot site.
    """
    own = names.without(docs, ("n_lines", "n_dropped"))
    if not {site, text} <= set(docs.columns):
        raise ValueError("site and text must be columns, spelled as they are")
    found = stage(
        boilerplate(docs, site, text, ratio, min_pages).select(
            F.coalesce(F.concat(F.lit("s"), F.col("_site").cast("string")), F.lit("n")).alias("_key"),
            F.col("keys").alias("_drop"),
        ),
        "boilerplate",
    )
    own, back = names.aside(own, ("_key", "_drop", "_keys", "_kept"))
    keyed = own.withColumn(
        "_key", F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("n"))
    )
    joined = keyed.join(found, "_key", "left")
    marked = joined.withColumn("_keys", F.when(F.col("_drop").isNotNull(), _line_keys(F.col(text))))
    touched = F.coalesce(F.arrays_overlap("_keys", "_drop"), F.lit(False))
    kept = F.filter(
        F.split(F.col(text), "\n", -1), lambda line, i: ~F.array_contains("_drop", F.get("_keys", i))
    )
    cleaned = marked.withColumn("_kept", F.when(touched & F.col(text).isNotNull(), kept))
    total = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(F.split(F.col(text), "\n", -1)))
    counted = cleaned.withColumn("n_lines", total.cast("long")).withColumn(
        "n_dropped",
        F.when(F.col("_kept").isNotNull(), F.col("n_lines") - F.size("_kept")).otherwise(0).cast("long"),
    )
    return counted.withColumn(
        text, F.when(F.col("_kept").isNotNull(), F.array_join("_kept", "\n")).otherwise(F.col(text))
    ).drop("_key", "_drop", "_keys", "_kept").withColumnsRenamed(back)
