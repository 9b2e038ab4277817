"""Filings: cached documents with their metadata, feeds, and index pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

META = (
    "cik string, accession string, filing_type string, doc_type string, filed_at date, items array<string>, requested_url string, final_url string, "
    "http_status int, content_type string, bytes long, raw_sha256 string, content_sha256 string, fetched_at timestamp"
)


def read_cache(spark: SparkSession, root: str) -> DataFrame:
    """Documents ``<cik>/<accession>.html`` beside ``<accession>.json``; those fetched well, with what their bytes hash to."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").option("recursiveFileLookup", "true").load(root)
    raw = raw.select(F.regexp_extract("path", r"([^/]+)/[^/]+\.html$", 1).alias("dir_cik"), F.regexp_extract("path", r"([^/]+)\.html$", 1).alias("accession"), "content")
    meta = spark.read.schema(META).option("multiLine", "true").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").json(root)
    return meta.where("http_status = 200").join(raw.drop("dir_cik"), "accession", "left")


def integrity(filings: DataFrame) -> DataFrame:
    """Adds ``issue``: missing, hash_mismatch or null."""
    return filings.withColumn("issue", F.when(F.col("content").isNull(), "missing").when(F.sha2("content", 256) != F.lower("raw_sha256"), "hash_mismatch"))


ENTRY = "content struct<`accession-number`: string, `filing-type`: string, `filing-date`: string, `filing-href`: string, `items-desc`: string>"


def _complete(entries: DataFrame) -> DataFrame:
    return entries.select(
        F.col("content.accession-number").alias("accession"),
        F.col("content.filing-type").alias("form"),
        F.expr("try_cast(content.`filing-date` as date)").alias("filed_at"),
        F.regexp_extract_all(F.coalesce("content.items-desc", F.lit("")), F.lit(r"\d\.\d{2}"), F.lit(0)).alias("items"),
        F.col("content.filing-href").alias("index_url"),
    ).where("accession is not null and form is not null and filed_at is not null and index_url is not null")


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of Atom files: accession, form, day, items and index page; incomplete entries are dropped."""
    return _complete(spark.read.format("xml").option("rowTag", "entry").schema(ENTRY).load(path))


def feed_entries(pages: DataFrame, page: str = "page") -> DataFrame:
    """The same of Atom pages held in a column."""
    parsed = F.from_xml(page, f"entry array<struct<{ENTRY.replace('content struct', 'content: struct', 1)}>>")
    return _complete(pages.select(F.explode(parsed["entry"]).alias("e")).select("e.*"))


# Character references that index pages use, hosts that links may name, and where documents lie in the archive.
REFERENCES = [("&nbsp;", " "), ("&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#38;", "&"), ("&amp;", "&")]
HOSTS = r"www\.sec\.gov|efts\.sec\.gov"
ARCHIVE = r"^/Archives/edgar/data/\d+/\d{18}/[^/?#]+$"


def _decoded(text: Column) -> Column:
    for name, char in REFERENCES:  # the ampersand last, so that what it makes is not read again
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def archive_path(href: Column) -> Column:
    """Where in the archive a link leads, without a viewer around it; null for other hosts and places."""
    local = F.regexp_replace(href, f"^(?:https?:)?//(?:{HOSTS})(?::\\d+)?(?=/)", "")
    shown = F.regexp_extract(local, r"^/ix\?doc=([^&#]*)", 1)
    path = F.when(shown != "", shown).otherwise(F.regexp_extract(local, r"^[^?#]*", 0))
    return F.when(path.rlike(ARCHIVE), path)


def index_documents(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows of an index page's tables with four cells or more, a number first and a link into the archive in the third: position, type and path."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    found = pages.select("page_id", F.posexplode(rows).alias("position", "row"))
    cells = F.regexp_extract_all("row", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1))
    found = found.withColumn("cells", cells).where(F.size("cells") >= 4)
    plain = F.transform("cells", lambda c: F.trim(F.regexp_replace(_decoded(F.regexp_replace(c, "(?s)<[^>]*>", "")), r"\s+", " ")))
    link = _decoded(F.regexp_extract(F.get("cells", F.lit(2)), r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']""", 1))
    out = found.select("page_id", "position", F.get(plain, F.lit(0)).alias("seq"), F.get(plain, F.lit(3)).alias("doc_type"), archive_path(link).alias("path"))
    return out.where(F.col("seq").rlike(r"^\d+$") & F.col("path").isNotNull()).drop("seq")


def pick_document(documents: DataFrame) -> DataFrame:
    """One document an index page: EX-99.1, else EX-99, else the form itself; the first on the page."""
    priority = F.when(F.col("doc_type") == "EX-99.1", 0).when(F.col("doc_type") == "EX-99", 1).when(F.col("doc_type").isin("10-K", "10-Q"), 2)
    ranked = documents.withColumn("priority", priority).where("priority is not null")
    return ranked.groupBy("page_id").agg(F.min_by(F.struct("doc_type", "path"), F.struct("priority", "position")).alias("d")).select("page_id", "d.*")
