"""Queries over pages, documents and events: extraction, sources, and incremental runs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dims import Config
from ..functions import extract
from ..operators import candidates as C
from ..sources import filings as S
from ..sources import records as R
from ..streaming import incremental as X
from .registry import query
from .substrate import FILINGS, RESOLVED, Tables

CONFIG = Config()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder where the cluster shares its checkpoints; a session of one machine without one gets a local folder.

    Raises on a cluster that names none, as executors do not see each other's folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(root or tempfile.mkdtemp(prefix='spark-scratch-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pages_with_guidance(t: Tables) -> DataFrame:
    """Pages as 8-K filings with a guidance section of their own after the page's body: with a table header on one line, on two, or
    without; some with a sentence too long for a candidate."""
    key = F.col("page_id")
    header = F.when(key % 3 == 0, "<p>Q2 2030 Full Year 2030</p>").when(key % 3 == 1, "<p>Q4 FY30</p><p>Full Year FY30</p>").otherwise("")
    long = F.when(key % 5 == 0, F.concat(F.lit("<p>We expect "), F.repeat(F.lit("very "), 300), F.lit("many millions, $5 million of them.</p>"))).otherwise("")
    section = F.concat(
        F.lit("<p>For the quarter:</p>"), header, F.lit("<h2>Financial Outlook</h2><p>Revenue of $"), (key % 90 + 10).cast("string"), F.lit(" million</p>"), long, F.lit("<p>We expect fiscal 2024 revenue of $"),
        (key % 50 + 1).cast("string"), F.lit(" billion. The rest is history.</p><h2>Conference Call</h2><p>None.</p>"),
    )
    return t.read("pages").select(key.cast("string").alias("accession"), F.lit("8-K").alias("form"), F.concat("html", section).alias("html"))


@query("t1_html_text")
def html_text(t: Tables) -> DataFrame:
    return t.read("pages").select("page_id", extract.html_text("html").alias("text"))


@query("t4_sentences")
def sentences(t: Tables) -> DataFrame:
    return C.sentences(t.read("documents").select(F.col("doc_id").alias("accession"), "text"))


@query("s2_integrity", "SELECT issue, count(*) AS n FROM (SELECT CASE WHEN doc_id % 17 = 0 THEN 'missing' WHEN doc_id % 13 = 0 THEN 'hash_mismatch' END AS issue FROM documents) GROUP BY issue")
def integrity(t: Tables) -> DataFrame:
    docs = t.read("documents").select("doc_id", F.col("text").cast("binary").alias("bytes"))
    content = F.when(F.col("doc_id") % 17 != 0, F.col("bytes"))
    stored = F.when(F.col("doc_id") % 13 == 0, F.lit("0" * 64)).otherwise(F.upper(F.sha2("bytes", 256)))
    return S.integrity(docs.select("doc_id", content.alias("content"), stored.alias("raw_sha256"))).groupBy("issue").agg(F.count("*").alias("n"))


@query("s6_round_trip", f"WITH {RESOLVED} SELECT record_id, company, status, target_low, reported_value, reported_value IS NULL AS no_outcome FROM resolved WHERE status <> 'open'")
def round_trip(t: Tables) -> DataFrame:
    """Records flattened to a review queue's text columns and built up again; nothing is lost."""
    schema = "record_id string, company string, status string, assumption struct<target_low: double, target_high: double, stated_at: date>, outcome struct<reported_value: double, reported_at: date>"
    nested = t.resolved.where("status <> 'open'").select(
        "record_id",
        "company",
        "status",
        F.struct("target_low", "target_high", "stated_at").alias("assumption"),
        F.when(F.col("reported_value").isNotNull(), F.struct("reported_value", "reported_at")).alias("outcome"),
    )
    flat = R.flatten(nested)
    queue = flat.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in flat.columns])
    back = R.unflatten(queue, schema)
    return back.select("record_id", "company", "status", "assumption.target_low", "outcome.reported_value", F.col("outcome").isNull().alias("no_outcome"))


@query("s8_release", f"WITH {RESOLVED} SELECT company, status, count(*) AS n, count(reported_value) AS outcomes FROM resolved WHERE reviewed AND publish GROUP BY ALL")
def release(t: Tables) -> DataFrame:
    """A release written flat and nested, read back from both."""
    rows = t.resolved.where("reviewed and publish").select("record_id", "company", "status", F.struct("target_low", "target_high", "stated_at").alias("assumption"), F.struct("reported_value").alias("outcome"))
    path = scratch(t.spark, "release")
    R.write_release(rows, path)
    flat = t.spark.read.parquet(f"{path}/parquet").select("record_id", "company", "status", F.col("`outcome.reported_value`").alias("v"))
    nested = t.spark.read.schema(rows.schema).json(f"{path}/jsonl").select("record_id", F.col("outcome.reported_value").alias("w"))
    both = flat.join(nested, "record_id").where(F.col("v").eqNullSafe(F.col("w")))
    return both.groupBy("company", "status").agg(F.count("*").alias("n"), F.count("v").alias("outcomes"))


@query("s4_jsonl", "SELECT doc_id % 7 <> 0 AND doc_id % 11 <> 0 AS valid, count(*) AS n FROM documents GROUP BY 1")
def jsonl(t: Tables) -> DataFrame:
    """Records as JSON lines; broken lines and rows with unknown keys are counted, not raised."""
    key = F.col("doc_id")
    good = F.to_json(F.struct(key.cast("string").alias("record_id"), F.col("lang").alias("company")))
    line = F.when(key % 7 == 0, F.lit("{broken")).when(key % 11 == 0, F.concat(F.lit('{"record_id": "'), key.cast("string"), F.lit('", "extra": 1}'))).otherwise(good)
    path = scratch(t.spark, "jsonl")
    t.read("documents").select(line.alias("value")).write.text(path)
    return R.read_jsonl(t.spark, path, "record_id string, company string").groupBy("valid").agg(F.count("*").alias("n"))


_FOLDER = "/Archives/edgar/data/12/000000001224000001/"


@query("s11_index_documents", f"SELECT page_id::VARCHAR AS page_id, CASE WHEN page_id % 2 = 0 THEN 'EX-99.1' ELSE 'EX-99' END AS doc_type, '{_FOLDER}b' || page_id || '&c.htm' AS path FROM pages")
def index_documents(t: Tables) -> DataFrame:
    """Index tables of filings: an exhibit is picked before the form itself; viewers, other hosts, other folders, character references, and links
    outside the document's own column."""
    key = F.col("page_id").cast("string")
    kind = F.when(F.col("page_id") % 2 == 0, " EX-99.1").otherwise("<b>EX-99</b>\n&nbsp;")
    row = '<tr class="x"><td scope="row">%s</td><td>%s</td><td><a\nhref="%s%s%s">d</a></td><td>%s</td></tr>'
    host = F.when(F.col("page_id") % 3 == 0, "https://www.sec.gov").when(F.col("page_id") % 3 == 1, "//efts.sec.gov:443").otherwise("")
    rows = [
        (F.lit("1"), F.lit("x"), F.lit(f"/ix?doc={_FOLDER}a"), key, F.lit(".htm&amp;x=1"), F.lit("8-K")),
        (F.lit("&nbsp;2 "), F.lit('<a href="/elsewhere">x</a>'), F.concat(host, F.lit(f"{_FOLDER}b")), key, F.lit("&amp;c.htm#top"), kind),
        (F.lit("3"), F.lit(f'<a href="{_FOLDER}x">x</a>'), F.lit("/elsewhere/c"), key, F.lit(""), F.lit("EX-99.1")),
        (F.lit("4"), F.lit("x"), F.lit(f"https://example.com{_FOLDER}d"), key, F.lit(""), F.lit("EX-99.1")),
        (F.lit("x"), F.lit("x"), F.lit(f"{_FOLDER}e"), key, F.lit(""), F.lit("EX-99.1")),
        (F.lit("5"), F.lit("x"), F.lit(f"{_FOLDER}deep/f"), key, F.lit(""), F.lit("EX-99.1")),
    ]
    html = F.concat(F.col("html"), F.lit("<table>"), *[F.format_string(row, *cells) for cells in rows], F.lit("</table>"))
    pages = t.read("pages").select(key.alias("page_id"), html.alias("html"))
    return S.pick_document(S.index_documents(pages))


@query("x1_unseen_filings", f"WITH {FILINGS}, w AS (SELECT cik, max(filed_at) AS d FROM filings WHERE o_orderkey % 3 = 0 GROUP BY cik) SELECT accession FROM filings JOIN w USING (cik) WHERE filed_at > d OR (filed_at = d AND o_orderkey % 3 <> 0)")
def unseen(t: Tables) -> DataFrame:
    """What a run finds after the watermarks of an earlier one."""
    seen = t.filings.where("o_orderkey % 3 = 0").select("cik", "accession", "filed_at", F.lit(True).alias("ok"))
    marks = X.advance(t.spark.createDataFrame([], "cik string, last_filing_date date, accessions_on_last_date array<string>"), seen)
    return X.unseen(t.filings.select("cik", "accession", "filed_at"), marks).select("accession")


@query(
    "a13_advance",
    f"""WITH {FILINGS}, w AS (SELECT cik, max(filed_at) AS d FROM filings WHERE o_orderkey % 3 = 0 GROUP BY cik), r AS (SELECT cik, max(filed_at) AS day, bool_and(o_orderkey % 400 <> 1) AS clean FROM filings WHERE o_orderkey % 3 = 1 GROUP BY cik)
        SELECT cik, CASE WHEN clean AND (d IS NULL OR day > d) THEN day ELSE d END AS last_filing_date FROM w FULL JOIN r USING (cik)""",
)
def advance(t: Tables) -> DataFrame:
    first = t.filings.where("o_orderkey % 3 = 0").select("cik", "accession", "filed_at", F.lit(True).alias("ok"))
    second = t.filings.where("o_orderkey % 3 = 1").select("cik", "accession", "filed_at", (F.col("o_orderkey") % 400 != 1).alias("ok"))
    marks = X.advance(t.spark.createDataFrame([], "cik string, last_filing_date date, accessions_on_last_date array<string>"), first)
    return X.advance(marks, second).select("cik", "last_filing_date")


@query("x6_late_rows", f"WITH {FILINGS}, w AS (SELECT cik, max(filed_at) AS d FROM filings WHERE o_orderkey % 3 = 0 GROUP BY cik) SELECT cik, count(*) AS late FROM filings JOIN w USING (cik) WHERE o_orderkey % 3 = 1 AND filed_at < d GROUP BY cik")
def late(t: Tables) -> DataFrame:
    marks = t.filings.where("o_orderkey % 3 = 0").groupBy("cik").agg(F.max("filed_at").alias("last_filing_date"))
    return X.late_rows(t.filings.where("o_orderkey % 3 = 1"), marks).groupBy("cik").agg(F.count("*").alias("late"))


@query("x3_open_work", f"WITH {RESOLVED} SELECT stage, count(*) AS n FROM (SELECT 'outcome' AS stage FROM resolved WHERE status = 'unresolved' UNION ALL SELECT 'acknowledgement' FROM resolved WHERE status = 'missed' AND acknowledged_at IS NULL AND reported_at + 400 >= DATE '2000-06-30' UNION ALL SELECT 'withdrawal' FROM resolved WHERE period_close >= DATE '2000-06-30' AND withdrawn_at IS NULL) GROUP BY stage")
def open_work(t: Tables) -> DataFrame:
    return X.open_work(t.resolved, "2000-06-30", CONFIG.ack_days).groupBy("stage").agg(F.count("*").alias("n"))


def _run_stream(stream: DataFrame, path: str, write) -> None:
    run = stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    write(run).start().awaitTermination()


_TRACK = """WITH m AS (SELECT user_id, event_type, ts, value, lag(event_type) OVER w AS t0, lag(ts) OVER w AS s0, lag(value) OVER w AS v0 FROM events WHERE event_type IN ('signup', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, s0 AS stated, v0 AS guided, value AS reported, CASE WHEN value >= v0 THEN 'met' ELSE 'missed' END AS result FROM m WHERE event_type = 'purchase' AND t0 = 'signup'"""


@query("x2_stream_merge", "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type")
def stream_merge(t: Tables) -> DataFrame:
    """The events as files that arrive one by one, each merged into the parts of a table that it touches; the table equals the batch result."""
    path = scratch(t.spark, "merge")
    t.read("events").repartition(3, "event_id").write.parquet(f"{path}/in")
    schema = t.read("events").schema
    stream = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    _run_stream(stream, path, lambda w: w.foreachBatch(X.merge_batches(f"{path}/table", ["event_id"])))
    return X.merged(t.spark, f"{path}/table", schema).groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))


@query("x5_track_batch", _TRACK)
def track_batch(t: Tables) -> DataFrame:
    return X.track_batch(t.read("events"))


@query("x5_track_stream")
def track_stream(t: Tables) -> DataFrame:
    """The stateful tracker over the events as a stream of one batch."""
    path = scratch(t.spark, "track")
    events = t.read("events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(f"{path}/in")
    stream = X.track_stream(t.spark.readStream.schema(events.schema).parquet(f"{path}/in"))
    _run_stream(stream, path, lambda w: w.format("parquet").outputMode("append").option("path", f"{path}/out"))
    return t.spark.read.schema(X.TRACKED).parquet(f"{path}/out").where("result <> 'expired'")
