"""Further guards, period rules and review rules over templated sentences and derived statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dims import Config
from ..functions import guards as G
from ..functions import ids
from ..functions import text as T
from ..operators import review, validate
from ..sources import filings as S
from ..sources import records as R
from .corpus import scratch
from .registry import query
from .substrate import FILINGS, RESOLVED, SENTENCES, STATEMENTS, Tables

CONFIG = Config()


@query("g2_metric_known", f"WITH {STATEMENTS} SELECT record_id, part % 8 <> 3 AS known FROM statements")
def metric_known(t: Tables) -> DataFrame:
    named = t.statements.select("record_id", F.when(F.col("part") % 8 == 3, "dividends").otherwise(F.col("metric")).alias("metric"))
    known = F.broadcast(t.metrics.select("metric", F.lit(True).alias("known")))
    return named.join(known, "metric", "left").select("record_id", F.coalesce("known", F.lit(False)).alias("known"))


@query("g19_custom_id", f"WITH {STATEMENTS} SELECT record_id, replace(accession, '-', '') || '_' || line || '_sen' AS custom_id FROM statements")
def custom_id(t: Tables) -> DataFrame:
    return t.statements.select("record_id", ids.custom_id(F.col("accession"), F.col("line"), F.lit("sentence")).alias("custom_id"))


_AHEAD = r"(^|[^A-Za-z0-9_])(expected|expects|guidance|outlook|anticipates)([^A-Za-z0-9_]|$)"
_REPORTING = (
    "was were had did used delivered reported returned grew increased decreased declined rose fell totaled totalled generated achieved completed recorded posted reached earned gained lost exceeded repurchased paid"
).split()


@query(
    "g21_result_excerpt",
    f"""WITH {SENTENCES} SELECT record_id, NOT regexp_matches(lower(sentence), '{_AHEAD}') OR len(list_intersect(regexp_split_to_array(lower(sentence), '[^a-z]+'), {_REPORTING!r})) > 0
        OR contains(lower(sentence), 'came in') AS ok FROM sentences""",
)
def result_excerpt(t: Tables) -> DataFrame:
    """Whether a sentence can report a result: "increased 7 percent, which exceeded our prior outlook" can, "is expected to be" cannot."""
    return t.sentences.select("record_id", G.is_result(F.col("sentence")).alias("ok"))


#: What a line says of sales, and which way it goes alone.
_SALES = [
    ("Comparable sales decreased", -1), ("Comparable sales increased", 1), ("Comparable sales were flat", 0), ("Comparable sales were lower", -1), ("Comparable sales were higher", 1),
    ("Comparable sales grew in stores and declined online", 0), ("U.S. Comparable Sales FELL", -1), ("Comparable sales rose", 1), ("Comparable sales were set up, then down", 0),
]


@query(
    "g24_sales_sign",
    f"""WITH {STATEMENTS}, v AS (SELECT record_id, metric, CASE WHEN supp % 2 = 0 THEN -reported_value ELSE reported_value END AS v, ({[way for _, way in _SALES]!r})[1 + supp % {len(_SALES)}] AS way FROM statements)
        SELECT record_id, CASE WHEN metric <> 'comparable sales' OR way = 0 OR v = 0 THEN v ELSE way * abs(v) END AS value FROM v""",
)
def sales_sign(t: Tables) -> DataFrame:
    """Values of all metrics, read with either sign; on comparable sales a line that goes one way alone decides."""
    said = F.element_at(F.array(*[F.lit(text) for text, _ in _SALES]), (F.col("supp") % len(_SALES) + 1).cast("int"))
    value = F.when(F.col("supp") % 2 == 0, -F.col("reported_value")).otherwise(F.col("reported_value"))
    return t.statements.select("record_id", G.comparable_sales_sign(F.col("metric"), value, said).alias("value"))


@query("g29_publishable", f"WITH {STATEMENTS} SELECT company, count(*) FILTER (reviewed) AS approved, count(*) FILTER (NOT reviewed) AS pending, count(*) FILTER (reviewed AND publish) AS publishable FROM statements GROUP BY company")
def publishable(t: Tables) -> DataFrame:
    published = t.companies.where("publish").select("cik", F.lit(True).alias("listed"))
    rows = t.statements.join(published, "cik", "left")
    return rows.groupBy("company").agg(F.count_if("reviewed").alias("approved"), F.count_if(~F.col("reviewed")).alias("pending"), F.count_if(F.col("reviewed") & F.col("listed").isNotNull()).alias("publishable"))


#: Notes, and whether they reject.
_NOTES = [
    ("duplicate: of a", True), (" seen ", False), ("  ", False), ("Not guidance, a result", True), ("component figure", False), ("wrong metric", False), ("wrong period (FY2024)", True), ("CONFLICT LOSER", True),
    ("a duplicate", False), (None, False), ("duplicated by hand", True),
]


@query(
    "g30_touched",
    f"""WITH {STATEMENTS}, n AS (SELECT record_id, reviewed, part % {len(_NOTES)} AS k FROM statements) SELECT record_id, k IN {tuple(k for k, (_, no) in enumerate(_NOTES) if no)} AS rejected,
        reviewed OR k NOT IN {tuple(k for k, (note, _) in enumerate(_NOTES) if not (note or "").strip())} AS touched FROM n""",
)
def touched(t: Tables) -> DataFrame:
    """Notes that reject, by how they begin, and rows that a person has approved or noted."""
    note = F.element_at(F.array(*[F.lit(text) for text, _ in _NOTES]), (F.col("part") % len(_NOTES) + 1).cast("int"))
    rows = t.statements.withColumn("note", note)
    return rows.select("record_id", review.is_rejection(F.col("note")).alias("rejected"), (F.col("reviewed") | (F.trim(F.coalesce("note", F.lit(""))) != "")).alias("touched"))


@query("t7_headings", "SELECT doc_id, count(*) FILTER (len(regexp_extract_all(trim(line), '[^ \\t\\x0B\\f\\r]+')) <= 8 AND NOT regexp_matches(line, '[.!?;,][ \\t\\x0B\\f\\r]*$')) AS short_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL) WHERE trim(line) <> '' GROUP BY doc_id")
def headings(t: Tables) -> DataFrame:
    """Lines short enough to be a heading that do not end like a sentence."""
    lines = t.read("documents").where("text is not null").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.trim("line") != "")
    words = F.filter(F.split(F.trim("line"), r"[ \t\x0B\f\r]+"), lambda w: w != "")
    short = (F.size(words) <= CONFIG.heading_words) & ~F.col("line").rlike(r"[.!?;,][ \t\x0B\f\r]*$")
    return lines.groupBy("doc_id").agg(F.count_if(short).alias("short_lines"))


@query("m4_propose_acknowledgement", f"WITH {RESOLVED} SELECT record_id, CASE WHEN part % 4 <> 0 AND part % 4 <> 1 THEN acknowledged_at END AS proposal FROM resolved WHERE acknowledged_at IS NOT NULL")
def propose_acknowledgement(t: Tables) -> DataFrame:
    """An acknowledgement is proposed unless the row has it already or a note rejects that day and address."""
    rows = t.resolved.where("acknowledged_at is not null")
    stored = F.when(F.col("part") % 4 == 0, F.col("acknowledged_at"))
    note = F.when(F.col("part") % 4 == 1, F.concat(F.lit("no (, "), F.col("acknowledged_at").cast("string"), F.lit(", "), F.col("accession"), F.lit(")"))).otherwise("")
    return rows.select("record_id", review.propose_acknowledgement(stored, F.col("acknowledged_at"), F.col("accession"), note).alias("proposal"))


@query("m5_attach_outcomes", f"WITH {STATEMENTS} SELECT record_id, CASE WHEN part % 3 = 0 THEN 1.0::DOUBLE WHEN part % 3 = 1 THEN reported_value END AS reported_value, part % 3 = 2 AND reported_value IS NOT NULL AS proposed FROM statements")
def attach_outcomes(t: Tables) -> DataFrame:
    """Empty cells of untouched rows are filled; touched rows get a proposal."""
    queue = t.statements.select("record_id", F.when(F.col("part") % 3 == 0, 1.0).alias("reported_value"), (F.col("part") % 3 == 2).alias("touched"))
    found = t.statements.where("reported_value is not null").select("record_id", F.col("reported_value").alias("found"))
    return review.attach(queue, found, "reported_value")


@query("m6_decisions_applied", f"WITH {STATEMENTS} SELECT decision, approved, count(*) AS n FROM (SELECT CASE part % 4 WHEN 0 THEN 'y' WHEN 1 THEN 'n' WHEN 2 THEN 's' ELSE 'v' END AS decision, CASE part % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 3 THEN true END AS approved FROM statements) GROUP BY ALL")
def decisions_applied(t: Tables) -> DataFrame:
    decision = F.element_at(F.array(*[F.lit(x) for x in "ynsv"]), (F.col("part") % 4 + 1).cast("int"))
    return t.statements.select(decision.alias("decision"), review.approved_by(decision).alias("approved")).groupBy("decision", "approved").agg(F.count("*").alias("n"))


@query("m7_verdicts_written", f"WITH {STATEMENTS} SELECT record_id, CASE WHEN part % 2 = 0 THEN 'fresh' WHEN part % 3 = 0 THEN 'old' END AS verdict FROM statements")
def verdicts_written(t: Tables) -> DataFrame:
    old = t.statements.select("record_id", F.when(F.col("part") % 3 == 0, "old").alias("verdict"))
    return review.keep_found(old, t.statements.where("part % 2 = 0").select("record_id", F.lit("fresh").alias("verdict")), "record_id", ["verdict"])


@query("m9_draft_stubs", f"WITH {RESOLVED} SELECT record_id, target_period, target_low FROM resolved WHERE part % 10 <> 0 AND reviewed")
def draft_stubs(t: Tables) -> DataFrame:
    """Drafts rebuilt from queue rows that are neither flags nor invalid."""
    rows = t.resolved.where("reviewed").withColumn("accession", F.when(F.col("part") % 10 == 0, "none").otherwise(F.col("accession")))
    bad = validate.issues(rows).where("check = 'accession'").select("record_id")
    return rows.join(bad, "record_id", "left_anti").select("record_id", "target_period", "target_low")


@query(
    "v1_schema_checks",
    f"""WITH {RESOLVED} SELECT record_id, 'accession' AS "check" FROM resolved WHERE part % 10 = 0 UNION ALL SELECT record_id, 'status' FROM resolved WHERE supp % 10 = 0
        UNION ALL SELECT record_id, 'reversed target' FROM resolved WHERE part % 7 = 0 AND target_low < target_high UNION ALL SELECT record_id, 'no target' FROM resolved WHERE part % 7 = 1 AND (target_low IS NULL OR part % 14 = 1) AND target_high IS NULL""",
)
def schema_checks(t: Tables) -> DataFrame:
    rows = t.resolved.withColumns(
        {
            "accession": F.when(F.col("part") % 10 == 0, "x").otherwise(F.col("accession")),
            "status": F.when(F.col("supp") % 10 == 0, "maybe").otherwise(F.col("status")),
            "target_low": F.when(F.col("part") % 7 == 0, F.col("target_high")).when((F.col("part") % 14 == 1) & F.col("target_high").isNull(), None).otherwise(F.col("target_low")),
            "target_high": F.when((F.col("part") % 7 == 0) & F.col("target_low").isNotNull(), F.col("target_low")).otherwise(F.col("target_high")),
        }
    )
    return validate.issues(rows).where(F.col("check").isin("accession", "status", "reversed target", "no target")).select("record_id", "check")


@query("v4_file_report", f"WITH {RESOLVED} SELECT (SELECT count(*) FROM resolved WHERE reviewed) AS checked, (SELECT count(*) FROM resolved WHERE reviewed AND acknowledged_at < reported_at) AS issues")
def file_report(t: Tables) -> DataFrame:
    rows = t.resolved.where("reviewed")
    return rows.agg(F.count("*").alias("checked")).crossJoin(validate.issues(rows).agg(F.count("*").alias("issues")))


@query("s3_tables_by_company", f"WITH {FILINGS} SELECT cik, count(*) AS n, min(filed_at) AS first_filed FROM filings GROUP BY cik")
def tables_by_company(t: Tables) -> DataFrame:
    """Filings written as JSON lines by company and read back with a schema."""
    path = scratch(t.spark, "by-company")
    R.write_by_company(t.filings.select("cik", "accession", "filed_at"), path)
    back = t.spark.read.schema("accession string, filed_at date, cik string").json(path)
    return back.groupBy("cik").agg(F.count("*").alias("n"), F.min("filed_at").alias("first_filed"))


@query("s5_review_csv", "SELECT conv_id, turn, role, text FROM conversations")
def review_csv(t: Tables) -> DataFrame:
    """Cells with line ends and quotes survive a review queue's file."""
    path = scratch(t.spark, "queue")
    R.write_queue(t.read("conversations").select(*[F.col(c).cast("string").alias(c) for c in ("conv_id", "turn", "role", "text")]), path)
    return R.read_queue(t.spark, path).select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")


@query("s9_feed", f"WITH {FILINGS} SELECT accession, form, filed_at, ['2.02', '9.01'] AS items FROM filings WHERE o_orderkey % 20 <> 0")
def feed(t: Tables) -> DataFrame:
    """Feed pages, one for each company and day; entries without a form are dropped."""
    form = F.when(F.col("o_orderkey") % 20 != 0, F.concat(F.lit("<filing-type>"), F.col("form"), F.lit("</filing-type>"))).otherwise("")
    entry = F.concat(
        F.lit("<entry><content><accession-number>"), F.col("accession"), F.lit("</accession-number>"), form, F.lit("<filing-date>"), F.col("filed_at").cast("string"),
        F.lit("</filing-date><filing-href>u</filing-href><items-desc>items 2.02 and 9.01</items-desc></content></entry>"),
    )
    pages = t.filings.groupBy("cik", "filed_at").agg(F.array_join(F.collect_list(entry), "").alias("entries"))
    pages = pages.select(F.concat(F.lit("<feed>"), "entries", F.lit("</feed>")).alias("page"))
    return S.feed_entries(pages).select("accession", "form", "filed_at", "items")
