"""Queries over filings, their titles and lines: as-of searches, ranks, blocks and tables, answers and evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dims import Config
from ..functions import guards as G
from ..functions import ids, periods, rubric, titles
from ..functions import text as T
from ..operators import candidates as C
from ..operators import review, validate
from ..operators.joins import counted_before, first_per, next_rows, ranked_in_parts, running_sum
from ..operators.orderstats import value_at
from ..sources import records as R
from .corpus import pages_with_guidance, scratch
from .joining import TERMS, about_metrics
from .registry import query
from .substrate import FILINGS, RELEASES, RESOLVED, SENTENCES, STATEMENTS, Tables, sql_period_end

CONFIG = Config()
LAST_DAY = "2001-06-30"


def reported(t: Tables) -> DataFrame:
    """``release, cik, filed_at, quarter, year``: a row for each period that an 8-K's headlines report (quarter 0: the year)."""
    rows = t.releases.where("form = '8-K' and http_status = 200")
    derived = {q: periods.fiscal_year_reported(F.col("fiscal_month"), F.col("named_for_end"), F.lit(q), F.col("filed_at")) + 30 for q in (1, 2, 3, 4)}
    return titles.reported_periods(rows.withColumnRenamed("accession", "release"), derived, ["release", "cik", "filed_at"])


@query(
    "j3_fiscal_asof",
    f"""WITH {STATEMENTS}, {RELEASES} SELECT accession, q AS quarter, y AS year FROM rel WHERE form = '8-K' AND http_status = 200 AND o_orderkey % 8 IN (2, 6)""",
)
def fiscal_asof(t: Tables) -> DataFrame:
    """Releases whose headlines name a quarter and no year, with the year that the company's calendar gives it on the filing day."""
    rows = t.releases.where("form = '8-K' and http_status = 200")
    rows = rows.withColumn("title", F.explode(F.array_distinct(F.array_compact(F.array(titles.headline(F.col("text"), wrap=True), titles.top_headline(F.col("text")))))))
    rows = rows.where(F.col("title").rlike(titles.QUARTER_WORD) & ~F.col("title").rlike(T.ANY_YEAR) & ~F.col("title").rlike(titles.NO_RESULTS))
    quarter = F.coalesce(*[F.when(T.names_quarter(F.col("title"), F.lit(k)), F.lit(k)) for k in (1, 2, 3, 4)])
    year = periods.fiscal_year_reported(F.col("fiscal_month"), F.col("named_for_end"), F.col("quarter"), F.col("filed_at")) + 30
    return rows.withColumn("quarter", quarter).select("accession", "quarter", year.alias("year"))


_J2 = f"""WITH {STATEMENTS}, {RELEASES}, m AS (SELECT s.record_id, r.release, row_number() OVER (PARTITION BY s.record_id ORDER BY r.filed_at, r.release) AS n
    FROM statements s JOIN reported r ON s.cik = r.cik AND coalesce(s.quarter, 0) = r.quarter AND s.fiscal_year + 30 = r.y AND r.filed_at > s.stated_at AND r.filed_at <= least(DATE '{LAST_DAY}', s.stated_at + 550))"""


def first_reports(t: Tables) -> DataFrame:
    """Each draft with the first three releases after it, in 550 days, whose headlines report its period."""
    drafts = t.statements.select("record_id", "cik", "stated_at", F.coalesce("quarter", F.lit(0)).alias("quarter"), (F.col("fiscal_year") + 30).alias("year"))
    keys = ["cik", "quarter", "year"]
    asked = drafts.select(*keys, "stated_at").distinct()  # drafts of one period and day ask the same; there are no more of these than days
    met = next_rows(asked, reported(t), keys, "stated_at", "filed_at", "release", CONFIG.max_docs)
    met = met.where(F.col("filed_at") <= F.least(F.lit(LAST_DAY).cast("date"), F.date_add("stated_at", CONFIG.search_days)))
    return drafts.join(met, [*keys, "stated_at"])


@query("j2_later_releases", _J2 + " SELECT record_id, release, n AS rank FROM m WHERE n <= 3")
def later_releases(t: Tables) -> DataFrame:
    return first_reports(t).select("record_id", "release", "rank")


@query("w2_first_releases", _J2 + " SELECT record_id, min(release) FILTER (n = 1) AS first_release, least(count(*), 3) AS found FROM m GROUP BY record_id")
def first_releases(t: Tables) -> DataFrame:
    found = first_reports(t).groupBy("record_id").agg(F.min_by("release", "rank").alias("first_release"), F.count("*").alias("found"))
    return found.select("record_id", "first_release", "found")


def _guided(low: Column, high: Column) -> Column:
    """A key for the figures of a guide: both ends, or the one there is."""
    a, b = F.coalesce(low, high), F.coalesce(high, low)
    return F.when(a == b, F.concat(F.lit("one "), a.cast("string"))).otherwise(F.concat_ws(" ", F.lit("both"), F.least(a, b).cast("string"), F.greatest(a, b).cast("string")))


def acknowledging_lines(rows: DataFrame) -> DataFrame:
    """``cik, filing, filed_at, side, about``: for each phrase of a side or direction and each period or guided range that a line is about, a row."""
    line = F.col("line")
    referred = line.rlike(f"(?i){'|'.join(CONFIG.ack_references)}")
    sides = F.array_compact(F.array(*[F.when(referred & line.rlike(rf"(?i)\b(?:{'|'.join(words)})\b"), F.lit(side)) for side, words in CONFIG.ack_phrases.items()]))
    years = F.array_distinct(F.concat(F.transform(F.regexp_extract_all(line, F.lit(r"\b(20\d\d)\b"), F.lit(1)), lambda y: y.cast("int")), T.years_named(line)))

    def of(q: int) -> Column:
        named = line.rlike(T.WHOLE_YEAR) if q == 0 else line.rlike(T.QUARTERS[q - 1])
        own = F.transform(F.filter(years, lambda y: T.names_year(line, y)), lambda y: F.concat_ws(" ", F.lit(str(q)), y.cast("string")))
        return F.when(~named, F.array().cast("array<string>")).when(line.rlike(T.ANY_YEAR), own).otherwise(F.array(F.lit(f"{q} any")))

    figures = F.array_distinct(T.figures(line))
    pairs = F.flatten(F.transform(figures, lambda a: F.transform(F.filter(figures, lambda b: b >= a), lambda b: _guided(a, b))))
    about = F.flatten(F.array(*[of(q) for q in range(5)], F.when(line.rlike(T.ANY_PERIOD), F.array().cast("array<string>")).otherwise(pairs)))
    lines = rows.select("cik", F.col("accession").alias("filing"), "filed_at", F.explode(sides).alias("side"), F.when(F.size(figures) > 0, about).alias("about"))
    return lines.withColumn("about", F.explode(F.array_distinct("about")))


@query(
    "j5_acknowledgements",
    f"""WITH {RESOLVED}, {RELEASES}, m AS (SELECT r.record_id, f.accession AS filing, f.filed_at, row_number() OVER (PARTITION BY r.record_id ORDER BY f.filed_at, f.accession) AS n
        FROM resolved r JOIN rel f ON r.cik = f.cik AND f.filed_at >= r.reported_at AND f.filed_at <= r.reported_at + 400
        WHERE r.status = 'missed' AND ((f.o_orderkey % 6 = 0 AND r.side = 'below' AND r.quarter = f.q) OR (f.o_orderkey % 6 = 1 AND (r.side = 'below' OR r.direction = 'worse') AND coalesce(r.quarter, f.q) = f.q AND r.fiscal_year + 30 = f.y)
            OR (f.o_orderkey % 6 = 2 AND r.side = 'above' AND r.quarter = f.q) OR (f.o_orderkey % 6 = 4 AND r.direction = 'worse' AND coalesce(r.target_low IN (150, 160), true) AND coalesce(r.target_high IN (150, 160), true))))
        SELECT record_id, filing, filed_at AS acknowledged_on FROM m WHERE n = 1""",
)
def acknowledgement_search(t: Tables) -> DataFrame:
    """The first filing of any form, from the day of the report and within 400 days, with a line that admits the miss.

    Lines and missed rows meet by what they are about, so each row asks a few times for one line, however many a company has.
    """
    missed = t.resolved.where("status = 'missed'")
    side = F.when(F.col("reported_value") < F.col("target_low"), "below").otherwise("above")
    quarter = F.coalesce("quarter", F.lit(0)).cast("string")
    about = F.array(F.concat_ws(" ", quarter, F.lit("any")), F.concat_ws(" ", quarter, (F.col("fiscal_year") + 30).cast("string")), _guided(F.col("target_low"), F.col("target_high")))
    asked = missed.select("record_id", "cik", "reported_at", F.explode(F.array(side, F.col("direction"))).alias("side"), about.alias("about")).withColumn("about", F.explode("about"))
    met = next_rows(asked, acknowledging_lines(t.releases), ["cik", "side", "about"], "reported_at", "filed_at", "filing", 1, same_day=True)
    met = met.where(F.col("filed_at") <= F.date_add("reported_at", CONFIG.ack_days))
    return met.groupBy("record_id").agg(F.min(F.struct("filed_at", "filing")).alias("b")).select("record_id", "b.filing", F.col("b.filed_at").alias("acknowledged_on"))


@query(
    "j6_withdrawals",
    f"""WITH {RESOLVED}, {RELEASES} SELECT d.record_id, min(r.filed_at) AS withdrawn_on, count(*) AS candidates FROM resolved d JOIN rel r ON d.cik = r.cik
        AND r.filed_at > d.stated_at AND r.filed_at <= d.period_close WHERE r.form = '8-K' AND r.http_status = 200
        AND (r.o_orderkey % 7 IN (0, 2) OR (r.o_orderkey % 7 = 1 AND d.quarter IS NULL AND d.fiscal_year = r.y - 29)) GROUP BY d.record_id""",
)
def withdrawal_search(t: Tables) -> DataFrame:
    """Releases that withdraw guidance after the statement and up to the close of its period; a line that names its period by end date is about that one alone."""
    label = G.period_by_end_date(F.col("withdrawal"), F.col("fiscal_month"), F.col("named_for_end"), F.col("filed_at"))
    lines = t.releases.where("form = '8-K' and http_status = 200").where(T.withdraws(F.col("withdrawal"), CONFIG)).select("cik", "accession", "filed_at", F.coalesce(label, F.lit("any")).alias("about"))
    drafts = t.resolved.select("record_id", "cik", "stated_at", "period_close", F.explode(F.array(F.lit("any"), "target_period")).alias("about")).where("stated_at < period_close")
    keys = ["cik", "about"]
    counted = counted_before(counted_before(drafts, lines, keys, "stated_at", "filed_at", "before"), lines, keys, "period_close", "filed_at", "upto").where("upto > before")
    numbered = ranked_in_parts(lines, keys, [F.trunc("filed_at", "MM")], [F.col("filed_at"), F.col("accession")], "place")
    first = counted.withColumn("place", F.col("before") + 1).join(numbered, [*keys, "place"])
    return first.groupBy("record_id").agg(F.min("filed_at").alias("withdrawn_on"), F.sum(F.col("upto") - F.col("before")).alias("candidates"))


@query(
    "w3_line_ranking",
    f"""WITH {SENTENCES}, x AS ({" UNION ALL ".join(f"SELECT record_id AS sentence_id, accession, part % 8 AS k, quarter AS sq, '{m}' AS metric FROM sentences WHERE regexp_matches(lower(sentence), '{p}')" for m, p in TERMS.items())}),
        p AS (SELECT s.record_id, x.sentence_id, 2 + CASE WHEN k = 0 AND (s.quarter = coalesce(sq, 4) OR (s.quarter IS NULL AND s.fiscal_year >= 2000)) THEN 3 WHEN k = 2 AND (s.quarter IS NULL OR s.quarter = coalesce(sq, 2)) THEN 3 WHEN k = 3 AND s.quarter IS NULL THEN 3 ELSE 0 END
            - CASE WHEN k <> 5 THEN 3 ELSE 0 END + CASE WHEN k = 1 THEN 1 ELSE 0 END AS score FROM statements s JOIN x USING (accession, metric)),
        r AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY score DESC, sentence_id) AS rank FROM p) SELECT record_id, sentence_id, score::INT AS score, rank FROM r WHERE rank <= 25""",
)
def line_ranking(t: Tables) -> DataFrame:
    """The 25 best lines of each draft by period, guidance words and basis."""
    lines = about_metrics(t)
    drafts = t.statements.select("record_id", "accession", "metric", "quarter", "fiscal_year")
    s = F.col("sentence")
    tags = [F.when(s.rlike(p), n).otherwise(0) for p, n in ((r"(?i)guidance|outlook|expect|target|initiat|raises?\b|forecast|anticipat", -3), (G.NON_GAAP, 1), (G.GAAP, 1))]
    score = 2 + T.period_signal(s, F.col("quarter"), F.col("fiscal_year")) + tags[0] + tags[1] + tags[2]
    met = drafts.join(lines, ["accession", "metric"]).withColumn("score", score.cast("int"))
    return first_per(met, ["record_id"], [F.desc("score"), F.col("sentence_id")], CONFIG.max_lines, "rank").select("record_id", "sentence_id", "score", "rank")


@query("w7_queue_order", f"WITH {STATEMENTS} SELECT record_id, row_number() OVER (PARTITION BY cik ORDER BY CASE WHEN part % 5 = 0 THEN 0 WHEN line >= 5 THEN 1 ELSE 2 END, stated_at, record_id) AS position FROM statements")
def queue_order(t: Tables) -> DataFrame:
    tier = F.when(F.col("part") % 5 == 0, 0).when(F.col("line") >= 5, 1).otherwise(2)
    return ranked_in_parts(t.statements.select("record_id", "cik", "part", "line", "stated_at"), ["cik"], [tier, F.trunc("stated_at", "MM")], [F.col("stated_at"), F.col("record_id")], "position").select("record_id", "position")


@query("w10_every_tenth", f"WITH {STATEMENTS} SELECT record_id, k % 10 = 0 AS marked FROM (SELECT record_id, row_number() OVER (PARTITION BY cik ORDER BY stated_at, record_id) AS k FROM statements WHERE reviewed)")
def every_tenth(t: Tables) -> DataFrame:
    rows = t.statements.where("reviewed").select("record_id", "cik", "stated_at")
    return ranked_in_parts(rows, ["cik"], [F.trunc("stated_at", "MM")], [F.col("stated_at"), F.col("record_id")], "k").select("record_id", (F.col("k") % 10 == 0).alias("marked"))


@query("w8_even_sample", f"WITH {FILINGS}, r AS (SELECT cik, accession, row_number() OVER (PARTITION BY cik ORDER BY filed_at, accession) - 1 AS i, count(*) OVER (PARTITION BY cik) AS n FROM filings) SELECT cik, accession FROM r JOIN (SELECT unnest(range(0, 7)) AS s) ON i = ((2 * s + 1) * n) // 14")
def even_sample(t: Tables) -> DataFrame:
    """Seven filings a company, evenly spaced in order."""
    rows = t.filings.select("cik", "accession", "filed_at")
    ranked = ranked_in_parts(rows, ["cik"], [F.trunc("filed_at", "MM")], [F.col("filed_at"), F.col("accession")], "i")
    wanted = rows.groupBy("cik").agg(F.count("*").alias("n")).select("cik", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda s: F.floor((2 * s + 1) * F.col("n") / 14) + 1))).alias("i"))
    return ranked.join(wanted, ["cik", "i"]).select("cik", "accession")


@query(
    "a8_histogram",
    f"""WITH {RESOLVED}, v AS (SELECT magnitude AS m, row_number() OVER (ORDER BY magnitude) - 1 AS i, count(*) OVER () AS n FROM resolved WHERE magnitude IS NOT NULL),
        e AS (SELECT max(m) FILTER (i = CASE WHEN n >= 10 THEN n * 2 // 100 ELSE 0 END) AS a, max(m) FILTER (i = CASE WHEN n >= 10 THEN n - n * 2 // 100 - 1 ELSE n - 1 END) AS b FROM v),
        p AS (SELECT a - pad AS lo, b + pad AS hi FROM (SELECT *, CASE WHEN b > a THEN (b - a) * 0.1 ELSE 0.5 END AS pad FROM e))
        SELECT CASE WHEN m < lo OR m > hi THEN -1 ELSE least(floor((m - lo) / ((hi - lo) / 30)), 29) END::BIGINT AS bin, count(*) AS n FROM v, p GROUP BY 1""",
)
def histogram(t: Tables) -> DataFrame:
    """Thirty bins between the 2nd and 98th of the sorted values, padded by a tenth; bin -1 holds what lies outside."""
    path = scratch(t.spark, "magnitudes")
    t.resolved.where("magnitude is not null").groupBy(F.col("magnitude").alias("m")).agg(F.count("*").alias("k")).write.parquet(path)
    values = t.spark.read.parquet(path)  # read once a round
    n = values.agg(F.sum("k")).first()[0] or 0
    cut = n * 2 // 100 if n >= 10 else 0
    a, b = (value_at(values, "m", "k", at) for at in (cut, n - cut - 1))
    pad = (b - a) * 0.1 if n and b > a else 0.5
    low, high = (a - pad, b + pad) if n else (0.0, 1.0)
    place = F.least(F.floor((F.col("m") - low) / ((high - low) / 30)), F.lit(29))
    return values.groupBy(F.when((F.col("m") < low) | (F.col("m") > high), -1).otherwise(place).cast("long").alias("bin")).agg(F.sum("k").alias("n"))


@query(
    "g1_parse_json",
    f"""WITH {STATEMENTS} SELECT record_id, i AS item, CASE WHEN part % 5 IN (0, 4) THEN metric END AS metric, CASE WHEN part % 5 IN (0, 4) THEN line + i END AS low, CASE WHEN part % 5 IN (2, 3) THEN 'unparsable answer' END AS reason
        FROM statements, (VALUES (0), (1)) AS v(i) WHERE (part % 5 = 0) OR (part % 5 = 4 AND i = 0) OR (part % 5 IN (2, 3) AND i = 0)""",
)
def parse_json(t: Tables) -> DataFrame:
    """Items of answers in JSON, code fences allowed, numbered; an unreadable answer or one without items is a reject."""

    def item(k: int) -> Column:
        return F.concat(F.lit('{"metric": "'), F.col("metric"), F.lit('", "value_low": '), (F.col("line") + k).cast("string"), F.lit("}"))

    both = F.concat(F.lit('```json\n{"items": ['), item(0), F.lit(", "), item(1), F.lit("]}\n```"))
    answer = F.element_at(F.array(both, F.lit('{"items": []}'), F.lit("I cannot say."), F.lit('{"other": 1}'), F.concat(F.lit('{"items": ['), item(0), F.lit("]}"))), (F.col("part") % 5 + 1).cast("int"))
    rows = t.statements.select("record_id", R.answer_items(answer, "metric string, value_low long").alias("items"))
    found = rows.select("record_id", "items", F.posexplode_outer("items").alias("item", "i")).where("items is null or i is not null")
    return found.select("record_id", F.coalesce("item", F.lit(0)).alias("item"), F.col("i.metric").alias("metric"), F.col("i.value_low").alias("low"), F.when(F.col("items").isNull(), "unparsable answer").alias("reason"))


_LINES = "lines AS (SELECT doc_id, unnest(range(0, len(l)))::INT AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))"


def _lines(t: Tables) -> DataFrame:
    return t.read("documents").where("text is not null").select(F.col("doc_id").alias("accession"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query(
    "t8_blocks",
    f"""WITH {_LINES}, k AS (SELECT doc_id, line_no, line, length(line) % 9 = 0 AS heading, length(line) % 11 = 0 AS ends, count(*) OVER (PARTITION BY doc_id) AS n FROM lines),
        s AS (SELECT *, CASE WHEN heading THEN 'heading' WHEN ends THEN 'end-heading' END AS stop FROM k),
        b AS (SELECT *, min(CASE WHEN stop IS NOT NULL THEN line_no END) OVER f AS next_stop, first(stop IGNORE NULLS) OVER f AS next_reason FROM s WINDOW f AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
        SELECT doc_id, line_no AS heading_line, least(coalesce(next_stop, n), line_no + 41, n)::INT AS end_line,
               CASE WHEN line_no + 41 < n AND line_no + 41 <= coalesce(next_stop, n) THEN 'max' WHEN next_stop IS NOT NULL THEN next_reason ELSE 'eof' END AS reason
        FROM b WHERE heading AND least(coalesce(next_stop, n), line_no + 41, n) > line_no + 1""",
)
def block_rows(t: Tables) -> DataFrame:
    """Blocks by stops of two kinds, through the function that finds candidates' sections."""
    rows = _lines(t).withColumn("stop", F.when(F.length("line") % 9 == 0, "heading").when(F.length("line") % 11 == 0, "end-heading"))
    found = C.block_lines(rows, CONFIG).where("line_no = heading_no")
    return found.select(F.col("accession").alias("doc_id"), F.col("heading_no").alias("heading_line"), F.col("end_no").alias("end_line"), "reason")


@query(
    "t9_lead_in",
    "SELECT conv_id, turn, last(CASE WHEN turn % 2 = 0 AND length(text) <= 399 THEN text || ':' END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING) AS lead_in FROM conversations",
)
def lead_in(t: Tables) -> DataFrame:
    """The nearest of fifteen earlier turns that ends with a colon and is short enough; every other turn is given one."""
    rows = t.read("conversations").select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, F.concat("text", F.lit(":"))).otherwise(F.regexp_replace("text", ":$", "")).alias("line"))
    return C.lead_in(rows, CONFIG, ["conv_id"], "turn", "line").select("conv_id", "turn", "lead_in")


@query("w6_frames", "SELECT conv_id, turn, len(coalesce(list(text) OVER b, []))::INT AS before, coalesce(sum(length(text)) OVER b, 0)::BIGINT AS chars, min(turn) FILTER (role = 'user') OVER a AS next_user FROM conversations WINDOW b AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING), a AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)")
def frames(t: Tables) -> DataFrame:
    """Frames before and after a line; what follows without bound is carried back by a running frame."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    before = w.rowsBetween(-5, -2)
    after = Window.partitionBy("conv_id").orderBy(F.desc("turn")).rowsBetween(Window.unboundedPreceding, -1)
    return t.read("conversations").select(
        "conv_id", "turn", F.size(F.collect_list("text").over(before)).alias("before"), F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)).alias("chars"), F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(after).alias("next_user")
    )


@query("t12_table_header", "SELECT page_id::VARCHAR AS accession, CASE page_id % 3 WHEN 0 THEN 'Q2 2030 Full Year 2030' WHEN 1 THEN 'Q4 FY30 | Full Year FY30' END AS table_header FROM pages")
def table_header(t: Tables) -> DataFrame:
    """The header above each page's guidance section: one line of periods, cells on lines of their own, or none; headers of periods that are over count as none."""
    rows = C.lines(C.texts(pages_with_guidance(t))).withColumns({"month": F.lit(12), "named": F.lit(True), "filed_at": F.lit("2029-06-30").cast("date")})
    found = C.table_header(rows, CONFIG, ("month", "named", "filed_at"))
    return found.where("line = 'Financial Outlook'").select("accession", "table_header")


@query("t18_outlook_lines", "SELECT page_id::VARCHAR AS accession, CASE WHEN page_id % 5 = 0 THEN 3 ELSE 2 END AS n FROM pages")
def outlook_lines(t: Tables) -> DataFrame:
    """How many lines of each page stand in a section of outlook, guidance or targets."""
    return C.outlook_lines(C.lines(C.texts(pages_with_guidance(t))), CONFIG).groupBy("accession").agg(F.count_if("in_outlook").alias("n"))


@query("t13_candidates")
def candidates(t: Tables) -> DataFrame:
    return C.candidates(pages_with_guidance(t), CONFIG)


@query(
    "t14_candidate_counters",
    """SELECT 'section' AS capture_method, count(*) AS n, count(*) AS with_lead_in, count(*) FILTER (page_id % 3 <> 2) AS with_header, count(*) AS ended_by_heading, 0 AS too_long FROM pages
       UNION ALL SELECT 'sentence', count(*), 0, 0, 0, count(*) FILTER (page_id % 5 = 0) FROM pages""",
)
def candidate_counters(t: Tables) -> DataFrame:
    found = C.candidates(pages_with_guidance(t), CONFIG)
    dropped = C.sentence_candidates(C.sentences(C.texts(pages_with_guidance(t))), CONFIG).where("too_long").groupBy("capture_method").agg(F.count("*").alias("too_long"))
    counts = found.groupBy("capture_method").agg(F.count("*").alias("n"), F.count("lead_in").alias("with_lead_in"), F.count("table_header").alias("with_header"), F.count_if(F.col("block_end") == "end-heading").alias("ended_by_heading"))
    return counts.join(dropped, "capture_method", "left").na.fill(0, ["too_long"])


@query("s7_flatten", f"WITH {RESOLVED} SELECT record_id, target_low, reported_value, stated_at FROM resolved")
def flatten(t: Tables) -> DataFrame:
    """Nested records as dotted columns, in the order of the schema."""
    nested = t.resolved.select("record_id", F.struct("target_low", F.struct("stated_at").alias("evidence")).alias("assumption"), F.struct("reported_value").alias("outcome"))
    flat = R.flatten(nested)
    return flat.toDF(*[name.split(".")[-1] for name in flat.columns]).select("record_id", "target_low", "reported_value", "stated_at")


@query(
    "v3_document_checks",
    """SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'missing' WHEN doc_id % 11 = 0 THEN 'hash differs' ELSE 'excerpt not verbatim' END AS issue FROM documents
       WHERE text IS NOT NULL AND (doc_id % 13 = 0 OR doc_id % 11 = 0 OR doc_id % 7 = 0)""",
)
def document_checks(t: Tables) -> DataFrame:
    """Evidence against the documents that it cites: there, unchanged, and holding the excerpt word for word."""
    docs = t.read("documents").where("text is not null")
    excerpt = F.when(F.col("doc_id") % 7 == 0, F.concat(F.substring("text", 5, 40), F.lit("\u0002"))).otherwise(F.substring("text", 5, 40))
    evidence = docs.select("doc_id", excerpt.alias("excerpt"), F.when(F.col("doc_id") % 11 == 0, F.lit("0")).otherwise(F.sha2("text", 256)).alias("content_sha256"))
    return validate.document_issues(evidence, docs.where("doc_id % 13 <> 0").select("doc_id", "text"), "doc_id")


@query("v5_dimensions", "SELECT n_name AS company, CASE WHEN n_nationkey % 7 = 0 THEN 'fiscal month' ELSE 'naming of years' END AS \"check\" FROM nation WHERE n_nationkey % 7 IN (0, 1)")
def dimensions(t: Tables) -> DataFrame:
    """Companies whose calendar is not usable."""
    month = F.when(F.col("n_nationkey") % 7 == 0, 13).otherwise(1 + F.col("n_nationkey") % 12)
    rows = t.read("nation").select(F.col("n_name").alias("company"), month.cast("int").alias("fiscal_month"), F.when(F.col("n_nationkey") % 7 != 1, F.lit(True)).alias("named_for_end"))
    return validate.calendar_issues(rows)


@query(
    "m3_proposals",
    f"""WITH {STATEMENTS} SELECT record_id, CASE WHEN part % 4 IN (0, 3) THEN 'target_low=' || (target_low + 1)::VARCHAR WHEN part % 4 = 2 THEN 'target_low=' || (-target_low)::VARCHAR END AS proposal FROM statements""",
)
def proposals(t: Tables) -> DataFrame:
    """What a refresh proposes to a person's row: what differs from the row and from what the pipeline said last.

    By part: 0 the pipeline has changed its mind, 1 it says what it said, 2 and 3 there is no snapshot: then a flipped sign is proposed alone.
    """
    kind, low = F.col("part") % 4, F.col("target_low")
    fresh = F.when(kind == 2, -low).when(kind == 1, low).otherwise(low + 1)
    rows = t.statements.where("part % 4 <> 3").select("record_id", low.alias("low"), fresh.alias("fresh"), kind.alias("kind"))
    again = t.statements.where("part % 4 = 3").select("record_id", low.alias("low"), fresh.alias("fresh"), F.lit(0).alias("kind"))
    rows = rows.unionByName(again)

    def as_map(x: Column) -> Column:
        return F.create_map(F.lit("target_low"), x.cast("string"))

    snapshot = F.when(F.col("kind") != 2, as_map(F.col("low")))
    row = as_map(F.when(F.col("kind") == 1, F.col("low") + 5).otherwise(F.col("low")))
    return rows.select("record_id", review.propose_changes(row, as_map(F.col("fresh")), snapshot, F.lit("")).alias("proposal"))


@query("s15_guarded_write", "SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1")
def guarded_write(t: Tables) -> DataFrame:
    """A table is written; writing nothing over it is refused, and it is still there."""
    path = scratch(t.spark, "guarded")
    orders = t.read("orders")
    written = R.write_unless_empty(orders, path), R.write_unless_empty(orders.where("o_orderkey < 0"), path)
    if written != (True, False):
        raise ValueError("an empty table was written")
    return t.spark.read.parquet(path).groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"))


@query(
    "a25_no_outcome",
    _J2 + f""", r AS (SELECT DISTINCT record_id FROM m), o AS (SELECT s.*, {sql_period_end('fiscal_year', 'quarter')} AS closes FROM statements s WHERE reported_value IS NULL)
    SELECT cik, CASE WHEN closes > DATE '{LAST_DAY}' THEN 'period not closed' WHEN r.record_id IS NULL THEN 'no release reports the period' ELSE 'no line gives the value' END AS reason, count(*) AS n FROM o LEFT JOIN r USING (record_id) GROUP BY ALL""",
)
def no_outcome(t: Tables) -> DataFrame:
    """Why rows have no outcome, counted for each company."""
    rows = t.resolved.where("reported_value is null").select("record_id", "cik", "period_close")
    found = first_reports(t).select("record_id", F.lit(True).alias("reported")).distinct()
    reason = F.when(F.col("period_close") > F.lit(LAST_DAY).cast("date"), "period not closed").when(F.col("reported").isNull(), "no release reports the period").otherwise("no line gives the value")
    return rows.join(found, "record_id", "left").groupBy("cik", reason.alias("reason")).agg(F.count("*").alias("n"))


@query(
    "g28_review_filters",
    f"""WITH {RESOLVED}, q AS (SELECT company, reviewed AS approved, part % 6 = 0 AS noted, part % 7 = 0 AS conflict, acknowledged_at IS NOT NULL AS ack, supp % 8 = 0 AS change, part % 11 = 0 AS flag, line % 2 = 1 AS sentence, part % 5 AS v,
            CASE WHEN above OR below THEN CASE WHEN above = higher_is_better THEN 'better' ELSE 'worse' END END AS d FROM resolved),
        u AS (SELECT *, NOT approved AND (NOT noted OR change OR ack) AS unreviewed FROM q),
        f AS (SELECT *, unreviewed AND NOT (noted OR change OR ack OR conflict OR flag) AND sentence AND v NOT IN (0, 1) AND d IS DISTINCT FROM 'worse' AS fast FROM u)
        SELECT company, count(*) FILTER (v = 0) AS verify_no, count(*) FILTER (NOT noted) AS no_note, count(*) FILTER (conflict) AS conflict, count(*) FILTER (ack) AS ack_pending, count(*) FILTER (change) AS change_pending,
               count(*) FILTER (fast) AS fast, count(*) FILTER (unreviewed AND NOT fast) AS slow, count(*) FILTER (v = 0 AND conflict) AS both FROM f GROUP BY company""",
)
def review_filters(t: Tables) -> DataFrame:
    """How many rows each named filter keeps, and two of them together."""
    part = F.col("part")
    low, high, value = F.col("target_low"), F.col("target_high"), F.col("reported_value")
    queue = t.statements.select(
        "company",
        F.col("reviewed").alias("approved"),
        F.when(part % 6 == 0, "seen").otherwise("").alias("note"),
        (part % 7 == 0).alias("conflict"),
        F.col("acknowledged_at").isNotNull().alias("ack_pending"),
        (F.col("supp") % 8 == 0).alias("change_pending"),
        F.lit(False).alias("empty_block"),
        F.when(part % 11 == 0, "period").otherwise("").alias("flag_note"),
        F.when(F.col("line") % 2 == 1, "sentence").otherwise("section").alias("capture_method"),
        F.when(part % 5 == 0, "no").when(part % 5 != 1, "yes").alias("verify"),
        rubric.direction(low, high, value, F.col("higher_is_better")).alias("direction"),
        F.lit(True).alias("polarity_known"),
        "reported_value",
    )
    named = review.filters()
    counts = [F.count_if(p).alias(name.replace("-", "_")) for name, p in named.items()]
    return queue.groupBy("company").agg(*counts, F.count_if(named["verify-no"] & named["conflict"]).alias("both"))


@query(
    "a17_verdicts",
    f"""WITH {STATEMENTS}, v AS (SELECT CASE WHEN part % 5 = 0 THEN 'no' WHEN part % 5 = 1 THEN 'unsure' ELSE 'yes' END AS verdict, (ARRAY['wrong_period', 'wrong_value', 'other'])[1 + part % 3] AS class, supp % 6 = 0 AS rejected FROM statements),
        s AS (SELECT count(*) FILTER (verdict = 'no' AND rejected) AS hit, count(*) FILTER (verdict = 'no') AS said, count(*) FILTER (rejected) AS were FROM v)
        SELECT verdict, CASE WHEN verdict = 'no' THEN class END AS class, count(*) AS n, count(*) FILTER (rejected) AS rejected, round(any_value(hit / said), 9) AS precision_of_no, round(any_value(hit / were), 9) AS recall_of_no FROM v, s GROUP BY 1, 2""",
)
def verdicts(t: Tables) -> DataFrame:
    """Verdicts by class against the reviewer's decisions, and precision and recall of "no" over all of them."""
    part = F.col("part")
    verdict = F.when(part % 5 == 0, "no").when(part % 5 == 1, "unsure").otherwise("yes")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("wrong_period", "wrong_value", "other")]), (part % 3 + 1).cast("int"))
    v = t.statements.select(verdict.alias("verdict"), F.when(verdict == "no", kind).alias("class"), (F.col("supp") % 6 == 0).alias("no"))
    counts = v.groupBy("verdict", "class").agg(F.count("*").alias("n"), F.count_if("no").alias("rejected"))
    said = counts.agg(F.sum(F.when(F.col("verdict") == "no", F.col("rejected"))).alias("hit"), F.sum(F.when(F.col("verdict") == "no", F.col("n"))).alias("said"), F.sum("rejected").alias("were"))
    both = counts.crossJoin(F.broadcast(said))  # one row
    return both.select("verdict", "class", "n", "rejected", F.round(F.col("hit") / F.col("said"), 9).alias("precision_of_no"), F.round(F.col("hit") / F.col("were"), 9).alias("recall_of_no"))


@query(
    "t17_section_label",
    r"""WITH c AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'Section ' || role WHEN 1 THEN text || ' (in millions)' WHEN 2 THEN 'Item ' || turn ELSE text END AS line FROM conversations)
       SELECT conv_id, turn, last(CASE WHEN len(regexp_extract_all(line, '[^ \t\n\x0B\f\r]+')) BETWEEN 1 AND 6 AND NOT regexp_matches(line, '[0-9]') AND NOT regexp_matches(line, '[.:]$') THEN line END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 25 PRECEDING AND 1 PRECEDING) AS label,
              last(CASE WHEN regexp_matches(line, '(?i)\bin (millions|thousands|billions)\b') THEN substr(line, 1, 160) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 40 PRECEDING AND CURRENT ROW) AS units FROM c""",
)
def section_label(t: Tables) -> DataFrame:
    """The nearest label and note of units above each line; turns are given labels and notes of every kind."""
    turn = F.col("turn") % 4
    line = F.when(turn == 0, F.concat(F.lit("Section "), "role")).when(turn == 1, F.concat("text", F.lit(" (in millions)"))).when(turn == 2, F.concat(F.lit("Item "), F.col("turn").cast("string"))).otherwise(F.col("text"))
    rows = t.read("conversations").select("conv_id", "turn", line.alias("line"))
    return C.labelled(rows, CONFIG, ["conv_id"], "turn", "line").select("conv_id", "turn", "label", "units")


@query("w9_prompt_dedup", "SELECT conv_id, turn, n > 1 AS suppressed FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY role, sha256(text) ORDER BY conv_id, turn) AS n FROM conversations)")
def prompt_dedup(t: Tables) -> DataFrame:
    """Prompts that the same source (here the role) has sent before; the first of each is found by partial aggregation."""
    rows = t.read("conversations").select("conv_id", "turn", "role", F.sha2("text", 256).alias("prompt"))
    first = rows.groupBy("role", "prompt").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    same = [F.col("r.role").eqNullSafe(F.col("f.role")), F.col("r.prompt").eqNullSafe(F.col("f.prompt"))]
    return rows.alias("r").join(first.alias("f"), same).select("r.conv_id", "r.turn", (F.struct("r.conv_id", "r.turn") != F.col("first")).alias("suppressed"))


@query("w11_spend_cap", "SELECT event_id, upto FROM (SELECT event_id, sum(round(value * 100)::BIGINT) OVER (ORDER BY event_id)::BIGINT AS upto FROM events) WHERE upto <= 500000")
def spend_cap(t: Tables) -> DataFrame:
    """The requests of a run before its spend would pass the cap, by a running sum in parts."""
    rows = t.read("events").select("event_id", "value")
    cents = F.round(F.col("value") * 100).cast("long")
    return running_sum(rows, cents, F.floor(F.col("event_id") / 10_000), [F.col("event_id")], "upto").where("upto <= 500000").select("event_id", "upto")


@query("j10_stale_flags", f"WITH {STATEMENTS}, f AS (SELECT DISTINCT accession, stated_at FROM statements WHERE part % 5 = 0) SELECT accession FROM f WHERE right(accession, 1) = '7' OR accession NOT IN (SELECT accession FROM statements WHERE part % 5 <> 0 AND supp % 2 = 0)")
def stale_flags(t: Tables) -> DataFrame:
    """Empty-block flags stay while touched, or while the block, found by its id worked out again, has no draft."""
    def block() -> Column:
        return ids.ulid(F.col("stated_at"), F.col("accession")).alias("block_id")

    flags = t.statements.where("part % 5 = 0").select("accession", block(), (F.substring("accession", -1, 1) == "7").alias("touched")).distinct()
    drafted = t.statements.where("part % 5 <> 0 and supp % 2 = 0").select(block()).distinct()
    return flags.where("touched").unionByName(flags.where("not touched").join(drafted, "block_id", "left_anti")).select("accession")


@query(
    "j14_row_context",
    rf"""WITH {SENTENCES}, d AS (SELECT record_id, replace(accession, '-', '') AS a, line FROM statements), x AS (SELECT replace(accession, '-', '') AS a, line, min(sentence) AS context FROM sentences
        WHERE NOT regexp_matches(sentence, '(?i)\bQ[1-4]\b|\bFY ?[0-9]|fiscal (year )?[0-9]|full-year|[a-z]+ quarter|[1-4]Q[0-9]') GROUP BY 1, 2) SELECT d.record_id, x.context FROM d LEFT JOIN x USING (a, line)""",
)
def row_context(t: Tables) -> DataFrame:
    """The candidate sentence of a draft, found by the filing and the place in its custom id, where the sentence names no period."""
    own = t.statements.select("record_id", ids.custom_id(F.col("accession"), F.col("line"), F.lit("sentence")).alias("custom_id"))
    part = F.split("custom_id", "_")
    keyed = own.select("record_id", F.get(part, F.lit(0)).alias("filing"), F.get(part, F.lit(1)).cast("long").alias("place"))
    bare = t.sentences.where(~F.col("sentence").rlike(r"(?i)\bQ[1-4]\b|\bFY ?\d|fiscal (?:year )?\d|full-year|[a-z]+ quarter|[1-4]Q\d"))
    context = bare.groupBy(F.regexp_replace("accession", "-", "").alias("filing"), F.col("line").alias("place")).agg(F.min("sentence").alias("context"))
    return keyed.join(context, ["filing", "place"], "left").select("record_id", "context")


_BROKEN = {3: "cik", 4: "ticker", 5: "content_sha256", 6: "source_url", 7: "excerpt", 8: "acknowledgement", 9: "draft_id"}


@query(
    "v1_record_schema",
    f"""WITH {STATEMENTS} SELECT record_id, CASE part % 12 {" ".join(f"WHEN {k} THEN '{name}'" for k, name in _BROKEN.items())} END AS "check" FROM statements WHERE part % 12 BETWEEN 3 AND 9""",
)
def record_schema(t: Tables) -> DataFrame:
    """Records with evidence, one column of every other one broken: every pattern of the schema, and a day of acknowledgement without evidence."""
    part = F.col("part") % 12

    def broken(k: int, wrong: Column, right: Column) -> Column:
        return F.when(part == k, wrong).otherwise(right)

    long = F.repeat(F.lit("word "), 81)
    rows = t.resolved.select(
        "record_id", "accession", "target_low", "target_high", "reported_value", "stated_at", "reported_at", "status", "acknowledged_at", "company",
        broken(3, F.col("supp").cast("string"), F.col("cik")).alias("cik"),
        broken(4, F.lit("toolong"), F.lit("BRK.B")).alias("ticker"),
        broken(5, F.md5("record_id"), F.sha2("record_id", 256)).alias("content_sha256"),
        broken(6, F.concat(F.lit("https://example.org/"), "accession"), F.concat(F.lit("https://www.sec.gov/Archives/"), "accession")).alias("source_url"),
        broken(7, F.when(F.col("supp") % 2 == 0, "").otherwise(long), F.substring(long, 1, 400)).alias("excerpt"),
        broken(8, F.when(F.col("acknowledged_at").isNull(), "u"), F.when(F.col("acknowledged_at").isNotNull(), "u")).alias("acknowledgement_url"),
        broken(9, F.lower("record_id"), ids.ulid(F.col("stated_at"), F.col("record_id"))).alias("draft_id"),
    )
    names = [*validate.PATTERNS, "acknowledgement"]
    return validate.issues(rows).where(F.col("check").isin(names)).select("record_id", "check")
