"""Queries of text patterns, guards, deduplication, the review queue and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..dims import UNITS, Config
from ..functions import guards as G
from ..functions import periods
from ..functions import text as T
from ..operators import candidates as C
from ..operators import dedupe as D
from ..operators import review, validate
from .registry import query
from .substrate import RESOLVED, SENTENCES, STATEMENTS, Tables

CONFIG = Config()
_FORWARD = "(?i)(^|[^A-Za-z0-9_])(expect(s|ed|ing)?|guidance|outlook|anticipat(e|es|ed|ing)|forecast(s|ed|ing)?|full[- ]year|fiscal (year )?20[0-9][0-9])([^A-Za-z0-9_]|$)"
_UNITS = "percent|per cent|basis points?|bps|pts|points?|cents?|thousand|million|billion|trillion|units|stores|locations"
_NUMBER = r"[0-9][0-9,]*(\.[0-9]+)?"


@query("t6_candidate_terms", rf"WITH {SENTENCES} SELECT record_id, regexp_matches(sentence, '{_FORWARD}') AS forward, regexp_matches(sentence, '(?i)[$€£] ?{_NUMBER}|{_NUMBER} ?%|{_NUMBER}[ -]({_UNITS})([^A-Za-z0-9_]|$)') AS number FROM sentences")
def candidate_terms(t: Tables) -> DataFrame:
    return t.sentences.select("record_id", T.has_forward_term(F.col("sentence"), CONFIG).alias("forward"), T.has_number_with_unit(F.col("sentence"), CONFIG).alias("number"))


def _lines(t: Tables) -> DataFrame:
    return t.read("documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


_LINES = "lines AS (SELECT doc_id, unnest(range(0, len(l)))::INT AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))"


@query("t2_gaps", f"WITH {_LINES}, k AS (SELECT * FROM lines WHERE trim(line) <> '') SELECT doc_id, line_no, (line_no - lag(line_no, 1, -1) OVER (PARTITION BY doc_id ORDER BY line_no) - 1)::INT AS gap FROM k")
def gaps(t: Tables) -> DataFrame:
    """Blank lines before each line that is not blank."""
    w = Window.partitionBy("doc_id").orderBy("line_no")
    return _lines(t).where(F.trim("line") != "").select("doc_id", "line_no", (F.col("line_no") - F.lag("line_no", 1, -1).over(w) - 1).alias("gap"))


@query("t3_line_offsets", f"WITH {_LINES} SELECT doc_id, line_no, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - length(line) - 1)::BIGINT AS line_start FROM lines")
def line_offsets(t: Tables) -> DataFrame:
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return _lines(t).select("doc_id", "line_no", (F.sum(F.length("line") + 1).over(w) - F.length("line") - 1).alias("line_start"))


@query("t5_content_hash", "SELECT doc_id, sha256(text) AS content_sha256 FROM documents")
def content_hash(t: Tables) -> DataFrame:
    return t.read("documents").select("doc_id", F.sha2("text", 256).alias("content_sha256"))


@query(
    "t10_context",
    """WITH c AS (SELECT conv_id, turn, CASE WHEN length(text) > 300 THEN rtrim(substr(text, 1, 300)) || '...' ELSE text END AS x FROM conversations)
       SELECT conv_id, turn, coalesce(list(x) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), []) AS before,
              coalesce(list(x) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), []) AS after FROM c""",
)
def context(t: Tables) -> DataFrame:
    return C.with_context(t.read("conversations"), CONFIG, ["conv_id"], "turn", "text").select("conv_id", "turn", "before", "after")


@query(
    "t11_parse_periods",
    f"""WITH {SENTENCES} SELECT record_id, CASE part % 8 WHEN 0 THEN CASE WHEN fiscal_year >= 2000 THEN ['Q' || coalesce(quarter, 4) || ' FY' || fiscal_year] ELSE [] END
        WHEN 2 THEN ['Q' || coalesce(quarter, 2) || ' FY20' || substr(fiscal_year::VARCHAR, 3, 2)] WHEN 3 THEN CASE WHEN fiscal_year >= 2000 THEN ['FY' || fiscal_year] ELSE [] END
        WHEN 5 THEN ['Q' || coalesce(quarter, 1) || ' FY20' || substr(fiscal_year::VARCHAR, 3, 2)] ELSE [] END AS periods FROM sentences""",
)
def parse_periods(t: Tables) -> DataFrame:
    return t.sentences.select("record_id", periods.parse_periods(F.col("sentence")).alias("periods"))


@query("t21_table_lines", f"WITH {SENTENCES} SELECT record_id, part % 8 = 7 AS is_table FROM sentences")
def table_lines(t: Tables) -> DataFrame:
    return t.sentences.select("record_id", T.is_table_line(F.col("sentence")).alias("is_table"))


_KINDS = ", ".join(f"('{u}', '{k}')" for u, _, k, _ in UNITS)


@query("g9_unit_kind", f"WITH {STATEMENTS}, units(unit, ukind) AS (VALUES {_KINDS}), s AS (SELECT *, (ARRAY['USD', 'USD millions', 'USD per share', 'percent', 'basis points'])[1 + supp % 5] AS unit FROM statements) SELECT record_id, CASE WHEN ukind <> kind THEN 'unit kind ' || ukind || ' for a metric in ' || kind END AS reason FROM s JOIN units USING (unit)")
def unit_kind(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(u) for u in ("USD", "USD millions", "USD per share", "percent", "basis points")])
    known = t.spark.createDataFrame([(u, k) for u, _, k, _ in UNITS], "unit string, ukind string")
    rows = t.statements.withColumn("unit", F.get(names, (F.col("supp") % 5).cast("int"))).join(F.broadcast(known), "unit")
    return rows.select("record_id", G.unit_kind_differs(F.col("ukind"), F.col("kind")).alias("reason"))


@query(
    "g12_resolve_range",
    f"""WITH {STATEMENTS}, r AS (SELECT record_id, target_low AS l, target_high AS h, CASE WHEN part % 3 = 0 THEN (supp % 7)::DOUBLE END AS spread, part % 2 = 0 AS rel FROM statements),
        x AS (SELECT *, CASE WHEN rel THEN abs(coalesce(l, h)) * spread / 100 ELSE spread END AS room FROM r)
        SELECT record_id, round(CASE WHEN spread IS NULL THEN l ELSE coalesce(l, h) - room END, 6) AS low, round(CASE WHEN spread IS NULL THEN h ELSE coalesce(l, h) + room END, 6) AS high FROM x""",
)
def resolve_range(t: Tables) -> DataFrame:
    spread = F.when(F.col("part") % 3 == 0, (F.col("supp") % 7).cast("double"))
    found = G.resolve_range(F.col("target_low"), F.col("target_high"), spread, F.col("part") % 2 == 0)
    return t.statements.select("record_id", found["low"].alias("low"), found["high"].alias("high"))


@query("g23_convert", f"WITH {STATEMENTS}, u(k, fam, sc) AS (VALUES (0, 'dollars', 1.0), (1, 'dollars', 1e3), (2, 'dollars', 1e6), (3, 'percent', 1.0), (4, 'percent', 0.01)) SELECT record_id, CASE WHEN a.fam = b.fam THEN round(target_low * a.sc / b.sc, 6) END AS value FROM statements JOIN u a ON a.k = part % 5 JOIN u b ON b.k = supp % 5")
def convert(t: Tables) -> DataFrame:
    table = t.spark.createDataFrame([(0, "dollars", 1.0), (1, "dollars", 1e3), (2, "dollars", 1e6), (3, "percent", 1.0), (4, "percent", 0.01)], "k long, family string, scale double")
    a = table.select((F.col("k")).alias("ka"), F.col("family").alias("fa"), F.col("scale").alias("sa"))
    b = table.select((F.col("k")).alias("kb"), F.col("family").alias("fb"), F.col("scale").alias("sb"))
    rows = t.statements.join(F.broadcast(a), F.col("part") % 5 == F.col("ka")).join(F.broadcast(b), F.col("supp") % 5 == F.col("kb"))
    return rows.select("record_id", G.convert(F.col("target_low"), F.col("sa"), F.col("fa"), F.col("sb"), F.col("fb")).alias("value"))


@query("g25_plausible", f"WITH {STATEMENTS} SELECT record_id, CASE WHEN reported_value IS NULL THEN NULL WHEN reported_value > 0 THEN 2 * reported_value / (coalesce(target_low, target_high) + coalesce(target_high, target_low)) BETWEEN 0.2 AND 5 ELSE true END AS plausible FROM statements WHERE reported_value IS NOT NULL")
def plausible(t: Tables) -> DataFrame:
    found = G.plausible(F.col("reported_value"), F.col("target_low"), F.col("target_high"), CONFIG.plausible_ratio)
    return t.statements.where("reported_value is not null").select("record_id", found.alias("plausible"))


@query("w4_prefer_prose", f"WITH {SENTENCES} SELECT record_id FROM (SELECT *, part % 8 <> 7 AS prose, bool_or(part % 8 <> 7) OVER (PARTITION BY accession) AS has_prose FROM sentences) WHERE prose OR NOT has_prose")
def prefer_prose(t: Tables) -> DataFrame:
    """Table rows of a release go when it has a prose line."""
    rows = t.sentences.withColumn("prose", ~T.is_table_line(F.col("sentence")))
    rows = rows.withColumn("has_prose", F.bool_or("prose").over(Window.partitionBy("accession")))
    return rows.where("prose or not has_prose").select("record_id")


@query("w5_earliest_withdrawal", f"WITH {RESOLVED} SELECT cik, metric, target_period, min(withdrawn_at) AS withdrawn_at, arg_min(record_id, (withdrawn_at, record_id)) AS record_id FROM resolved WHERE withdrawn_at <= period_close GROUP BY ALL")
def earliest_withdrawal(t: Tables) -> DataFrame:
    first = F.min(F.struct("withdrawn_at", "record_id")).alias("b")
    return t.resolved.where("withdrawn_at <= period_close").groupBy("cik", "metric", "target_period").agg(first).select("cik", "metric", "target_period", "b.withdrawn_at", "b.record_id")


def _drafts(t: Tables) -> DataFrame:
    """Statements as drafts on coarser days, so that keys repeat, some in another dollar unit."""
    thousand = F.col("part") % 6 == 0
    return t.statements.select(
        "cik",
        "metric",
        "target_period",
        F.to_date(F.date_trunc("quarter", "stated_at")).alias("stated_at"),
        F.when(F.col("line") % 2 == 0, "sentence").otherwise("section").alias("capture_method"),
        F.col("line").cast("int").alias("char_start"),
        F.col("supp").cast("int").alias("item_index"),
        F.col("record_id").alias("draft_id"),
        F.when(thousand, F.col("target_low") * 1000).otherwise(F.col("target_low")).alias("target_low"),
        F.when(thousand, F.col("target_high") * 1000).otherwise(F.col("target_high")).alias("target_high"),
        F.when(thousand, "USD thousands").otherwise("USD millions").alias("unit"),
    )


@query("a6_dedupe")
def dedupe_drafts(t: Tables) -> DataFrame:
    return D.dedupe(_drafts(t))


@query(
    "a18_funnel",
    f"""WITH {STATEMENTS}, k AS (SELECT cik, metric, target_period, date_trunc('quarter', stated_at) AS q, count(*) AS n FROM statements GROUP BY ALL)
        SELECT 'drafts' AS stage, sum(n)::BIGINT AS n FROM k UNION ALL SELECT 'keys', count(*) FROM k UNION ALL SELECT 'reviewed', count(*) FROM statements WHERE reviewed
        UNION ALL SELECT 'published', count(*) FROM statements WHERE reviewed AND publish""",
)
def funnel(t: Tables) -> DataFrame:
    s = t.statements
    stages = s.agg(F.count("*").alias("drafts"), F.count_if("reviewed").alias("reviewed"), F.count_if(F.expr("reviewed and publish")).alias("published"))
    keys = _drafts(t).select(*D.KEYS).distinct().agg(F.count("*").alias("keys"))
    return stages.unpivot([], ["drafts", "reviewed", "published"], "stage", "n").union(keys.unpivot([], ["keys"], "stage", "n"))


def _queue(t: Tables) -> DataFrame:
    columns = ["target_low", "target_high"]
    q = t.statements.where("part % 3 <> 0").select("record_id", *columns, (F.col("part") % 4 == 0).alias("touched"), F.lit("").alias("note"))
    return q.withColumn("snapshot", review.as_map(columns)).withColumn("target_low", F.when(F.col("touched"), F.col("target_low") + 0.5).otherwise(F.col("target_low")))


def _fresh(t: Tables) -> DataFrame:
    moved = F.when(F.col("supp") % 5 == 0, F.col("target_low") + 1).otherwise(F.col("target_low"))
    return t.statements.where("part % 7 <> 0").select("record_id", moved.alias("target_low"), "target_high")


@query(
    "m2_refresh",
    f"""WITH {STATEMENTS}, x AS (SELECT *, part % 3 <> 0 AS in_q, part % 7 <> 0 AS in_f, part % 4 = 0 AND part % 3 <> 0 AS touched, CASE WHEN supp % 5 = 0 THEN target_low + 1 ELSE target_low END AS f_low FROM statements WHERE part % 3 <> 0 OR part % 7 <> 0)
        SELECT record_id, CASE WHEN in_f AND NOT touched THEN f_low WHEN touched THEN target_low + 0.5 ELSE target_low END AS target_low, target_high, NOT in_q AS added,
               touched AND in_f AND f_low IS DISTINCT FROM target_low AND f_low IS DISTINCT FROM target_low + 0.5 AS proposed FROM x""",
)
def refresh(t: Tables) -> DataFrame:
    out = review.refresh(_queue(t), _fresh(t), ["target_low", "target_high"])
    return out.select("record_id", "target_low", "target_high", "added", F.col("proposal").isNotNull().alias("proposed"))


@query("x4_keep_found", f"WITH {STATEMENTS} SELECT record_id, CASE WHEN part % 3 = 0 THEN coalesce(reported_value, 0) ELSE reported_value END AS reported_value FROM statements")
def keep_found(t: Tables) -> DataFrame:
    old = t.statements.select("record_id", "reported_value")
    new = t.statements.where("part % 2 = 0 or part % 3 = 0").select("record_id", F.when(F.col("part") % 3 == 0, F.coalesce("reported_value", F.lit(0.0))).alias("reported_value"))
    return review.keep_found(old, new, "record_id", ["reported_value"])


@query(
    "v2_row_checks",
    f"""WITH {RESOLVED}, v AS (SELECT record_id, CASE WHEN supp % 40 = 0 THEN 'met' ELSE status END AS status, status AS again, CASE WHEN part % 50 = 0 THEN stated_at ELSE reported_at END AS reported_at, stated_at, acknowledged_at, above, below, reported_value, accession FROM resolved)
        SELECT record_id, 'reported before stated' AS "check" FROM v WHERE reported_at <= stated_at UNION ALL
        SELECT record_id, 'acknowledged before reported' FROM v WHERE acknowledged_at < reported_at UNION ALL
        SELECT record_id, 'stored status' FROM v WHERE status NOT IN ('open', 'withdrawn') AND status <> CASE WHEN reported_value IS NULL THEN 'unresolved' WHEN above OR below THEN 'missed' ELSE 'met' END""",
)
def row_checks(t: Tables) -> DataFrame:
    rows = t.resolved.withColumn("status", F.when(F.col("supp") % 40 == 0, "met").otherwise(F.col("status")))
    rows = rows.withColumn("reported_at", F.when(F.col("part") % 50 == 0, F.col("stated_at")).otherwise(F.col("reported_at")))
    return validate.issues(rows).select("record_id", "check")
