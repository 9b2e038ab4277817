"""The review queue at full width: rows built from drafts and outcomes, its files, checks of its records and evidence, and what a run changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import audit, validate
from ..operators import queue as Q
from ..operators.joins import join_within
from ..sources import records as R
from .corpus import scratch
from .registry import query
from .substrate import FILINGS, RESOLVED, STATEMENTS, Tables

TODAY = "2030-01-01"
_NAMED, _UNNAMED, _GONE = "We expect this in Q2 FY2030.", 'We said "more",\nand then less.', "We withdraw\nour guidance."


def _evidence(accession: Column, day: Column, excerpt: Column) -> Column:
    return F.struct(
        F.concat(F.lit("https://www.sec.gov/"), accession).alias("source_url"), accession.alias("accession_number"), F.lit("8-K").alias("filing_type"), day.alias("filed_at"),
        F.lit("2030-01-01 12:00:00").cast("timestamp").alias("fetched_at"), F.concat("record_id", "record_id").alias("content_sha256"), excerpt.alias("excerpt"),
    )


def _inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Drafts of all statements, and what was found for those that were searched (all but a ninth), both with their filing's number."""
    s, own = t.statements, F.col("accession")
    unit = F.when(F.col("kind") == "percent", "percent").when(F.col("kind") == "per share", "USD per share").when(F.col("part") % 5 == 0, "USD").otherwise("USD millions")
    ids = F.concat(F.lit("0"), F.upper(F.substring("record_id", 1, 25))).alias("draft_id")
    excerpt = F.when(F.col("part") % 4 == 0, _NAMED).otherwise(_UNNAMED)
    said = F.struct(
        F.lit("Guidance.").alias("text"), "metric", "target_low", "target_high", unit.alias("unit"), "target_period", "stated_at", _evidence(own, F.col("stated_at"), excerpt).alias("evidence")
    )
    drafts = s.select(
        ids, "company", F.substring(F.replace("company", F.lit(" "), F.lit("")), 1, 5).alias("ticker"), "cik", (F.col("part") % 8 == 0).alias("conflict"),
        F.when(F.col("line") % 2 == 0, "sentence").otherwise("section").alias("capture_method"), F.when(F.col("line") % 2 == 1, "Financial Outlook").alias("heading"),
        F.lit(None).cast("string").alias("lead_in"), F.lit(None).cast("string").alias("table_header"), F.lit(None).cast("string").alias("value_column"),
        F.when(F.col("part") % 7 == 0, "a figure in parentheses").alias("parens_note"), F.when(F.col("part") % 3 == 0, F.array(F.lit("In the\n quarter"), F.lit(" we sold   more."))).alias("context_before"),
        said.alias("assumption"), "filing_no",
    )
    outcome = F.struct("reported_value", "reported_at", _evidence(own, F.col("reported_at"), F.lit("Revenue was told.")).alias("evidence"))
    seen = F.struct("acknowledged_at", _evidence(own, F.col("acknowledged_at"), F.lit("We fell short, as \\ told.")).alias("evidence"))
    gone = F.struct("withdrawn_at", F.date_add("stated_at", (F.col("supp") % 3 * 30).cast("int")).alias("period_close"), _evidence(own, F.col("withdrawn_at"), F.lit(_GONE)).alias("evidence"))
    outcomes = s.where("part % 9 <> 0").select(
        ids, "cik", F.when(F.col("reported_value").isNotNull(), outcome).alias("outcome"), F.when(F.col("reported_value").isNull() & (F.col("supp") % 2 == 0), "no line gives the value").otherwise("").alias("outcome_reason"),
        F.when(F.col("acknowledged_at").isNotNull(), seen).alias("acknowledgement"), F.when(F.col("withdrawn_at").isNotNull(), gone).alias("withdrawal"), "filing_no",
    )
    return drafts, outcomes


def _rows(t: Tables) -> DataFrame:
    return Q.build_rows(*_inputs(t), F.lit(TODAY).cast("date"), "a reviewer", "filing_no")


def _marked(t: Tables) -> DataFrame:
    """Records of all drafts, with the numbers of their statement: ``p``, ``s`` and ``n``."""
    s = t.statements
    marks = s.select("filing_no", F.concat(F.lit("0"), F.upper(F.substring("record_id", 1, 25))).alias("record_id"), F.col("part").alias("p"), F.col("supp").alias("s"), F.col("line").alias("n"))
    rows = Q.build_records(*_inputs(t), F.lit(TODAY).cast("date"), "a reviewer", "filing_no")
    return join_within(rows, marks, "filing_no", "record_id", "mark").withColumns({c: F.col(f"mark.{c}") for c in "psn"}).drop("mark")


def _amount(x: str) -> str:
    return f"CASE unit WHEN 'USD' THEN '$' || format('{{:,.2f}}', {x}) WHEN 'USD millions' THEN '$' || {x}::INT || ' million' WHEN 'percent' THEN {x}::INT || '%' ELSE '$' || {x}::INT || ' per share' END"


_QUEUE = f"""{STATEMENTS}, q0 AS (SELECT *, '0' || upper(record_id[1:25]) AS id, CASE WHEN kind = 'percent' THEN 'percent' WHEN kind = 'per share' THEN 'USD per share' WHEN part % 5 = 0 THEN 'USD' ELSE 'USD millions' END AS unit,
      part % 9 <> 0 AS searched, CASE WHEN part % 9 <> 0 THEN reported_value END AS v, part % 9 <> 0 AND withdrawn_at IS NOT NULL AND supp % 3 <> 0 AS gone FROM statements),
    q AS (SELECT *, company || ' expects ' || metric || ' of ' || CASE WHEN target_low = target_high THEN {_amount("target_low")} WHEN target_low IS NULL THEN 'no more than ' || {_amount("target_high")}
        WHEN target_high IS NULL THEN 'at least ' || {_amount("target_low")} ELSE {_amount("target_low")} || ' to ' || {_amount("target_high")} END || ' for ' || target_period || '.' AS claim,
      'reported value ' || CASE WHEN target_low = target_high THEN 'differs from ' || target_low::INT WHEN target_low IS NULL THEN 'is above ' || target_high::INT WHEN target_high IS NULL THEN 'is below ' || target_low::INT
        ELSE 'falls outside [' || target_low::INT || ', ' || target_high::INT || ']' END AS condition,
      CASE WHEN gone THEN 'withdrawn' WHEN v IS NULL THEN 'unresolved' WHEN coalesce(v > target_high, false) OR coalesce(v < target_low, false) THEN 'missed' ELSE 'met' END AS proposed,
      CASE WHEN gone THEN 'filed ' || withdrawn_at || ', before the period closed on ' || (stated_at + (supp % 3 * 30)::INT) || ' (https://www.sec.gov/' || accession || '): {_GONE}' END AS gone_note FROM q0)"""


@query(
    "m1_build_row",
    f"""WITH {_QUEUE} SELECT id AS record_id, claim, condition, 'open' AS status, proposed, CASE WHEN v IS NOT NULL THEN NULL WHEN searched AND reported_value IS NULL AND supp % 2 = 0 THEN 'no line gives the value' ELSE 'outcome search not run' END AS outcome_note,
        gone_note, CASE WHEN line % 2 = 0 AND part % 4 <> 0 AND part % 3 = 0 THEN 'In the quarter we sold more.' END AS context, CASE WHEN v IS NOT NULL THEN (reported_at - stated_at)::INT END AS days,
        CASE WHEN v IS NOT NULL THEN (acknowledged_at - reported_at)::INT END AS ack_days, claim AS last_claim, CASE WHEN part % 7 = 0 THEN 'a figure in parentheses' ELSE '' END AS last_flag, part % 8 = 0 AS last_conflict, target_low AS last_low, 11 AS last_size FROM q""",
)
def build_row(t: Tables) -> DataFrame:
    """What rows say, what would show them wrong, what the rubric proposes, what helps a reviewer, and the values last derived."""

    def last(name: str) -> Column:
        return F.get_json_object("aid_derived_snapshot", f"$['{name}']")

    return _rows(t).select(
        "record_id", "claim", F.col("invalidation_condition").alias("condition"), "status", F.col("aid_proposed_status").alias("proposed"), F.col("aid_outcome_note").alias("outcome_note"), F.col("aid_withdrawal_note").alias("gone_note"),
        F.col("aid_context").alias("context"), F.col("days_to_falsifiable").cast("int").alias("days"), F.col("days_to_acknowledged").cast("int").alias("ack_days"), last("claim").alias("last_claim"), last("aid_flag_note").alias("last_flag"),
        last("conflict").cast("boolean").alias("last_conflict"), last("assumption.target_low").try_cast("double").alias("last_low"), F.size(F.json_object_keys("aid_derived_snapshot")).alias("last_size"),
    )


_BACK = """id AS record_id, claim, metric, target_low, target_high, stated_at, CASE WHEN part % 4 = 0 THEN '""" + _NAMED + "' ELSE '" + _UNNAMED + """' END AS excerpt, v AS reported_value, CASE WHEN v IS NOT NULL THEN reported_at END AS reported_at,
        CASE WHEN searched THEN acknowledged_at END AS acknowledged_at, CASE WHEN searched AND acknowledged_at IS NOT NULL THEN 'We fell short, as \\ told.' END AS ack_excerpt"""


def _back(records: DataFrame) -> DataFrame:
    a, o = (lambda n: F.col(f"assumption.{n}")), (lambda n: F.col(f"outcome.{n}"))
    return records.select(
        "record_id", "claim", a("metric"), a("target_low"), a("target_high"), a("stated_at"), a("evidence.excerpt"), o("reported_value"), o("reported_at"), "acknowledged_at", F.col("acknowledgement_evidence.excerpt").alias("ack_excerpt")
    )


@query("s5_full_queue", f"WITH {_QUEUE} SELECT {_BACK}, gone_note, 69 AS width FROM q")
def full_queue(t: Tables) -> DataFrame:
    """The whole queue as a CSV file and back, as nested records beside the notes: all columns, cells with quotes, commas, backslashes and line ends."""
    path = scratch(t.spark, "full-queue")
    R.write_queue(_rows(t), path)
    read = R.read_queue(t.spark, path)
    note = read.select(F.col("record_id").alias("its_id"), F.nullif("aid_withdrawal_note", F.lit("")).alias("gone_note"))
    return _back(R.unflatten(read)).join(note, F.col("record_id") == F.col("its_id")).drop("its_id").withColumn("width", F.lit(len(read.columns)))


@query("s3_drafts_and_outcomes", f"WITH {_QUEUE} SELECT {_BACK} FROM q")
def drafts_and_outcomes(t: Tables) -> DataFrame:
    """Drafts and outcomes as JSON lines by company, read back with their schemas, make the same records."""
    back = []
    for rows, schema, name in zip(_inputs(t), (Q.DRAFT, Q.OUTCOME), ("drafts", "outcomes")):
        path = scratch(t.spark, name)
        R.write_by_company(rows.drop("filing_no"), path)
        back.append(t.spark.read.schema(schema).json(path))
    return _back(Q.build_records(*back, F.lit(TODAY).cast("date"), "a reviewer"))


_FAULTS = {
    "ticker": "part % 11 = 0",
    "status": "supp % 7 = 0",
    "assumption.evidence.source_url": "part % 13 = 0",
    "outcome.evidence.excerpt": "supp % 11 = 0 AND v IS NOT NULL",
    "acknowledged_at": "part % 6 = 0 AND searched AND acknowledged_at IS NOT NULL",
    "assumption.target_low": "supp % 13 = 0",
    "assumption": "supp % 13 <> 0 AND part % 19 = 0 AND target_high IS NOT NULL",
    "assumption.unit": "line = 4",
    "assumption.evidence.filed_at": "part % 21 = 0",
}


@query("v1_record_issues", f"WITH {_QUEUE} " + " UNION ALL ".join(f"SELECT id AS record_id, '{name}' AS \"check\" FROM q WHERE {when}" for name, when in _FAULTS.items()))
def record_issues(t: Tables) -> DataFrame:
    """All records with faults of many kinds at every level, alone and together; results are not filtered."""
    rows = _marked(t)
    p, s = F.col("p"), F.col("s")
    a = F.col("assumption")
    low = F.when(s % 13 == 0, float("nan")).when(p % 19 == 0, F.coalesce(a["target_high"] + 1, a["target_low"])).otherwise(a["target_low"])
    url = F.when(p % 13 == 0, "https://example.com/x").otherwise(a["evidence"]["source_url"])
    day = F.when(p % 21 != 0, a["evidence"]["filed_at"])
    a = a.withField("target_low", low).withField("unit", F.when(F.col("n") == 4, "").otherwise(a["unit"])).withField("evidence", a["evidence"].withField("source_url", url).withField("filed_at", day))
    o = F.col("outcome")
    words = F.when(s % 11 == 0, F.repeat(F.lit("x"), 401)).otherwise(o["evidence"]["excerpt"])
    o = o.withField("evidence", o["evidence"].withField("excerpt", words))
    bad = rows.withColumns(
        {
            "assumption": a,
            "outcome": o,
            "ticker": F.when(p % 11 == 0, "no ticker").otherwise(F.lower("ticker")),
            "status": F.when(s % 7 == 0, "done").otherwise(F.col("status")),
            "acknowledgement_evidence": F.when(p % 6 != 0, F.col("acknowledgement_evidence")),
        }
    )
    return validate.record_issues(bad).select("record_id", "check")


@query(
    "j11_three_evidences",
    f"""WITH {_QUEUE}, e AS (SELECT id AS record_id, 'assumption.evidence' AS place, o_orderkey % 50 = 0 AS gone, false AS changed, part % 5 = 0 AS other FROM q JOIN filings USING (accession)
          UNION ALL SELECT id, 'outcome.evidence', o_orderkey % 50 = 0, supp % 7 = 0, false FROM q JOIN filings USING (accession) WHERE v IS NOT NULL
          UNION ALL SELECT id, 'acknowledgement_evidence', o_orderkey % 50 = 0 OR part % 2 = 0, false, supp % 3 = 0 FROM q JOIN filings USING (accession) WHERE searched AND q.acknowledged_at IS NOT NULL)
        SELECT record_id, place || '.cached_document' AS "check" FROM e WHERE gone UNION ALL SELECT record_id, place || '.content_sha256' FROM e WHERE NOT gone AND changed UNION ALL SELECT record_id, place || '.excerpt' FROM e WHERE NOT gone AND other""",
)
def three_evidences(t: Tables) -> DataFrame:
    """All evidence of all records against the cache of releases: missing, changed, or without the excerpt."""
    releases = t.releases.select("cik", "accession", "text", "o_orderkey")
    sha = releases.select(F.col("o_orderkey").alias("filing_no"), F.sha2("text", 256).alias("sha"))
    rows = _marked(t).join(sha, "filing_no")
    p, s = F.col("p"), F.col("s")

    def cites(evidence: Column, excerpt: Column, sha: Column | None = None, accession: Column | None = None) -> Column:
        out = evidence.withField("excerpt", excerpt).withField("content_sha256", F.col("sha") if sha is None else sha)
        return out if accession is None else out.withField("accession_number", accession)

    other = F.lit("never said")
    a, o, k = F.col("assumption"), F.col("outcome"), F.col("acknowledgement_evidence")
    name = F.col("company")
    cited = rows.withColumns(
        {
            "assumption": a.withField("evidence", cites(a["evidence"], F.when(p % 5 == 0, other).otherwise(name))),
            "outcome": o.withField("evidence", cites(o["evidence"], name, F.when(s % 7 == 0, F.reverse("sha")).otherwise(F.col("sha")))),
            "acknowledgement_evidence": cites(k, F.when(s % 3 == 0, other).otherwise(name), None, F.when(p % 2 == 0, "0000000000-00-000000").otherwise(k["accession_number"])),
        }
    )
    return validate.evidence_issues(cited, releases.where("o_orderkey % 50 <> 0").drop("o_orderkey"))


#: Excerpts about a value N, and the reasons that each gives.
_EXCERPTS = [
    ("Revenue was $N million.", ""), ("We expect revenue of $N million.", "k"), ("Margin was N% to 99999%.", "r"), ("Our Outlook and guidance were 7–N.", "kr"), ("Revenue was $9N9 million.", "m"),
    ("Revenue was $N.01 per share.", ""), ("Revenue was N000 thousand, as targeted.", "k"), (None, "m"), ("Revenue was N,777.", "m"), ("(N), N.00 and 1N0N", ""), ("It was flat.", "m"),
]


@query(
    "a21_outcome_audit",
    f"""WITH {RESOLVED}, r AS (SELECT company, ({[why for _, why in _EXCERPTS]!r})[1 + part % {len(_EXCERPTS)}] AS why, supp % 6 = 0 AS ok FROM resolved WHERE reviewed AND reported_value IS NOT NULL)
        SELECT coalesce(company, 'TOTAL') AS company, count(*) FILTER (why <> '' AND NOT ok) AS flagged, count(*) FILTER (why <> '' AND ok) AS allowed, count(*) FILTER (why = '') AS clean,
          count(*) FILTER (contains(why, 'k')) AS keyword, count(*) FILTER (contains(why, 'r')) AS in_range, count(*) FILTER (contains(why, 'm')) AS value_missing FROM r GROUP BY ROLLUP (company)""",
)
def outcome_audit(t: Tables) -> DataFrame:
    """Approved rows whose excerpt looks ahead, prints the value in a range or does not print it, less those looked at, by company with a total."""
    said = F.element_at(F.array(*[F.lit(x) for x, _ in _EXCERPTS]), (F.col("part") % len(_EXCERPTS) + 1).cast("int"))
    value = F.col("reported_value")
    rows = t.resolved.select("record_id", "company", F.col("reviewed").alias("approved"), F.concat(F.lit("$"), value.cast("string")).alias("value"), F.replace(said, F.lit("N"), value.cast("int").cast("string")).alias("excerpt"))
    return audit.audit_outcomes(rows, t.statements.where("supp % 6 = 0").select("record_id"), "company")


@query(
    "a20_before_after",
    f"""WITH {RESOLVED}, d AS (SELECT company, reviewed, supp % 31 <> 0 AS old, part % 29 <> 0 AS new, part % 3 <> 1 AS guided, part % 4 <> 0 AS searched, CASE WHEN supp % 31 <> 0 THEN reported_value END AS b,
          CASE WHEN part % 29 = 0 THEN NULL WHEN part % 10 = 0 THEN NULL WHEN part % 10 = 1 THEN reported_value + 1 WHEN part % 10 = 2 THEN coalesce(reported_value, 5) ELSE reported_value END AS a,
          part % 10 = 3 AS moved, CASE WHEN supp % 5 = 0 THEN coalesce(reported_value + 1, 3) ELSE reported_value END AS f FROM resolved WHERE supp % 31 <> 0 OR part % 29 <> 0)
        SELECT coalesce(company, 'TOTAL') AS company, count(b) AS before, count(a) AS after, count(*) FILTER (old AND new AND b IS NULL AND a IS NOT NULL) AS gained, count(*) FILTER (new AND b IS NOT NULL AND a IS NULL) AS lost,
          count(*) FILTER (new AND b IS NOT NULL AND a IS NOT NULL AND (a <> b OR moved)) AS changed, count(*) FILTER (old AND new AND reviewed AND searched AND f IS DISTINCT FROM b) AS pending,
          count(*) FILTER (new AND b IS NOT NULL AND a IS NULL AND guided) AS lost_guidance FROM d GROUP BY ROLLUP (company)""",
)
def before_after(t: Tables) -> DataFrame:
    """Two states of a queue by value and filing, what the pipeline would change, and what was lost that reads like guidance."""
    kind, value = F.col("part") % 10, F.col("reported_value")
    said = F.element_at(F.array(*[F.lit(x) for x in ("We EXPECT $5.", "Results were $5.", "Approximately $5.")]), (F.col("part") % 3 + 1).cast("int"))
    rows = t.resolved.withColumn("excerpt", said)
    changed = F.when(kind == 0, None).when(kind == 1, value + 1).when(kind == 2, F.coalesce(value, F.lit(5.0))).otherwise(value)
    place = F.when(kind == 3, F.concat("accession", F.lit("x"))).otherwise(F.col("accession"))
    before = rows.where("supp % 31 <> 0").select("record_id", "company", F.col("reviewed").alias("approved"), value.alias("value"), "accession", "excerpt")
    after = rows.where("part % 29 <> 0").select("record_id", "company", F.col("reviewed").alias("approved"), changed.alias("value"), place.alias("accession"), "excerpt")
    found = rows.where("part % 4 <> 0").select("record_id", F.when(F.col("supp") % 5 == 0, F.coalesce(value + 1, F.lit(3.0))).otherwise(value).alias("value"), "accession")
    return audit.compare_outcomes(before, after, found)


_SUMMED = ["filings", "candidates", "new_row", "new_flag", "outcome_attached", "outcome_proposed", "ack_filled", "ack_proposed", "withdrawal_filled", "withdrawal_proposed", "proposal"]


@query(
    "a14_refresh_summary",
    f"""WITH {STATEMENTS}, m AS (SELECT *, part % 6 = 0 AS new, part % 6 IN (1, 4) AS change, part % 6 = 2 AND supp % 4 <> 0 AS ack FROM statements),
        d AS (SELECT cik, 1 AS filings, 0 AS candidates, 0 AS new_row, 0 AS new_flag, 0 AS outcome_attached, 0 AS outcome_proposed, 0 AS ack_filled, 0 AS ack_proposed, 0 AS withdrawal_filled, 0 AS withdrawal_proposed, 0 AS proposal FROM filings WHERE filed_at >= DATE '1998-01-01'
          UNION ALL SELECT cik, 0, (stated_at >= DATE '1998-01-01')::INT, (new AND supp % 5 <> 0)::INT, (new AND supp % 5 = 0)::INT, (NOT new AND supp % 2 = 0 AND reported_value IS NOT NULL)::INT, (change AND supp % 3 = 0)::INT, (NOT new AND acknowledged_at IS NOT NULL)::INT,
            ack::INT, (NOT new AND withdrawn_at IS NOT NULL AND supp % 4 <> 1)::INT, (change AND supp % 3 <> 0)::INT, (change OR ack)::INT FROM m)
        SELECT coalesce(cik, 'TOTAL') AS cik, {", ".join(f"sum({c})::BIGINT AS {c}" for c in _SUMMED)} FROM d GROUP BY ROLLUP (cik)""",
)
def refresh_summary(t: Tables) -> DataFrame:
    """A run by company: filings of its last years, candidates in them, and two states of the queue held against each other."""
    s, true, new = t.statements, F.lit("true"), F.col("part") % 6 == 0
    change, waits = (F.col("part") % 6).isin(1, 4), F.col("part") % 6 == 2
    proposed = F.when(F.col("supp") % 3 == 0, '{"outcome.reported_value": "1", "claim": "c"}').otherwise('{"aid_withdrawal_note": "x", "claim": "outcome.reported_value"}')
    cells = {
        "outcome.reported_value": F.when(F.col("supp") % 2 == 0, F.col("reported_value").cast("string")),
        "acknowledged_at": F.col("acknowledged_at").cast("string"),
        "aid_withdrawal_note": F.when(F.col("withdrawn_at").isNotNull(), "filed"),
        "change_pending_review": F.when(change, true).otherwise("false"),
        "ack_pending_review": F.when(waits, true).otherwise("false"),
    }
    after = s.select("record_id", "cik", F.when(F.col("supp") % 5 == 0, true).otherwise("false").alias("empty_block"), F.when(change, proposed).alias("aid_proposed_change"), *[v.alias(c) for c, v in cells.items()])
    old = {"aid_withdrawal_note": F.when((F.col("supp") % 4 == 1) & F.col("withdrawn_at").isNotNull(), "filed").otherwise(""), "ack_pending_review": F.when(waits & (F.col("supp") % 4 == 0), true).otherwise("")}
    before = s.where(~new).select("record_id", *[old.get(c, F.lit("")).alias(c) for c in cells])
    filings = t.filings.where("filed_at >= date'1998-01-01'")
    return audit.refresh_summary(filings, s.select("cik", "accession"), Q.queue_changes(before, after))


_LEDGER = "WITH l AS (SELECT event_id AS line, event_type AS stage, 1 + user_id % 3 AS requests, round(value * 100) / 100 AS usd FROM events)"


@query("a14_stage_spend", f"{_LEDGER} SELECT stage, sum(requests)::BIGINT AS requests, round(sum(usd), 6) AS usd FROM l WHERE line >= 100 GROUP BY stage")
def stage_spend(t: Tables) -> DataFrame:
    """Requests and dollars of each stage since a line of the ledger."""
    ledger = t.read("events").select(F.col("event_id").alias("line"), F.col("event_type").alias("stage"), (1 + F.col("user_id") % 3).alias("requests"), (F.round(F.col("value") * 100) / 100).alias("usd"))
    return audit.stage_spend(ledger, 100)


_STAGES = [("structure", 900), ("verify", 60), ("outcomes", 250)]


@query(
    "a16_stage_costs",
    f"""{_LEDGER}, r AS (SELECT ({[s for s, _ in _STAGES]!r})[1 + doc_id % 3] AS stage, ({[n for _, n in _STAGES]!r})[1 + doc_id % 3] AS n, coalesce(length(text), 0) AS chars, 1000 + doc_id % 7 * 100 AS most FROM documents),
        s AS (SELECT stage, n, count(*) AS requests, sum(ceil((40 * n + chars + 8) / 3))::BIGINT AS input_tokens, sum(most) AS max_output FROM r GROUP BY ALL), c AS (SELECT 'verify' AS stage, sum(usd) AS usd FROM l)
        SELECT stage, requests, input_tokens, round((input_tokens * 0.75 + n * requests * 4.5) / 1e6 * 0.5, 6) AS usd_expected, round((input_tokens * 0.75 + max_output * 4.5) / 1e6 * 0.5, 6) AS usd_worst,
          (input_tokens * 0.75 + max_output * 4.5) / 1e6 * 0.5 <= 1000 - coalesce(c.usd, 0) AS fits FROM s LEFT JOIN c USING (stage)""",
)
def stage_costs(t: Tables) -> DataFrame:
    """What asking about every document would cost by stage, expected and at worst, and whether that is left of the budget."""
    k = (F.col("doc_id") % 3 + 1).cast("int")
    size = F.element_at(F.array(*[F.lit(n) for _, n in _STAGES]), k)
    stage = F.element_at(F.array(*[F.lit(s) for s, _ in _STAGES]), k)
    requests = t.read("documents").select(stage.alias("stage"), F.repeat(F.lit("s"), 40 * size).alias("system"), F.col("text").alias("user"), F.lit('{"a": 1}').alias("schema"), (1000 + F.col("doc_id") % 7 * 100).alias("max_tokens"))
    answers = F.create_map(*[F.lit(x) for row in _STAGES for x in row])
    spent = t.read("events").select(F.lit("verify").alias("stage"), (F.round(F.col("value") * 100) / 100).alias("usd"))
    return audit.project_costs(requests, answers[F.col("stage")], spent, audit.Prices(0.75, 4.5, budget=1000.0))
