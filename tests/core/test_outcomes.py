"""Drafts to reported values: releases of one company, and the guards on what an answer chose."""

import datetime
import json

from pyspark.sql import functions as F

from pledgewise import dims
from pledgewise.functions import periods, rubric, titles
from pledgewise.functions import text as T
from pledgewise.operators import outcomes

CONFIG = dims.Config()
METRICS = [m for m, _, _ in dims.METRICS]

RELEASES = [
    ("2024-02-01", "Example Reports Third Quarter Fiscal 2024 Results", ["Outlook", "Fourth quarter revenue is expected to be $5.0 billion to $6.0 billion."]),
    ("2024-04-15", "Example to Host Conference Call on Fourth Quarter Fiscal 2024 Results", ["Fourth quarter revenue was $9.9 billion."]),
    (
        "2024-05-01",
        "Example Reports Fourth Quarter and Fiscal 2024 Results",
        ["Fourth quarter revenue was $4.8 billion.", "Fiscal 2024 revenue was $19.5 billion.", "Revenue $4,800 $4,700 $4,600", "Outlook", "First quarter fiscal 2025 revenue is expected to be $5.5 billion."],
    ),
    ("2024-08-01", "Example Reports First Quarter Fiscal 2025 Results", ["Fourth quarter revenue of $4.8 billion was below our guidance."]),
]


def day(text):
    return datetime.date.fromisoformat(text)


DRAFT = {"metric": "revenue", "unit": "USD billions", "target_period": "Q4 FY2024", "target_low": 5.0, "target_high": 6.0, "stated_at": "2024-02-01"}


def derive(spark, *cases):
    """Cases of (answer, releases, what the draft has otherwise), each a company of its own: the lines offered and the result of each."""
    filings, drafts, answers = [], [], []
    for k, (answer, releases, changed) in enumerate(cases):
        d, key = DRAFT | changed, f"{k:02d}"
        filings += [(key, f"{key}a{i}", day(filed), "\n".join([title, *lines])) for i, (filed, title, lines) in enumerate(releases)]
        drafts.append((key, key, d["metric"], d["unit"], d["target_period"], d["target_low"], d["target_high"], day(d["stated_at"])))
        if answer is not None:
            answers.append((key, "ok", answer if isinstance(answer, str) else json.dumps(answer)))
    filings = spark.createDataFrame(filings, "cik string, accession string, filed_at date, text string")
    companies = spark.createDataFrame([(d[0], "Example Corporation", 2, True) for d in drafts], "cik string, company string, fiscal_month int, named_for_end boolean")
    known = filings.join(companies, "cik")
    derived = {q: periods.fiscal_year_reported(F.col("fiscal_month"), F.col("named_for_end"), F.lit(q), F.col("filed_at")) for q in (1, 2, 3, 4)}
    reported = titles.reported_periods(known, derived, ["accession", "cik", "filed_at"])
    found = filings.select("accession", F.col("text").alias("raw"), "text")
    sentences = outcomes.sentence_metrics(outcomes.release_sentences(found, CONFIG), CONFIG, METRICS)
    drafts = spark.createDataFrame(drafts, "draft_id string, cik string, metric string, unit string, target_period string, target_low double, target_high double, stated_at date")
    named = outcomes.named_releases(drafts, reported, CONFIG, F.lit("2026-01-01").cast("date"))
    lines = outcomes.candidate_lines(drafts, named, sentences, companies, CONFIG).persist()
    answers = spark.createDataFrame(answers, "draft_id string, status string, text string")
    out = outcomes.chosen(drafts, named, lines, answers, companies, CONFIG, F.lit("2024-09-01").cast("date"))
    offered = [[] for _ in cases]
    for r in lines.orderBy("draft_id", "index").collect():
        offered[int(r.draft_id)].append(r.sentence)
    return list(zip(offered, out.orderBy("draft_id").collect(), strict=True))


def answer(index=1, value=4.8, unit="USD billions"):
    return {"index": index, "value": value, "unit": unit}


def one(*lines, filed="2024-05-01", title="Example Reports Fourth Quarter Fiscal 2024 Results"):
    return [(filed, title, lines)]


def test_four_releases(spark):
    [(lines, got)] = derive(spark, (answer(), RELEASES, {}))
    # the forecast, the call's notice and the row without a header are not offered
    assert lines == ["Fourth quarter revenue was $4.8 billion.", "Fiscal 2024 revenue was $19.5 billion."]
    assert (got.reported_value, got.reported_at, got.accession, got.reason) == (4.8, day("2024-05-01"), "00a2", None)
    low, high, value = F.lit(5.0), F.lit(6.0), F.lit(got.reported_value)
    status = spark.range(1).select(rubric.resolve(low, high, value, F.lit(True), F.lit(True), F.lit(False)).alias("s"), rubric.direction(low, high, value, F.lit(True)).alias("d"))
    assert tuple(status.first()) == ("missed", "worse")


def test_reasons(spark):
    cases = [
        (None, {}, "search not completed"), ("{}", {}, "answer did not parse"), ("no", {}, "answer did not parse"), (answer(None), {}, "no line was chosen"), (answer(3), {}, "index or value is not usable"),
        (answer(value=None), {}, "index or value is not usable"), (answer(unit="percent"), {}, "a unit of another family"), (answer(value=4.9), {}, "the value is not printed"), (answer(value=4800.0, unit="USD millions"), {}, None),
        (answer(), {"target_period": "soon"}, "period not understood"), (answer(), {"target_period": "Q2 FY2026"}, "period not closed"), (answer(), {"target_period": "Q2 FY2024"}, "no release reports the period"),
        (answer(), {"metric": "free cash flow"}, "no line gives the value"), (answer(), {"target_low": 0.5, "target_high": 0.6}, "the value is implausible"),
    ]
    got = derive(spark, *[(given, RELEASES, changed) for given, changed, _ in cases])
    assert [r.reason for _, r in got] == [reason for _, _, reason in cases]
    assert all((r.reported_value == 4.8) == (r.reason is None) for _, r in got)


def test_lines_that_are_offered(spark):
    margin = {"metric": "gross margin non-GAAP", "unit": "percent", "target_low": 40.0, "target_high": 45.0}
    eps = {"metric": "EPS GAAP", "unit": "USD per share", "target_low": 3.0, "target_high": 4.0}
    sales = {"metric": "comparable sales", "unit": "percent", "target_low": -1.0, "target_high": 1.0}
    year = {"target_period": "FY2024", "target_low": 19.0, "target_high": 20.0}
    table = ("Q4 FY24 Q3 FY24 Q4 FY23", "Revenue $4.8 $5.1 $5.0")
    annual = one("Revenue", "For fiscal 2024: $19.5 billion", title="Example Reports Fourth Quarter and Fiscal 2024 Results")
    long = "Adjusted gross margin " + "and so on " * 60 + "was better."
    unconfirmed = "multi-column, unconfirmed"
    cases = [  # answer, releases, draft, lines, value or reason
        (answer(1, 44.0, "percent"), one("Gross margin was 44.0%."), margin, 1, 44.0),
        (answer(1, 44.0, "percent"), one("Gross margin was 44.0%.", "Non-GAAP gross margin was 45.5%."), margin, 1, "the value is not printed"),
        (answer(1, 44.0, "percent"), one("Gross margin was 44.0%.", long), margin, 0, "no line gives the value"),  # too long to be chosen, it still shows that both are printed
        (answer(), one(*table), {}, 1, 4.8), (answer(), one(table[1]), {}, 1, unconfirmed), (answer(), one("Q3 FY24 Q2 FY24", table[1]), {}, 1, unconfirmed),
        (answer(), one(table[0], *["A line."] * 25, table[1]), {}, 1, unconfirmed),  # the header is too far up
        (answer(), one(table[1], "Revenue was $4.8 billion."), {}, 1, 4.8), (answer(), one(*table, "Revenue was $4.8 billion."), {}, 2, 4.8),
        (answer(1, 19.5), annual, year, 1, 19.5), (answer(1, 19.5), annual, {"target_low": 19.0}, 0, "no line gives the value"),  # a label's line is for years alone
        (answer(1, 12.19, "USD per share"), one("Full Year and Fourth Quarter Net Earnings were $12.19 Per Share and $3.10 Per Share"), eps, 1, 3.1),  # by its place, whatever was answered
        (answer(1, 0.7, "percent"), one("Comparable sales decreased 0.7 percent."), sales, 1, -0.7), (answer(1, -0.7, "percent"), one("Comparable sales increased 0.7 percent, up in all regions."), sales, 1, 0.7),
        (answer(), one("Revenue was $4.8 billion.", filed="2024-02-20"), {}, 0, "no line gives the value"),
    ]
    got = derive(spark, *[c[:3] for c in cases])
    assert [(len(lines), r.reported_value if r.reason is None else r.reason) for lines, r in got] == [c[3:] for c in cases]
    assert got[1][0] == ["Non-GAAP gross margin was 45.5%."]


def test_every_metric_has_words(spark):
    assert all(T.metric_pattern(m, CONFIG) for m in METRICS)
    assert T.metric_pattern("store openings", CONFIG) == "(?:store)|(?:openings)" and T.metric_pattern("full year", CONFIG) is None
    got = spark.range(1).select(T.metrics_in(F.lit("Capital expenditures and free cash flow; new store openings"), CONFIG, [*METRICS, "store openings", "full year"]).alias("m")).first().m
    assert got == ["free cash flow", "capital expenditures", "store openings"]
