"""Wording of bounds, whole rows of the queue, checks of records, and audits of outcomes."""

import datetime
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pledgewise.functions import wording
from pledgewise.operators import audit, validate
from pledgewise.operators import queue as Q
from pledgewise.operators.chain import UNREAD
from pledgewise.sources import filings
from pledgewise.sources import records as R

DAY = datetime.date(2024, 2, 1)
STAMP = datetime.datetime(2026, 9, 20, 12)


def test_general_prints_as_a_short_float_format_does(spark):
    rng = random.Random(3)
    fixed = [0.0, 5.0, -5.5, 0.1, 1e5, 999999.0, 1e6, 1234567.0, 1e-4, 1.5e-5, 123.456789, -0.00012345678, 2.5e12, 100.0, 1e22]
    values = fixed + [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 9) for _ in range(300)]
    got = [r.g for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").orderBy("k").select(wording.general(F.col("v")).alias("g")).collect()]
    assert got == [f"{v:g}" for v in values]


def test_words_of_ranges(spark):
    rows = [(5.0, 6.0, "USD billions"), (5.5, 5.5, "percent"), (None, 1234.5, "USD"), (3.0, None, "USD per share"), (None, None, "percent"), (1e6, 2e6, "units"), (-2.0, 1.0, "USD thousands")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, low double, high double, unit string").orderBy("k")
    low, high, unit = F.col("low"), F.col("high"), F.col("unit")
    got = [tuple(r) for r in df.select(wording.range_words(low, high, unit), wording.invalidation(low, high)).collect()]
    assert got == [
        ("$5 billion to $6 billion", "reported value falls outside [5, 6]"), ("5.5%", "reported value differs from 5.5"), ("no more than $1,234.50", "reported value is above 1234.5"),
        ("at least $3 per share", "reported value is below 3"), (None, None), ("1e+06 units to 2e+06 units", "reported value falls outside [1e+06, 2e+06]"), ("$-2 thousand to $1 thousand", "reported value falls outside [-2, 1]"),
    ]


def evidence(**changed):
    return {"source_url": "https://www.sec.gov/a", "accession_number": "0000000123-24-000001", "filing_type": "8-K", "filed_at": DAY, "fetched_at": STAMP, "content_sha256": "a" * 64, "excerpt": "We said so."} | changed


def record(n=0, **changed):
    base = {
        "record_id": f"01HZY8Q9XMR3T7VBN2CDEFGH{n:02d}", "company": "Example", "ticker": "EXMP", "cik": "0000000123", "claim": "c",
        "assumption": {"text": "t", "metric": "revenue", "target_low": 5.0, "target_high": 6.0, "unit": "percent", "target_period": "FY2024", "stated_at": DAY, "evidence": evidence()},
        "outcome": {"reported_value": 4.8, "reported_at": DAY, "evidence": evidence()}, "invalidation_condition": "i", "status": "missed", "acknowledged_at": DAY, "acknowledgement_evidence": evidence(),
        "days_to_falsifiable": 0, "days_to_acknowledged": 0, "last_reviewed_at": DAY, "reviewer": "r",
    }
    for name, value in changed.items():
        at, parts = base, name.split("__")
        for p in parts[:-1]:
            at = at[p]
        at[parts[-1]] = value
    return base


def test_record_issues(spark):
    cases = [
        ({}, []),
        ({"outcome": None, "acknowledged_at": None, "acknowledgement_evidence": None}, []),
        ({"ticker": " brk.b "}, []),
        ({"ticker": "much too long"}, ["ticker"]),
        ({"cik": "123"}, ["cik"]),
        ({"company": ""}, ["company"]),
        ({"assumption__target_low": 7.0}, ["assumption"]),
        ({"assumption__target_low": float("nan")}, ["assumption.target_low"]),
        ({"outcome__reported_value": float("-inf"), "status": "lost"}, ["outcome.reported_value", "status"]),
        ({"outcome__reported_value": None, "outcome__reported_at": None}, ["outcome.reported_at"]),
        ({"acknowledged_at": None}, ["acknowledged_at"]),
        ({"acknowledgement_evidence": None}, ["acknowledged_at"]),
        ({"assumption__evidence__source_url": "https://sec.gov/a", "assumption__evidence__excerpt": "x" * 401}, ["assumption.evidence.excerpt", "assumption.evidence.source_url"]),
        ({"outcome__evidence__content_sha256": " " + "AB" * 32}, []),
        ({"outcome__evidence": None}, [f"outcome.evidence.{n}" for n in ("accession_number", "content_sha256", "excerpt", "fetched_at", "filed_at", "filing_type", "source_url")]),
        ({"acknowledgement_evidence__accession_number": "1-2-3", "acknowledgement_evidence__filing_type": " "}, ["acknowledgement_evidence.accession_number", "acknowledgement_evidence.filing_type"]),
    ]
    rows = spark.createDataFrame([record(n, **c) for n, (c, _) in enumerate(cases)], R.RECORD)
    got = {}
    for r in validate.record_issues(rows).collect():
        got.setdefault(r.record_id[-2:], []).append(r.check)
    assert {k: sorted(v) for k, v in got.items()} == {f"{n:02d}": want for n, (_, want) in enumerate(cases) if want}
    assert validate.record_issues(rows.where("1 = 0")).count() == 0


def test_evidence_issues(spark):
    import hashlib

    text = "He said: We said so. And left."
    sha = hashlib.sha256(text.encode()).hexdigest()
    good = {f"{p}__content_sha256": sha for p in ("assumption__evidence", "outcome__evidence", "acknowledgement_evidence")}
    rows = [record(0, **good), record(1, **good, outcome__evidence__excerpt="we said so."), record(2, **good, acknowledgement_evidence__accession_number="x"), record(3, **good, cik="0000000124"), record(4, outcome=None, acknowledgement_evidence=None)]
    documents = spark.createDataFrame([("0000000123", "0000000123-24-000001", text), ("0000000123", "y", None)], "cik string, accession string, text string")
    got = sorted((r.record_id[-1], r.check) for r in validate.evidence_issues(spark.createDataFrame(rows, R.RECORD), documents).collect())
    missing = [("3", f"{p}.cached_document") for p in sorted(("assumption.evidence", "outcome.evidence", "acknowledgement_evidence"))]
    assert got == [("1", "outcome.evidence.excerpt"), ("2", "acknowledgement_evidence.cached_document"), *missing, ("4", "assumption.evidence.content_sha256")]


def doubts(value: str, excerpt: str) -> list[str]:
    """The reasons worked out by searching for each form at each place of the text."""
    words = [k for k in audit.KEYWORDS if k in excerpt.lower()]
    size = abs(Decimal(value))
    forms = {f"{size * s:{c}.{p}f}" for s in audit.SCALES for p in audit.PLACES for c in ("", ",")}

    def alone(form: str) -> bool:
        for k in range(len(excerpt)):
            if excerpt.startswith(form, k):
                before, rest = excerpt[k - 1 : k], excerpt[k + len(form) :]
                if not (before and before in "0123456789.,") and not rest[:1].isdigit() and not (rest[:1] in (".", ",") and rest[1:2].isdigit()):
                    return True
        return False

    loose = [x for x in re.findall(audit.NUMBER, excerpt) if len(x) > 1 and x[-1].isdigit() and x[:-1] in forms]
    ends = {re.sub(r"[$\s]", "", e) for pair in re.findall(audit.RANGE, excerpt) for e in pair}
    return (["keyword:" + ",".join(words)] if words else []) + (["range"] if ends & forms else []) + ([] if loose or any(alone(f) for f in forms) else ["value-missing"])


def test_doubts_about_outcomes(spark):
    rng = random.Random(9)
    parts = ["5", "5.0", "5.00", "1,250", "1250", "-", "–", " to ", " ", "$", "%", ",", ".", "expects ", "TARGET", "12.5", "0.05", "5,000", "5000000", "1", " percent through "]
    cases = [(rng.choice(["5", "-5", "1250", "12.5", "0.05", "1.33"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))) for _ in range(600)]
    cases += [("1.33", "It was $1.331 a share."), ("1.8", "decreased 1.8%"), ("2.5", "revenue of $2,500 million"), ("5", "It was 5, then 6.")]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, value string, excerpt string").orderBy("k")
    got = [r.why for r in df.select(audit.outcome_doubts(F.col("value"), F.col("excerpt")).alias("why")).collect()]
    assert got == [doubts(*c) for c in cases]
    odd = spark.createDataFrame([("much", "much"), (None, "5"), ("$1,250.5", "It was 1,250.50."), ("5", None)], "value string, excerpt string")
    assert [r[0] for r in odd.select(audit.outcome_doubts(F.col("value"), F.col("excerpt"))).collect()] == [["value-missing"], ["value-missing"], [], ["value-missing"]]


def test_rows_of_drafts_at_full_width(spark, tmp_path):
    said = record()["assumption"]
    drafts = [("a", "sentence", None, said), ("b", "sentence", ["In  Q2\n", "it rose."], said), ("c", "section", ["x"], said), ("d", None, None, {k: None for k in said} | {"evidence": evidence(excerpt='A "b",\nin FY2025')})]
    d = spark.createDataFrame([(i, "Example", "EXMP", "0000000123", None, m, None, None, None, None, None, c, a) for i, m, c, a in drafts], Q.DRAFT)
    gone = {"withdrawn_at": DAY, "period_close": DAY, "evidence": evidence()}
    late = gone | {"withdrawn_at": DAY + datetime.timedelta(1)}
    found = [("a", "1", record()["outcome"], None, {"acknowledged_at": DAY, "evidence": evidence()}, None), ("b", "1", None, "no line", None, gone), ("c", "1", None, "", None, late)]
    rows = Q.build_rows(d, spark.createDataFrame(found, Q.OUTCOME), F.lit(DAY), "r")
    assert rows.columns == Q.columns() and len(rows.columns) == 69 and len(set(rows.columns)) == 69
    got = {r.record_id: r.asDict() for r in rows.collect()}
    assert got["a"]["claim"] == "Example expects revenue of 5% to 6% for FY2024." and got["a"]["aid_proposed_status"] == "missed" and got["a"]["aid_outcome_note"] is None and got["a"]["aid_context"] is None
    assert got["b"]["aid_context"] == "In Q2 it rose." and got["b"]["aid_outcome_note"] == "no line" and got["b"]["aid_proposed_status"] == "withdrawn" and got["b"]["aid_withdrawal_note"].startswith("filed 2024-02-01, before")
    assert got["c"]["aid_outcome_note"] == got["d"]["aid_outcome_note"] == "outcome search not run" and got["c"]["aid_proposed_status"] == "unresolved" and got["c"]["aid_withdrawal_note"] is None and got["c"]["aid_context"] is None
    assert got["d"]["claim"] is None and got["d"]["invalidation_condition"] is None and got["d"]["conflict"] == "false"
    R.write_queue(rows, str(tmp_path / "q"))
    back = R.unflatten(R.read_queue(spark, str(tmp_path / "q")))
    assert {r.record_id: r.assumption.evidence.excerpt for r in back.collect()} == {"a": "We said so.", "b": "We said so.", "c": "We said so.", "d": 'A "b",\nin FY2025'}
    assert Q.build_rows(d.where("1 = 0"), spark.createDataFrame(found, Q.OUTCOME), F.lit(DAY), "r").count() == 0
    after = rows.withColumn("change_pending_review", F.when(F.col("record_id") == "b", "true").otherwise("false")).withColumn("aid_proposed_change", F.when(F.col("record_id") == "b", '{"outcome.reported_value": "1"}'))
    before = rows.where("record_id <> 'c'").withColumn("acknowledged_at", F.lit(None).cast("string"))
    changed = {r.record_id: {c for c, v in r.asDict().items() if v is True} for r in Q.queue_changes(before, after).collect()}
    assert changed == {"a": {"ack_filled"}, "b": {"outcome_proposed", "proposal"}, "c": {"new_row"}, "d": set()}


def test_summary_counts_candidates_of_new_filings_alone(spark):
    filings = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "cik string, accession string")
    candidates = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", "old"), ("3", "z")], "cik string, accession string")
    changes = spark.createDataFrame([("r", "2", True), ("s", "4", False)], "record_id string, cik string, new_row boolean")
    got = {r.cik: (r.filings, r.candidates, r.new_row) for r in audit.refresh_summary(filings, candidates, changes).collect()}
    assert got == {"1": (2, 2, 0), "2": (1, 0, 1), "4": (0, 0, 0), "TOTAL": (3, 2, 1)}


def test_sectors_of_published_companies(spark):
    rows = [("1", "A", True, "tech"), ("2", "B", True, "tech"), ("3", "C", True, "care"), ("4", "D", False, None)]
    companies = spark.createDataFrame(rows, "cik string, company string, publish boolean, sector string")
    assert [tuple(r) for r in audit.sector_coverage(companies).orderBy("place").collect()] == [("tech", 2, 1), ("care", 1, 2)]
    for nothing in (None, ""):
        worse = companies.union(spark.createDataFrame([("5", "E", True, nothing)], companies.schema))
        with pytest.raises(Exception, match="a published company has no sector: E"):
            audit.sector_coverage(worse).collect()


def test_paths_into_the_archive(spark):
    place = "/Archives/edgar/data/1/000000000124000001/a.htm"
    cases = [
        (place, place), (f"https://www.sec.gov{place}?x#y", place), (f"//efts.sec.gov:443{place}", place), (f"/ix?doc={place}&xbrl=true", place), (f"https://www.sec.gov/ix?doc={place}", place), (f"https://www.sec.gov.evil.com{place}", None),
        (f"https://example.com{place}", None), ("/Archives/edgar/data/1/1/a.htm", None), (f"{place}/b", None), ("", None), (None, None), (f"/ix?doc=https://example.com{place}", None),
    ]
    got = [r[0] for r in spark.createDataFrame([(k, h) for k, (h, _) in enumerate(cases)], "k int, h string").orderBy("k").select(filings.archive_path(F.col("h"))).collect()]
    assert got == [want for _, want in cases]


def test_the_funnel_counts_every_item_once(spark):
    candidates = spark.createDataFrame([(k,) for k in range(5)], "custom_id int")
    derived = spark.createDataFrame([(0, None), (0, "bad"), (0, UNREAD), (0, None), (0, None)], "item_index int, reason string")
    judged = spark.createDataFrame([("a", "kept", True), ("b", "kept", True), ("c", "duplicate", False)], "draft_id string, outcome string, conflict boolean")
    said = spark.createDataFrame([("a", True, True), ("c", True, True)], "draft_id string, approved boolean, published boolean")
    got = {(r.stage, r.reason): r.n for r in audit.guard_funnel(candidates, derived, judged, said).collect()}
    assert got == {("sent", None): 5, ("returned", None): 4, ("rejected", "bad"): 1, ("rejected", UNREAD): 1, ("dropped", "duplicate"): 1, ("conflicts", None): 2, ("review", None): 2, ("undecided", None): 1, ("published", None): 1}
