"""The guards in their order: what one step changes is what the next one sees, and the first refusal counts."""

import datetime
import json

from pyspark.sql import functions as F

from pledgewise.functions import guards as G
from pledgewise.operators import chain

DAY = datetime.date(2024, 2, 1)
COLUMNS = "custom_id string, cik string, accession string, filed_at date, capture_method string, char_start int, sentence string, heading string, lead_in string, table_header string, context_before array<string>"


def item(**given):
    return {"metric": "revenue", "unit": "USD billions", "target_period": "Q4 FY2024", "value_low": 5.0, "value_high": 6.0, "plus_minus": None, "plus_minus_kind": "none", "line_first": 1, "line_last": 1} | given


def derived(spark, *cases):
    """Cases: (items or raw answer, candidate columns)."""
    candidates, answers = [], []
    for k, (answer, given) in enumerate(cases):
        row = {"capture_method": "sentence", "sentence": "", "heading": None, "lead_in": None, "table_header": None, "context_before": []} | given
        candidates.append((f"c{k:03d}", "01", "0000000123-24-000001", DAY, row["capture_method"], 0, row["sentence"], row["heading"], row["lead_in"], row["table_header"], row["context_before"]))
        answers.append((f"c{k:03d}", "ok", answer if isinstance(answer, str) else json.dumps({"items": answer})))
    candidates, answers = spark.createDataFrame(candidates, COLUMNS), spark.createDataFrame(answers, "custom_id string, status string, text string")
    companies = spark.createDataFrame([("01", 1, True, False)], "cik string, fiscal_month int, named_for_end boolean, tax_rate_parens_negative boolean")
    return candidates, answers, chain.derive(chain.answered_items(candidates, answers), companies)


def rows(spark, *cases):
    return [(r.metric, r.target_period, r.target_low, r.target_high, r.reason) for r in derived(spark, *cases)[2].orderBy("custom_id", "item_index").collect()]


TEXT = "We expect fourth quarter revenue of $5.0 billion to $6.0 billion."


def test_drafts_and_rejects(spark):
    got = rows(
        spark,
        ([item()], {"sentence": TEXT}),
        ("I cannot say.", {"sentence": TEXT}),
        ("```json\n" + json.dumps({"items": [item(metric="dividends"), item()]}) + "\n```", {"sentence": TEXT}),
        ([item(unit="percent")], {"sentence": TEXT}),
        ([item(value_low=5.5)], {"sentence": TEXT}),
        ([item(target_period="second half 2024")], {"sentence": TEXT}),
        ([item(value_low=6.0, value_high=5.0)], {"sentence": TEXT}),
        ([item(value_low=None, value_high=None)], {"sentence": TEXT}),
        ([item()], {"sentence": "Revenue was $5.0 billion to $6.0 billion."}),
        ([item()], {"sentence": "We expect revenue of $5.0 billion and, later, of $6.0 billion."}),
    )
    draft = ("revenue", "Q4 FY2024", 5.0, 6.0, None)
    assert got[0] == draft and got[3] == draft
    assert [r[4] for r in got] == [
        None, "output did not parse as a list of items", "metric is not in the list", None, "unit kind percent for a metric in dollars", "a stated number is not in the evidence",
        "half-year period", "reversed range", "no number", "past tense without a forward verb", "a range without words of a range",
    ]


def test_the_first_refusal_counts(spark):
    text = {"sentence": "Second half revenue was 5.5 percent."}
    wrong = {"unit": "percent", "value_low": 9.0, "value_high": 8.0}
    cases = [{"metric": "profit", "target_period": "H2"}, {"target_period": "H2"}, {}, {"metric": "gross margin GAAP"}]
    got = rows(spark, *[([item(**wrong, **c)], text) for c in cases])
    assert [r[4] for r in got] == ["metric is not in the list", "half-year period", "unit kind percent for a metric in dollars", "reversed range"]


def test_steps_see_what_earlier_ones_changed(spark):
    spread = "We expect revenue of $1.52 billion, plus or minus $50 million, with growth in all regions."
    floor = "We expect GAAP EPS of $1.30 or better."
    got = rows(
        spark,
        # endpoints that are nowhere in the text become the printed centre and spread, which also makes words of growth harmless
        ([item(value_low=1.47, value_high=1.57)], {"sentence": spread}),
        # the same figure without the spread is a change
        ([item(value_low=1.52, value_high=1.52)], {"sentence": "We expect revenue growth of $1.52 billion."}),
        # the sign is settled after the spread is worked out: a range below zero stays there, a point would read positive
        ([item(metric="gross margin GAAP", unit="percent", value_low=-3.0, value_high=-3.0, plus_minus=1.0, plus_minus_kind="percent")], {"sentence": "We expect GAAP gross margin of (3.0%), plus or minus 1%."}),
        # a floor has no upper bound, so its number need not be there twice
        ([item(metric="EPS GAAP", unit="USD per share", value_low=1.3, value_high=1.3)], {"sentence": floor}),
        # a spread in money is absolute, whatever the answer says
        ([item(metric="EPS GAAP", unit="USD per share", value_low=0.42, value_high=0.42, plus_minus=7.0, plus_minus_kind="percent")], {"sentence": "We expect GAAP EPS of $0.42 ± $0.07."}),
        ([item(value_low=5.0, value_high=5.0, plus_minus=0.2, plus_minus_kind="absolute")], {"sentence": "We expect revenue of $5.0 billion."}),
        ([item(value_low=5.0, value_high=6.0, plus_minus=0.2, plus_minus_kind="absolute")], {"sentence": TEXT}),
    )
    assert [r[2:] for r in got] == [
        (1.47, 1.57, None), (1.52, 1.52, "a change, not a level"), (-4.0, -2.0, None), (1.3, None, None), (0.35, 0.49, None),
        (5.0, 5.0, "a spread without plus or minus in the evidence"), (5.0, 6.0, "a spread without one centre"),
    ]


BLOCK = {"capture_method": "section", "sentence": "Gross margin 44.0% ± 1% 0.5% 44.5% ± 1%\nOperating expenses $891 million $66 million $825 million\nRevenue N/A $5.0 billion to $6.0 billion", "heading": "GAAP Outlook Adjustments Non-GAAP Outlook"}


def test_columns_decide_basis_and_period(spark):
    opex = {"metric": "operating expenses GAAP", "unit": "USD millions", "line_first": 2, "line_last": 2}
    got = rows(
        spark,
        ([item(**opex, value_low=825.0, value_high=825.0), item(**opex, value_low=66.0, value_high=66.0), item(**opex, value_low=891.0, value_high=891.0)], BLOCK),
        # the column makes it a metric in percent on the other basis, which then meets its own spread
        ([item(metric="gross margin GAAP", unit="percent", value_low=44.5, value_high=44.5)], BLOCK),
        # an empty column moves the period, whose shape is judged afterwards
        ([item(target_period="Q1 FY2024", line_first=3, line_last=3)], BLOCK | {"table_header": "Q1 FY2024 Q2 FY2024", "heading": "Outlook"}),
        ([item(line_first=3, line_last=9)], BLOCK),
        ([item(metric="EPS GAAP", unit="USD per share", value_low=1.2, value_high=1.2)], {"capture_method": "section", "sentence": "EPS of $1.20", "heading": "Adjusted Outlook"}),
        ([item(value_low=1.2, value_high=1.2)], {"capture_method": "section", "sentence": "$1.20 billion", "heading": "Full-Year 2024 Guidance"}),
    )
    assert [(r[0], r[4]) for r in got] == [
        ("operating expenses non-GAAP", None), ("operating expenses GAAP", "the figure is in the Adjustments column"), ("operating expenses GAAP", None),
        ("gross margin non-GAAP", None), ("revenue", None), ("revenue", "lines outside the section"), ("EPS non-GAAP", None), ("revenue", "a bare value without a label"),
    ]
    assert got[3][2:4] == (43.5, 45.5) and got[4][1] == "Q2 FY2024"


def test_one_pass_writes_both_and_empty_blocks_have_reasons(spark, tmp_path):
    cases = [([item()], {"sentence": TEXT}), ([item(metric="x"), item(metric="y"), item(value_low=7.0)], BLOCK), ([], BLOCK), ("no", BLOCK), ([item(line_first=3, line_last=3)], BLOCK), ("no", {"sentence": TEXT})]
    candidates, answers, out = derived(spark, *cases)
    drafts, rejects = chain.write(out, f"{tmp_path}/derived")
    assert drafts.count() + rejects.count() == out.count() == 7
    assert "reason" not in drafts.columns and drafts.where(F.length("draft_id") == 26).count() == 2 == drafts.select("draft_id").distinct().count()
    got = {r.custom_id: r.reason for r in chain.empty_blocks(candidates, answers, drafts, rejects).collect()}
    assert set(got) == {"c001", "c002", "c003"}
    assert got["c001"].startswith("3 item(s), all rejected: ") and "metric is not in the list" in got["c001"]
    assert got["c002"] == "no items were returned" and got["c003"] == "the output did not parse"


def test_answers_that_failed_or_have_no_candidate_give_nothing(spark):
    candidates, answers, _ = derived(spark, ([item()], {"sentence": TEXT}))
    assert chain.answered_items(candidates, answers.withColumn("status", F.lit("errored"))).count() == 0
    assert chain.answered_items(candidates.where("false"), answers).count() == 0


def test_missing_fields_are_reasons_or_defaults(spark):
    names = ["metric", "unit", "target_period", "value_low", "plus_minus_kind", "line_first"]
    got = rows(spark, *[([{k: v for k, v in item().items() if k != name}], {"sentence": TEXT}) for name in names])
    assert [r[4] is None for r in got] == [False, False, False, True, True, True]


def test_texts_are_read_once_and_only_where_a_mark_allows(spark):
    """What spares reading a text never changes a reason: odd spaces, capitals, marks of spread and ends of periods."""
    rows = [
        ("Revenue\u0001of $5.0 million ± $1 million.", 5.0, 5.0, "dollars"), ("GUIDANCE for revenue of $5 million is\u0001based on FY 24. It was flat.", 5.0, 5.0, "dollars"),
        ("Revenue GROWTH of $5 million.", 5.0, 5.0, "dollars"), ("Margin of 5 points, compared\u0001to 6 points.", 5.0, 5.0, "percent"), ("Revenue for the year\nended\tMarch 31, 2030 is $5 million.", 5.0, 5.0, "dollars"),
        ("It rained.", 5.0, 5.0, "dollars"), (None, 5.0, 5.0, "dollars"),
    ]
    t, low, high, kind = (F.col(c) for c in ("t", "low", "high", "kind"))
    march = [F.lit(3), F.lit(True), F.lit("2029-01-01").cast("date")]
    found = {
        "spread": G.printed_spread(t, low, high, kind, F.lit(1e6)).isNotNull(), "base": G.restated_base(t, low, high), "change": G.is_change(t, kind, low, high), "prior": G.relative_to_prior(t, kind, low, high),
        "period": G.period_by_end_date(t, *march), "missing": G.missing_numbers(t, [low, high]),
    }
    got = spark.createDataFrame(rows, "t string, low double, high double, kind string").coalesce(1).select(*[c.alias(n) for n, c in found.items()]).collect()
    assert [r["spread"] for r in got] == [True, False, False, False, False, False, False]
    assert [n for r in got for n in ("base", "change", "prior") if r[n]] == ["base", "change", "prior"] and got[1]["base"] and got[2]["change"] and got[3]["prior"]
    assert [r["period"] for r in got] == [None] * 4 + ["FY2030", None, None]
    assert [r["missing"] is not None for r in got] == [False] * 5 + [True, True]
    assert str(found["missing"]).count("regexp_extract_all") == 1 and str(found["base"]).count("split") == 1
