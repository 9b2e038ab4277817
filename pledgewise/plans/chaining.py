"""Answers about derived candidates, run through all guards in their order.

A candidate's text has one of ten shapes, by its part, with the statement's own numbers and period; the answer about it has one of seven
faults or none, by its supplier.  Both vary by themselves, so most items meet several guards at once and the order decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import audit, chain
from ..operators.dedupe import dedupe
from .corpus import scratch
from .registry import query
from .substrate import STATEMENTS, Tables

N_SHAPES, N_FAULTS = 10, 7
BLOCKS = (4, 5)
_SHAPED = (
    "concat('We expect revenue of $', a, ' million to $', b, ' million.')",
    "concat('We expect revenue of $', a, ' million, plus or minus $', p, ' million.')",
    "concat('Revenue was $', a, ' million to $', b, ' million.')",
    "concat('We expect revenue of $', a, ' million and costs of $', b, ' million.')",
    "concat('Revenue comes first\\nOperating expenses $', a, ' million $7 million $', b, ' million')",
    "concat('$', a, ' million - $', b, ' million\\nin all')",
    "concat('We expect GAAP gross margin of ', a, '% to ', b, '%.')",
    "concat('We expect revenue growth of $', a, ' million to $', b, ' million.')",
    "concat('We expect GAAP EPS of at least $', a, '.50.')",
    "concat('For the second half we expect revenue of $', a, ' million to $', b, ' million.')",
)
_METRIC, _UNIT = {4: "operating expenses non-GAAP", 6: "gross margin GAAP", 8: "EPS GAAP"}, {6: "percent", 8: "USD per share"}


def _by_shape(values: dict[int, str], other: str) -> str:
    return "CASE s " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + f" ELSE {other} END"


_LOW, _HIGH = _by_shape({1: "a - p", 4: "a", 8: "a + 0.5D"}, "a"), _by_shape({1: "a + p", 4: "a", 8: "a + 0.5D"}, "b")
_STATED = {
    "metric": f"CASE WHEN f = 2 THEN 'dividends' ELSE {_by_shape({k: repr(v) for k, v in _METRIC.items()}, repr('revenue'))} END",
    "unit": f"CASE WHEN f = 1 THEN CASE s WHEN 6 THEN 'USD millions' ELSE 'percent' END ELSE {_by_shape({k: repr(v) for k, v in _UNIT.items()}, repr('USD millions'))} END",
    "target_period": "CASE WHEN f = 4 THEN 'second half' ELSE target_period END",
    "value_low": f"CASE WHEN f = 3 AND s = 4 THEN b WHEN f = 3 THEN {_HIGH} ELSE {_LOW} END",
    "value_high": f"CASE WHEN f = 3 AND s = 4 THEN a WHEN f = 3 THEN {_LOW} WHEN f = 5 THEN {_HIGH} + 0.25D ELSE {_HIGH} END",
}


def _candidates(t: Tables) -> DataFrame:
    rows = t.statements.selectExpr("*", "100 + supp % 400 AS a", "101 + supp % 400 + part % 50 AS b", "1 + part % 9 AS p", f"part % {N_SHAPES} AS s", f"supp % {N_FAULTS} AS f")
    text: Column = F.coalesce(*[F.when(F.col("s") == k, F.expr(x)) for k, x in enumerate(_SHAPED)])
    heading = F.when(F.col("s") == 4, "GAAP Outlook Adjustments Non-GAAP Outlook").when(F.col("s") == 5, "Full-Year 2024 Guidance")
    return rows.select(
        F.col("record_id").alias("custom_id"), "cik", "accession", F.col("stated_at").alias("filed_at"), F.when(F.col("s").isin(*BLOCKS), "section").otherwise("sentence").alias("capture_method"), F.col("line").cast("int").alias("char_start"),
        text.alias("sentence"), heading.alias("heading"), F.lit(None).cast("string").alias("lead_in"), F.lit(None).cast("string").alias("table_header"), F.array().cast("array<string>").alias("context_before"), "a", "b", "p", "s", "f", "target_period",
    )


def _answers(candidates: DataFrame) -> DataFrame:
    line = F.when(F.col("s") == 4, 2).otherwise(1)
    item = F.struct(*[F.expr(x).cast("double" if name.startswith("value") else "string").alias(name) for name, x in _STATED.items()], F.lit("none").alias("plus_minus_kind"), line.alias("line_first"), line.alias("line_last"))
    return candidates.select("custom_id", F.lit("ok").alias("status"), F.when(F.col("f") == 6, "I cannot say.").otherwise(F.to_json(F.struct(F.array(item).alias("items")))).alias("text"))


def _derived(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = _candidates(t)
    candidates, answers = rows.drop("a", "b", "p", "s", "f", "target_period"), _answers(rows)
    return candidates, answers, chain.derive(chain.answered_items(candidates, answers), t.companies.withColumn("tax_rate_parens_negative", F.lit(False)))


def _duck(x: str) -> str:
    return x.replace("0.5D", "0.5").replace("0.25D", "0.25")


#: The reason by shape and fault, written from the rules' order.
_WANTED = f"""{STATEMENTS},
x AS (SELECT *, 100 + supp % 400 AS a, 101 + supp % 400 + part % 50 AS b, 1 + part % 9 AS p, part % {N_SHAPES} AS s, supp % {N_FAULTS} AS f FROM statements),
y AS (SELECT *, CASE
    WHEN f = 6 THEN 'output did not parse as a list of items'
    WHEN f = 2 THEN 'metric is not in the list'
    WHEN s = 5 THEN 'a bare value without a label'
    WHEN f = 4 OR (s = 9 AND quarter IS NULL) THEN 'half-year period'
    WHEN f = 1 AND s = 6 THEN 'unit kind dollars for a metric in percent'
    WHEN f = 1 AND s = 8 THEN 'unit kind percent for a metric in per share'
    WHEN f = 1 THEN 'unit kind percent for a metric in dollars'
    WHEN s = 7 THEN 'a change, not a level'
    WHEN f = 3 AND s NOT IN (1, 8) THEN 'reversed range'
    WHEN s = 3 OR (f = 5 AND s IN (1, 4, 8)) THEN 'a range without words of a range'
    WHEN f = 5 THEN 'a stated number is not in the evidence'
    WHEN s = 2 THEN 'past tense without a forward verb' END AS reason FROM x),
chained AS (SELECT record_id, cik, accession, s, reason, CASE WHEN f <> 6 THEN CASE WHEN reason IS NULL AND s = 4 THEN 'operating expenses GAAP' ELSE {_STATED["metric"]} END END AS metric,
    CASE WHEN f <> 6 THEN {_STATED["target_period"].replace("target_period END", "y.target_period END")} END AS target_period,
    (CASE WHEN f <> 6 THEN CASE WHEN reason IS NULL AND s = 1 THEN a - p ELSE {_duck(_STATED["value_low"])} END END)::DOUBLE AS target_low,
    (CASE WHEN f <> 6 THEN CASE WHEN reason IS NULL AND s = 1 THEN a + p WHEN reason IS NULL AND s = 8 THEN NULL ELSE {_duck(_STATED["value_high"])} END END)::DOUBLE AS target_high FROM y)"""


@query("guard_chain", f"WITH {_WANTED} SELECT record_id, metric, target_period, target_low, target_high, reason FROM chained")
def guard_chain(t: Tables) -> DataFrame:
    """Answers to drafts and rejects: what each item states in the end, or what it said and why it was refused."""
    return _derived(t)[2].select(F.col("custom_id").alias("record_id"), "metric", "target_period", "target_low", "target_high", "reason")


@query("a18_reject_reasons", f"WITH {_WANTED} SELECT coalesce(reason, 'draft') AS outcome, count(*) AS n, count(DISTINCT cik) AS companies FROM chained GROUP BY ALL")
def reject_reasons(t: Tables) -> DataFrame:
    """Drafts and rejects by reason, from the two tables that one pass writes."""
    drafts, rejects = chain.write(_derived(t)[2], scratch(t.spark, "derived"))
    both = drafts.select("cik", F.lit("draft").alias("outcome")).union(rejects.select("cik", "reason"))
    return both.groupBy("outcome").agg(F.count("*").alias("n"), F.countDistinct("cik").alias("companies"))


@query(
    "j9_rejected_blocks",
    f"""WITH {_WANTED} SELECT record_id, accession, CASE WHEN reason LIKE 'output did not parse%' THEN 'the output did not parse' ELSE '1 item(s), all rejected: ' || reason END AS reason
        FROM chained WHERE s IN {BLOCKS} AND reason IS NOT NULL""",
)
def rejected_blocks(t: Tables) -> DataFrame:
    """Answered sections without a draft, each with its reasons."""
    candidates, answers, derived = _derived(t)
    drafts, rejects = chain.write(derived, scratch(t.spark, "derived-blocks"))
    return chain.empty_blocks(candidates, answers, drafts, rejects).select(F.col("custom_id").alias("record_id"), "accession", "reason")


@query(
    "a18_guard_funnel",
    f"""WITH {_WANTED}, d AS (SELECT k.*, st.stated_at, st.publish, dense_rank() OVER (PARTITION BY k.cik, metric, k.target_period, stated_at ORDER BY k.target_low, k.target_high) AS nth FROM chained k JOIN (SELECT record_id, stated_at, publish FROM statements) st USING (record_id) WHERE reason IS NULL),
        g AS (SELECT cik, metric, target_period, stated_at, target_low, target_high, any_value(publish) AS publish, any_value(conflict) AS conflict, any_value(floor(target_low)::BIGINT % 5) AS said FROM (SELECT *, max(nth) OVER (PARTITION BY cik, metric, target_period, stated_at) > 1 AS conflict FROM d) GROUP BY cik, metric, target_period, stated_at, target_low, target_high)
        SELECT * FROM (SELECT 1 AS step, 'sent' AS stage, NULL::VARCHAR AS reason, count(*) AS n FROM chained UNION ALL SELECT 2, 'returned', NULL, count(*) FILTER (reason IS DISTINCT FROM 'output did not parse as a list of items') FROM chained
          UNION ALL SELECT 3, 'rejected', reason, count(*) FROM chained WHERE reason IS NOT NULL GROUP BY reason UNION ALL SELECT 4, 'dropped', 'duplicate', (SELECT count(*) FROM d) - count(*) FROM g UNION ALL SELECT 5, 'conflicts', NULL, count(*) FROM g WHERE conflict
          UNION ALL SELECT 6, 'review', NULL, count(*) FROM g UNION ALL SELECT 7, 'rejected in review', NULL, count(*) FROM g WHERE said = 0 UNION ALL SELECT 8, 'undecided', NULL, count(*) FROM g WHERE said = 1
          UNION ALL SELECT 9, 'published', NULL, count(*) FROM g WHERE said > 1 AND publish) WHERE n > 0""",
)
def whole_funnel(t: Tables) -> DataFrame:
    """From candidates to a release in one table: sent, returned, rejected by reason, dropped, in conflict, reviewed, published."""
    candidates, _, derived = _derived(t)
    path = scratch(t.spark, "funnel")
    derived.select("draft_id", "cik", "metric", "target_period", "stated_at", "capture_method", "char_start", "item_index", "target_low", "target_high", "unit", "reason").write.parquet(path)
    items = t.spark.read.parquet(path)  # the chain runs once for all stages
    drafts = items.where("reason is null").drop("reason")
    judged = dedupe(drafts)
    said = F.floor("target_low") % 5
    decisions = drafts.join(t.companies.select("cik", "publish"), "cik").select("draft_id", F.when(said == 0, False).when(said > 1, True).alias("approved"), F.col("publish").alias("published"))
    return audit.guard_funnel(candidates, items, judged, decisions)
