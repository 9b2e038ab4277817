"""Statistics of a release, and windows over statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import periods
from ..operators import audit
from .registry import query
from .substrate import COMPANIES, FILINGS, RESOLVED, STATEMENTS, Tables


def _missed() -> Column:
    return F.col("status") == "missed"


def _never() -> Column:
    return _missed() & F.col("acknowledged_at").isNull()


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole, 9))


def _beyond(direction: str, size: float) -> Column:
    return F.count_if((F.col("direction") == direction) & (F.col("miss") > size))


def _median(direction: str) -> Column:
    return F.median(F.when(F.col("direction") == direction, F.col("days_to_falsifiable")))


def _rate(direction: str) -> Column:
    hit = F.col("direction") == direction
    return _share(F.count_if(hit & F.col("acknowledged_at").isNotNull()), F.count_if(hit))


@query(
    "a1_release_stats",
    f"""WITH {RESOLVED} SELECT count(*) AS n_rows, count(*) FILTER (status IN ('met', 'missed')) AS resolved, count(acknowledged_at) AS acknowledged,
        median(days_to_falsifiable) AS median_days, count(*) FILTER (status = 'missed') AS missed,
        count(*) FILTER (status = 'missed' AND acknowledged_at IS NULL) AS never_acknowledged,
        round(count(*) FILTER (status = 'missed' AND acknowledged_at IS NULL) / count(*) FILTER (status = 'missed'), 9) AS never_share,
        count(*) FILTER (direction = 'better') AS better, count(*) FILTER (direction = 'worse') AS worse,
        count(*) FILTER (direction = 'worse' AND miss > 0.01) AS worse_1, count(*) FILTER (direction = 'worse' AND miss > 0.05) AS worse_5,
        count(*) FILTER (direction = 'better' AND miss > 0.01) AS better_1, count(*) FILTER (direction = 'better' AND miss > 0.05) AS better_5,
        count(*) FILTER (status = 'missed' AND target_low IS NOT NULL AND target_high IS NULL) AS missed_floors,
        median(days_to_falsifiable) FILTER (direction = 'better') AS median_better, median(days_to_falsifiable) FILTER (direction = 'worse') AS median_worse,
        round(count(acknowledged_at) FILTER (direction = 'better') / count(*) FILTER (direction = 'better'), 9) AS rate_better,
        round(count(acknowledged_at) FILTER (direction = 'worse') / count(*) FILTER (direction = 'worse'), 9) AS rate_worse FROM resolved""",
)
def release_stats(t: Tables) -> DataFrame:
    """One row; exact medians."""
    return t.resolved.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("status").isin("met", "missed")).alias("resolved"),
        F.count("acknowledged_at").alias("acknowledged"),
        F.median("days_to_falsifiable").alias("median_days"),
        F.count_if(_missed()).alias("missed"),
        F.count_if(_never()).alias("never_acknowledged"),
        _share(F.count_if(_never()), F.count_if(_missed())).alias("never_share"),
        F.count_if(F.col("direction") == "better").alias("better"),
        F.count_if(F.col("direction") == "worse").alias("worse"),
        _beyond("worse", 0.01).alias("worse_1"),
        _beyond("worse", 0.05).alias("worse_5"),
        _beyond("better", 0.01).alias("better_1"),
        _beyond("better", 0.05).alias("better_5"),
        F.count_if(_missed() & F.col("target_low").isNotNull() & F.col("target_high").isNull()).alias("missed_floors"),
        _median("better").alias("median_better"),
        _median("worse").alias("median_worse"),
        _rate("better").alias("rate_better"),
        _rate("worse").alias("rate_worse"),
    )


STATUSES = ["met", "missed", "open", "unresolved", "withdrawn"]
_STATUS_SQL = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in STATUSES)


def status_counts() -> list[Column]:
    return [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]


@query(
    "a2_company_table",
    f"""WITH {RESOLVED} SELECT company, count(*) AS n_rows, {_STATUS_SQL}, count(acknowledged_at) AS acknowledged,
        round(count(*) FILTER (status = 'missed' AND acknowledged_at IS NULL) / nullif(count(*) FILTER (status = 'missed'), 0), 9) AS never_share FROM resolved GROUP BY company""",
)
def company_table(t: Tables) -> DataFrame:
    never = _share(F.count_if(_never()), F.count_if(_missed())).alias("never_share")
    return t.resolved.groupBy("company").agg(F.count("*").alias("n_rows"), *status_counts(), F.count("acknowledged_at").alias("acknowledged"), never)


@query(
    "a3_summary",
    f"""WITH {RESOLVED} SELECT coalesce(company, 'Total') AS company, count(*) AS statements, count(*) FILTER (status IN ('met', 'missed')) AS resolved,
        count(*) FILTER (status = 'met') AS met, count(*) FILTER (direction = 'better') AS better, count(*) FILTER (direction = 'worse') AS worse,
        count(acknowledged_at) FILTER (direction = 'worse') AS worse_acknowledged FROM resolved GROUP BY ROLLUP (company)""",
)
def summary(t: Tables) -> DataFrame:
    worse = F.col("direction") == "worse"
    return (
        t.resolved.rollup("company")
        .agg(
            F.count("*").alias("statements"),
            F.count_if(F.col("status").isin("met", "missed")).alias("resolved"),
            F.count_if(F.col("status") == "met").alias("met"),
            F.count_if(F.col("direction") == "better").alias("better"),
            F.count_if(worse).alias("worse"),
            F.count_if(worse & F.col("acknowledged_at").isNotNull()).alias("worse_acknowledged"),
            F.grouping("company").alias("total"),
        )
        .withColumn("company", F.when(F.col("total") == 1, "Total").otherwise(F.col("company")))
        .drop("total")
    )


@query("a4_cube", f"WITH {RESOLVED} SELECT status, direction, company, metric, count(*) AS n, grouping_id(status, direction, company, metric)::BIGINT AS gid FROM resolved GROUP BY GROUPING SETS ((status), (status, direction), (company, status), (metric, direction), ())")
def cube(t: Tables) -> DataFrame:
    rows = t.resolved.select("status", "direction", "company", "metric")
    sets = [[F.col("status")], [F.col("status"), F.col("direction")], [F.col("company"), F.col("status")], [F.col("metric"), F.col("direction")], []]
    return rows.groupingSets(sets, "status", "direction", "company", "metric").agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))


@query(
    "a5_acknowledgements",
    f"""WITH {RESOLVED} SELECT count(*) AS missed, count(acknowledged_at) AS acknowledged, count(*) FILTER (days_to_acknowledged = 0) AS same_filing,
        count(*) FILTER (days_to_acknowledged > 0) AS later, list_sort(list_distinct(list(company) FILTER (acknowledged_at IS NOT NULL))) AS companies FROM resolved WHERE status = 'missed'""",
)
def acknowledgements(t: Tables) -> DataFrame:
    companies = F.sort_array(F.collect_set(F.when(F.col("acknowledged_at").isNotNull(), F.col("company"))))
    return t.resolved.where(_missed()).agg(
        F.count("*").alias("missed"),
        F.count("acknowledged_at").alias("acknowledged"),
        F.count_if(F.col("days_to_acknowledged") == 0).alias("same_filing"),
        F.count_if(F.col("days_to_acknowledged") > 0).alias("later"),
        companies.alias("companies"),
    )


@query("a7_by_year", f"WITH {RESOLVED} SELECT fiscal_year, count(*) FILTER (status = 'met') AS met, count(*) FILTER (status = 'missed') AS missed, count(*) FILTER (status = 'withdrawn') AS withdrawn FROM resolved GROUP BY fiscal_year")
def by_year(t: Tables) -> DataFrame:
    return t.resolved.groupBy(periods.year_of(F.col("target_period")).alias("fiscal_year")).agg(*[c for c, s in zip(status_counts(), STATUSES, strict=True) if s in ("met", "missed", "withdrawn")])


@query(
    "a9_miss_sizes",
    f"""WITH {RESOLVED} SELECT direction, metric, count(*) AS n, round(median(miss), 9) AS median_miss, count(*) FILTER (miss > 0.01) AS over_1,
        count(*) FILTER (miss > 0.05) AS over_5, count(*) FILTER (miss > 0.1) AS over_10 FROM resolved WHERE status = 'missed' GROUP BY direction, metric""",
)
def miss_sizes(t: Tables) -> DataFrame:
    over = [F.count_if(F.col("miss") > x).alias(name) for x, name in ((0.01, "over_1"), (0.05, "over_5"), (0.1, "over_10"))]
    return t.resolved.where(_missed()).groupBy("direction", "metric").agg(F.count("*").alias("n"), F.round(F.median("miss"), 9).alias("median_miss"), *over)


@query("a10_sectors", f"WITH {STATEMENTS} SELECT sector, count(DISTINCT cik) AS companies, count(*) AS statements FROM statements WHERE publish AND sector IS NOT NULL GROUP BY sector")
def sectors(t: Tables) -> DataFrame:
    return t.statements.where("publish and sector is not null").groupBy("sector").agg(F.countDistinct("cik").alias("companies"), F.count("*").alias("statements"))


@query(
    "a10_coverage",
    f"""WITH {COMPANIES}, {FILINGS}, c AS (SELECT cik, coalesce(sector, 'utilities') AS sector FROM companies WHERE publish AND cik IN (SELECT cik FROM filings))
        SELECT sector, count(*) AS companies, row_number() OVER (ORDER BY count(*) DESC, sector)::INT AS place FROM c GROUP BY sector""",
)
def coverage(t: Tables) -> DataFrame:
    """Sectors of the published companies that have filed, most first; each must have one."""
    filed = t.companies.withColumn("sector", F.coalesce("sector", F.lit("utilities"))).join(t.filings.select("cik").distinct(), "cik", "left_semi")
    return audit.sector_coverage(filed)


@query("a11_left_out", f"WITH {STATEMENTS} SELECT coalesce(sector, 'no sector') AS reason, list_sort(list_distinct(list(company))) AS companies, count(*) AS statements FROM statements WHERE NOT publish GROUP BY 1")
def left_out(t: Tables) -> DataFrame:
    return t.statements.where("not publish").groupBy(F.coalesce("sector", F.lit("no sector")).alias("reason")).agg(F.sort_array(F.collect_set("company")).alias("companies"), F.count("*").alias("statements"))


@query(
    "a12_manifest",
    f"""WITH {FILINGS}, m AS (SELECT cik, max(filed_at) AS last_filing_date FROM filings GROUP BY cik)
        SELECT cik, last_filing_date, list_sort(list(accession)) AS accessions_on_last_date FROM filings JOIN m USING (cik) WHERE filed_at = last_filing_date GROUP BY cik, last_filing_date""",
)
def manifest(t: Tables) -> DataFrame:
    latest = t.filings.groupBy("cik").agg(F.max("filed_at").alias("last_filing_date"))
    return t.filings.join(latest, "cik").where("filed_at = last_filing_date").groupBy("cik", "last_filing_date").agg(F.sort_array(F.collect_list("accession")).alias("accessions_on_last_date"))


@query("a14_run_summary", f"WITH {FILINGS} SELECT date_trunc('week', filed_at)::DATE AS week, form, count(*) AS filings, count(DISTINCT cik) AS companies FROM filings GROUP BY ALL")
def run_summary(t: Tables) -> DataFrame:
    return t.filings.groupBy(F.to_date(F.date_trunc("week", "filed_at")).alias("week"), "form").agg(F.count("*").alias("filings"), F.countDistinct("cik").alias("companies"))


@query(
    "a15_spend",
    """WITH l AS (SELECT event_id AS seq, event_type AS stage, user_id % 7 AS batch, round(value * 100)::BIGINT AS cents FROM events),
       latest AS (SELECT stage, batch, max_by(cents, seq) AS cents FROM l WHERE stage <> 'click' GROUP BY ALL),
       done AS (SELECT stage, cents FROM latest UNION ALL SELECT stage, cents FROM l WHERE stage = 'click')
       SELECT stage, sum(cents)::BIGINT AS cents, greatest(500000 - sum(cents), 0)::BIGINT AS remaining FROM done GROUP BY stage""",
)
def spend(t: Tables) -> DataFrame:
    """Direct calls add up; of each batch only the latest row counts."""
    ledger = t.read("events").select(F.col("event_id").alias("seq"), F.col("event_type").alias("stage"), (F.col("user_id") % 7).alias("batch"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    latest = ledger.where("stage <> 'click'").groupBy("stage", "batch").agg(F.max_by("cents", "seq").alias("cents"))
    done = latest.select("stage", "cents").unionByName(ledger.where("stage = 'click'").select("stage", "cents"))
    return done.groupBy("stage").agg(F.sum("cents").alias("cents"), F.greatest(F.lit(500000) - F.sum("cents"), F.lit(0)).cast("long").alias("remaining"))


@query("a16_cost_projection", "SELECT lang, count(*) AS requests, sum(ceil(length(text) / 3))::BIGINT AS tokens, round(sum(ceil(length(text) / 3)) * 0.5 / 1e6, 6) AS expected_usd, round(count(*) * 1000 * 2.5 / 1e6, 6) AS worst_output_usd FROM documents GROUP BY lang")
def cost_projection(t: Tables) -> DataFrame:
    tokens = F.sum(F.ceil(F.length("text") / 3))
    return t.read("documents").groupBy("lang").agg(
        F.count("*").alias("requests"), tokens.alias("tokens"), F.round(tokens * 0.5 / 1e6, 6).alias("expected_usd"), F.round(F.count("*") * 1000 * 2.5 / 1e6, 6).alias("worst_output_usd")
    )


@query(
    "a19_hand_verified",
    f"WITH {STATEMENTS} SELECT company, round(avg((supp % 9 = 0)::INT), 9) AS share, avg((supp % 9 = 0)::INT) >= 0.1 AS enough FROM statements WHERE reviewed GROUP BY company",
)
def hand_verified(t: Tables) -> DataFrame:
    share = F.avg((F.col("supp") % 9 == 0).cast("int"))
    return t.statements.where("reviewed").groupBy("company").agg(F.round(share, 9).alias("share"), (share >= 0.1).alias("enough"))


@query("a22_approximate")
def approximate(t: Tables) -> DataFrame:
    """Approximate counterparts of the exact medians and counts, for tables where exact ones cost too much."""
    return t.resolved.groupBy("company").agg(F.percentile_approx("days_to_falsifiable", 0.5, 10_000).alias("median_days"), F.approx_count_distinct("record_id").alias("records"))


@query("a23_rejection_notes", f"WITH {STATEMENTS} SELECT split_part(note, ':', 1) AS prefix, count(*) AS n FROM (SELECT CASE part % 3 WHEN 0 THEN 'duplicate: ' WHEN 1 THEN 'wrong period: ' ELSE 'component figure: ' END || record_id AS note FROM statements WHERE NOT reviewed) GROUP BY 1")
def rejection_notes(t: Tables) -> DataFrame:
    kind = F.when(F.col("part") % 3 == 0, "duplicate: ").when(F.col("part") % 3 == 1, "wrong period: ").otherwise("component figure: ")
    notes = t.statements.where("not reviewed").select(F.concat(kind, F.col("record_id")).alias("note"))
    return notes.groupBy(F.split("note", ":")[0].alias("prefix")).agg(F.count("*").alias("n"))


@query(
    "a24_review_tiers",
    f"""WITH {RESOLVED} SELECT company, CASE WHEN line = 4 OR period_close > stated_at + 730 THEN 'full' WHEN line IN (5, 6) THEN 'medium' ELSE 'fast' END AS tier, count(*) AS n FROM resolved GROUP BY ALL""",
)
def review_tiers(t: Tables) -> DataFrame:
    far = F.col("period_close") > F.date_add("stated_at", 730)
    tier = F.when((F.col("line") == 4) | far, "full").when(F.col("line").isin(5, 6), "medium").otherwise("fast")
    return t.resolved.groupBy("company", tier.alias("tier")).agg(F.count("*").alias("n"))


@query("a26_filing_span", f"WITH {STATEMENTS} SELECT min(least(stated_at, reported_at)) AS first_filed, max(greatest(stated_at, reported_at)) AS last_filed FROM statements")
def filing_span(t: Tables) -> DataFrame:
    return t.statements.select(F.explode(F.array("stated_at", "reported_at")).alias("filed_at")).agg(F.min("filed_at").alias("first_filed"), F.max("filed_at").alias("last_filed"))


# windows


@query("w1_latest_answer", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (event_type <> 'error') DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_answer(t: Tables) -> DataFrame:
    """The last success of each id, or its last row if none succeeded."""
    best = F.max(F.struct((F.col("event_type") != "error").alias("ok"), "event_id", "event_type"))
    return t.read("events").groupBy("user_id").agg(best.alias("b")).select("user_id", "b.event_id", "b.event_type")


@query(
    "w12_revisions",
    f"""WITH {STATEMENTS} SELECT record_id, target_low - lag(target_low) OVER w AS low_change, target_high - lag(target_high) OVER w AS high_change,
        (stated_at - lag(stated_at) OVER w)::BIGINT AS days FROM statements WINDOW w AS (PARTITION BY cik, metric, target_period ORDER BY stated_at, record_id)""",
)
def revisions(t: Tables) -> DataFrame:
    w = Window.partitionBy("cik", "metric", "target_period").orderBy("stated_at", "record_id")
    return t.statements.select(
        "record_id",
        (F.col("target_low") - F.lag("target_low").over(w)).alias("low_change"),
        (F.col("target_high") - F.lag("target_high").over(w)).alias("high_change"),
        F.datediff("stated_at", F.lag("stated_at").over(w)).cast("long").alias("days"),
    )
