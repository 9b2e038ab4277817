"""Rubric and period queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids, periods, rubric
from .registry import query
from .substrate import COMPANIES, FILINGS, RESOLVED, STATEMENTS, Tables, sql_period_end


def _bounds() -> tuple:
    return F.col("target_low"), F.col("target_high"), F.col("reported_value")


@query("r1_in_range", f"WITH {RESOLVED} SELECT record_id, CASE WHEN reported_value IS NULL THEN NULL ELSE NOT (above OR below) END AS inside FROM resolved")
def in_range(t: Tables) -> DataFrame:
    return t.statements.select("record_id", rubric.in_range(*_bounds()).alias("inside"))


@query("r2_side", f"WITH {RESOLVED} SELECT record_id, side FROM resolved")
def side(t: Tables) -> DataFrame:
    return t.statements.select("record_id", rubric.side(*_bounds()).alias("side"))


@query("r3_direction", f"WITH {RESOLVED} SELECT record_id, CASE WHEN side IS NOT NULL THEN CASE WHEN (side = 'above') = higher_is_better THEN 'better' ELSE 'worse' END END AS direction FROM resolved")
def direction(t: Tables) -> DataFrame:
    return t.statements.select("record_id", rubric.direction(*_bounds(), F.col("higher_is_better")).alias("direction"))


@query("r4_resolve", f"WITH {RESOLVED} SELECT record_id, status FROM resolved")
def resolve(t: Tables) -> DataFrame:
    return t.resolved.select("record_id", "status")


@query("r5_withdrawn_before_close", f"WITH {RESOLVED} SELECT record_id, coalesce(withdrawn_at <= period_close, false) AS withdrawn FROM resolved")
def withdrawn(t: Tables) -> DataFrame:
    return t.resolved.select("record_id", rubric.withdrawn_before_close(F.col("withdrawn_at"), F.col("period_close")).alias("withdrawn"))


@query("r6_days", f"WITH {RESOLVED} SELECT record_id, days_to_falsifiable, days_to_acknowledged FROM resolved")
def days(t: Tables) -> DataFrame:
    return t.resolved.select("record_id", "days_to_falsifiable", "days_to_acknowledged")


@query("r7_miss_size", f"WITH {RESOLVED} SELECT record_id, round(miss, 9) AS miss, round(magnitude, 9) AS magnitude FROM resolved WHERE status = 'missed'")
def miss_size(t: Tables) -> DataFrame:
    return t.resolved.where("status = 'missed'").select("record_id", F.round("miss", 9).alias("miss"), F.round("magnitude", 9).alias("magnitude"))


@query("r8_shape", f"WITH {STATEMENTS} SELECT record_id, target_low IS NOT NULL AND target_high IS NULL AS is_floor, coalesce(target_low = target_high, false) AS is_point FROM statements")
def shape(t: Tables) -> DataFrame:
    low, high, _ = _bounds()
    return t.statements.select("record_id", rubric.is_floor(low, high).alias("is_floor"), rubric.is_point(low, high).alias("is_point"))


@query(
    "r9_acknowledgement_bucket",
    f"""WITH {RESOLVED} SELECT CASE WHEN acknowledged_at IS NULL THEN 'never acknowledged' WHEN coalesce(days_to_acknowledged, 0) = 0 THEN 'acknowledged in the same filing'
        ELSE 'acknowledged later' END AS bucket, count(*) AS n FROM resolved WHERE status = 'missed' GROUP BY 1""",
)
def bucket(t: Tables) -> DataFrame:
    found = rubric.acknowledgement_bucket(F.col("status"), F.col("acknowledged_at"), F.col("days_to_acknowledged"))
    return t.resolved.select(found.alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count("*").alias("n"))


@query("r10_release_status", f"WITH {RESOLVED} SELECT status, publish, count(*) AS n FROM (SELECT publish, CASE WHEN status = 'open' THEN CASE WHEN coalesce(withdrawn_at <= period_close, false) THEN 'withdrawn' WHEN reported_value IS NULL THEN 'unresolved' WHEN above OR below THEN 'missed' ELSE 'met' END ELSE status END AS status FROM resolved) GROUP BY ALL")
def release_status(t: Tables) -> DataFrame:
    pulled = rubric.withdrawn_before_close(F.col("withdrawn_at"), F.col("period_close"))
    status = rubric.resolve(*_bounds(), F.lit(True), F.col("reported_value").isNotNull(), pulled)
    return t.resolved.select("publish", status.alias("status")).groupBy("publish", "status").agg(F.count("*").alias("n"))


@query("p1_period_end", f"WITH {STATEMENTS} SELECT DISTINCT cik, target_period, {sql_period_end('fiscal_year', 'quarter')} AS period_close FROM statements")
def period_end(t: Tables) -> DataFrame:
    close = periods.period_end(F.col("fiscal_month"), F.col("named_for_end"), F.col("fiscal_year"), F.col("quarter"))
    return t.statements.select("cik", "target_period", close.alias("period_close")).distinct()


_ENDS = ", ".join(f"({k})" for k in (-2, -1, 0, 1))


@query(
    "p2_fiscal_year_reported",
    f"""WITH {COMPANIES}, {FILINGS}, f AS (SELECT DISTINCT cik, filed_at, quarter FROM filings, (VALUES (1), (2), (3), (4), (NULL)) AS q(quarter)),
        e AS (SELECT f.*, (year(filed_at) + k)::INT AS y, {sql_period_end('(year(filed_at) + k)', 'quarter')} AS period_close FROM f JOIN companies USING (cik), (VALUES {_ENDS}) AS k(k)),
        b AS (SELECT cik, filed_at, quarter, max_by(y, period_close) AS y, max(period_close) AS period_close FROM e WHERE period_close < filed_at GROUP BY ALL)
        SELECT f.cik, f.filed_at, coalesce(f.quarter, 0)::INT AS quarter, CASE WHEN b.filed_at - b.period_close <= 150 THEN y END AS fiscal_year
        FROM f LEFT JOIN b ON f.cik = b.cik AND f.filed_at = b.filed_at AND f.quarter IS NOT DISTINCT FROM b.quarter""",
)
def year_reported(t: Tables) -> DataFrame:
    rows = t.filings.select("cik", "filed_at").distinct().withColumn("quarter", F.explode(F.expr("array(1, 2, 3, 4, cast(null as int))")))
    year = periods.fiscal_year_reported(F.col("fiscal_month"), F.col("named_for_end"), F.col("quarter"), F.col("filed_at"))
    return rows.join(t.companies, "cik").select("cik", "filed_at", F.coalesce("quarter", F.lit(0)).alias("quarter"), year.cast("int").alias("fiscal_year"))


@query(
    "p3_label_for_end",
    f"""WITH {COMPANIES}, {FILINGS}, f AS (SELECT DISTINCT cik, filed_at, last_day(filed_at - 7) AS target FROM filings),
        c AS (SELECT cik, filed_at, q.q, (year(target) + k)::INT AS y FROM f JOIN companies USING (cik), (VALUES (-1), (0), (1), (2)) AS k(k), (VALUES (1), (2), (3), (4), (NULL)) AS q(q)
              WHERE {sql_period_end('(year(target) + k)', 'q.q')} = target)
        SELECT f.cik, f.filed_at, (SELECT 'FY' || y FROM c WHERE c.cik = f.cik AND c.filed_at = f.filed_at AND q IS NULL) AS year_label,
               (SELECT 'Q' || q || ' FY' || y FROM c WHERE c.cik = f.cik AND c.filed_at = f.filed_at AND q IS NOT NULL) AS quarter_label FROM f""",
)
def label_for_end(t: Tables) -> DataFrame:
    rows = t.filings.select("cik", "filed_at").distinct().join(t.companies, "cik")
    args = F.col("fiscal_month"), F.col("named_for_end"), F.col("filed_at")
    return rows.select("cik", "filed_at", periods.fiscal_label_for_end(*args, quarterly=False).alias("year_label"), periods.fiscal_label_for_end(*args, quarterly=True).alias("quarter_label"))


@query("p5_parse_period", f"WITH {STATEMENTS} SELECT DISTINCT target_period, quarter, fiscal_year FROM statements")
def parse_period(t: Tables) -> DataFrame:
    parsed = periods.parse_period(F.col("target_period"))
    return t.statements.select("target_period").distinct().select("target_period", parsed["quarter"].alias("quarter"), parsed["year"].alias("fiscal_year"))


@query(
    "p6_next_period",
    f"""WITH {STATEMENTS} SELECT DISTINCT target_period, CASE WHEN quarter IS NULL THEN 'FY' || (fiscal_year + 1) WHEN quarter = 4 THEN 'Q1 FY' || (fiscal_year + 1)
        ELSE 'Q' || (quarter + 1) || ' FY' || fiscal_year END AS next_period FROM statements""",
)
def next_period(t: Tables) -> DataFrame:
    return t.statements.select("target_period").distinct().select("target_period", periods.next_period(F.col("target_period")).alias("next_period"))


@query("p7_closes_before_stated", f"WITH {RESOLVED} SELECT record_id, coalesce(period_close < stated_at, false) AS flagged FROM resolved")
def closes_before_stated(t: Tables) -> DataFrame:
    flagged = periods.closes_before_stated(F.col("fiscal_month"), F.col("named_for_end"), F.col("target_period"), F.col("stated_at"))
    return t.statements.select("record_id", flagged.alias("flagged"))


@query("p8_year_in_label", f"WITH {STATEMENTS} SELECT DISTINCT target_period, CASE WHEN fiscal_year >= 2000 THEN fiscal_year END AS year FROM statements")
def year_in_label(t: Tables) -> DataFrame:
    return t.statements.select("target_period").distinct().select("target_period", periods.year_in(F.col("target_period")).alias("year"))


_HEX = "lpad(to_base((stated_at - DATE '1970-01-01')::BIGINT * 86400000, 16), 12, '0') || sha256(cik || '|' || record_id)[1:20]"


@query(
    "g18_ulid",
    f"""WITH {STATEMENTS}, b AS (SELECT record_id, '00' || array_to_string(list_transform(string_split(lower({_HEX}), ''), lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '') AS bits FROM statements)
        SELECT record_id, array_to_string(list_transform(range(26), lambda k: ('{ids.CROCKFORD}')[1 + list_sum(list_transform(range(5), lambda i: (bits[1 + 5 * k + i])::INT * (16 >> i::INT)))::INT]), '') AS ulid FROM b""",
)
def ulid(t: Tables) -> DataFrame:
    return t.statements.select("record_id", ids.ulid(F.col("stated_at"), F.concat_ws("|", "cik", "record_id")).alias("ulid"))
