"""Guidance-shaped tables derived from the given ones, as DataFrames and as the same DuckDB SQL.

Companies are nations, filings are orders, and statements are line items: their bounds, reported values and periods come
from whole-number arithmetic, so both engines get the same doubles.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import periods, rubric


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def metrics(self) -> DataFrame:
        numbered = [(k, *m) for k, m in enumerate(dims.METRICS)]
        return self.spark.createDataFrame(numbered, "metric_no long, metric string, kind string, higher_is_better boolean")

    @cached_property
    def companies(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.read("nation").select(
            F.lpad(key.cast("string"), 10, "0").alias("cik"),
            F.col("n_name").alias("company"),
            (1 + key % 12).cast("int").alias("fiscal_month"),
            (key % 2 == 0).alias("named_for_end"),
            (key % 5 != 0).alias("publish"),
            F.when(key % 3 == 0, "technology").when(key % 3 == 1, "industrials").alias("sector"),
        )

    @cached_property
    def _orders(self) -> DataFrame:
        """Orders with their customer's nation, before names are made of keys."""
        return self.read("orders").join(self.read("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))

    @cached_property
    def _filing(self) -> dict[str, Column]:
        """A filing's columns by name, over an order's."""
        day = F.to_date("o_orderdate")
        return {
            "cik": F.lpad(F.col("c_nationkey").cast("string"), 10, "0"),
            "accession": F.concat_ws("-", F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.date_format(day, "yy"), F.lpad((F.col("o_custkey") % 1000000).cast("string"), 6, "0")),
            "form": F.when(F.col("o_orderpriority") == "1-URGENT", "10-K").when(F.col("o_orderpriority") == "2-HIGH", "10-Q").otherwise("8-K"),
            "filed_at": day,
            "http_status": F.when(F.col("o_orderkey") % 50 == 0, 404).otherwise(200),
            "kind": F.col("o_orderstatus"),
        }

    @cached_property
    def filings(self) -> DataFrame:
        return self._orders.select("o_orderkey", *[value.alias(name) for name, value in self._filing.items()])

    @cached_property
    def releases(self) -> DataFrame:
        """Filings with the fiscal quarter that ended last before them (years thirty later, as titles name years of this century).

        ``text`` begins with a title, ``line`` speaks of a miss, and ``withdrawal`` may withdraw guidance; 8-K alone has titles that count.
        """
        rows = self.filings.join(self.companies.select("cik", "company", "fiscal_month", "named_for_end"), "cik")
        month, last = F.col("fiscal_month") - 1, F.year("filed_at") * 12 + F.month("filed_at") - 2
        end = last - F.pmod(last - month, F.lit(3))
        into = F.pmod(end - month, F.lit(12))
        year = F.floor((end + F.pmod(12 - into, F.lit(12))) / 12).cast("int") - F.when(F.col("named_for_end") | (F.col("fiscal_month") == 12), 0).otherwise(1) + 30
        rows = rows.withColumns({"q": F.when(into == 0, 4).otherwise(into / 3).cast("int"), "y": year})
        ordinal = F.initcap(F.element_at(F.array(*[F.lit(x) for x in periods.ORDINALS]), F.col("q")))
        full, short, q = F.col("y").cast("string"), F.lpad((F.col("y") % 100).cast("string"), 2, "0"), F.col("q").cast("string")
        name, key = F.col("company"), F.col("o_orderkey")

        def pick(n: int, *texts: tuple) -> Column:
            parts = [F.concat(*[F.lit(x) if isinstance(x, str) else x for x in t]) for t in texts]
            return F.element_at(F.array(*parts), (F.least(key % n, F.lit(len(texts) - 1)) + 1).cast("int"))

        title = pick(
            8, (name, " Reports ", ordinal, " Quarter Fiscal ", full, " Results"), (name, " Announces Q", q, " FY", short, " Results and 2030 Outlook"), (name, " Reports ", ordinal, " Quarter Earnings Results"),
            (name, " Reports ", full, " Results"), (name, " to Host Conference Call on ", ordinal, " Quarter Results"), (name, " Declares Dividend Today"), ("EX-99.1\n", name, " net sales rise in Q", q),
            (name, " Announces Its Results\nFor the ", ordinal, " Quarter of Fiscal ", full),
        )
        line = pick(
            6, (ordinal, " quarter revenue of $5.2 billion was below our guidance."), ("In Q", q, " FY", short, ", results fell short of our prior outlook of $5 million."),
            (ordinal, " quarter revenue of $7.1 billion exceeded our guidance."), ("Results were below our guidance.",), ("Revenue missed the expected range of $150 to $160.",), ("The board met twice.",),
        )
        closes = F.date_format(periods.period_end(F.col("fiscal_month"), F.col("named_for_end"), F.col("y") - 29, F.lit(None).cast("int")), "MMMM d, yyyy")
        withdrawal = pick(
            7, ("We are withdrawing our guidance for the year.",), ("We are suspending our outlook for the fiscal year ending ", closes, "."), ("Guidance was suspended.",), ("We suspended the dividend.",), ("The board met twice.",),
        )
        return rows.withColumns({"text": title, "line": line, "withdrawal": withdrawal})

    @cached_property
    def statements(self) -> DataFrame:
        """One row per line item: bounds, stated and reported dates, the reported value, period and metric."""
        # keys, which are small, are moved to their lines; names are made of them there
        orders = self._orders.select("o_orderkey", "o_custkey", "c_nationkey", F.to_date("o_orderdate").alias("o_orderdate"))
        own = {name: self._filing[name] for name in ("cik", "accession")}
        cents = F.round(F.col("l_extendedprice") * 100).cast("long")
        n = F.col("l_linenumber")
        base = (cents % 1000 + 100).cast("double")
        shipped = F.to_date("l_shipdate")
        low = F.when(n == 2, None).otherwise(base)
        high = F.when(n == 1, None).when(n == 3, base).otherwise(base + 1 + F.col("l_partkey") % 50)
        later = shipped > F.col("stated_at")
        rows = (
            self.read("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumns(own | {"stated_at": F.col("o_orderdate")})
            .select(
                F.md5(F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", shipped.cast("string"), cents.cast("string"))).alias("record_id"),
                "cik",
                "accession",
                (F.col("l_partkey") % 16).alias("metric_no"),
                low.alias("target_low"),
                high.alias("target_high"),
                "stated_at",
                F.when(later, shipped).alias("reported_at"),
                F.when(later, base - 40 + F.col("l_suppkey") % 120).alias("reported_value"),
                F.when(n == 7, None).otherwise((1 + F.col("l_suppkey") % 4).cast("int")).alias("quarter"),
                F.year("stated_at").alias("fiscal_year"),
                F.when(F.col("l_partkey") % 17 == 0, F.date_add("stated_at", 30)).alias("withdrawn_at"),
                (F.col("l_quantity") % 10 != 0).alias("reviewed"),
                F.when((F.col("l_partkey") % 23 == 0) & later, F.date_add(shipped, (F.col("l_suppkey") % 3 * 45).cast("int"))).alias("acknowledged_at"),
                n.cast("long").alias("line"),
                F.col("l_partkey").alias("part"),
                F.col("l_suppkey").alias("supp"),
                F.col("l_orderkey").alias("filing_no"),
            )
        )
        return rows.join(F.broadcast(self.metrics), "metric_no").join(self.companies, "cik").withColumn("target_period", periods.format_period(F.col("quarter"), F.col("fiscal_year")))

    @cached_property
    def resolved(self) -> DataFrame:
        """Statements with status, direction and days."""
        low, high, value = F.col("target_low"), F.col("target_high"), F.col("reported_value")
        close = periods.period_end(F.col("fiscal_month"), F.col("named_for_end"), F.col("fiscal_year"), F.col("quarter"))
        rows = self.statements.withColumn("period_close", close)
        withdrawn = rubric.withdrawn_before_close(F.col("withdrawn_at"), F.col("period_close"))
        rows = rows.withColumn("status", rubric.resolve(low, high, value, F.col("reviewed"), value.isNotNull(), withdrawn))
        missed = F.col("status") == "missed"
        return rows.withColumns(
            {
                "direction": F.when(missed, rubric.direction(low, high, value, F.col("higher_is_better"))),
                "days_to_falsifiable": rubric.days_between(F.col("stated_at"), F.col("reported_at")),
                "days_to_acknowledged": rubric.days_between(F.col("reported_at"), F.col("acknowledged_at")),
                "miss": F.when(missed, rubric.miss_fraction(low, high, value)),
                "magnitude": rubric.miss_magnitude(low, high, value, F.col("status")),
            }
        )

    @cached_property
    def sentences(self) -> DataFrame:
        """A templated sentence of guidance or result for each statement."""
        s = self.statements
        lowest = F.coalesce("target_low", "target_high").cast("int").cast("string")
        highest = F.coalesce("target_high", "target_low").cast("int").cast("string")
        number = F.element_at(F.array(*[F.lit(x) for x in periods.ORDINALS]), F.coalesce("quarter", F.lit(4)))
        year = F.col("fiscal_year").cast("string")
        value = F.coalesce(F.col("reported_value"), F.lit(7.0)).cast("int").cast("string")
        kind = F.col("part") % 8
        text = (
            F.when(kind == 0, F.concat(F.lit("Revenue for the "), number, F.lit(" quarter of fiscal "), year, F.lit(" is expected to be $"), lowest, F.lit(" million to $"), highest, F.lit(" million.")))
            .when(kind == 1, F.concat(F.lit("GAAP gross margin outlook of "), lowest, F.lit("."), F.col("line").cast("string"), F.lit("%, plus or minus "), F.col("line").cast("string"), F.lit("0 basis points.")))
            .when(kind == 2, F.concat(F.lit("Q"), F.coalesce("quarter", F.lit(2)).cast("string"), F.lit(" FY"), F.substring(year, 3, 2), F.lit(" operating expenses were $"), value, F.lit(",000 and below our guidance.")))
            .when(kind == 3, F.concat(F.lit("We are suspending our full-year "), year, F.lit(" guidance; tax rate ("), lowest, F.lit(")%.")))
            .when(kind == 4, F.concat(F.lit("Comparable sales increased "), value, F.lit(" percent, which exceeded our prior outlook.")))
            .when(kind == 5, F.concat(F.lit("Earnings per share of at least $"), lowest, F.lit(".50 or more in "), F.coalesce("quarter", F.lit(1)).cast("string"), F.lit("Q"), F.substring(year, 3, 2), F.lit(".")))
            .when(kind == 6, F.lit("The board met twice."))
            .otherwise(F.concat(value, F.lit(" "), lowest, F.lit(" "), highest, F.lit(" 12.5")))
        )
        return s.withColumn("sentence", text)


COMPANIES = """
companies AS (
  SELECT lpad(n_nationkey::VARCHAR, 10, '0') AS cik, n_name AS company, (1 + n_nationkey % 12)::INT AS fiscal_month,
         n_nationkey % 2 = 0 AS named_for_end, n_nationkey % 5 <> 0 AS publish,
         CASE n_nationkey % 3 WHEN 0 THEN 'technology' WHEN 1 THEN 'industrials' END AS sector FROM nation)"""

METRICS = "metrics(metric_no, metric, kind, higher_is_better) AS (VALUES " + ", ".join(f"({k}, '{m}', '{kind}', {str(up).lower()})" for k, (m, kind, up) in enumerate(dims.METRICS)) + ")"

FILINGS = """
filings AS (
  SELECT o_orderkey, lpad(c_nationkey::VARCHAR, 10, '0') AS cik,
         lpad(o_orderkey::VARCHAR, 10, '0') || '-' || strftime(o_orderdate, '%y') || '-' || lpad((o_custkey % 1000000)::VARCHAR, 6, '0') AS accession,
         CASE o_orderpriority WHEN '1-URGENT' THEN '10-K' WHEN '2-HIGH' THEN '10-Q' ELSE '8-K' END AS form,
         o_orderdate::DATE AS filed_at, CASE WHEN o_orderkey % 50 = 0 THEN 404 ELSE 200 END AS http_status, o_orderstatus AS kind
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


RELEASES = """
rel0 AS (SELECT f.*, company, fiscal_month, named_for_end, year(filed_at) * 12 + month(filed_at) - 2 AS last_m FROM filings f JOIN companies USING (cik)),
rel1 AS (SELECT *, last_m - (last_m - fiscal_month + 1) % 3 AS end_m FROM rel0),
rel2 AS (SELECT *, (end_m - fiscal_month + 1) % 12 AS into_y FROM rel1),
rel AS (SELECT *, CASE WHEN into_y = 0 THEN 4 ELSE into_y // 3 END AS q, (end_m + (12 - into_y) % 12) // 12 - CASE WHEN named_for_end OR fiscal_month = 12 THEN 0 ELSE 1 END + 30 AS y FROM rel2),
reported AS (SELECT accession AS release, cik, filed_at, q AS quarter, y FROM rel WHERE form = '8-K' AND http_status = 200 AND o_orderkey % 8 IN (0, 1, 2, 6, 7)
  UNION ALL SELECT accession, cik, filed_at, 0, y FROM rel WHERE form = '8-K' AND http_status = 200 AND o_orderkey % 8 IN (0, 1, 2, 6, 7) AND q = 4
  UNION ALL SELECT accession, cik, filed_at, unnest([0, 4]), y FROM rel WHERE form = '8-K' AND http_status = 200 AND o_orderkey % 8 = 3)"""


def sql_period_end(year: str, quarter: str, month: str = "fiscal_month", named: str = "named_for_end") -> str:
    return f"last_day((make_date((CASE WHEN {named} OR {month} = 12 THEN {year} ELSE {year} + 1 END)::BIGINT, {month}::BIGINT, 1) - to_months((3 * (4 - coalesce({quarter}, 4)))::INT))::DATE)"


STATEMENTS = f"""{COMPANIES}, {METRICS}, {FILINGS},
s0 AS (
  SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate::DATE, round(l_extendedprice * 100)::BIGINT)) AS record_id,
         cik, accession, l_partkey % 16 AS metric_no, (round(l_extendedprice * 100)::BIGINT % 1000 + 100)::DOUBLE AS base,
         filed_at AS stated_at, CASE WHEN l_shipdate::DATE > filed_at THEN l_shipdate::DATE END AS reported_at,
         l_linenumber::BIGINT AS line, l_partkey AS part, l_suppkey AS supp, l_quantity, year(filed_at)::INT AS fiscal_year
  FROM lineitem JOIN filings ON l_orderkey = o_orderkey),
s1 AS (
  SELECT *, CASE WHEN line <> 2 THEN base END AS target_low, CASE WHEN line = 1 THEN NULL WHEN line = 3 THEN base ELSE base + 1 + part % 50 END AS target_high,
         CASE WHEN reported_at IS NOT NULL THEN base - 40 + supp % 120 END AS reported_value, CASE WHEN line <> 7 THEN (1 + supp % 4)::INT END AS quarter,
         CASE WHEN part % 17 = 0 THEN stated_at + 30 END AS withdrawn_at, l_quantity % 10 <> 0 AS reviewed,
         CASE WHEN part % 23 = 0 AND reported_at IS NOT NULL THEN reported_at + (supp % 3 * 45)::INT END AS acknowledged_at FROM s0),
statements AS (
  SELECT s1.*, company, fiscal_month, named_for_end, publish, sector, metric, kind, higher_is_better,
         CASE WHEN quarter IS NULL THEN 'FY' || fiscal_year ELSE 'Q' || quarter || ' FY' || fiscal_year END AS target_period
  FROM s1 JOIN metrics USING (metric_no) JOIN companies USING (cik))"""

RESOLVED = f"""{STATEMENTS},
r0 AS (
  SELECT *, {sql_period_end('fiscal_year', 'quarter')} AS period_close,
         coalesce(reported_value > target_high + 1e-9 * greatest(abs(target_high), 1), false) AS above,
         coalesce(reported_value < target_low - 1e-9 * greatest(abs(target_low), 1), false) AS below FROM statements),
r1 AS (
  SELECT *, CASE WHEN NOT reviewed THEN 'open' WHEN coalesce(withdrawn_at <= period_close, false) THEN 'withdrawn' WHEN reported_value IS NULL THEN 'unresolved'
                 WHEN above OR below THEN 'missed' ELSE 'met' END AS status,
         CASE WHEN above THEN 'above' WHEN below THEN 'below' END AS side,
         CASE WHEN target_low = target_high THEN target_low WHEN above THEN target_high WHEN below THEN target_low END AS edge FROM r0),
resolved AS (
  SELECT *, CASE WHEN status = 'missed' AND side IS NOT NULL THEN CASE WHEN (side = 'above') = higher_is_better THEN 'better' ELSE 'worse' END END AS direction,
         (reported_at - stated_at)::BIGINT AS days_to_falsifiable, (acknowledged_at - reported_at)::BIGINT AS days_to_acknowledged,
         CASE WHEN status = 'missed' AND edge <> 0 THEN abs(reported_value - edge) / abs(edge) END AS miss,
         CASE WHEN status = 'missed' AND edge <> 0 THEN (reported_value - edge) / edge END AS magnitude FROM r1)"""

_ORDINAL = "CASE coalesce(quarter, 4) WHEN 1 THEN 'first' WHEN 2 THEN 'second' WHEN 3 THEN 'third' ELSE 'fourth' END"
_LOW, _HIGH, _VALUE = "coalesce(target_low, target_high)::INT", "coalesce(target_high, target_low)::INT", "coalesce(reported_value, 7)::INT"
SENTENCES = f"""{STATEMENTS},
sentences AS (
  SELECT *, CASE part % 8
    WHEN 0 THEN 'Revenue for the ' || {_ORDINAL} || ' quarter of fiscal ' || fiscal_year || ' is expected to be $' || {_LOW} || ' million to $' || {_HIGH} || ' million.'
    WHEN 1 THEN 'GAAP gross margin outlook of ' || {_LOW} || '.' || line || '%, plus or minus ' || line || '0 basis points.'
    WHEN 2 THEN 'Q' || coalesce(quarter, 2) || ' FY' || substr(fiscal_year::VARCHAR, 3, 2) || ' operating expenses were $' || {_VALUE} || ',000 and below our guidance.'
    WHEN 3 THEN 'We are suspending our full-year ' || fiscal_year || ' guidance; tax rate (' || {_LOW} || ')%.'
    WHEN 4 THEN 'Comparable sales increased ' || {_VALUE} || ' percent, which exceeded our prior outlook.'
    WHEN 5 THEN 'Earnings per share of at least $' || {_LOW} || '.50 or more in ' || coalesce(quarter, 1) || 'Q' || substr(fiscal_year::VARCHAR, 3, 2) || '.'
    WHEN 6 THEN 'The board met twice.'
    ELSE {_VALUE} || ' ' || {_LOW} || ' ' || {_HIGH} || ' 12.5' END AS sentence FROM statements)"""
