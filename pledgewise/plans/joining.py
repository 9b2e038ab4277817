"""Join and set-operation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..dims import METRICS, Config
from ..functions import periods
from ..functions import text as T
from ..operators.joins import replace_by_id, replace_scope
from .registry import query
from .substrate import FILINGS, RESOLVED, SENTENCES, STATEMENTS, Tables

CONFIG = Config()


@query(
    "j1_answers_current",
    f"""WITH {STATEMENTS}, a AS (SELECT record_id, CASE WHEN part % 3 = 0 THEN 'old' WHEN part % 3 = 1 THEN 'new' ELSE 'stale' END AS fingerprint, supp FROM statements WHERE reviewed)
        SELECT s.record_id, a.fingerprint, a.supp AS answer FROM statements s JOIN a USING (record_id) WHERE a.fingerprint IN ('new', 'old')""",
)
def answers_current(t: Tables) -> DataFrame:
    """Answers whose fingerprint is the request's present or former one."""
    kind = F.when(F.col("part") % 3 == 0, "old").when(F.col("part") % 3 == 1, "new").otherwise("stale")
    answers = t.statements.where("reviewed").select("record_id", kind.alias("fingerprint"), F.col("supp").alias("answer"))
    return t.statements.select("record_id").join(answers.where(F.col("fingerprint").isin("new", "old")), "record_id")


#: By metric, what a line about it must say.
TERMS = {m: T.metric_pattern(m, CONFIG) for m, _, _ in METRICS}


def about_metrics(t: Tables) -> DataFrame:
    """``sentence_id, accession, sentence, metric``: sentences with a number, once for each metric that they are about."""
    rows = t.sentences.select(F.col("record_id").alias("sentence_id"), "accession", "sentence").where(F.size(T.numbers(F.col("sentence"))) > 0)
    return rows.withColumn("metric", F.explode(T.metrics_in(F.col("sentence"), CONFIG, list(TERMS))))


@query(
    "j4_sentence_metric",
    f"""WITH {SENTENCES}, x AS ({" UNION ALL ".join(f"SELECT record_id AS sentence_id, accession, '{m}' AS metric FROM sentences WHERE regexp_matches(lower(sentence), '{p}')" for m, p in TERMS.items())})
        SELECT s.record_id, x.sentence_id FROM statements s JOIN x USING (accession, metric)""",
)
def sentence_metric(t: Tables) -> DataFrame:
    """Drafts meet the sentences of their filing by the metrics each sentence was found to be about, once."""
    return t.statements.select("record_id", "accession", "metric").join(about_metrics(t), ["accession", "metric"]).select("record_id", "sentence_id")


@query("j7_outcomes", f"WITH {RESOLVED} SELECT s.record_id, o.reported_value, o.status FROM statements s LEFT JOIN (SELECT * FROM resolved WHERE status = 'missed') o USING (record_id)")
def outcomes(t: Tables) -> DataFrame:
    found = t.resolved.where("status = 'missed'").select("record_id", "reported_value", "status")
    return t.statements.select("record_id").join(found, "record_id", "left")


@query("j8_new_rows", f"WITH {STATEMENTS} SELECT record_id, 'queue' AS origin FROM statements WHERE part % 3 = 0 UNION ALL SELECT record_id, 'new' FROM statements WHERE part % 3 <> 0 AND supp % 2 = 0")
def new_rows(t: Tables) -> DataFrame:
    """Append-only: rows whose id is not in the queue yet join it."""
    queue = t.statements.where("part % 3 = 0").select("record_id", F.lit("queue").alias("origin"))
    fresh = t.statements.where("part % 3 = 0 or supp % 2 = 0").select("record_id", F.lit("new").alias("origin"))
    return queue.unionByName(fresh.join(queue, "record_id", "left_anti"))


@query(
    "j9_empty_blocks",
    f"""WITH {FILINGS}, answered AS (SELECT o_orderkey AS id, accession FROM filings WHERE http_status = 200), l AS (SELECT l_orderkey AS id, l_returnflag AS flag FROM lineitem),
        gone AS (SELECT id, list_sort(list_distinct(list(flag))) AS reasons FROM l WHERE flag = 'R' GROUP BY id)
        SELECT a.accession, coalesce(g.reasons, []) AS reasons FROM answered a LEFT JOIN gone g USING (id) WHERE a.id NOT IN (SELECT id FROM l WHERE flag IN ('A', 'N'))""",
)
def empty_blocks(t: Tables) -> DataFrame:
    """Answered blocks that gave no draft and no duplicate, with the reasons of what was rejected."""
    answered = t.filings.where("http_status = 200").select(F.col("o_orderkey").alias("id"), "accession")
    lines = t.read("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("flag"))
    reasons = lines.where("flag = 'R'").groupBy("id").agg(F.sort_array(F.collect_set("flag")).alias("reasons"))
    left = answered.join(lines.where("flag in ('A', 'N')"), "id", "left_anti").join(reasons, "id", "left")
    return left.select("accession", F.coalesce("reasons", F.expr("cast(array() as array<string>)")).alias("reasons"))


@query(
    "j11_evidence",
    f"""WITH {STATEMENTS}, docs AS (SELECT accession, http_status, cik FROM filings), e AS (SELECT record_id, accession FROM statements UNION ALL
        SELECT record_id, '0000000000-00-' || lpad((part % 9)::VARCHAR, 6, '0') FROM statements WHERE part % 40 = 0)
        SELECT e.record_id, e.accession, CASE WHEN d.accession IS NULL THEN 'missing' ELSE 'hash differs' END AS issue FROM e LEFT JOIN docs d USING (accession)
        WHERE d.accession IS NULL OR d.http_status <> 200""",
)
def evidence(t: Tables) -> DataFrame:
    """Evidence whose document is missing or differs; all evidences of a row meet the documents in one join."""
    made_up = F.when(F.col("part") % 40 == 0, F.concat(F.lit("0000000000-00-"), F.lpad((F.col("part") % 9).cast("string"), 6, "0")))
    rows = t.statements.select("record_id", F.explode(F.array_compact(F.array("accession", made_up))).alias("accession"))
    docs = t.filings.select(F.col("accession").alias("doc"), "http_status")
    met = rows.join(docs, F.col("accession") == F.col("doc"), "left")
    issue = F.when(F.col("doc").isNull(), "missing").when(F.col("http_status") != 200, "hash differs")
    return met.select("record_id", "accession", issue.alias("issue")).where("issue is not null")


@query(
    "j12_snapshot_diff",
    f"""WITH {STATEMENTS}, b AS (SELECT record_id, cik, target_low AS v FROM statements WHERE part % 7 <> 0), a AS (SELECT record_id, cik, CASE WHEN part % 11 = 0 THEN 0 ELSE target_low END AS v FROM statements WHERE part % 7 <> 1)
        SELECT coalesce(a.cik, b.cik) AS cik, count(*) FILTER (b.record_id IS NULL) AS added, count(*) FILTER (a.record_id IS NULL) AS dropped,
               count(*) FILTER (a.record_id IS NOT NULL AND b.record_id IS NOT NULL AND a.v IS DISTINCT FROM b.v) AS changed FROM a FULL JOIN b USING (record_id) GROUP BY 1""",
)
def snapshot_diff(t: Tables) -> DataFrame:
    before = t.statements.where("part % 7 <> 0").select("record_id", F.col("cik").alias("b_cik"), F.col("target_low").alias("b"))
    after = t.statements.where("part % 7 <> 1").select("record_id", F.col("cik").alias("a_cik"), F.when(F.col("part") % 11 == 0, 0.0).otherwise(F.col("target_low")).alias("a"))
    both = before.join(after, "record_id", "full_outer")
    changed = F.col("a_cik").isNotNull() & F.col("b_cik").isNotNull() & ~F.col("a").eqNullSafe(F.col("b"))
    return both.groupBy(F.coalesce("a_cik", "b_cik").alias("cik")).agg(F.count_if(F.col("b_cik").isNull()).alias("added"), F.count_if(F.col("a_cik").isNull()).alias("dropped"), F.count_if(changed).alias("changed"))


@query("j13_allowlist", f"WITH {RESOLVED} SELECT company, count(*) FILTER (part % 6 <> 0) AS flagged, count(*) FILTER (part % 6 = 0) AS allowed FROM resolved WHERE miss > 0.05 GROUP BY company")
def allowlist(t: Tables) -> DataFrame:
    allowed = t.statements.where("part % 6 = 0").select("record_id", F.lit("known").alias("why"))
    return t.resolved.where("miss > 0.05").join(allowed, "record_id", "left").groupBy("company").agg(F.count_if(F.col("why").isNull()).alias("flagged"), F.count("why").alias("allowed"))


@query(
    "j15_decisions",
    f"""WITH {STATEMENTS}, d AS (SELECT CASE WHEN part % 10 = 0 THEN accession ELSE record_id END AS record_id, CASE WHEN supp % 5 = 0 THEN 'x' ELSE 'y' END AS decision, k * 1000 + supp AS seq
        FROM statements, (VALUES (1), (2)) AS k(k) WHERE k = 1 OR part % 4 = 0)
        SELECT CASE WHEN record_id NOT IN (SELECT record_id FROM statements) THEN 'unknown id' WHEN n > 1 THEN 'repeated id' WHEN decision = 'x' THEN 'bad decision' ELSE 'applied' END AS outcome, count(*) AS n
        FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY seq) AS n FROM d) GROUP BY 1""",
)
def decisions(t: Tables) -> DataFrame:
    """A decisions file against the queue: the first row of an id counts; the rest are warnings."""
    rows = t.statements.withColumn("k", F.explode(F.when(F.col("part") % 4 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    rows = rows.select(
        F.when(F.col("part") % 10 == 0, F.col("accession")).otherwise(F.col("record_id")).alias("record_id"),
        F.when(F.col("supp") % 5 == 0, "x").otherwise("y").alias("decision"),
        (F.col("k") * 1000 + F.col("supp")).alias("seq"),
    )
    return apply_decisions(rows, t.statements).groupBy("outcome").agg(F.count("*").alias("n"))


def apply_decisions(decisions: DataFrame, queue: DataFrame) -> DataFrame:
    """Each row of ``record_id, decision, seq`` with what becomes of it."""
    ranked = decisions.withColumn("n", F.row_number().over(Window.partitionBy("record_id").orderBy("seq")))
    ranked = ranked.join(queue.select("record_id", F.lit(True).alias("known")), "record_id", "left")
    outcome = F.when(F.col("known").isNull(), "unknown id").when(F.col("n") > 1, "repeated id").when(~F.col("decision").isin("y", "n", "s", "v"), "bad decision").otherwise("applied")
    return ranked.withColumn("outcome", outcome)


_KEY = "cik, metric, target_period, stated_at"


@query(
    "j16_points_in_ranges",
    f"""WITH {STATEMENTS} SELECT p.record_id AS point_id, min(r.record_id) AS range_id FROM statements p JOIN statements r USING ({_KEY})
        WHERE p.target_low = p.target_high AND NOT coalesce(r.target_low = r.target_high, false) AND (r.target_low IS NULL OR p.target_low >= r.target_low)
          AND (r.target_high IS NULL OR p.target_low <= r.target_high) GROUP BY 1""",
)
def points_in_ranges(t: Tables) -> DataFrame:
    """The first range of a point's key that holds it; figures meet figures, each once, and points learn their figure's range."""
    keys = ["cik", "metric", "target_period", "stated_at"]
    point = F.col("target_low").eqNullSafe(F.col("target_high"))
    points = t.statements.where(point).select(*keys, F.col("record_id").alias("point_id"), F.col("target_low").alias("at"))
    ranges = t.statements.where(~point).groupBy(*keys, "target_low", "target_high").agg(F.min("record_id").alias("range_id"))
    held = (F.col("target_low").isNull() | (F.col("at") >= F.col("target_low"))) & (F.col("target_high").isNull() | (F.col("at") <= F.col("target_high")))
    found = points.select(*keys, "at").distinct().join(ranges, keys).where(held).groupBy(*keys, "at").agg(F.min("range_id").alias("range_id"))
    return points.join(found, [*keys, "at"]).select("point_id", "range_id")


@query("j17_conflict_pairs", f"WITH {STATEMENTS} SELECT a.record_id AS first_id, b.record_id AS second_id FROM statements a JOIN statements b USING ({_KEY}) WHERE a.record_id < b.record_id AND (a.target_low IS DISTINCT FROM b.target_low OR a.target_high IS DISTINCT FROM b.target_high)")
def conflict_pairs(t: Tables) -> DataFrame:
    """Pairs of records on one key that state different numbers.

    Records are moved and sorted once, for both sides of one join, and a pair is given out where it is made: pairs are many times the
    records, so they are never moved.
    """
    records = t.statements.select("cik", "metric", "target_period", "stated_at", "target_low", "target_high", "record_id")
    a, b = records.alias("a"), records.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("cik", "metric", "target_period", "stated_at")]
    differ = ~(F.col("a.target_low").eqNullSafe(F.col("b.target_low")) & F.col("a.target_high").eqNullSafe(F.col("b.target_high")))
    met = a.join(b, [*same, F.col("a.record_id") < F.col("b.record_id"), differ])
    return met.select(F.col("a.record_id").alias("first_id"), F.col("b.record_id").alias("second_id"))


@query("u1_union_priority", f"WITH {STATEMENTS} SELECT record_id, CASE WHEN part % 2 = 0 THEN 'fresh' ELSE 'stub' END AS origin FROM statements WHERE part % 2 = 0 OR part % 3 = 0")
def union_priority(t: Tables) -> DataFrame:
    """Fresh drafts and stubs rebuilt from the queue; fresh wins by id."""
    fresh = t.statements.where("part % 2 = 0").select("record_id", F.lit("fresh").alias("origin"))
    stubs = t.statements.where("part % 3 = 0").select("record_id", F.lit("stub").alias("origin"))
    return fresh.unionByName(stubs).groupBy("record_id").agg(F.min("origin").alias("origin"))


@query("u2_except", f"WITH {FILINGS} SELECT accession FROM filings WHERE form = '8-K' AND http_status = 200 EXCEPT SELECT accession FROM filings WHERE kind = 'F'")
def except_known(t: Tables) -> DataFrame:
    known = t.filings.where("kind = 'F'").select("accession")
    return t.filings.where("form = '8-K' and http_status = 200").select("accession").distinct().join(known, "accession", "left_anti")


@query("u3_intersect", f"WITH {FILINGS}, asked AS (SELECT accession FROM filings WHERE o_orderkey % 9 = 0 UNION SELECT 'none') SELECT accession, accession IN (SELECT accession FROM filings) AS known FROM asked")
def intersect(t: Tables) -> DataFrame:
    """Asked-for ids, and which of them exist."""
    asked = t.filings.where("o_orderkey % 9 = 0").select("accession").union(t.spark.createDataFrame([("none",)], "accession string")).distinct()
    known = t.filings.select("accession")
    return asked.intersect(known).withColumn("known", F.lit(True)).union(asked.join(known, "accession", "left_anti").withColumn("known", F.lit(False)))


@query("u4_represented", f"WITH {STATEMENTS} SELECT DISTINCT accession FROM statements WHERE part % 2 = 0 OR supp % 5 = 0")
def represented(t: Tables) -> DataFrame:
    return t.statements.where("part % 2 = 0").select("accession").union(t.statements.where("supp % 5 = 0").select("accession")).distinct()


@query("s10_discover", f"WITH {FILINGS} SELECT DISTINCT accession, form FROM filings WHERE form IN ('8-K', '10-Q') AND filed_at BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND o_orderkey % 13 <> 0")
def discover(t: Tables) -> DataFrame:
    """Exact forms in an inclusive range of days that are not known yet, one row an accession."""
    skip = t.filings.where("o_orderkey % 13 = 0").select("accession")
    asked = t.filings.where(F.col("form").isin("8-K", "10-Q") & F.col("filed_at").between("1996-01-01", "1999-12-31"))
    return asked.join(skip, "accession", "left_anti").select("accession", "form").dropDuplicates(["accession"])


@query("s12_pick_document", "SELECT l_orderkey AS filing, arg_min(l_linenumber, (CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) * 100 + l_linenumber)::INT AS position FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY 1")
def pick_document(t: Tables) -> DataFrame:
    """One document a filing: the preferred type, then the first on the page."""
    rank = F.when(F.col("l_returnflag") == "A", 0).otherwise(1) * 100 + F.col("l_linenumber")
    return t.read("lineitem").where(F.col("l_returnflag").isin("A", "N")).groupBy(F.col("l_orderkey").alias("filing")).agg(F.min_by("l_linenumber", rank).alias("position"))


@query("s13_replace_scope", f"WITH {FILINGS} SELECT accession, CASE WHEN o_orderkey % 10 = 0 THEN 'new' ELSE 'old' END AS origin FROM filings WHERE NOT (o_orderkey % 10 = 0 AND o_orderkey % 20 <> 0)")
def scoped_merge(t: Tables) -> DataFrame:
    old = t.filings.select("accession", "o_orderkey", F.lit("old").alias("origin"))
    scope = t.filings.where("o_orderkey % 10 = 0").select("accession")
    new = t.filings.where("o_orderkey % 20 = 0").select("accession", "o_orderkey", F.lit("new").alias("origin"))
    return replace_scope(old, new, scope, ["accession"]).select("accession", "origin")


@query(
    "s14_replace_by_id",
    """WITH o AS (SELECT event_id AS pos, user_id AS id, value AS v FROM events), n AS (SELECT event_id AS pos, user_id AS id, value + 1 AS v FROM events WHERE user_id % 5 = 0 AND event_id % 2 = 0),
       ids AS (SELECT DISTINCT id FROM o WHERE id % 5 = 0), ro AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM o), rn AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM n)
       SELECT pos, id, v FROM o WHERE id NOT IN (SELECT id FROM ids) UNION ALL
       SELECT coalesce(ro.pos, rn.pos + (SELECT max(pos) FROM o) + 1), rn.id, rn.v FROM rn LEFT JOIN ro ON ro.id = rn.id AND ro.k = rn.k""",
)
def merge_in_place(t: Tables) -> DataFrame:
    old = t.read("events").select(F.col("user_id").alias("id"), F.col("event_id").alias("pos"), F.col("value").alias("v"))
    new = old.where("id % 5 = 0 and pos % 2 = 0").withColumn("v", F.col("v") + 1)
    return replace_by_id(old, new, old.where("id % 5 = 0"), "id").select("pos", "id", "v")


@query(
    "x7_fiscal_windows",
    f"""WITH {RESOLVED} SELECT cik, target_period, count(*) AS statements, count(*) FILTER (status = 'missed') AS missed FROM resolved GROUP BY ALL""",
)
def fiscal_windows(t: Tables) -> DataFrame:
    """Tumbling windows are the companies' own fiscal quarters and years."""
    label = periods.format_period(F.col("quarter"), F.col("fiscal_year")).alias("target_period")
    return t.resolved.groupBy("cik", label).agg(F.count("*").alias("statements"), F.count_if(F.col("status") == "missed").alias("missed"))
