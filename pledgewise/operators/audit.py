"""Audits and summaries: doubts about outcomes, two states of a queue compared, a run summed up, and what requests would cost."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chain import UNREAD

# Words that look ahead, numbers in text, ranges of numbers, and words of guidance in an excerpt.
KEYWORDS = ("expect", "guidance", "outlook", "forecast", "anticipate", "target")
NUMBER = r"\d[\d,]*(?:\.\d+)?"
RANGE = rf"(?i)(\$?\s*{NUMBER})\s*(?:%|percent)?\s*(?:to|through|-|–|—)\s*(\$?\s*{NUMBER})"
GUIDANCE = r"(?i)expect|guidance|outlook|approximately"
#: A number as a whole: not inside a longer one; a point or comma before no digit ends it.
WHOLE_NUMBER = r"(?<![\d.,])\d(?:\d|[.,](?=\d))*"
SCALES, PLACES = (1, 1000, 1_000_000), (0, 1, 2)


def printed_forms(value: Column) -> Column:
    """How a filing may print a value: without its sign, as it is or in thousands or millions of a smaller unit, with up to two decimals, with commas and without."""
    size = F.abs(F.regexp_replace(F.trim(value.cast("string")), r"^\$+|,", "").try_cast("double")).cast("decimal(26,8)")
    with_commas = F.array(*[F.format_number(size * F.lit(scale).cast("decimal(7,0)"), places) for scale in SCALES for places in PLACES])
    return F.array_union(with_commas, F.transform(with_commas, lambda x: F.replace(x, F.lit(","), F.lit(""))))


def _numbers(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def outcome_doubts(value: Column, excerpt: Column) -> Column:
    """Reasons to look at a reported value again: its excerpt looks ahead, prints it as an end of a range, or does not print it.

    A digit that follows the value directly may be a footnote's.  A value that is no number has no form, so it is missing.
    """
    text = F.coalesce(excerpt, F.lit(""))
    forms = F.coalesce(F.array_compact(printed_forms(value)), F.array().cast("array<string>"))
    words = F.array_compact(F.array(*[F.when(F.contains(F.lower(text), F.lit(k)), k) for k in KEYWORDS]))
    ends = F.transform(F.concat(_numbers(text, RANGE, 1), _numbers(text, RANGE, 2)), lambda x: F.regexp_replace(x, r"[$\s]", ""))
    loose = F.filter(_numbers(text, NUMBER), lambda x: (F.length(x) > 1) & x.rlike(r"\d$"))
    noted = F.transform(loose, lambda x: F.left(x, F.length(x) - 1))
    printed = F.arrays_overlap(_numbers(text, WHOLE_NUMBER), forms) | F.arrays_overlap(noted, forms)
    return F.array_compact(
        F.array(
            F.when(F.size(words) > 0, F.concat(F.lit("keyword:"), F.array_join(words, ","))),
            F.when(F.arrays_overlap(ends, forms), "range"),
            F.when(~printed, "value-missing"),
        )
    )


def audit_outcomes(rows: DataFrame, allowed: DataFrame, by: str) -> DataFrame:
    """Approved rows with a value and a doubt, counted by ``by`` with a total: flagged, allowed, and how many for each reason.

    ``rows``: record_id, approved, value, excerpt and ``by``; ``allowed``: ids that a person has looked at, any number of times.
    """
    looked_at = allowed.select("record_id").distinct().withColumn("allowed", F.lit(True))
    found = rows.where("approved and value is not null").withColumn("why", outcome_doubts(F.col("value"), F.col("excerpt"))).select("record_id", by, "why")
    found = found.join(looked_at, "record_id", "left")
    doubted, allow = F.size("why") > 0, F.col("allowed").isNotNull()
    counts = found.rollup(by).agg(
        F.count_if(doubted & ~allow).alias("flagged"),
        F.count_if(doubted & allow).alias("allowed"),
        F.count_if(~doubted).alias("clean"),
        F.count_if(F.exists("why", lambda w: w.startswith("keyword"))).alias("keyword"),
        F.count_if(F.array_contains("why", "range")).alias("in_range"),
        F.count_if(F.array_contains("why", "value-missing")).alias("value_missing"),
        F.grouping(by).alias("total"),
    )
    return counts.withColumn(by, F.when(F.col("total") == 1, "TOTAL").otherwise(F.col(by))).drop("total")


def compare_outcomes(before: DataFrame, after: DataFrame, found: DataFrame) -> DataFrame:
    """Outcomes of two states of a queue, by company with a total.

    ``before`` and ``after`` have ``record_id, company, approved, value, accession, excerpt``; ``found`` has ``record_id, value, accession`` of all drafts the
    pipeline has searched.  An outcome is the same where value and filing are.  ``pending``: approved before, and the pipeline now finds
    something else.  ``lost_guidance``: lost, and its excerpt reads like guidance.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("record_id", F.struct(*[c for c in rows.columns if c != "record_id"]).alias(name))

    both = side(before, "b").join(side(after, "a"), "record_id", "full_outer").join(side(found, "f"), "record_id", "left")
    kept = F.col("b").isNotNull() & F.col("a").isNotNull()
    was, has = F.col("b.value").isNotNull(), F.col("a.value").isNotNull()
    lost = kept & was & ~has
    other = was & has & ~(F.col("a.value").eqNullSafe(F.col("b.value")) & F.col("a.accession").eqNullSafe(F.col("b.accession")))
    now = F.col("f.value").isNotNull()
    moved = (was != now) | (was & now & ((F.col("b.value") != F.col("f.value")) | ~F.col("b.accession").eqNullSafe(F.col("f.accession"))))
    rows = both.withColumn("company", F.coalesce("a.company", "b.company"))
    counts = rows.rollup("company").agg(
        F.count_if(was).alias("before"),
        F.count_if(has).alias("after"),
        F.count_if(kept & ~was & has).alias("gained"),
        F.count_if(lost).alias("lost"),
        F.count_if(kept & other).alias("changed"),
        F.count_if(kept & F.col("b.approved") & F.col("f").isNotNull() & moved).alias("pending"),
        F.count_if(lost & F.col("b.excerpt").rlike(GUIDANCE)).alias("lost_guidance"),
        F.grouping("company").alias("total"),
    )
    return counts.withColumn("company", F.when(F.col("total") == 1, "TOTAL").otherwise(F.col("company"))).drop("total")


def refresh_summary(filings: DataFrame, candidates: DataFrame, changes: DataFrame) -> DataFrame:
    """A run by company (``cik``) with a total: new filings, candidates in them, and what the stages changed in the queue.

    ``filings`` and ``candidates`` have ``cik, accession`` (candidates of other filings do not count), ``changes`` is of ``queue.queue_changes``.
    Each input is counted before the counts meet.
    """
    new = filings.select("cik", "accession").distinct()
    kinds = [c for c in changes.columns if c not in ("record_id", "cik")]
    parts = [
        filings.groupBy("cik").agg(F.count("*").alias("filings")),
        candidates.join(new, ["cik", "accession"], "left_semi").groupBy("cik").agg(F.count("*").alias("candidates")),
        changes.groupBy("cik").agg(*[F.count_if(c).alias(c) for c in kinds]),
    ]
    stacked = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    counts = stacked.rollup("cik").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("filings", "candidates", *kinds)], F.grouping("cik").alias("total"))
    return counts.withColumn("cik", F.when(F.col("total") == 1, "TOTAL").otherwise(F.col("cik"))).drop("total")


def stage_spend(ledger: DataFrame, since: int) -> DataFrame:
    """Requests and dollars of each stage over the ledger's lines from ``since`` on."""
    return ledger.where(F.col("line") >= since).groupBy("stage").agg(F.sum("requests").alias("requests"), F.round(F.sum("usd"), 6).alias("usd"))


@dataclass(frozen=True)
class Prices:
    """Dollars a million tokens, the share that a batch costs, and what is left of a budget."""

    per_input: float
    per_output: float
    batch_share: float = 0.5
    budget: float = 0.0
    chars_per_token: int = 3

    def usd(self, tokens_in: Column, tokens_out: Column) -> Column:
        return (tokens_in * self.per_input + tokens_out * self.per_output) / 1_000_000 * self.batch_share


def project_costs(requests: DataFrame, expected_output: Column, committed: DataFrame, prices: Prices) -> DataFrame:
    """What each stage's requests would cost as a batch: expected, at worst, and whether the worst still fits its budget.

    ``requests`` has ``stage, system, user, schema, max_tokens``; ``expected_output`` is a stage's tokens of an answer; ``committed`` has ``stage, usd``.
    """
    chars = sum((F.length(F.coalesce(c, F.lit(""))) for c in ("system", "user", "schema")), F.lit(0))
    sums = requests.groupBy("stage").agg(F.count("*").alias("requests"), F.sum(F.ceil(chars / prices.chars_per_token)).alias("input_tokens"), F.sum("max_tokens").alias("max_output"))
    rows = sums.join(committed.groupBy("stage").agg(F.sum("usd").alias("committed")), "stage", "left").withColumn("committed", F.coalesce("committed", F.lit(0.0)))
    expected, worst = prices.usd(F.col("input_tokens"), expected_output * F.col("requests")), prices.usd(F.col("input_tokens"), F.col("max_output"))
    return rows.select("stage", "requests", "input_tokens", F.round(expected, 6).alias("usd_expected"), F.round(worst, 6).alias("usd_worst"), (worst <= F.lit(prices.budget) - F.col("committed")).alias("fits"))


def guard_funnel(candidates: DataFrame, derived: DataFrame, judged: DataFrame, decisions: DataFrame) -> DataFrame:
    """``step, stage, reason, n``: what was sent to the model, what came back, and where it was lost on its way to a release.

    ``candidates`` is what was asked, ``derived`` every item with its reason (an answer that could not be read gave no item), ``judged``
    the drafts' verdicts of ``dedupe``, and ``decisions`` has ``draft_id, approved`` (null: undecided) and ``published`` of kept drafts.
    """
    kept = judged.where("outcome = 'kept'").select("draft_id", "conflict").join(decisions, "draft_id", "left")
    approved = F.col("approved")

    def part(step: int, stage: str, rows: DataFrame, reason: Column | None = None) -> DataFrame:
        named = rows.select((F.lit(None).cast("string") if reason is None else reason).alias("reason"))
        return named.groupBy("reason").agg(F.count("*").alias("n")).select(F.lit(step).alias("step"), F.lit(stage).alias("stage"), "reason", "n")

    parts = [
        part(1, "sent", candidates),
        part(2, "returned", derived.where(~F.col("reason").eqNullSafe(UNREAD))),
        part(3, "rejected", derived.where("reason is not null"), F.col("reason")),
        part(4, "dropped", judged.where("outcome <> 'kept'"), F.col("outcome")),
        part(5, "conflicts", kept.where("conflict")),
        part(6, "review", kept),
        part(7, "rejected in review", kept.where(~approved)),
        part(8, "undecided", kept.where(approved.isNull())),
        part(9, "published", kept.where(approved & F.coalesce("published", F.lit(False)))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sector_coverage(companies: DataFrame) -> DataFrame:
    """``sector, companies, place`` of published companies, most first and then by name; a published company without a sector is an error.

    ``companies`` has ``cik, company, publish, sector``.
    """
    named = F.coalesce(F.nullif("sector", F.lit("")), F.raise_error(F.concat(F.lit("a published company has no sector: "), "company")).cast("string"))
    counts = companies.where("publish").select("cik", named.alias("sector")).groupBy("sector").agg(F.countDistinct("cik").alias("companies"))
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("companies"), "sector")))  # a row a sector
