"""Rows of the review queue at full width: the record of a draft, what a reviewer decides about it, and what helps them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import periods, rubric, wording
from ..sources import records as R
from .joins import join_within

# The columns of a queue beside those of the record.
REVIEWER_COLUMNS = ["approved", "hand_verified", "reviewer_note"]
FLAG_COLUMNS = ["conflict", "empty_block", "ack_pending_review", "change_pending_review"]
AID_COLUMNS = [
    "aid_proposed_status", "aid_capture_method", "aid_heading", "aid_lead_in", "aid_table_header", "aid_value_column", "aid_outcome_note", "aid_flag_note", "aid_withdrawal_note",
    "aid_verify", "aid_verify_reason", "aid_verify_class", "aid_suggested_note", "aid_ack_proposed_at", "aid_ack_proposed_excerpt", "aid_ack_proposed_url", "aid_ack_proposed_evidence",
    "aid_proposed_change", "aid_derived_snapshot", "aid_context",
]
BESIDE = REVIEWER_COLUMNS + FLAG_COLUMNS + AID_COLUMNS

DRAFT = (
    "draft_id string, company string, ticker string, cik string, conflict boolean, capture_method string, heading string, lead_in string, table_header string, "
    f"value_column string, parens_note string, context_before array<string>, assumption {R.ASSUMPTION}"
)
OUTCOME = (
    f"draft_id string, cik string, outcome {R.OUTCOME}, outcome_reason string, "
    f"acknowledgement struct<acknowledged_at:date,evidence:{R.EVIDENCE}>, withdrawal struct<withdrawn_at:date,period_close:date,evidence:{R.EVIDENCE}>"
)


def record_columns() -> list[str]:
    """Dotted names of a record's values, in the order of its schema."""
    return [name for name, _ in R.leaves(T.StructType.fromDDL(R.RECORD))]


def columns() -> list[str]:
    """All columns of a queue, in order."""
    return record_columns() + BESIDE


def proposable() -> list[str]:
    """What a new derivation may propose to change on a row that a person has touched."""
    own = [c for c in record_columns() if c.startswith("assumption.") and not c.startswith("assumption.evidence.")]
    return own + ["claim", "invalidation_condition", "aid_flag_note", "conflict"]


def snapshot(watched: list[str]) -> Column:
    """The named text columns as JSON, by name; absent cells are empty text."""
    names = sorted(watched)
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names]
    return F.to_json(F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*cells)))


def build_records(drafts: DataFrame, outcomes: DataFrame, today: Column, reviewer: str, within: str | None = None) -> DataFrame:
    """A record of each draft as nested columns, then ``found`` (what was searched for it) and ``draft`` (what helps a reviewer).

    ``drafts`` has the columns of ``DRAFT`` and ``outcomes`` those of ``OUTCOME``, one row a draft at most; a draft without one has not been searched.
    ``within`` may name a column that both have and a draft shares with its outcome, as its filing: they meet by it, and it is kept.
    """
    kept = [within] if within else []
    found = outcomes.select("draft_id", *kept, F.struct("outcome", "acknowledgement", "withdrawal", "outcome_reason").alias("found"))
    rows = join_within(drafts, found, within, "draft_id", "its").withColumn("found", F.col("its.found")) if within else drafts.join(found, "draft_id", "left")
    a, outcome, seen = (lambda n: F.col(f"assumption.{n}")), F.col("found.outcome"), F.col("found.acknowledgement")
    reported, acknowledged = F.col("found.outcome.reported_at"), F.col("found.acknowledgement.acknowledged_at")
    return rows.select(
        F.col("draft_id").alias("record_id"),
        "company",
        "ticker",
        "cik",
        wording.claim(F.col("company"), a("metric"), a("target_low"), a("target_high"), a("unit"), a("target_period")).alias("claim"),
        "assumption",
        outcome.alias("outcome"),
        wording.invalidation(a("target_low"), a("target_high")).alias("invalidation_condition"),
        F.lit("open").alias("status"),
        acknowledged.alias("acknowledged_at"),
        F.when(seen.isNotNull(), F.col("found.acknowledgement.evidence")).alias("acknowledgement_evidence"),
        rubric.days_between(a("stated_at"), reported).cast("int").alias("days_to_falsifiable"),
        rubric.days_between(reported, acknowledged).cast("int").alias("days_to_acknowledged"),
        today.alias("last_reviewed_at"),
        F.lit(reviewer).alias("reviewer"),
        "found",
        F.struct("conflict", "capture_method", "heading", "lead_in", "table_header", "value_column", "parens_note", "context_before").alias("draft"),
        *kept,
    )


def build_rows(drafts: DataFrame, outcomes: DataFrame, today: Column, reviewer: str, within: str | None = None) -> DataFrame:
    """The queue's row of each draft, all columns as text in their order; empty cells are null.

    A withdrawal counts when it was filed no later than the day its period closed; ``aid_context`` tells where the period came from when the
    excerpt of a sentence names none.  One join, and nothing else is shuffled.
    """
    rows = build_records(drafts, outcomes, today, reviewer, within)
    a, gone = (lambda n: F.col(f"assumption.{n}")), F.col("found.withdrawal")
    withdrawn = gone.isNotNull() & rubric.withdrawn_before_close(gone["withdrawn_at"], gone["period_close"])
    status = rubric.resolve(a("target_low"), a("target_high"), F.col("outcome.reported_value"), F.lit(True), F.lit(True), withdrawn)
    note = F.concat(
        F.lit("filed "), gone["withdrawn_at"].cast("string"), F.lit(", before the period closed on "), gone["period_close"].cast("string"), F.lit(" ("), gone["evidence"]["source_url"], F.lit("): "), gone["evidence"]["excerpt"]
    )
    spoken = F.trim(F.regexp_replace(F.array_join("draft.context_before", " "), r"\s+", " "))
    unnamed = (F.col("draft.capture_method") == "sentence") & (F.size(periods.parse_periods(a("evidence.excerpt"))) == 0)
    false = F.lit("false")
    own = {
        "approved": false,
        "hand_verified": false,
        "conflict": F.coalesce(F.col("draft.conflict"), F.lit(False)).cast("string"),
        "empty_block": false,
        "ack_pending_review": false,
        "change_pending_review": false,
        "aid_proposed_status": status,
        "aid_capture_method": F.col("draft.capture_method"),
        "aid_heading": F.col("draft.heading"),
        "aid_lead_in": F.col("draft.lead_in"),
        "aid_table_header": F.col("draft.table_header"),
        "aid_value_column": F.col("draft.value_column"),
        "aid_outcome_note": F.when(F.col("outcome").isNull(), F.coalesce(F.nullif("found.outcome_reason", F.lit("")), F.lit("outcome search not run"))),
        "aid_flag_note": F.col("draft.parens_note"),
        "aid_withdrawal_note": F.when(withdrawn, note),
        "aid_context": F.when(unnamed, F.nullif(spoken, F.lit(""))),
    }
    beside = [own.get(c, F.lit(None)).cast("string").alias(c) for c in BESIDE]
    flat = rows.select(*[F.col(c).cast("string").alias(c) for c in record_columns()], *beside)
    return flat.withColumn("aid_derived_snapshot", snapshot(proposable())).select(*[F.col(f"`{c}`") for c in columns()])


def queue_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What stages changed in the queue, a row for each record of ``after`` that is new or changed, and flags of what happened to it.

    Both are queues of text columns.  A new row counts as new alone; of others, an empty cell that is filled and a mark of a pending
    change or acknowledgement that was not there count.
    """
    watched = ["outcome.reported_value", "acknowledged_at", "aid_withdrawal_note", "change_pending_review", "ack_pending_review"]
    old = before.select("record_id", F.struct(*[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in watched]).alias("old"))
    rows = after.select("record_id", "cik", "empty_block", "aid_proposed_change", *[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in watched]).join(old, "record_id", "left")
    is_new = F.col("old").isNull()

    def filled(name: str) -> Column:
        return ~is_new & (F.coalesce(F.col(f"old.{name}"), F.lit("")) == "") & (F.coalesce(name, F.lit("")) != "")

    def raised(name: str) -> Column:
        return ~is_new & F.col(name).eqNullSafe("true") & ~F.col(f"old.{name}").eqNullSafe("true")

    proposed = F.coalesce(F.json_object_keys("aid_proposed_change"), F.array().cast("array<string>"))
    change, ack = raised("change_pending_review"), raised("ack_pending_review")
    flags = {
        "new_row": is_new & ~F.col("empty_block").eqNullSafe("true"),
        "new_flag": is_new & F.col("empty_block").eqNullSafe("true"),
        "outcome_attached": filled("outcome_reported_value"),
        "outcome_proposed": change & F.array_contains(proposed, "outcome.reported_value"),
        "ack_filled": filled("acknowledged_at"),
        "ack_proposed": ack,
        "withdrawal_filled": filled("aid_withdrawal_note"),
        "withdrawal_proposed": change & F.array_contains(proposed, "aid_withdrawal_note"),
        "proposal": change | ack,
    }
    return rows.select("record_id", "cik", *[f.alias(name) for name, f in flags.items()])
