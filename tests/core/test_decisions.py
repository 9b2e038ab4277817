"""Decisions and proposals on the queue, samples by kind, and keys that a schema does not know."""

import datetime
import random

from pyspark.sql import functions as F

from pledgewise.operators import decisions as D
from pledgewise.operators import sampling, validate
from pledgewise.sources import records as R

COLUMNS = ["low", "day", "reported_value"]
QUEUE = "record_id string, low double, day date, reported_value double, approved boolean, hand_verified boolean, note string, change_pending boolean, ack_pending boolean, empty_block boolean, proposed map<string,string>, decision_run string, other int"
DAY = datetime.date(2024, 1, 1)


def queue(spark, *rows):
    filled = [{"approved": None, "hand_verified": False, "note": "", "ack": False, "empty": False, "proposed": None} | r for r in rows]
    return spark.createDataFrame(
        [(f"r{k}", 1.0, DAY, None, r["approved"], r["hand_verified"], r["note"], r["proposed"] is not None, r["ack"], r["empty"], r["proposed"], None, k) for k, r in enumerate(filled)], QUEUE
    )


def said(spark, *rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "pos int, record_id string, decision string, note string")


def applied(q, decisions, run="1"):
    after, report = D.apply(q, decisions, COLUMNS, run)
    assert after.columns == q.columns and after.schema == q.schema
    return {r.record_id: r for r in after.collect()}, sorted((r.record_id, r.result) for r in report.collect()), after


def test_proposals_are_patched_once_and_rejections_are_remembered(spark):
    change = {"low": "2.5", "day": "2024-02-03", "reported_value": None}
    q = queue(spark, {"proposed": change}, {"proposed": {"low": "2.5", "day": "2024-02-03"}, "note": "seen"}, {"proposed": {"low": "much"}}, {"proposed": {"low": "3"}}, {})
    decisions = said(spark, ("r0", "Y", ""), ("r1", "n", "no "), ("r2", "y", ""), ("r3", "v", "x"))
    got, report, after = applied(q, decisions)
    assert (got["r0"].low, got["r0"].day, got["r0"].reported_value, got["r0"].change_pending, got["r0"].proposed) == (2.5, datetime.date(2024, 2, 3), None, False, None)
    assert got["r0"].note.startswith("proposed change applied [") and got["r0"].note.endswith("]: day, low, reported_value")
    assert got["r1"].low == 1.0 and got["r1"].note.startswith("seen; proposed change rejected [") and got["r1"].note.endswith("]: no")
    assert got["r2"].low == 1.0 and got["r2"].change_pending and got["r3"].change_pending
    assert report == [("r0", "applied"), ("r1", "applied"), ("r2", "a proposed value does not fit its column"), ("r3", "a change is pending: only y, n or s")]
    twice, report, _ = applied(after, decisions)
    assert twice == got and report[0] == ("r0", "already applied")
    fresh = spark.createDataFrame([("r1", 2.5, datetime.date(2024, 2, 3), None), ("r0", 9.0, DAY, 5.0)], "record_id string, low double, day date, reported_value double")
    told = F.create_map(F.lit("low"), F.lit("1.0"), F.lit("day"), F.lit("2024-01-01"), F.lit("reported_value"), F.lit(None).cast("string"))
    again = {r.record_id: r for r in D.propose(after.withColumns({"touched": F.lit(True), "snapshot": told}), fresh, COLUMNS).collect()}
    assert not again["r1"].change_pending  # the very proposal that was rejected
    assert again["r0"].proposed == {"low": "9.0", "reported_value": "5.0"}  # the day is what the pipeline said before
    assert not again["r3"].change_pending and not again["r4"].change_pending  # what no longer holds goes


def test_outcomes_are_proposed_once_and_signs_without_a_snapshot(spark):
    rows = spark.createDataFrame([("a", -1.0, DAY, 3.0, ""), ("b", 2.0, DAY, None, "")], "record_id string, low double, day date, reported_value double, note string")
    rows = rows.withColumns({"touched": F.lit(True), "snapshot": F.lit(None).cast("map<string,string>")})
    fresh = spark.createDataFrame([("a", 1.0, None, 4.0), ("b", 5.0, None, 4.0)], "record_id string, low double, day date, reported_value double")
    got = {r.record_id: r.proposed for r in D.propose(rows, fresh, COLUMNS).collect()}
    assert got == {"a": {"low": "1.0"}, "b": None}


def test_approvals_and_refusals(spark):
    q = queue(spark, {}, {"note": "seen"}, {"note": "Duplicate: x"}, {"note": "duplicate: x"}, {"empty": True}, {"empty": True}, {"ack": True}, {"ack": True}, {}, {}, {})
    decisions = [("r0", "y", ""), ("r1", "v", " "), ("r2", "y", "wrong period"), ("r3", "y", "it is fine"), ("r4", "y", "ok"), ("r5", "n", "not guidance"), ("r6", "n", "not guidance"), ("r7", "s", ""), ("r8", "n", "no"), ("r9", "q", ""), ("zz", "y", "x"), ("r10", "y", "first"), ("r10", "n", "duplicate")]
    got, report, _ = applied(q, said(spark, *decisions))
    assert report == sorted([
        ("r0", "approving needs a note"), ("r1", "applied"), ("r2", "rejected before, and the note does not replace it"), ("r3", "applied"), ("r4", "empty block"), ("r5", "applied"), ("r6", "an acknowledgement is pending"),
        ("r7", "skipped"), ("r8", "the note gives no reason of rejection"), ("r9", "unknown decision"), ("zz", "no such record"), ("r10", "applied"), ("r10", "decided more than once"),
    ])
    assert [(got[r].approved, got[r].hand_verified, got[r].note) for r in ("r1", "r3", "r5", "r10", "r0")] == [(True, True, "seen"), (True, False, "it is fine"), (False, False, "not guidance"), (True, False, "first"), (None, False, "")]


def test_samples_by_kind(spark):
    def plain(rows, k):
        def pick(items, n):
            return items if n >= len(items) else [items[int((i + 0.5) * len(items) / n)] for i in range(n)]

        a, b = [r for r in rows if r[2]], [r for r in rows if not r[2]]
        half = min(len(a), k // 2)
        other = min(len(b), k - half)
        return pick(a, min(len(a), k - other)) + pick(b, other)

    rng = random.Random(1)
    rows = [(key, at, rng.random() < share) for key, n, share in (("x", 40, 0.5), ("y", 30, 0.05), ("z", 30, 0.97), ("one", 1, 1.0), ("few", 5, 0.5)) for at in range(n)]
    df = spark.createDataFrame([(key, at, a, at // 7) for key, at, a in rows], "key string, at int, a boolean, part int")
    for k in (1, 2, 7, 12):
        got = sorted((r.key, r.at) for r in sampling.even_by_kind(df, "key", F.col("a"), F.col("part"), [F.col("at")], k).collect())
        assert got == sorted((r[0], r[1]) for key in {r[0] for r in rows} for r in plain([r for r in rows if r[0] == key], k))


def test_unknown_keys_at_every_level(spark):
    values = ['{"record_id": "a", "assumption": {"evidence": {"x.y": 1, "excerpt": "e"}, "Metric": 2}}', '{"outcome": null, "more": {"deep": 1}}', "{}", "no json", None, '{"acknowledgement_evidence": {"filed_at": "2024-01-01", "by": []}}']
    df = spark.createDataFrame(list(enumerate(values)), "n int, value string")
    got = sorted((r.n, r.key) for r in validate.unknown_keys(df, "value", R.RECORD).collect())
    assert got == [(0, "assumption.Metric"), (0, "assumption.evidence.x.y"), (1, "more"), (5, "acknowledgement_evidence.by")]
