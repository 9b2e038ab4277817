import random
from datetime import date, timedelta
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pledgewise.dims import Config
from pledgewise.operators import candidates, dedupe, joins, orderstats, review
from pledgewise.operators.joins import interval_join, replace_scope
from pledgewise.plans.joining import conflict_pairs
from pledgewise.plans.substrate import Tables
from pledgewise.sources import filings, records
from pledgewise.streaming import incremental

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("closed", [False, True])
def test_interval_join_is_brute_force(spark, closed):
    rng, day = random.Random(2), date(2020, 1, 1)
    left = [(i, rng.choice("ab"), day + timedelta(rng.randrange(900)), rng.choice([None, 0, 30, 550, -5])) for i in range(150)]
    left = [(i, k, lo, None if n is None else lo + timedelta(n)) for i, k, lo, n in left]
    right = [(100 + i, rng.choice("ab"), rng.choice([None, day + timedelta(rng.randrange(1500))])) for i in range(200)]
    a, b = spark.createDataFrame(left, "i int, k string, lo date, hi date"), spark.createDataFrame(right, "j int, k string, at date")
    got = {(r.i, r.j) for r in interval_join(a, b, "k", F.col("lo"), F.col("hi"), "at", closed).collect()}
    want = {(i, j) for i, k, lo, hi in left for j, q, at in right if k == q and hi and at and (lo <= at if closed else lo < at) and at <= hi}
    assert got == want


DRAFT = "cik string, metric string, target_period string, stated_at date, capture_method string, char_start int, item_index int, draft_id string, target_low double, target_high double, unit string"


def draft(name, low, high, unit="USD millions", method="sentence", at=0):
    return ("1", "revenue", "FY2024", date(2024, 2, 1), method, at, 0, name, low, high, unit)


def verdicts(spark, drafts):
    return {r.draft_id: (r.outcome, r.kept_by, r.conflict) for r in dedupe.dedupe(spark.createDataFrame(drafts, DRAFT)).collect()}


def test_dedupe(spark):
    got = verdicts(spark, [draft("a", 5.0, 6.0, at=3), draft("b", 5.0, 6.0, method="section"), draft("p", 5.5, 5.5, at=1)])
    assert got == {"a": ("kept", "a", False), "b": ("duplicate", "a", False), "p": ("point in range", "a", False)}
    got = verdicts(spark, [draft("a", 5.0, 6.0), draft("b", 7.0, 8.0, at=1)])
    assert got == {"a": ("kept", "a", True), "b": ("kept", "b", True)}
    got = verdicts(spark, [draft("a", 1.52, 1.52, "USD billions"), draft("b", 1515.0, 1515.0, at=1), draft("c", 1400.0, 1400.0, at=2)])
    assert [got[x][0] for x in "abc"] == ["kept", "duplicate", "kept"] and got["c"][2]
    got = verdicts(spark, [draft("f", 5.0, None), draft("p", 6.0, 6.0, at=1), draft("q", 4.0, 4.0, at=2)])
    assert [got[x][0] for x in "fpq"] == ["kept", "point in range", "kept"]


def test_dedupe_keeps_every_draft_once(spark):
    rng = random.Random(5)
    drafts = [draft(f"d{i}", rng.choice([None, 1.0, 2.0]), rng.choice([1.0, 2.0, 3.0]), rng.choice(["USD millions", "USD billions", "percent"]), rng.choice(["sentence", "section"]), i) for i in range(40)]
    got = verdicts(spark, drafts)
    assert set(got) == {d[7] for d in drafts} and all(got[k][0] == "kept" for _, k, _ in got.values() if got[k][0] != "point in range")


def test_join_within_meets_by_the_coarser_key_and_moves_nothing_again(spark):
    rows = [(k // 3, f"k{k}", k) for k in range(30)] + [(None, "n", 5)]
    both = spark.createDataFrame(rows, "filing int, id string, v int").repartition(4, "filing")
    left, right = both.drop("v"), both.where("v % 4 <> 1")
    got = {r.id: r.its and r.its.v for r in joins.join_within(left, right, "filing", "id", "its").collect()}
    assert got == {i: v if v % 4 != 1 else None for _, i, v in rows}
    met = joins.join_within(left.hint("merge"), right, "filing", "id", "its")
    assert met._jdf.queryExecution().sparkPlan().toString().count("ENSURE_REQUIREMENTS") == 0 and str(met._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning(filing") == 2


def test_files_of_the_queue_are_compressed(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a", 'x "y",\nz'), ("2", "b", "")], "cik string, record_id string, note string")
    records.write_queue(rows, f"{tmp_path}/queue")
    records.write_by_company(rows, f"{tmp_path}/companies")
    files = [p.name for folder in ("queue", "companies") for p in (tmp_path / folder).rglob("part-*")]
    assert files and all(name.endswith(".gz") for name in files)
    assert {r.note for r in records.read_queue(spark, f"{tmp_path}/queue").collect()} == {'x "y",\nz', None}


SCALES = {"USD": 1.0, "USD thousands": 1e3, "USD millions": 1e6, "USD billions": 1e9}


def plain_verdicts(drafts):
    """The rule of deduplication, pair by pair."""
    ranked = sorted((d for d in drafts), key=lambda d: (d[4] != "sentence", d[5], d[6], d[7]))

    def room(x, unit):
        return SCALES[unit] * 10.0 ** -max(len(f"{x:.10f}".rstrip("0").split(".")[1]), 1) / 2 * (1 + 1e-9)

    def same(x, y):
        for a, b in zip(x[8:10], y[8:10], strict=True):
            if a is None or b is None:
                ok = a is b
            elif x[10] == y[10]:
                ok = round(a, 6) == round(b, 6)
            else:
                ok = x[10] in SCALES and y[10] in SCALES and abs(a * SCALES[x[10]] - b * SCALES[y[10]]) <= max(room(a, x[10]), room(b, y[10]))
            if not ok:
                return False
        return True

    def holds(r, p):
        return r[10] == p[10] and (r[8] is None or r[8] <= p[8]) and (r[9] is None or p[8] <= r[9])

    point = [d[8] is not None and d[8] == d[9] for d in ranked]
    holder = [next((r[7] for r, q in zip(ranked, point, strict=True) if not q and holds(r, d)), None) if p else None for d, p in zip(ranked, point, strict=True)]
    leaders = []
    for d, h in zip(ranked, holder, strict=True):
        if h is None and not any(same(x, d) for x in leaders):
            leaders.append(d)
    out = {}
    for d, h in zip(ranked, holder, strict=True):
        first = h or next(x[7] for x in leaders if same(x, d))
        kind = "point in range" if h else "kept" if first == d[7] else "duplicate"
        out[d[7]] = (kind, first, kind == "kept" and len(leaders) > 1)
    return out


def test_dedupe_is_the_rule_pair_by_pair(spark, monkeypatch):
    rng = random.Random(11)
    units = [*SCALES, "percent"]

    def some(i):
        unit, x = rng.choice(units), rng.choice([1.0, 1.52, 1.515, 1515.0, 1515.04, 1520.0, 2.0, 2.0000001])
        x = x / 1e3 if unit == "USD billions" and x > 1000 else x
        high = rng.choice([x, x, None, x + 1, x + 0.04])
        return draft(f"d{i:03}", rng.choice([x, x, None]), high, unit, rng.choice(["sentence", "section"]), rng.randrange(9))

    for n in (3, 40, 250):
        drafts = [some(i) for i in range(n)]
        assert verdicts(spark, drafts) == plain_verdicts(drafts)
    monkeypatch.setattr(dedupe, "PAIRS", 3)  # the same in steps of three pairs
    u, low = np.array([1, 2, 1, 2, 1]), np.array([5.0, 5.0, 6.0, 5.04, 4.0])
    assert sorted(dedupe.near_pairs(u, np.array([low, low]), np.full((2, 5), 0.05))) == [(0, 1), (0, 3)]
    assert dedupe.first_ranges(np.array([1, 1, 1, 2]), np.array([5.0, np.nan, 4.0, 5.0]), np.array([5.0, 9.0, 6.0, 5.0])).tolist() == [1, -1, -1, -1]


def test_dedupe_meets_only_figures_that_are_near():
    n = 20_000  # of one key: pair by pair they would be 200 million
    value = np.arange(n) * 1e6
    assert len(dedupe.near_pairs(np.arange(n) % 2, np.array([value, value]), np.full((2, n), 5e4))) == 0
    assert (dedupe.first_leaders(np.zeros(n), np.array([value, value]), np.array([value, value]), np.full((2, n), 5e4)) == np.arange(n)).all()


def test_refresh_never_overwrites_a_person(spark):
    columns = ["a"]
    queue = spark.createDataFrame([("1", 1.0, True, "", {"a": "0.0"}), ("2", 1.0, False, "", {"a": "1.0"}), ("3", 5.0, True, "", {"a": "2.0"})], "record_id string, a double, touched boolean, note string, snapshot map<string,string>")
    fresh = spark.createDataFrame([("1", 2.0), ("2", 3.0), ("3", 2.0), ("4", 9.0)], "record_id string, a double")
    once = review.refresh(queue, fresh, columns)
    got = {r.record_id: r for r in once.collect()}
    assert (got["1"].a, got["1"].proposal) == (1.0, "a=2.0") and (got["2"].a, got["2"].proposal) == (3.0, None)
    assert (got["3"].a, got["3"].proposal) == (5.0, None) and got["4"].added
    again = {r.record_id: r.a for r in review.refresh(once.drop("proposal", "added"), fresh, columns).collect()}
    assert again == {k: r.a for k, r in got.items()}


def test_replace_scope_twice_is_once(spark):
    old = spark.createDataFrame([(1, "o"), (2, "o")], "k int, v string")
    new = spark.createDataFrame([(2, "n"), (2, "m")], "k int, v string")
    once = replace_scope(old, new, new, ["k"])
    assert sorted(once.collect()) == sorted(replace_scope(once, new, new, ["k"]).collect()) == [(1, "o"), (2, "m"), (2, "n")]


def test_candidates(spark):
    html = "<p>We will provide the following:</p><h2>Financial Outlook</h2><p>Revenue</p><p>$5.0 billion</p><h2>Conference Call</h2><p>We expect growth of 3 percent.</p><p>We expect rain.</p>"
    found = candidates.candidates(spark.createDataFrame([("a", "8-K", html), ("b", "10-Q", html), ("c", "8-K", None)], "accession string, form string, html string"), Config()).collect()
    sections = [r for r in found if r.capture_method == "section"]
    assert [(r.accession, r.sentence, r.lead_in) for r in sections] == [("a", "Revenue\n$5.0 billion", "We will provide the following:")]
    assert sorted((r.accession, r.sentence) for r in found if r.capture_method == "sentence") == [("a", "We expect growth of 3 percent."), ("b", "We expect growth of 3 percent.")]


def test_cache_and_feed(spark, tmp_path):
    import hashlib
    import json

    (tmp_path / "1").mkdir()
    for name, status, stored in (("a", 200, None), ("b", 200, "0" * 64), ("c", 404, None)):
        body = f"<p>{name}</p>".encode()
        (tmp_path / "1" / f"{name}.html").write_bytes(body)
        (tmp_path / "1" / f"{name}.json").write_text(json.dumps({"cik": "1", "accession": name, "http_status": status, "raw_sha256": stored or hashlib.sha256(body).hexdigest().upper()}))
    got = {r.accession: r.issue for r in filings.integrity(filings.read_cache(spark, str(tmp_path))).collect()}
    assert got == {"a": None, "b": "hash_mismatch"}
    entry_xml = "<entry><content><accession-number>%s</accession-number><filing-type>8-K</filing-type><filing-date>2024-02-0%d</filing-date><filing-href>u</filing-href><items-desc>items 2.02 and 9.01</items-desc></content></entry>"
    (tmp_path / "feed.xml").write_text("<feed>" + entry_xml % ("x", 1) + "<entry><content></content></entry></feed>")
    assert [(r.accession, r.items) for r in filings.read_feed(spark, str(tmp_path / "feed.xml")).collect()] == [("x", ["2.02", "9.01"])]


def test_records(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"record_id": "1"}\n\n{"record_id": "2", "other": 1}\n{bad\n')
    assert sorted(r.valid for r in records.read_jsonl(spark, str(tmp_path / "r.jsonl")).collect()) == [False, False, True]
    queue = spark.createDataFrame([("1", 'say "hi"\nthere'), ("2", "")], "record_id string, note string")
    records.write_queue(queue, str(tmp_path / "q"))
    assert sorted((r.record_id, r.note) for r in records.read_queue(spark, str(tmp_path / "q")).collect())[0] == ("1", 'say "hi"\nthere')
    assert not records.write_unless_empty(queue.where("false"), str(tmp_path / "e"))


def test_watermarks(spark):
    marks = spark.createDataFrame([("1", date(2024, 1, 5), ["a"]), ("2", date(2024, 1, 5), ["b"])], "cik string, last_filing_date date, accessions_on_last_date array<string>")
    run = spark.createDataFrame([("1", "c", date(2024, 1, 5), True), ("2", "d", date(2024, 1, 9), False), ("3", "e", date(2024, 1, 2), True)], "cik string, accession string, filed_at date, ok boolean")
    assert sorted(map(tuple, incremental.advance(marks, run).collect())) == [("1", date(2024, 1, 5), ["a", "c"]), ("2", date(2024, 1, 5), ["b"]), ("3", date(2024, 1, 2), ["e"])]
    assert [r.accession for r in incremental.unseen(run.select("cik", "accession", "filed_at"), marks).orderBy("accession").collect()] == ["c", "d", "e"]


def test_stream_equals_batch(spark):
    queries = entry.queries()
    a = sorted(map(tuple, queries["x5_track_stream"](spark, SF).select("user_id", "guided", "reported", "result").collect()))
    b = sorted(map(tuple, queries["x5_track_batch"](spark, SF).select("user_id", "guided", "reported", "result").collect()))
    assert a == b and a


def test_sentences_hold_all_words(spark):
    """Random texts: spans are ordered, verbatim, and leave nothing but spaces, line ends and bullets out."""
    rng = random.Random(8)
    texts = ["".join(rng.choices(list("ab.!? \n•U1\"") + ["Inc. ", "e.g. "], k=rng.randint(0, 40))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "accession int, text string")
    found = {}
    for r in candidates.sentences(rows).collect():
        found.setdefault(r.accession, []).append((r.char_start, r.char_end, r.sentence))
    for i, said in enumerate(texts):
        spans = sorted(found.get(i, []))
        assert all(said[a:b] == s and a < b for a, b, s in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
        left = list(said)
        for a, b, _ in spans:
            left[a:b] = [" "] * (b - a)
        assert not set("".join(left)) & set("abU1IncegI")


@pytest.mark.parametrize("same_day", [False, True])
def test_next_rows_is_brute_force(spark, same_day):
    rng, day = random.Random(4), date(2020, 1, 1)
    left = [(i, rng.choice("ab"), rng.choice([None, day + timedelta(rng.randrange(300))])) for i in range(120)]
    right = [(f"r{i:03}", rng.choice("abc"), rng.choice([None, day + timedelta(rng.randrange(300))])) for i in range(90)]
    a, b = spark.createDataFrame(left, "i int, k string, at date"), spark.createDataFrame(right, "j string, k string, day date")
    got = {(r.i, r.rank, r.j) for r in joins.next_rows(a, b, ["k"], "at", "day", "j", 3, same_day).collect()}
    want = set()
    for i, k, at in left:
        later = sorted((d, j) for j, q, d in right if q == k and d and at and (d >= at if same_day else d > at))
        want |= {(i, n, j) for n, (_, j) in enumerate(later[:3], 1)}
    assert got == want
    counts = {r.i: r.n for r in joins.counted_before(a, b, ["k"], "at", "day", "n", same_day).collect()}
    assert counts == {i: sum(1 for _, q, d in right if q == k and d and at and (d <= at if same_day else d < at)) for i, k, at in left}


def test_ranked_in_parts(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice("ab"), rng.randrange(40), rng.random()) for i in range(200)]
    df = joins.ranked_in_parts(spark.createDataFrame(rows, "i int, k string, day int, x double"), ["k"], [F.floor(F.col("day") / 10)], [F.col("day"), F.col("x")], "n")
    for key in "ab":
        own = sorted((d, x, i) for i, k, d, x in rows if k == key)
        assert {r.i: r.n for r in df.where(F.col("k") == key).collect()} == {i: n for n, (_, _, i) in enumerate(own, 1)}


def test_value_at(spark, monkeypatch):
    """An outlier puts nearly all values in one span, which is narrowed until few are left."""
    monkeypatch.setattr(orderstats, "FEW", 5)
    rng = random.Random(7)
    values = [(rng.choice([rng.random(), rng.random() * 1e-6, 0.25]), rng.randint(1, 3)) for _ in range(300)] + [(1e12, 1), (-1e9, 2)]
    df = spark.createDataFrame(values, "v double, n long").cache()
    flat = sorted(v for v, n in values for _ in range(n))
    for at in (0, 1, 2, 50, 300, len(flat) - 2, len(flat) - 1):
        assert orderstats.value_at(df, "v", "n", at) == flat[at]
    assert orderstats.value_at(df, "v", "n", len(flat)) is None and orderstats.value_at(df.where("false"), "v", "n", 0) is None


def test_blocks_are_brute_force(spark):
    rng, config = random.Random(3), Config(block_lines=6)
    docs = [[rng.choice([None] * 5 + ["heading", "end-heading", "gap"]) for _ in range(rng.randint(0, 40))] for _ in range(80)]
    rows = spark.createDataFrame([(d, n, s) for d, stops in enumerate(docs) for n, s in enumerate(stops)], "accession int, line_no int, stop string")
    got = {(r.accession, r.heading_no, r.end_no, r.reason) for r in candidates.block_lines(rows, config).where("line_no = heading_no").collect()}
    members = {(r.accession, r.line_no, r.heading_no) for r in candidates.block_lines(rows, config).where("heading_no is not null").collect()}
    want, inside = set(), set()
    for d, stops in enumerate(docs):
        for h in (n for n, s in enumerate(stops) if s == "heading"):
            following = next((n for n in range(h + 1, len(stops)) if stops[n]), None)
            most = h + config.block_lines + 1
            end = min(len(stops) if following is None else following, most, len(stops))
            reason = "max" if most < len(stops) and most <= (len(stops) if following is None else following) else stops[following] if following is not None else "eof"
            if end > h + 1:
                want.add((d, h, end, reason))
                inside |= {(d, n, h) for n in range(h, end)}
    assert got == want and members == inside


def test_merged_tables(spark, tmp_path):
    """Batches replace the rows of their keys; a batch that runs twice changes nothing."""
    table, schema = f"{tmp_path}/t", "id long, v string"
    for number, rows in enumerate([[(1, "a"), (2, "a")], [(2, "b"), (3, "b"), (3, "c")], [(1, "d")]]):
        for _ in range(2):
            incremental.merge_batches(table, ["id"])(spark.createDataFrame(rows, schema), number)
    now = incremental.merged(spark, table, spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, now.collect())) == [(1, "d"), (2, "b"), (3, "b"), (3, "c")]


def test_conflict_pairs_are_of_records(spark):
    """Every record of a figure meets every record of another one on its key; records that agree do not meet."""
    figures = [(5.0, 6.0)] * 3 + [(7.0, None)] * 2 + [(None, None), (5.0, 6.0), (None, 7.0)]
    rows = [(f"r{7 * i % 8}", "1" if i < 7 else None, "eps", "FY2024", date(2024, 2, 1 + (i == 6)), *f) for i, f in enumerate(figures)]
    rows += [(*rows[0][:5], 9.0, 9.0), rows[3]]
    statements = spark.createDataFrame(rows, "record_id string, cik string, metric string, target_period string, stated_at date, target_low double, target_high double")
    got = sorted(map(tuple, conflict_pairs(SimpleNamespace(statements=statements)).collect()))
    keyed = [r for r in rows if r[1]]
    assert got == sorted((a[0], b[0]) for a in keyed for b in keyed if a[0] < b[0] and a[1:5] == b[1:5] and a[5:] != b[5:])


def test_entry(spark):
    assert entry.entry(spark).count() == 26
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert Tables(spark, SF).statements.count() > 0
