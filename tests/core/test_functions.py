import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from pledgewise.dims import METRICS, Config
from pledgewise.functions import extract, guards, ids, periods, rubric, text
from pledgewise.operators import candidates

CONFIG = Config()


def ask(spark, rows, schema, **columns):
    """The values of some columns over literal rows."""
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_range_bounds(spark):
    cases = [
        (5000.0, 6000.0, 4900.0, False), (5000.0, 6000.0, 5000.0, True), (5000.0, 6000.0, 6000.0, True), (5000.0, 6000.0, 6000.01, False), (1.1, 3.3, 1.1 + 2.2, True),
        (-0.5, -0.4, -0.45, True), (100.0, 100.0, 100.0, True), (100.0, 100.0, 100.01, False), (500.0, None, 500.0, True), (500.0, None, 499.0, False), (None, 500.0, 501.0, False),
        (None, None, 3.0, None), (1.0, 2.0, None, None),
    ]
    got = ask(spark, cases, "l double, h double, v double, want boolean", a=rubric.in_range(F.col("l"), F.col("h"), F.col("v")), b=F.col("want"))
    assert all(a == b for a, b in got)


def test_direction_and_status(spark):
    rows = [(1.0, 2.0, 3.0, True), (1.0, 2.0, 3.0, False), (1.0, 2.0, 0.5, True), (1.0, 2.0, 1.5, True), (1.0, 2.0, None, True)]
    c = [F.col(x) for x in "lhv"]
    yes, no = F.lit(True), F.lit(False)
    got = ask(spark, rows, "l double, h double, v double, up boolean", d=rubric.direction(*c, F.col("up")), s=rubric.resolve(*c, yes, yes, no), o=rubric.resolve(*c, no, yes, yes), w=rubric.resolve(*c, yes, no, yes), u=rubric.resolve(*c, yes, no, no))
    assert [g[0] for g in got] == ["better", "worse", "worse", None, None]
    assert [g[1] for g in got] == ["missed", "missed", "missed", "met", "unresolved"]
    assert {g[2:] for g in got} == {("open", "withdrawn", "unresolved")}


def test_miss_sizes(spark):
    rows = [(10.0, 20.0, 25.0), (10.0, 20.0, 5.0), (-1.0, -0.5, -2.0), (0.0, 0.0, 1.0), (10.0, 20.0, 15.0)]
    c = [F.col(x) for x in "lhv"]
    got = ask(spark, rows, "l double, h double, v double", f=rubric.miss_fraction(*c), m=rubric.miss_magnitude(*c, F.lit("missed")))
    assert got == [(0.25, 0.25), (0.5, -0.5), (1.0, 1.0), (None, None), (None, None)]


def test_period_ends(spark):
    rows = [(1, True, 2024, None, date(2024, 1, 31)), (1, False, 2022, None, date(2023, 1, 31)), (1, True, 2024, 1, date(2023, 4, 30)), (12, False, 2024, 2, date(2024, 6, 30)), (8, True, 2023, 4, date(2023, 8, 31)), (None, True, 2023, 4, None)]
    got = ask(spark, rows, "m int, e boolean, y int, q int, want date", a=periods.period_end(F.col("m"), F.col("e"), F.col("y"), F.col("q")), b=F.col("want"))
    assert all(a == b for a, b in got)


def test_reported_year_and_labels(spark):
    rows = [(1, False, 4, date(2020, 2, 26)), (1, True, None, date(2024, 2, 21)), (12, True, 1, date(2024, 4, 25)), (12, True, 1, date(2024, 12, 25)), (1, False, None, date(2019, 2, 1))]
    a = F.col("m"), F.col("e")
    got = ask(spark, rows, "m int, e boolean, q int, d date", y=periods.fiscal_year_reported(*a, F.col("q"), F.col("d")), l=periods.fiscal_label_for_end(*a, F.col("d"), False))
    assert [g[0] for g in got] == [2019, 2024, 2024, None, 2018] and got[4][1] == "FY2018"


@pytest.mark.parametrize(
    ("words", "want"),
    [
        ("Q2 2023 and Full Year 2023", ["Q2 FY2023", "FY2023"]), ("4Q23 | FY26", ["Q4 FY2023", "FY2026"]), ("first quarter of fiscal 2024", ["Q1 FY2024"]), ("no period", []),
    ],
)
def test_parse_periods(spark, words, want):
    assert ask(spark, [(words,)], "t string", p=periods.parse_periods(F.col("t"))) == [(want,)]


def test_ulid(spark):
    got = ask(spark, [(date(2024, 2, 1), "a"), (date(2024, 2, 1), "b"), (date(1969, 1, 1), "a")][:2], "d date, k string", u=ids.ulid(F.col("d"), F.col("k")))
    assert all(len(u) == 26 and set(u) <= set(ids.CROCKFORD) for (u,) in got) and got[0] != got[1] and got[0][0][:10] == got[1][0][:10]
    millis = int((date(2024, 2, 1) - date(1970, 1, 1)).days) * 86_400_000
    value = 0
    for c in got[0][0][:10]:
        value = value * 32 + ids.CROCKFORD.index(c)
    assert value == millis


def test_ulid_is_small_and_exact(spark):
    days, keys = [date(2024, 2, 1), date(1970, 1, 1), date(2999, 12, 31)], ["a", "", "record|9"]
    rows = [(d, k) for d in days for k in keys] + [(None, "a"), (days[0], None)]

    def plain(d, k):
        if d is None or k is None:
            return None
        value = ((d - date(1970, 1, 1)).days * 86_400_000 << 80) + int(hashlib.sha256(k.encode()).hexdigest()[:20], 16)
        return "".join(ids.CROCKFORD[value >> 5 * i & 31] for i in reversed(range(26)))

    assert ask(spark, rows, "d date, k string", u=ids.ulid(F.col("d"), F.col("k"))) == [(plain(d, k),) for d, k in rows]
    # under a condition nothing is shared between letters, so the expression itself must not hash a key again for each
    assert str(F.when(F.col("k") != "", ids.ulid(F.col("d"), F.col("k")))).count("sha2") <= 2


def test_patterns(spark):
    rows = [("We expect revenue of $5.0 billion.",), ("Target Corporation sold 5 stores.",), ("our targets are 10 percent",), ("It rained.",)]
    got = ask(spark, rows, "t string", f=text.has_forward_term(F.col("t"), CONFIG), n=text.has_number_with_unit(F.col("t"), CONFIG))
    assert got == [(True, True), (False, True), (True, True), (False, False)]
    assert ask(spark, [("Revenue(1) was 1,234.50 and 7",)], "t string", n=text.numbers(F.col("t"))) == [([1234.5, 7.0],)]
    assert ask(spark, [("operating income of 5",)], "t string", m=text.metrics_in(F.col("t"), CONFIG, [m for m, _, _ in METRICS])) == [(["operating income"],)]


def test_guards(spark):
    spread = guards.resolve_range(F.lit(62.4), F.lit(None).cast("double"), F.lit(0.5), F.lit(False))
    relative = guards.resolve_range(F.lit(200.0), F.lit(200.0), F.lit(2.0), F.lit(True))
    reversed_ = guards.resolve_range(F.lit(3.0), F.lit(2.0), F.lit(None).cast("double"), F.lit(False))
    got = ask(spark, [(1,)], "x int", a=spread, b=relative, c=reversed_)[0]
    assert tuple(got[0])[:2] == (61.9, 62.9) and tuple(got[1])[:2] == (196.0, 204.0) and got[2].reason == "reversed range"
    t = F.col("t")


def test_html():
    page = b"<html><style>x</style><div>One\xc2\xa0 two</div><div style='display: none'>no<div>no</div>no</div><table><tr><td>a</td><td>b</td></tr></table><p>End</p>"
    assert [x for x in extract.raw_lines(page).split("\n") if x] == ["One two", "a b", "End"]
    assert extract.decode(b"\x93quoted\x94") == "“quoted”" and extract.raw_lines(None) == ""
    page = "<!-- <p>no</p> --><script>if (a<b) no()</script><p title='a > b'>A &amp; B</p><ix:header/>C<br/>D<span hidden style=\"x;display:NONE\">no<br>no</span>E<title>no"
    assert [x for x in extract.raw_lines(page).split("\n") if x] == ["A & B", "C", "DE"]


SAID = [
    ("Acme Inc. rose 5.5%. It grew! e.g. this\n• Point one. next\nU.S. sales fell. J. Doe left.", ["Acme Inc. rose 5.5%.", "It grew! e.g. this", "Point one. next", "U.S. sales fell.", "J. Doe left."]),
    ('He said "stop." Then left.', ['He said "stop."', "Then left."]), ("", []), (None, []), ("a.  b. C\n\n - D", ["a.  b.", "C", " - D"]), ("One?) Two", ["One?)", "Two"]), ("日本。 é. Über", ["日本。 é.", "Über"]),
]


def test_sentences(spark):
    rows = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(SAID)], "accession string, text string")
    found = candidates.sentences(rows).collect()
    for i, (text, want) in enumerate(SAID):
        own = sorted((r.sent_no, r.char_start, r.char_end, r.sentence) for r in found if r.accession == str(i))
        assert [s for *_, s in own] == want and all((text or "")[a:b] == s for _, a, b, s in own)
        assert [n for n, *_ in own] == list(range(len(own)))
