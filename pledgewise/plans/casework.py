"""Guards, text and period rules over cases whose right answers are written down beside them.

Each statement of the given tables meets one case, by its part's number, and puts its own numbers in the case's text; the SQL
knows the answers alone and not the rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dims import Config
from ..functions import extract, suggest, titles
from ..functions import guards as G
from ..functions import text as T
from .registry import query
from .substrate import STATEMENTS, Tables

CONFIG = Config()


@dataclass(frozen=True)
class Case:
    """``text`` may hold ``{a}`` and ``{b}``, whole numbers of the statement with a < b; bounds are multiples of these."""

    text: str
    want: str  # SQL over a and b
    kind: str = "dollars"
    metric: str = "revenue"
    low: float | None = None  # times a
    high: float | None = None  # times b; with ``point`` times a
    point: bool = False
    extra: str = ""
    quarter: int | None = None
    year: int = 2024


_A, _B = "(100 + supp % 400)", "(100 + supp % 400 + 1 + part % 50)"


def cased(name: str, cases: list[Case], **columns: str) -> Callable:
    """Registers ``rule(row)``, which gives Columns by name over the cases' columns; ``columns`` names them and their SQL types."""
    (column, kind), *more = columns.items()
    picked = f"CASE part % {len(cases)} " + " ".join(f"WHEN {k} THEN {c.want}" for k, c in enumerate(cases)) + " END"
    value = f"({picked})::{kind}"
    sql = f"WITH {STATEMENTS}, n AS (SELECT record_id, part, supp, {_A}::BIGINT AS a, {_B}::BIGINT AS b FROM statements) SELECT record_id, {value} AS {column} FROM n"

    def register(rule: Callable[[Column], Column]) -> Callable:
        @query(name, sql)
        def run(t: Tables) -> DataFrame:
            schema = "case_no long, text string, kind string, metric string, low double, high double, point boolean, extra string, quarter int, year int"
            rows = [(k, c.text, c.kind, c.metric, c.low, c.high, c.point, c.extra, c.quarter, c.year) for k, c in enumerate(cases)]
            table = t.spark.createDataFrame(rows, schema)  # as many rows as are written in this file
            a, b = (100 + F.col("supp") % 400), (101 + F.col("supp") % 400 + F.col("part") % 50)
            met = t.statements.select("record_id", a.alias("a"), b.alias("b"), (F.col("part") % len(cases)).alias("case_no")).join(F.broadcast(table), "case_no")
            filled = {c: F.replace(F.replace(F.col(c), F.lit("{a}"), F.col("a").cast("string")), F.lit("{b}"), F.col("b").cast("string")) for c in ("text", "extra")}
            met = met.withColumns(filled | {"low": F.col("low") * F.col("a"), "high": F.col("high") * F.when(F.col("point"), F.col("a")).otherwise(F.col("b"))})
            return met.select("record_id", rule().alias(column))

        return run

    return register


def c(name: str) -> Column:
    return F.col(name)


YES, NO, NONE = "true", "false", "NULL"


@cased(
    "p9_period_signal",
    [
        Case("Third quarter fiscal 2024 revenue was ${a} million.", "3", quarter=3),
        Case("Third-quarter revenue was ${a} million.", "2", quarter=3),
        Case("3rd quarter revenue of FY23 was ${a} million.", "2", quarter=3),
        Case("3Q24 revenue was ${a} million; FY24 to come.", "0", quarter=3),
        Case("Q3 FY24 revenue was ${a} million.", "3", quarter=3),
        Case("Faq3 and q30 are names, ${a} million.", "0", quarter=3),
        Case("Second quarter 2024 revenue was ${a}.", "0", quarter=3),
        Case("For the year, revenue was ${a} million.", "2"),
        Case("Full-year 2024 revenue was ${a} million.", "3"),
        Case("Revenue was ${a} million in 2024.", "0"),
        Case("Fiscal year 2022 revenue was ${a} million.", "2"),
    ],
    signal="INT",
)
def period_signal() -> Column:
    return T.period_signal(c("text"), c("quarter"), c("year"))


@cased(
    "p12_tax_footnote",
    [
        Case("A tax benefit of ${a} million in Q3 FY2024 and fiscal 2024.", YES),
        Case("A tax benefit of ${a} million in Q3 FY2024.", NO),
        Case("A benefit of ${a} million in Q3 FY2024 and fiscal 2024.", NO),
        Case("Tax of ${a} million in Q3 FY2024, fiscal 2024 and fiscal 2025.", NO),
        Case("Tax of ${a} million in Q3 FY2024 and fiscal 2025.", NO),
        Case("Tax charges of ${a} in the second quarter of fiscal 2023 and full year 2023.", YES),
    ],
    refused="BOOLEAN",
)
def tax_footnote() -> Column:
    return G.is_tax_footnote(c("text"))


@cased(
    "p10_title_names_period",
    [
        Case("Acme Reports Third Quarter Fiscal 2024 Results", YES, quarter=3),
        Case("Acme Reports Third Quarter Fiscal 2024 Results", NO, quarter=2),
        Case("Acme Reports Third Quarter Fiscal 2023 Results", NO, quarter=3),
        Case("Acme Announces Q3 FY24 Results and 2025 Outlook", YES, quarter=3),
        Case("Acme to Host Conference Call on Third Quarter 2024 Results", NO, quarter=3),
        Case("Acme will report Third Quarter 2024 earnings", NO, quarter=3),
        Case("Acme Reports Third Quarter Earnings", YES, quarter=3, extra="2024"),
        Case("Acme Reports Third Quarter Earnings", NO, quarter=3, extra="2023"),
        Case("Acme Reports 2024 Results", YES),
        Case("Acme Reports 2024 Results", YES, quarter=4),
        Case("Acme Reports 2024 Results", NO, quarter=3),
        Case("Acme Reports 2024 Results; Initiates 2025 Outlook", YES),
        Case("Acme Reports 2023 and 2024 Results", NO),
        Case("Acme Reports Fourth Quarter and Full Year 2024 Results", YES),
        Case("Acme Declares Dividend of {a} Cents in 2024", NO),
    ],
    named="BOOLEAN",
)
def title_names_period() -> Column:
    return titles.title_names_period(c("text"), F.lit(""), c("quarter"), c("year"), F.nullif(c("extra"), F.lit("")).cast("int"))


_TITLED = [
    Case("Acme Reports Second Quarter Results\nNet sales of ${a} million", "'Acme Reports Second Quarter Results'"),
    Case("EX-99.1\nACME INC. REPORTS RESULTS FOR THE\nFIRST QUARTER OF FISCAL 2025\nRaises fourth quarter outlook", "'ACME INC. REPORTS RESULTS FOR THE FIRST QUARTER OF FISCAL 2025'"),
    Case("One\nTwo\nThree", NONE),
    Case("Results\nAcme announces ${a} million of debt\n\nmore", "'Acme announces $' || a || ' million of debt'"),
    Case("Acme reports earnings of ${a}\nfor a good year\nand more\nin the third quarter", "'Acme reports earnings of $' || a || ' for a good year and more'"),
]


@cased("t15_headline", _TITLED, headline="VARCHAR")
def headline() -> Column:
    return titles.headline(c("text"), wrap=True)


@cased(
    "t16_top_headline",
    [
        Case("EX-99.1\nAcme Inc. net sales exceed ${a} billion in Q4\nmore", "'Acme Inc. net sales exceed $' || a || ' billion in Q4'"),
        Case("Page 1 of 21 Acme Group Reports 2025 Results • Revenue of ${a} • more", "'Acme Group Reports 2025 Results'"),
        Case("12\nPRESS RELEASE\nOctober 3, 2024\nAcme Reports\nThird Quarter Results\nnext", "'Acme Reports Third Quarter Results'"),
        Case("Investor Update\nAcme Reports {a}", NONE),
        Case("Acme earnings presentation {a}", NONE),
        Case("\n\n \nAcme earnings up {a}\n• a point", "'Acme earnings up ' || a"),
        Case("The board met {a} times\nAcme Reports", "'The board met ' || a || ' times Acme Reports'"),
        Case("file.htm\nEX-99\n7", NONE),
    ],
    headline="VARCHAR",
)
def top_headline() -> Column:
    return titles.top_headline(c("text"))


@cased(
    "t12_header_cell",
    [
        Case("Q2 2023 Full Year 2023", YES), Case("Q1 FY22 Guidance", YES), Case("Previous Q4 Fiscal 2019 Guidance", YES), Case("Acme Reports Q2 2023 Results", NO),
        Case("Q2 2023 vs Q2 2022", NO), Case("Q2 2023 grew {a}%", NO), Case("Q2 2023 Guidance:", NO), Case("Updated Full Year 2024 Outlook | Prior FY24", YES),
    ],
    is_cell="BOOLEAN",
)
def header_cell() -> Column:
    from ..operators.candidates import is_header_cell

    return is_header_cell(c("text"), CONFIG)


@cased(
    "g3_evidence_text",
    [
        Case("one\ntwo ${a}\nthree", "'two $' || a", low=1.0, point=True, extra="2,2"),
        Case("one\ntwo ${a}\nthree", "'one' || chr(10) || 'two $' || a", low=1.0, point=True, extra="1,2"),
        Case("one\ntwo", "'lines outside the section'", low=1.0, extra="2,3"),
        Case("one\ntwo", "'lines outside the section'", low=1.0, extra="2,1"),
        Case("x" * 390 + "\nRevenue of ${a} million.", "'Revenue of $' || a || ' million.'", low=1.0, point=True, extra="1,2"),
        Case("Boiler plate " * 30 + "ends. We expect ${a} million. Then ${b} million. " + "More words " * 5, "'We expect $' || a || ' million. Then $' || b || ' million.'", low=1.0, high=1.0, extra="1,1"),
        Case("Boiler plate " * 40 + "ends. None.", "'longer than an excerpt'", low=1.0, extra="1,1"),
        Case("We expect ${a} million. " + "Between them are many more words. " * 13 + "Then ${b} million.", "'We expect $' || a || ' million.'", low=1.0, high=1.0, extra="1,1"),
    ],
    found="VARCHAR",
)
def evidence_text() -> Column:
    at = F.split(c("extra"), ",")
    found = G.evidence_text(c("text"), at[0].try_cast("int"), at[1].try_cast("int"), c("low"), c("high"), F.lit(None).cast("double"))
    return F.coalesce(found["text"], found["reason"])


@cased(
    "g4_bare_value",
    [
        Case("${a} million - ${b} million", YES), Case("Operating expenses ${a} million", NO), Case("{a} basis points", YES), Case("${a} million", YES, extra="Updated Q4 Fiscal 2019 Guidance"),
        Case("${a} million", NO, extra="GAAP diluted earnings per share guidance"), Case("up to ${a}", NO),
    ],
    bare="BOOLEAN",
)
def bare_value() -> Column:
    return G.bare_value(c("text"), c("extra"))


@cased(
    "g5_restated_base",
    [
        Case("Guidance is based on the following FY26 figures: Net sales: ${a} billion.", "'restated base year'", low=1.0, high=1.0, point=True),
        Case("Guidance is based on the following FY26 figures: Net sales: ${a} billion. We expect sales of ${a} billion.", NONE, low=1.0, high=1.0, point=True),
        Case("We expect sales of ${a} billion.", NONE, low=1.0, high=1.0, point=True),
        Case("The guidance is based on a base year of ${a}. We expect ${b}.", "'restated base year'", low=1.0, high=1.0, point=True),
        Case("The guidance is based on a base year of ${a}. We expect ${b}.", NONE, low=1.0, high=1.0),
        Case("Guidance is based on our plan of ${a} billion.", NONE, low=1.0, high=1.0, point=True),
    ],
    reason="VARCHAR",
)
def restated_base() -> Column:
    return G.restated_base(c("text"), c("low"), c("high"))


@cased(
    "g6_column_shift",
    [
        Case("Operating margin N/A ~{a}%", "'FY2024'", extra="Q1 2024 | Full Year 2024"), Case("Operating margin ~{a}% {b}%", "'Q1 FY2024'", extra="Q1 2024 | Full Year 2024"),
        Case("Margin N/A — {a}%", "'FY2025'", extra="Q1 2024 | Full Year 2024 | FY25"), Case("Margin N/A {a}%", "'Q1 FY2024'", extra="Q1 2024"), Case("Margin N/A {a}%", "'Q1 FY2024'"),
        Case("Margin N/A {a}%", "'Q1 FY2024'", extra="Q3 2024 | FY24"), Case("Margin n/a approximately {a}%", "'FY2024'", extra="Q1 2024 | Full Year 2024"), Case("N/A grows", "'Q1 FY2024'", extra="Q1 2024 | FY24"),
    ],
    period="VARCHAR",
)
def column_shift() -> Column:
    return G.shifted_period(F.lit("Q1 FY2024"), c("text"), c("extra"))


@cased(
    "g7_end_date_period",
    [
        Case("For the fiscal year ending Jan. 31, 2020, sales of ${a}.", "'FY2019'", extra="FY2020"), Case("Sales of ${a} for the year ending January 31, 2021 are expected.", "'FY2020'", extra="FY2021"),
        Case("For the three months ended October 31, 2020, sales of ${a}.", "'Q3 FY2020'", extra="Q4 FY2020"), Case("For the three months ended October 31, 2020, sales of ${a}.", "'FY2020'", extra="FY2020"),
        Case("Sales of ${a}.", "'FY2020'", extra="FY2020"), Case("For the fiscal year ending Feb. 31, 2020, sales of ${a}.", "'FY2020'", extra="FY2020"),
        Case("For the fiscal year ending Jan. 31, 2018, sales of ${a}.", "'FY2020'", extra="FY2020"), Case("Fiscal year ending Jan. 31, 2020 and fiscal year ending Jan. 31, 2021: ${a}.", "'FY2022'", extra="FY2022"),
    ],
    period="VARCHAR",
)
def end_date_period() -> Column:
    """A calendar whose years end in January and are named for the year they begin in; stated on 1 June 2019."""
    return G.end_date_period(c("extra"), c("text"), F.lit(""), F.lit(1), F.lit(False), F.lit("2019-06-01").cast("date"))


@cased(
    "p4_period_by_end_date",
    [
        Case("for the three months ended Oct. 31, 2020: {a}", "'Q3 FY2020'"), Case("for the fiscal year ending January 31, 2021", "'FY2020'"), Case("the quarter ended April 30, 2020 was {a}", "'Q1 FY2020'"),
        Case("ended April 30, 2020", NONE), Case("for the year ending Feb. 31, 2030", NONE), Case("year ended Jan 31, 2021 and year ended Jan 31, 2022", NONE), Case("fiscal year ended Jan 31, 2021; FY ended Jan. 31, 2021", "'FY2020'"),
        Case("for the year ended Jan. 31, 2019", NONE), Case("for the year ending Mar. 31, 2021", NONE),
    ],
    label="VARCHAR",
)
def period_by_end_date() -> Column:
    return G.period_by_end_date(c("text"), F.lit(1), F.lit(False), F.lit("2019-06-01").cast("date"))


@cased(
    "g8_basis",
    [
        Case("${a}", "'GAAP'", extra="GAAP | Adjustments | Non-GAAP;0;Outlook"), Case("${a}", "'Adjustments'", extra="GAAP | Adjustments | Non-GAAP;1;Outlook"), Case("${a}", "'non-GAAP'", extra="GAAP | Adjustments | Non-GAAP;2;Outlook"),
        Case("${a}", "'non-GAAP'", extra=";0;Adjusted earnings guidance"), Case("GAAP margin ${a}", NONE, extra=";0;Adjusted earnings guidance"), Case("${a}", "'GAAP'", extra="x | y;1;GAAP outlook"), Case("${a}", NONE, extra="x | y;5;Outlook"),
    ],
    basis="VARCHAR",
)
def basis() -> Column:
    part = F.split(c("extra"), ";")
    return G.basis_in_context(part[0], part[1].cast("int"), part[2], c("text"))


_SPREAD = [
    Case("$1.52 billion, plus or minus $50 million", "'1.47 1.57'", low=0.0, high=0.0, extra="1e9;1.52"), Case("gross margin of 41%, plus or minus 1%", "'40 42'", "percent", extra="1;41"),
    Case("62.3 percent ± 50 basis points", "'61.8 62.8'", "percent", extra="1;62.3"), Case("$108.0 billion, plus or minus 2%", "'105.84 110.16'", extra="1e9;108"),
    Case("$0.42 +/- $0.07", "'0.35 0.49'", "per share", extra="1;0.42"), Case("EPS of $0.42 plus/minus 7", "'0.42 0.42'", "per share", extra="1;0.42"),
    Case("$900 million ± $25 million and $825 million ± $30 million", "'795 855'", extra="1e6;825"), Case("$900 million ± $25 million", "'800 800'", extra="1e6;800"),
    Case("41% to 43%", "'42 42'", "percent", extra="1;42"), Case("$2 million plus or minus $100 thousand", "'1.9 2.1'", extra="1e6;2"),
]


@cased("g10_printed_spread", _SPREAD, bounds="VARCHAR")
def printed_spread() -> Column:
    """The range of a centre with the spread that its text prints."""
    part = F.split(c("extra"), ";")
    centre = part[1].cast("double")
    found = G.stated_range(c("text"), centre, centre, c("kind"), part[0].cast("double"))
    plain = [F.regexp_replace(F.regexp_replace(F.round(found[x], 4).cast("decimal(20,4)").cast("string"), r"0+$", ""), r"\.$", "") for x in ("low", "high")]
    return F.concat_ws(" ", *plain)


@cased(
    "g11_spread_rule",
    [
        Case("${a} million, plus or minus 2%", YES, low=1.0, high=1.0, point=True), Case("${a} million, plus or minus $2 million", NO, low=1.0, high=1.0, point=True),
        Case("{a}%, plus or minus 2%", NO, "percent", low=1.0, high=1.0, point=True), Case("${a}.00 ± 3%", YES, "per share", low=1.0, high=1.0, point=True), Case("${a} to ${b} million", NONE, low=1.0, high=1.0),
    ],
    relative="BOOLEAN",
)
def spread_rule() -> Column:
    """A percent spread is a share of a centre in money, and points of a rate."""
    return G.printed_spread(c("text"), c("low"), c("high"), c("kind"), F.when(c("kind") == "dollars", 1e6).otherwise(1.0))["relative"]


@cased(
    "g13_floor_language",
    [
        Case("EPS of ${a}+ for the year", YES), Case("EPS of at least ${a}", YES), Case("revenue of ${a} million or more", YES), Case("EPS of ${a} or better", YES), Case("growth of +{a}%", NO), Case("${a} +/- $1", NO),
        Case("${b}+ and exactly ${a}", NO), Case("at least ${b}, then ${a}", NO), Case("at least approximately ${a}", YES), Case("EPS of ${a}", NO),
    ],
    no_upper="BOOLEAN",
)
def floor_language() -> Column:
    point = c("a").cast("double")
    return G.one_sided(point, point, c("text")).isNull()


@cased(
    "g14_signed_rate",
    [
        Case("a tax provision of ({a}%)", "a || ' ' || a", "percent", "tax rate", -1.0, -1.0, True), Case("a tax benefit of ({a}%)", "-a || ' ' || -a", "percent", "tax rate", -1.0, -1.0, True),
        Case("comparable sales of ({b}%) to ({a}%)", "-a || ' ' || -b", "percent", "comparable sales", -1.0, -1.0), Case("a loss of (${a})", "-a || ' ' || -a", "per share", "EPS GAAP", -1.0, -1.0, True),
        Case("an expense of ${a} million", "-a || ' ' || -a", "dollars", "other income and expense", 1.0, 1.0, True), Case("an expense of ${a} to ${b} million", "-b || ' ' || -a", "dollars", "other income and expense", 1.0, 1.0),
        Case("income of ${a} million", "a || ' ' || a", "dollars", "other income and expense", 1.0, 1.0, True), Case("margin of ({a})%", "a || ' ' || a", "percent", "gross margin GAAP", -1.0, -1.0, True),
        Case("tax rate of ({a}%)", "-a || ' ' || -a", "percent", "tax rate", -1.0, -1.0, True, "habit"), Case("margin of -{a}%", "-a || ' ' || -a", "percent", "gross margin GAAP", -1.0, -1.0, True),
    ],
    bounds="VARCHAR",
)
def signed_rate() -> Column:
    found = G.signed_range(c("metric"), c("kind"), c("low"), c("high"), c("text"), c("extra") == "habit")
    return F.concat_ws(" ", found["low"].cast("long").cast("string"), found["high"].cast("long").cast("string"))


@cased(
    "g15_level_not_change",
    [
        Case("Operating income is expected to grow more than ${a} million.", "'a change, not a level'", low=1.0, high=1.0, point=True), Case("Revenue is expected to be ${a} million.", NONE, low=1.0, high=1.0, point=True),
        Case("An increase of ${a} million is expected.", "'a change, not a level'", low=1.0, high=1.0, point=True), Case("Revenue growth of {a} percent is expected.", NONE, "percent", low=1.0, high=1.0, point=True),
        Case("Revenue of ${a} million is expected. Growth in other segments continues.", NONE, low=1.0, high=1.0, point=True), Case("Revenue of ${a} million, up 12 percent.", "'a change, not a level'", low=1.0, high=1.0, point=True),
        Case("Revenue increased to ${a} million.", NONE, low=1.0, high=1.0, point=True),
    ],
    reason="VARCHAR",
)
def level_not_change() -> Column:
    return G.is_change(c("text"), c("kind"), c("low"), c("high"))


@cased(
    "g16_percent_level",
    [
        Case("Margin about {a} basis points higher than the 4.6 percent rate in 2025.", "'relative to a prior period'", "percent", low=1.0, high=1.0, point=True),
        Case("Operating margin of {a}%, compared to 19% last year.", NONE, "percent", low=1.0, high=1.0, point=True), Case("Operating margin of {a}% is expected.", NONE, "percent", low=1.0, high=1.0, point=True),
        Case("Revenue of ${a} million, above last year.", NONE, low=1.0, high=1.0, point=True), Case("A rate {a} points below the prior year.", "'relative to a prior period'", "percent", low=1.0, high=1.0, point=True),
        Case("A margin of {a} is expected. It is above last year.", NONE, "percent", low=1.0, high=1.0, point=True),
    ],
    reason="VARCHAR",
)
def percent_level() -> Column:
    return G.relative_to_prior(c("text"), c("kind"), c("low"), c("high"))


_RANGE, _PAST, _MISSING = "'a range without words of a range'", "'past tense without a forward verb'", "'a stated number is not in the evidence'"


@cased(
    "g17_reject_reasons",
    [
        Case("We expect ${a} million to ${b} million.", NONE, low=1.0, high=1.0), Case("We expect ${a} million and ${b} million.", _RANGE, low=1.0, high=1.0), Case("We expect between ${a} and ${b} million.", NONE, low=1.0, high=1.0),
        Case("We expect ${a}B - ${b}B.", NONE, low=1.0, high=1.0), Case("We expect ${a} million.", _MISSING, low=1.0, high=2.0, point=True, extra="x"), Case("We expect a loss of ({a}) million.", NONE, low=-1.0, high=-1.0, point=True),
        Case("Revenue was ${a} million.", _PAST, low=1.0, high=1.0, point=True), Case("Revenue was ${a} million and we expect more.", NONE, low=1.0, high=1.0, point=True), Case("Revenue(12) of ${a} million will come.", NONE, low=1.0, high=1.0, point=True),
        Case("Margin expected at {a}%–{b}%.", NONE, low=1.0, high=1.0), Case("It is expected to be about ${a} and then ${b}.", _RANGE, low=1.0, high=1.0),
    ],
    reason="VARCHAR",
)
def reject_reasons() -> Column:
    """The first reason of three in their order; a case with an extra states a bound that is not printed."""
    said = F.when(c("extra") != "", None).otherwise(G.range_unsaid(c("text"), c("low"), c("high")))
    return G.first_reason(said, G.missing_numbers(c("text"), [c("low"), c("high")]), G.past_tense(c("text")))


@cased(
    "g20_outcome_lines",
    [
        Case("Revenue was ${a} million.", NONE, quarter=3), Case("Revenue of $2.55 - $2.75 was seen.", "'prints a range'", quarter=3), Case("Revenue between ${a} and ${b} was seen.", "'prints a range'", quarter=3),
        Case("Revenue rose from $1.2 billion to $1.4 billion.", NONE, quarter=3), Case("In 2019-2020 revenue was ${a} million.", NONE, quarter=3), Case("Revenue is expected at ${a}.", "'forward-looking'", quarter=3),
        Case("Target sold ${a} million of goods.", NONE, quarter=3), Case("Revenue was ${a} million.", "'in an outlook section'", quarter=3, extra="outlook"), Case("Revenue was ${a} million.", "'filed before the close'", quarter=3, extra="early"),
        Case("Fiscal 2025 revenue was ${a} million.", "'names a later period'", quarter=3), Case("Fourth quarter revenue was ${a} million.", "'names a later period'", quarter=3), Case("In FY23 the fourth quarter had ${a} million.", NONE, quarter=3),
        Case("Adjusted EPS was ${a}.", "'labelled adjusted or non-GAAP'", metric="EPS GAAP", quarter=3), Case("GAAP and adjusted EPS were ${a} and ${b}.", NONE, metric="EPS GAAP", quarter=3),
        Case("EPS was ${a}.", "'no non-GAAP label, and the release prints both'", metric="EPS non-GAAP", quarter=3), Case("EPS was ${a}.", NONE, metric="EPS non-GAAP", quarter=3, extra="Non-GAAP results"),
        Case("Margins of 11-12 were seen.", "'prints a range'", quarter=3), Case("{a} and {b} stores were opened.", NONE, quarter=3),
    ],
    reason="VARCHAR",
)
def outcome_lines() -> Column:
    """Why a line cannot be an outcome of a quarter that closed on 30 September 2024; the first reason counts."""
    filed = F.when(c("extra") == "early", F.lit("2024-09-30")).otherwise(F.lit("2024-10-20")).cast("date")
    return G.not_an_outcome(c("text"), c("metric"), c("quarter"), c("year"), filed, F.lit("2024-09-30").cast("date"), F.lit("Target Corporation"), c("extra") == "outlook", c("extra"), F.lit(True))


@cased(
    "g22_value_in_evidence",
    [
        Case("Revenue was ${a} million.", YES, extra="1"), Case("A loss of ({a}) million.", YES, extra="-1"), Case("Revenue was ${a},000.", YES, extra="1"), Case("Revenue was ${a}.331.", NO, extra="1"), Case("Revenue was ${a}.001 million.", YES, extra="1"),
        Case("Revenue was ${b} million.", NO, extra="1"), Case("Revenue was $0.{a} billion.", "a % 10 = 0", extra="1"), Case("Revenue was {a}000000.", YES, extra="1"), Case("Revenue was ${a}.0001.", NO, extra="1"), Case("None.", NO, extra="1"), Case("It was 12.", NO, extra="0.000001"),
    ],
    printed="BOOLEAN",
)
def value_in_evidence() -> Column:
    return G.value_in_evidence(c("a") * c("extra").cast("double"), c("text"))


@cased(
    "g26_parallel_figures",
    [
        Case("Full Year and Fourth Quarter Net Earnings were ${a}.19 Per Share and ${b}.10 Per Share", "b || '.10'", metric="EPS GAAP", quarter=4), Case("Full Year and Fourth Quarter Net Earnings were ${a}.19 Per Share and ${b}.10 Per Share", "a || '.19'", metric="EPS GAAP"),
        Case("Full Year and Fourth Quarter Net Earnings were ${a}.19 Per Share and ${b}.10 Per Share", NONE, metric="EPS GAAP", quarter=3), Case("Full Year and Fourth Quarter Adjusted Net Earnings of ${a}.19 and ${b}.10 Per Share", "a || '.19'", metric="EPS non-GAAP"),
        Case("Full Year and Fourth Quarter Adjusted Net Earnings of ${a}.19 and ${b}.10 Per Share", NONE, metric="EPS GAAP"), Case("Full Year and Fourth Quarter Net Earnings were ${a}.19 Per Share", NONE, metric="EPS GAAP"),
        Case("Full Year and Fourth Quarter Net Earnings reflect ${a}.19 and ${b}.10 Per Share", NONE, metric="EPS GAAP"), Case("Full Year and Q4 Earnings were ${a}.19 and ${b}.10 per share", "b || '.10'", metric="EPS GAAP", quarter=4),
        Case("Full Year and Fourth Quarter Net Earnings were ${a}.19 and ${b}.10 per share", NONE, metric="revenue"),
    ],
    figure="VARCHAR",
)
def parallel_figures() -> Column:
    return G.parallel_figure(c("text"), c("metric"), c("quarter")).cast("decimal(12,2)").cast("string")


@cased(
    "g27_acknowledging",
    [
        Case("Third quarter revenue of ${a} was below our guidance.", YES, quarter=3), Case("Revenue was below our guidance.", NO, quarter=3), Case("Third quarter fiscal 2023 revenue of ${a} was below our guidance.", NO, quarter=3),
        Case("Revenue missed the expected range of ${a} to ${b}.", YES, low=1.0, high=1.0, quarter=3), Case("Revenue missed the expected range of ${a} to ${b}.", NO, low=1.0, high=2.0, quarter=3),
        Case("Second quarter revenue missed the expected range of ${a} to ${b}.", NO, low=1.0, high=1.0, quarter=3), Case("Full year revenue of ${a} fell short of our outlook.", YES), Case("Third quarter revenue of ${a} fell short of our outlook.", NO),
        Case("Third quarter revenue of ${a} was fine.", NO, quarter=3),
    ],
    admits="BOOLEAN",
)
def acknowledging() -> Column:
    """A phrase of a miss below, a reference to the guide, and a figure of the row's own period or its guided range."""
    return T.acknowledges(c("text"), "below", "worse", CONFIG) & G.may_acknowledge(c("text"), c("quarter"), c("year"), c("low"), c("high"))


@cased(
    "p11_half_year",
    [
        Case("Revenue of ${a} for the second half of 2024.", "'half-year period'", extra="FY2024"), Case("Revenue of ${a} for the second half and full year.", NONE, extra="FY2024"), Case("Revenue of ${a}.", "'half-year period'", extra="H2 2024"),
        Case("Revenue of ${a}.", "'period has another shape'", extra="2024"), Case("Revenue of ${a} in the third quarter and second half.", NONE, extra="Q3 FY2024"), Case("Revenue of ${a}.", NONE, extra="FY2024"), Case("2H revenue of ${a}.", "'half-year period'", extra="FY2024"),
    ],
    reason="VARCHAR",
)
def half_year() -> Column:
    return G.period_shape(c("extra"), c("text"))


@cased(
    "t20_numbers",
    [
        Case("Revenue(1) was 1,{a} and 7.50", "'1' || a || ' 7.5'"), Case("range(1)(2) of {a}", "a::VARCHAR"), Case("($0.03) and (200)", "'0.03 200'"), Case("none", "''"), Case("{a} and {a}", "a::VARCHAR"), Case("margin(12) {a}%", "a::VARCHAR"), Case("sum (123)", "'123'"),
    ],
    found="VARCHAR",
)
def numbers() -> Column:
    plain = F.transform(T.numbers(c("text")), lambda x: F.regexp_replace(F.regexp_replace(x.cast("decimal(20,4)").cast("string"), "0+$", ""), r"\.$", ""))
    return F.array_join(plain, " ")


@cased(
    "t4_sentence_rules",
    [
        Case("Acme Inc. rose {a}.5%. It grew! e.g. this", "'Acme Inc. rose ' || a || '.5%.|It grew! e.g. this'"), Case("• Point one. next\nU.S. sales fell. J. Doe left {a}.", "'Point one. next|U.S. sales fell.|J. Doe left ' || a || '.'"),
        Case("He said \"stop.\" Then {a}.", "'He said \"stop.\"|Then ' || a || '.'"), Case("", "''"), Case("A?  b\n\n- C", "'A?  b|C'"), Case("In Sept. 2020 we sold {a}. Then", "'In Sept. 2020 we sold ' || a || '.|Then'"), Case("Up {a}.3 pp. Next.", "'Up ' || a || '.3 pp. Next.'"),
    ],
    found="VARCHAR",
)
def sentence_rules() -> Column:
    return F.array_join(extract.sentence_list(c("text")), "|")


@cased(
    "t7_heading_rule",
    [
        Case("Financial Outlook", YES), Case("Outlook for {a} is good.", NO), Case("Third Quarter Guidance", YES), Case("Our outlook on the world and on all its {a} many things", NO), Case("Results", NO), Case("2024 Guidance:", YES), Case("Guidance!", NO), Case("Misguidance", NO),
    ],
    heading="BOOLEAN",
)
def headings() -> Column:
    return T.is_heading(c("text"), CONFIG)


_HEADED, _OTHER, _BARE = "Q1 2024 Full Year 2024;FY2024", "Q1 2024 Full Year 2024;FY2023", ";FY2024"


@cased(
    "t19_header_confirms",
    [
        Case("Revenue ${a} ${b} $3", YES, extra=_HEADED), Case("Revenue ${a} ${b}", YES, extra=_BARE), Case("Revenue ${a} ${b} $3", NO, extra=_OTHER), Case("Revenue ${a} ${b} $3", NO, extra=_BARE),
        Case("Revenue of ${a} compared to ${b} and $3", YES, extra=_BARE), Case("Revenue rose from ${a} and ${b} to $3", NO, extra=_OTHER), Case("Revenue ${a} ${b} $3 a year ago", YES, extra=_BARE),
        Case("Revenue ${a} was up sequentially, ${b} and $3", YES, extra=_OTHER), Case("Revenue {a} {b} 3 4", YES, extra=_BARE), Case("Revenue $({a}) $ {b} $3.5 up 4%", NO, extra=_BARE),
        Case("Gross margin {a}% {b}% (3.5)%", NO, kind="percent", extra=_BARE), Case("Gross margin {a}% {b}% (3.5)%", YES, kind="percent", extra=_HEADED), Case("Gross margin {a}% $1 $2 $3", YES, kind="percent", extra=_BARE),
        Case("Revenue ${a} ${b} $3", YES, extra="4Q23 4Q22;Q4 FY2022"), Case("Revenue ${a} ${b} $3", NO, extra="4Q23 4Q22;FY2022"),
    ],
    confirmed="BOOLEAN",
)
def header_confirms() -> Column:
    """Any line of one reading is confirmed; a row of three or more figures of its unit needs a header with the period."""
    part = F.split(c("extra"), ";")
    return G.column_confirmed(c("kind"), c("text"), F.nullif(part[0], F.lit("")), part[1])


@cased(
    "m8_suggested_notes",
    [
        Case("x", "'false alarm: period from header column 2'", extra="wrong_period;FY2024;Q1 2024 | Full Year 2024;"), Case("x", "'false alarm: period from header column 1'", extra="wrong_period;Q1 FY2024;Q1 2024 Full Year 2024;"),
        Case("x", "'CHECK: period'", extra="wrong_period;FY2025;Q1 2024 | Full Year 2024;"), Case("${a}, plus or minus ${a}", "'false alarm: ± expands to 0-' || 2 * a", low=0.0, high=2.0, point=True, extra="wrong_value;FY2024;;"),
        Case("${a}, plus or minus $1", "'CHECK: value'", low=0.0, high=2.0, point=True, extra="wrong_value;FY2024;;"), Case("${a}", "'CHECK: value'", low=1.0, high=1.0, point=True, extra="wrong_value;FY2024;;"),
        Case("x", "'false alarm: metric in heading'", metric="EPS GAAP", extra="wrong_metric;FY2024;;GAAP EPS guidance"), Case("x", "'CHECK: metric'", metric="EPS GAAP", extra="wrong_metric;FY2024;;EPS guidance"),
        Case("We expect Q3 FY2024 revenue of ${a} million.", "'false alarm: forward verb, period, number present'", extra="not_guidance;FY2024;;"), Case("We expect revenue of ${a} million.", "'CHECK: guidance'", extra="not_guidance;FY2024;;"),
        Case("x", "'CHECK: wrong_sign'", extra="wrong_sign;FY2024;;"), Case("x", "'CHECK: other'", extra=";FY2024;;"), Case("x", "'CHECK: Q4 FY2020 closed before this was stated; likely Q1 FY2021'", extra="early;Q4 FY2020;;"),
        Case("x", "'CHECK: period closes before stated'", extra="early;H1 2020;;"),
    ],
    note="VARCHAR",
)
def suggested_notes() -> Column:
    part = F.split(c("extra"), ";")
    return suggest.suggested_note(part[0], part[0] == "early", part[1], part[2], c("text"), c("low"), c("high"), c("metric"), part[3], CONFIG)
