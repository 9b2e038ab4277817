"""Small fixed dimensions and the configuration that callers may replace."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The metrics statements may be about, what each is measured in, and whether more is better.
METRICS = [
    ("revenue", "dollars", True),
    ("gross margin GAAP", "percent", True),
    ("gross margin non-GAAP", "percent", True),
    ("operating expenses GAAP", "dollars", False),
    ("operating expenses non-GAAP", "dollars", False),
    ("operating margin GAAP", "percent", True),
    ("operating margin non-GAAP", "percent", True),
    ("operating income", "dollars", True),
    ("EPS GAAP", "per share", True),
    ("EPS non-GAAP", "per share", True),
    ("tax rate", "percent", False),
    ("other income and expense", "dollars", True),
    ("comparable sales", "percent", True),
    ("free cash flow", "dollars", True),
    ("total expenses", "dollars", False),
    ("capital expenditures", "dollars", False),
]

# Units, the family in which they convert (none: not at all), their kind, and their scale in the family.
UNITS = [
    ("USD", "dollars", "dollars", 1.0),
    ("USD thousands", "dollars", "dollars", 1e3),
    ("USD millions", "dollars", "dollars", 1e6),
    ("USD billions", "dollars", "dollars", 1e9),
    ("USD per share", None, "per share", 1.0),
    ("percent", "percent", "percent", 1.0),
    ("percentage points", "percent", "percent", 1.0),
    ("basis points", "percent", "percent", 0.01),
]


def metrics(spark: SparkSession) -> DataFrame:
    """``metric, kind, higher_is_better``; sixteen rows."""
    return spark.createDataFrame(METRICS, "metric string, kind string, higher_is_better boolean")


def units(spark: SparkSession) -> DataFrame:
    """``unit, family, kind, scale``."""
    return spark.createDataFrame(UNITS, "unit string, family string, kind string, scale double")


@dataclass(frozen=True)
class Config:
    """Windows, limits and word lists; every operator takes one."""

    search_days: int = 550
    ack_days: int = 400
    max_docs: int = 3
    max_lines: int = 25
    plausible_ratio: float = 5.0
    max_sentence_chars: int = 1200
    block_lines: int = 40
    block_gap: int = 8
    heading_gap: int = 4
    heading_words: int = 8
    lead_in_lookback: int = 15
    lead_in_chars: int = 400
    context_chars: int = 300

    # Words that look ahead, and unit words that make a number count.
    forward_terms: tuple[str, ...] = (
        r"expect(?:s|ed|ing)?",
        "guidance",
        "outlook",
        r"anticipat(?:e|es|ed|ing)",
        r"forecast(?:s|ed|ing)?",
        r"(?-i:targets?|targeted|targeting)",
        r"full[- ]year",
        r"fiscal (?:year )?20\d\d",
    )
    number_units: tuple[str, ...] = (
        "percent", "per cent", "basis points?", "bps", "pts", "points?", "cents?", "thousand", "million", "billion", "trillion", "units", "stores", "locations",
    )
    section_heading: str = r"\b(?:Financial Outlook|Guidance|Outlook)\b"
    outlook_heading: str = r"\b(?:Outlook|Guidance|Targets?)\b"
    # Headings that end a section, as whole lines.
    end_headings: tuple[str, ...] = (
        "(?:Business |Financial |Company )?Highlights", "(?:Financial |Operating |Consolidated )?Results(?: of Operations)?", "Reconciliations?.*", "Conference Call.*", ".*Webcast.*",
        "Non-GAAP (?:Financial )?Measures.*", "Forward-Looking.*", "Safe Harbor.*", "About .*", "Shareholder Letter", "(?:Investor |Media )?Contacts?:?",
    )
    header_lookback: int = 10
    header_words: int = 10

    # What a line about a metric must say, by words in the metric's name; all that match count.
    metric_terms: tuple[tuple[str, str], ...] = (
        ("revenue|net sales|total sales", "revenue|net sales|total sales"),
        ("gross margin", "gross margin"),
        ("operating margin|operating income margin", "operating (?:income )?margin|operating income rate"),
        ("operating income", "operating income|income from operations|operating profit"),
        ("total expenses", "total (?:costs and )?expenses"),
        ("operating expense|opex", "operating expenses"),
        ("eps|earnings per share|per share", "earnings per share|eps|per diluted share|diluted earnings"),
        ("tax rate", "tax rate"),
        ("operating cash flow", "operating cash flow|cash flow from operations|cash provided by operat"),
        ("free cash flow", "free cash flow"),
        ("other income", "other income"),
        ("capital expenditure|capex", "capital expenditures|capex|capital spending"),
        ("comparable sales", "comparable sales"),
    )

    # How companies withdraw guidance, and how they admit a gap, by side and by direction.
    withdrawal_phrases: tuple[str, ...] = (
        r"withdr(?:aw|aws|ew|awn|awing|awal)", r"suspend(?:s|ed|ing)?", "suspension", r"no longer (?:provid|issu|giv)(?:e|es|ing)",
    )
    withdrawal_subjects: str = "guidance|outlook|forecast|expectations|projections|targets?"
    ack_phrases: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "below": ("below", "short of", "lower than our", "lower than expected", "less than expected"),
            "above": ("above the high end", "exceeded", "higher than our", "higher than expected", "greater than expected"),
            "worse": ("fell short", "shortfall", "did not meet", "missed", "revised"),
            "better": ("better than",),
        }
    )
    ack_references: tuple[str, ...] = ("guidance", "outlook", "expected range", "we had expected", "our prior", "compared with our")
