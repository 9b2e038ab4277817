"""Text patterns as Column expressions over the configuration's word lists."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import Config

NUMBER = r"\d[\d,]*(?:\.\d+)?"

# How the quarters are written, what speaks of a year as a whole, and how a year is written.
QUARTERS = (
    r"(?i)\b(?:(?:first|1st)[- ]quarter|Q1|1Q)\b", r"(?i)\b(?:(?:second|2nd)[- ]quarter|Q2|2Q)\b", r"(?i)\b(?:(?:third|3rd)[- ]quarter|Q3|3Q)\b", r"(?i)\b(?:(?:fourth|4th)[- ]quarter|Q4|4Q)\b",
)
ANY_QUARTER = r"(?i)\b(?:(?:first|second|third|fourth|1st|2nd|3rd|4th)[- ]quarter|Q[1-4]|[1-4]Q)\b"
WHOLE_YEAR = r"(?i)full[- ]year|fiscal year|for the year|\bFY ?\d{2,4}\b|fiscal 20\d\d"
ANY_YEAR = r"(?i)\b20\d\d\b|\b(?:fiscal(?: year)? ?|FY ?)\d{2}\b"
ANY_PERIOD = ANY_QUARTER + r"|(?i)\bfull[- ]year\b|\bfor the year\b|\bfiscal (?:year )?\d{2,4}\b|\bFY ?\d{2,4}\b"
FISCAL_YEAR = r"(?i)\b(?:fiscal(?: year)? ?|FY ?)(20\d\d|\d\d)\b"
QUARTER_YEAR = r"(?i)\b(?:(?:first|second|third|fourth|1st|2nd|3rd|4th)[- ]quarter(?: of)?(?: fiscal)? ?|Q[1-4] ?(?:fiscal |FY ?)?)(20\d\d)\b"


def _any(words: tuple[str, ...]) -> str:
    return "|".join(f"(?:{w})" for w in words)


def has_forward_term(text: Column, config: Config) -> Column:
    return text.rlike(rf"(?i)\b(?:{_any(config.forward_terms)})\b")


def has_number_with_unit(text: Column, config: Config) -> Column:
    return text.rlike(rf"(?i)[$€£] ?{NUMBER}|{NUMBER} ?%|{NUMBER}[ -](?:{_any(config.number_units)})\b")


def is_heading(line: Column, config: Config, section: str | None = None) -> Column:
    """A short line that names a section and does not end like a sentence."""
    return (F.size(F.split(F.trim(line), r"\s+")) <= config.heading_words) & line.rlike(rf"(?i){section or config.section_heading}") & ~line.rlike(r"[.!?;,]\s*$")


def clip(text: Column, size: int) -> Column:
    return F.when(F.length(text) > size, F.concat(F.rtrim(F.substring(text, 1, size)), F.lit("..."))).otherwise(text)


def as_number(token: Column) -> Column:
    return F.round(F.regexp_replace(token, ",", "").try_cast("double"), 6)


def numbers(text: Column) -> Column:
    """Distinct numbers in order; thousands commas are dropped, and footnote marks after words or other marks are not numbers."""
    plain = F.regexp_replace(text, r"(?<=[A-Za-z)])\(\d{1,2}\)", "")
    return F.array_distinct(F.transform(F.regexp_extract_all(plain, F.lit(NUMBER), F.lit(0)), as_number))


def figures(text: Column) -> Column:
    """Numbers that do not continue a word or another number."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?<![A-Za-z\d.,])" + NUMBER), F.lit(0)), as_number)


def percents(text: Column) -> Column:
    """Numbers that a percent sign or the word follows."""
    return F.transform(F.regexp_extract_all(text, F.lit(rf"(?i)({NUMBER})\s*(?:%|percent\b|per\s*cent\b)"), F.lit(1)), as_number)


def is_table_line(text: Column) -> Column:
    """At least three numeric tokens and at most four other words."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    numeric = F.filter(words, lambda w: w.rlike(r"^[($]*\d[\d,.]*[)%]*$"))
    return (F.size(numeric) >= 3) & (F.size(words) - F.size(numeric) <= 4)


#: Words in a metric's name that say nothing about it.
PLAIN_WORDS = ("gaap", "non", "adjusted", "diluted", "full", "year", "growth", "expected", "total", "rate")


def metric_pattern(name: str, config: Config) -> str | None:
    """What a line about a metric must say: all patterns that the name calls for, else the name's own words; None if it has none."""
    terms = [match for when, match in config.metric_terms if re.search(when, name, re.IGNORECASE)]
    terms = terms or [w for w in re.findall("[a-z]{4,}", name.lower()) if w not in PLAIN_WORDS]
    return _any(tuple(terms)) if terms else None


def metrics_in(text: Column, config: Config, names: list[str]) -> Column:
    """The metrics whose words the text has; metrics of the same words are looked for once."""
    alike: dict[str, list[str]] = {}
    for name in names:
        if pattern := metric_pattern(name, config):
            alike.setdefault(pattern, []).append(name)
    none = F.array().cast("array<string>")
    return F.flatten(F.array(none, *[F.when(text.rlike(f"(?i){p}"), F.array(*[F.lit(m) for m in own])).otherwise(none) for p, own in alike.items()]))


def acknowledges(text: Column, side: str, direction: str, config: Config) -> Column:
    """A phrase of the side or of the direction, and a reference to what was guided."""
    phrases = config.ack_phrases[side] + config.ack_phrases[direction]
    return text.rlike(rf"(?i)\b(?:{_any(phrases)})\b") & text.rlike(f"(?i){_any(config.ack_references)}")


def withdraws(text: Column, config: Config) -> Column:
    return text.rlike(rf"(?i)\b(?:{_any(config.withdrawal_phrases)})\b") & text.rlike(rf"(?i)\b(?:{config.withdrawal_subjects})\b") & (F.length(text) <= 400)


def names_quarter(text: Column, quarter: Column) -> Column:
    return F.coalesce(F.rlike(text, F.get(F.array(*[F.lit(p) for p in QUARTERS]), quarter - 1)), F.lit(False))


def names_year(text: Column, year: Column) -> Column:
    full, short = year.cast("string"), F.lpad((year % 100).cast("string"), 2, "0")
    return F.rlike(text, F.concat(F.lit(r"(?i)\b(?:fiscal(?: year)? ?|FY ?)(?:"), full, F.lit("|"), short, F.lit(r")\b|\b"), full, F.lit(r"\b")))


def period_signal(text: Column, quarter: Column, year: Column) -> Column:
    """3 if the text names the quarter (null: speaks of the year) and the year, 2 if it does without this year, else 0."""
    named = F.when(quarter.isNull(), text.rlike(WHOLE_YEAR)).otherwise(names_quarter(text, quarter))
    return F.when(~named, 0).when(names_year(text, year), 3).otherwise(2)


def names_period(text: Column, quarter: Column, year: Column) -> Column:
    """Names the period with its year, or without any year."""
    signal = period_signal(text, quarter, year)
    return (signal == 3) | ((signal == 2) & ~text.rlike(ANY_YEAR))


def years_named(text: Column) -> Column:
    """Fiscal years and years of quarters that a text names, in four digits."""
    found = F.concat(F.regexp_extract_all(text, F.lit(FISCAL_YEAR), F.lit(1)), F.regexp_extract_all(text, F.lit(QUARTER_YEAR), F.lit(1)))
    return F.transform(found, lambda y: F.when(F.length(y) == 4, y.cast("int")).otherwise(2000 + y.cast("int")))


def names_later_period(text: Column, quarter: Column, year: Column) -> Column:
    """Names a later fiscal year or, of a quarter and unless an earlier year is named, a later quarter."""
    years = years_named(text)
    later = [F.coalesce(quarter < k, F.lit(False)) & text.rlike(QUARTERS[k - 1]) for k in (2, 3, 4)]
    return F.exists(years, lambda y: y > year) | (~F.exists(years, lambda y: y < year) & (later[0] | later[1] | later[2]))
