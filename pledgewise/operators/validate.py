"""Validation of records: each check gives an issue row or nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rubric

STATUSES = ("open", "met", "missed", "unresolved", "withdrawn")
ACCESSION = r"^\d{10}-\d{2}-\d{6}$"
# What the columns of a record and its evidence look like, where a table has them.
PATTERNS = {
    "draft_id": "^[0-7][0-9A-HJKMNP-TV-Z]{25}$",
    "cik": r"^\d{10}$",
    "ticker": r"^[A-Z]{1,5}(?:[.-][A-Z])?$",
    "content_sha256": "^[0-9a-f]{64}$",
    "source_url": r"^https?://(?:www|efts)\.sec\.gov(?::\d+)?/",
    "excerpt": r"^(?s).{1,400}$",
    "filing_type": "^.",
    "company": "^.",
    "claim": "^.",
}


def _bad(check: str, when: Column, detail: Column) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(check).alias("check"), detail.cast("string").alias("detail")))


def schema_issues(records: DataFrame) -> list[Column]:
    """Checks of the columns that ``records`` has of a record's schema: patterns, and an acknowledgement's day with its evidence."""
    found = [_bad(name, ~F.coalesce(F.col(name), F.lit("")).rlike(pattern), F.col(name)) for name, pattern in PATTERNS.items() if name in records.columns]
    if "acknowledgement_url" in records.columns:
        found.append(_bad("acknowledgement", F.col("acknowledged_at").isNull() != F.col("acknowledgement_url").isNull(), F.col("acknowledgement_url")))
    return found


def issues(records: DataFrame) -> DataFrame:
    """``record_id, check, detail`` for ``record_id, accession, target_low, target_high, reported_value, stated_at, reported_at,
    acknowledged_at, status`` and the columns of ``PATTERNS`` that there are; one pass without shuffles."""
    low, high, value = F.col("target_low"), F.col("target_high"), F.col("reported_value")
    again = rubric.resolve(low, high, value, F.col("status") != "open", F.lit(True), F.col("status") == "withdrawn")
    found = [
        _bad("record id", ~F.col("record_id").rlike("^[0-9a-f]{32}$"), F.col("record_id")),
        _bad("accession", ~F.col("accession").rlike(ACCESSION), F.col("accession")),
        _bad("status", ~F.col("status").isin(*STATUSES), F.col("status")),
        _bad("no target", low.isNull() & high.isNull(), F.lit("both bounds are empty")),
        _bad("reversed target", low > high, F.concat_ws(" > ", low.cast("int").cast("string"), high.cast("int").cast("string"))),
        *[_bad("not finite", F.isnan(x) | (F.abs(x) == float("inf")), x) for x in (low, high, value)],
        _bad("reported before stated", F.col("reported_at") <= F.col("stated_at"), F.col("reported_at")),
        _bad("acknowledged before reported", F.col("acknowledged_at") < F.col("reported_at"), F.col("acknowledged_at")),
        _bad("stored status", F.col("status") != again, F.concat_ws(" is ", F.col("status"), again)),
    ]
    found += schema_issues(records)
    return records.select("record_id", F.explode(F.array_compact(F.array(*found))).alias("i")).select("record_id", "i.*")


def document_issues(evidence: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """``key, issue`` of evidence whose document is missing or changed, or does not hold its excerpt word for word.

    ``evidence`` has ``key, excerpt, content_sha256`` and ``documents`` ``key, text``; all of it is one join.
    """
    met = evidence.join(documents, key, "left")
    issue = (
        F.when(F.col("text").isNull(), "missing")
        .when(F.sha2("text", 256) != F.col("content_sha256"), "hash differs")
        .when(~F.contains("text", "excerpt"), "excerpt not verbatim")
    )
    return met.select(key, issue.alias("issue")).where("issue is not null")


#: Where a record's evidence stands.
EVIDENCES = ("assumption.evidence", "outcome.evidence", "acknowledgement_evidence")


def record_issues(records: DataFrame) -> DataFrame:
    """``record_id, check, detail`` of nested records: what the schema of a record refuses, by the dotted name of the value.

    Cells must not be empty, names must look as they should, evidence must come from the right hosts with an excerpt of 1 to 400
    characters, numbers must be finite, bounds in order, the status known, and an acknowledgement's day must come with its evidence.
    Evidence that a record need not have is checked where it is.
    """

    def matches(name: str, pattern: str, there: Column | None = None, value: Column | None = None) -> Column:
        text = F.coalesce(F.col(name) if value is None else value, F.lit(""))
        return _bad(name, ~text.rlike(pattern) if there is None else there & ~text.rlike(pattern), text)

    def present(name: str, there: Column) -> Column:
        return _bad(name, there & F.col(name).isNull(), F.lit("missing"))

    def number(name: str) -> Column:
        return _bad(name, F.isnan(name) | (F.abs(F.col(name)) == float("inf")), F.col(name))

    def upper(name: str) -> Column:
        return F.upper(F.trim(F.col(name)))

    always = F.lit(True)
    found = [
        matches("record_id", PATTERNS["draft_id"], value=upper("record_id")),
        matches("ticker", r"^[A-Z0-9.\-]{1,10}$", value=upper("ticker")),
        matches("cik", PATTERNS["cik"]),
        *[matches(name, "^(?s).") for name in ("company", "claim", "invalidation_condition", "reviewer", "assumption.text", "assumption.metric", "assumption.unit", "assumption.target_period")],
        *[present(name, always) for name in ("assumption.stated_at", "last_reviewed_at")],
        present("outcome.reported_at", F.col("outcome").isNotNull()),
        *[number(name) for name in ("assumption.target_low", "assumption.target_high", "outcome.reported_value")],
        _bad("assumption", (F.col("assumption.target_low") > F.col("assumption.target_high")) & ~F.isnan("assumption.target_low"), F.lit("bounds are not in order")),
        _bad("status", ~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)), F.col("status")),
        _bad("acknowledged_at", F.col("acknowledged_at").isNull() != F.col("acknowledgement_evidence").isNull(), F.lit("day and evidence come together")),
    ]
    for place in EVIDENCES:
        needed = {"assumption.evidence": always, "outcome.evidence": F.col("outcome").isNotNull()}.get(place, F.col(place).isNotNull())
        found += [
            matches(f"{place}.source_url", PATTERNS["source_url"], needed),
            matches(f"{place}.accession_number", ACCESSION, needed),
            matches(f"{place}.filing_type", "^.", needed, F.trim(F.col(f"{place}.filing_type"))),
            *[present(f"{place}.{name}", needed) for name in ("filed_at", "fetched_at")],
            matches(f"{place}.content_sha256", PATTERNS["content_sha256"], needed, F.lower(F.trim(F.col(f"{place}.content_sha256")))),
            matches(f"{place}.excerpt", PATTERNS["excerpt"], needed),
        ]
    return records.select("record_id", F.explode(F.array_compact(F.array(*found))).alias("i")).select("record_id", "i.*")


def evidence_issues(records: DataFrame, documents: DataFrame) -> DataFrame:
    """``record_id, check`` of evidence, up to three a record, whose document is not in the cache, has changed, or lacks the excerpt word for word.

    ``records`` are nested; ``documents`` has ``cik, accession, text``.  All evidence is met in one join, and a text is hashed once.
    """
    given = F.array(*[F.when(F.col(place).isNotNull(), F.struct(F.lit(place).alias("place"), F.col(place).alias("e"))) for place in EVIDENCES])
    rows = records.select("record_id", "cik", F.explode(F.array_compact(given)).alias("g"))
    rows = rows.select("record_id", "cik", "g.place", F.col("g.e.accession_number").alias("accession"), F.col("g.e.content_sha256").alias("sha"), F.col("g.e.excerpt").alias("excerpt"))
    kept = documents.select("cik", "accession", "text", F.sha2("text", 256).alias("its_sha"))
    met = rows.join(kept, ["cik", "accession"], "left")
    there = F.col("text").isNotNull()
    found = F.array_compact(
        F.array(
            F.when(~there, "cached_document"),
            F.when(there & ~F.col("its_sha").eqNullSafe(F.col("sha")), "content_sha256"),
            F.when(there & ~F.coalesce(F.contains("text", "excerpt"), F.lit(False)), "excerpt"),
        )
    )
    return met.select("record_id", F.explode(F.transform(found, lambda c: F.concat("place", F.lit("."), c))).alias("check"))


def calendar_issues(companies: DataFrame) -> DataFrame:
    """``company, check`` of companies without a fiscal month from 1 to 12, or a rule by which years are named."""
    found = F.array_compact(F.array(F.when(~F.coalesce(F.col("fiscal_month").between(1, 12), F.lit(False)), "fiscal month"), F.when(F.col("named_for_end").isNull(), "naming of years")))
    return companies.select("company", F.explode(found).alias("check"))


def unknown_keys(rows: DataFrame, value: str, schema: str) -> DataFrame:
    """All columns of ``rows`` and ``key``, a row for each key of the JSON text that the schema does not have, in dots from the top.

    The checks are made by walking the schema: every object it describes is asked for its keys.  Objects that are null or absent have none;
    what an unknown key holds is not looked into.  Names differ by case.
    """

    def walk(fields: list[T.StructField], path: str) -> list[Column]:
        known = F.array(*[F.lit(f.name) for f in fields])
        whole = F.col(value) if not path else F.get_json_object(value, f"$.{path}")
        prefix = f"{path}." if path else ""
        keys = F.transform(F.array_except(F.json_object_keys(whole), known), lambda k: F.concat(F.lit(prefix), k))
        found = [F.coalesce(keys, F.array().cast("array<string>"))]
        for f in fields:
            if isinstance(f.dataType, T.StructType):
                found += walk(f.dataType.fields, prefix + f.name)
        return found

    return rows.withColumn("key", F.explode(F.flatten(F.array(*walk(T.StructType.fromDDL(schema).fields, "")))))
