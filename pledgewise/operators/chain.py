"""Answers about candidates turned into drafts and rejects: all guards in one order, in one plan.

Every answered item is a row that states something (metric, period, unit, bounds, spread).  Steps change what it states, layer by layer, and
later steps see what earlier ones changed; guards give reasons, each over the values of its own place in the order, and the first
reason is the row's.  So a row ends as a draft or as a reject with the guard that refused it.  All are Column expressions over one
row: a single stage, without shuffles but for the joins that bring answers, candidates and companies together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions import guards as G
from ..functions import ids
from ..functions import text as T
from ..sources import records as R

ITEM = "metric string, unit string, target_period string, value_low double, value_high double, plus_minus double, plus_minus_kind string, line_first int, line_last int"
EMPTY_REASON_CHARS, EXCERPT_CHARS = 90, 400


def _looked_up(name: Column, table: list[tuple], value: int) -> Column:
    """The value of a fixed table whose rows begin with the name; null for other names."""
    return F.element_at(F.create_map(*[F.lit(x) for row in table for x in (row[0], row[value])]), name)


_TWO_BASES = [m[: -len(" GAAP")] for m, _, _ in dims.METRICS if m.endswith(" GAAP") and m.replace(" GAAP", " non-GAAP") in {x for x, _, _ in dims.METRICS}]


#: The reason of an answer that has no items to judge.
UNREAD = "output did not parse as a list of items"


def answered_items(candidates: DataFrame, answers: DataFrame) -> DataFrame:
    """A row for each item of each usable answer with its candidate, and one row with a reason for an answer that cannot be read.

    ``candidates`` has ``custom_id, cik, accession, filed_at, capture_method, char_start, sentence, heading, lead_in, table_header,
    context_before``; ``answers`` has ``custom_id, status, text``.  Answers that did not succeed give nothing.
    """
    read = answers.where("status = 'ok'").select("custom_id", R.answer_items(F.col("text"), ITEM).alias("items"))
    met = candidates.join(read, "custom_id")
    rows = met.select("*", F.posexplode_outer("items").alias("item_index", "item")).where("items is null or item_index is not null")
    unread = F.when(F.col("items").isNull(), UNREAD)
    return rows.withColumns({"item_index": F.coalesce("item_index", F.lit(0)), "reason": unread}).drop("items")


def _other_basis(metric: Column, basis: Column) -> Column:
    """The metric on a basis, where it is one that has both."""
    plain = F.regexp_replace(metric, " (?:non-)?GAAP$", "")
    return F.when(basis.isNotNull() & metric.rlike(" (?:non-)?GAAP$") & plain.isin(_TWO_BASES), F.concat(plain, F.lit(" "), basis))


def derive(items: DataFrame, companies: DataFrame) -> DataFrame:
    """Every item with ``metric, target_period, target_low, target_high, unit, excerpt, draft_id`` and ``reason`` (null: a draft); a reject says what was answered.

    ``companies`` has ``cik, fiscal_month, named_for_end`` and ``tax_rate_parens_negative``; a company that is not in it has no calendar.
    """
    known = companies.select("cik", "fiscal_month", "named_for_end", F.coalesce("tax_rate_parens_negative", F.lit(False)).alias("tax_negative"))
    rows = items.withColumnRenamed("reason", "unread").join(known, "cik", "left")
    c, i = F.col, F.col("item")
    block, text = c("capture_method") != "sentence", c("excerpt")

    # What the row states, layer by layer: a name with a number is a value that a later step changes.
    rows = rows.withColumns(
        {"metric_1": i["metric"], "period_1": F.trim(i["target_period"]), "unit": i["unit"], "low_1": i["value_low"], "high_1": i["value_high"], "spread_1": i["plus_minus"], "how_1": F.coalesce(i["plus_minus_kind"], F.lit("none"))}
    )
    whole = F.struct(c("sentence").alias("text"), F.lit(None).cast("string").alias("reason"))
    rows = rows.withColumns({"evidence": F.when(block, G.evidence_text(c("sentence"), i["line_first"], i["line_last"], c("low_1"), c("high_1"), c("spread_1"))).otherwise(whole), "bases": F.when(block, G.header_bases(c("heading"), c("context_before")))})
    rows = rows.withColumn("excerpt", c("evidence")["text"])
    shifted = F.when(c("table_header").isNotNull(), G.shifted_period(c("period_1"), text, c("table_header"))).otherwise(c("period_1"))
    rows = rows.withColumns({"period_2": shifted, "column": G.figure_column(c("bases"), text, c("low_1"))})
    ended = G.end_date_period(c("period_2"), text, F.concat_ws(" ", "lead_in", "heading"), c("fiscal_month"), c("named_for_end"), c("filed_at"))
    rows = rows.withColumns({"target_period": F.coalesce(ended, "period_2"), "basis": F.get("bases", c("column") - 1)})
    basis = F.coalesce(F.nullif("basis", F.lit("Adjustments")), F.when(block, G.heading_basis(c("heading"), text)))
    rows = rows.withColumn("metric", F.coalesce(_other_basis(c("metric_1"), basis), "metric_1"))
    rows = rows.withColumns({"kind": _looked_up(c("metric"), dims.METRICS, 1), "scale": _looked_up(c("unit"), dims.UNITS, 3)})
    rows = rows.withColumn("printed", G.printed_spread(text, c("low_1"), c("high_1"), c("kind"), c("scale")))
    found, is_printed = c("printed"), c("printed").isNotNull()
    rows = rows.withColumns(
        {
            "low": F.when(is_printed, found["centre"]).otherwise(c("low_1")),
            "high_2": F.when(is_printed, found["centre"]).otherwise(c("high_1")),
            "spread_2": F.when(is_printed, found["size"]).otherwise(c("spread_1")),
            "how_2": F.when(is_printed, F.when(found["relative"], "percent").otherwise("absolute")).otherwise(c("how_1")),
        }
    )
    alone = c("how_2") == "none"
    rows = rows.withColumn("high", F.when(alone, G.one_sided(c("low"), c("high_2"), text)).otherwise(c("high_2")))
    money = ~alone & c("kind").isin("dollars", "per share") & (c("low") == c("high"))
    rows = rows.withColumn("in_money", F.when(money, G.currency_spread(text, c("low"), c("unit") == "USD per share", c("scale"))))
    points = c("in_money").isNotNull() | ((c("kind") == "percent") & (c("how_2") == "percent"))
    rows = rows.withColumn("range", G.resolve_range(c("low"), c("high"), F.when(~alone, F.coalesce("in_money", "spread_2")), ~points & (c("how_2") == "percent")))
    rows = rows.withColumn("signed", G.signed_range(c("metric"), c("kind"), c("range")["low"], c("range")["high"], text, c("tax_negative")))

    centred = F.coalesce((c("low") == c("high")) & F.coalesce("in_money", "spread_2").isNotNull(), F.lit(False))
    reasons = [  # in the order in which guards refuse
        c("unread"),
        F.when(_looked_up(c("metric_1"), dims.METRICS, 1).isNull(), "metric is not in the list"),
        c("evidence")["reason"],
        F.when(G.bare_value(text, c("heading")), "a bare value without a label"),
        G.restated_base(text, c("low_1"), c("high_1")),
        G.period_shape(c("target_period"), text),
        F.when((c("metric_1") == "tax rate") & G.is_tax_footnote(text), "a footnote on two periods of the tax rate"),
        F.when((c("basis") == "Adjustments") & _other_basis(c("metric_1"), F.lit("GAAP")).isNotNull(), "the figure is in the Adjustments column"),
        G.unit_kind_differs(_looked_up(c("unit"), dims.UNITS, 2), c("kind")),
        F.when(~is_printed, G.is_change(text, c("kind"), c("low"), c("high_2"))),
        G.relative_to_prior(text, c("kind"), c("low"), c("high_2")),
        F.when(~alone & ~centred, "a spread without one centre"),
        c("range")["reason"],
        F.when(~alone & ~text.rlike(f"(?i){G.PLUS_MINUS}"), "a spread without plus or minus in the evidence"),
        F.when(alone & (c("low") != c("high")) & ~text.rlike(G.RANGE_WORDS), "a range without words of a range"),
        F.when(~is_printed, G.missing_numbers(text, [c("low"), c("high")])),
        G.past_tense(text),
    ]
    rows = rows.withColumn("reason", G.first_reason(*reasons))
    key = F.concat_ws("|", "custom_id", c("item_index").cast("string"), "metric", "target_period")
    kept = c("reason").isNull()
    draft_id = F.when(kept, ids.ulid(c("filed_at"), key))
    low, high = F.when(kept, c("signed")["low"]).otherwise(c("low_1")), F.when(kept, c("signed")["high"]).otherwise(c("high_1"))
    return rows.select(
        "custom_id", "item_index", draft_id.alias("draft_id"), "cik", "accession", c("filed_at").alias("stated_at"), "capture_method", "char_start", F.when(kept, c("metric")).otherwise(c("metric_1")).alias("metric"),
        F.when(kept, c("target_period")).otherwise(c("period_1")).alias("target_period"), low.alias("target_low"), high.alias("target_high"), "unit", "excerpt", "reason",
    )


def write(derived: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Drafts and rejects, written apart in one pass and read back."""
    derived.withColumn("kept", F.col("reason").isNull()).write.mode("overwrite").partitionBy("kept").parquet(path)
    back = derived.sparkSession.read.schema(derived.withColumn("kept", F.lit(True)).schema).parquet(path)
    return back.where("kept").drop("kept", "reason"), back.where("not kept").select("custom_id", "item_index", "cik", "metric", "reason")


def empty_blocks(candidates: DataFrame, answers: DataFrame, drafts: DataFrame, rejects: DataFrame) -> DataFrame:
    """``custom_id, cik, accession, block_id, excerpt, reason`` of answered blocks without a draft.

    A block whose drafts were later dropped as duplicates has drafts; one that was not answered is not listed.
    """
    read = answers.where("status = 'ok'").select("custom_id", R.answer_items(F.col("text"), ITEM).alias("items"))
    blocks = candidates.where("capture_method <> 'sentence'").join(read, "custom_id").join(drafts.select("custom_id").distinct(), "custom_id", "left_anti")
    why = rejects.groupBy("custom_id").agg(F.array_join(F.sort_array(F.collect_set(F.substring("reason", 1, EMPTY_REASON_CHARS))), "; ").alias("why"))
    n = F.size("items")
    reason = (
        F.when(F.col("items").isNull(), "the output did not parse")
        .when(n == 0, "no items were returned")
        .otherwise(F.concat(n.cast("string"), F.lit(" item(s), all rejected: "), F.coalesce("why", F.lit(""))))
    )
    block_id = ids.ulid(F.col("filed_at"), F.concat(F.col("custom_id"), F.lit("|empty_block")))
    return blocks.join(why, "custom_id", "left").select("custom_id", "cik", "accession", block_id.alias("block_id"), F.substring("sentence", 1, EXCERPT_CHARS).alias("excerpt"), reason.alias("reason"))
