"""Records in and out: JSON lines with bad rows counted, review queues in CSV, releases in Parquet and JSON lines."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVIDENCE = "struct<source_url: string, accession_number: string, filing_type: string, filed_at: date, fetched_at: timestamp, content_sha256: string, excerpt: string>"
ASSUMPTION = f"struct<text: string, metric: string, target_low: double, target_high: double, unit: string, target_period: string, stated_at: date, evidence: {EVIDENCE}>"
OUTCOME = f"struct<reported_value: double, reported_at: date, evidence: {EVIDENCE}>"
RECORD = (
    "record_id string, company string, ticker string, cik string, claim string, "
    f"assumption {ASSUMPTION}, "
    f"outcome {OUTCOME}, invalidation_condition string, status string, acknowledged_at date, "
    f"acknowledgement_evidence {EVIDENCE}, days_to_falsifiable int, days_to_acknowledged int, last_reviewed_at date, reviewer string"
)


def read_jsonl(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """``record, valid``: blank lines are skipped; unreadable lines and unknown keys make a row invalid, not an error."""
    known = [f.name for f in T.StructType.fromDDL(schema).fields]
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", schema).alias("record"), F.expr("json_object_keys(value)").alias("keys"))
    closed = F.size(F.array_except("keys", F.array(*[F.lit(k) for k in known]))) == 0
    return parsed.select("record", (F.col("record").isNotNull() & F.coalesce(closed, F.lit(False)) & F.col(f"record.{known[0]}").isNotNull()).alias("valid"))


def answer_items(answer: Column, fields: str) -> Column:
    """The items of a model's answer in JSON, with or without a code fence around it; null if it cannot be read or has no list of items."""
    plain = F.regexp_replace(F.trim(answer), r"^```(?:json)?\s*|\s*```$", "")
    return F.from_json(plain, f"items array<struct<{', '.join(f.replace(' ', ': ', 1) for f in fields.split(', '))}>>")["items"]


def leaves(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    """Dotted names and types of a schema's leaves, in order."""
    out = []
    for f in schema.fields:
        out += leaves(f.dataType, f"{prefix}{f.name}.") if isinstance(f.dataType, T.StructType) else [(prefix + f.name, f.dataType)]
    return out


def flatten(df: DataFrame) -> DataFrame:
    """Nested records as dotted columns."""
    return df.select(*[F.col(".".join(f"`{p}`" for p in name.split("."))).alias(name) for name, _ in leaves(df.schema)])


def unflatten(df: DataFrame, schema: str = RECORD) -> DataFrame:
    """Dotted text columns as nested records: empty text is null, and a struct without any value is null."""

    def build(fields: list[T.StructField], prefix: str) -> list[Column]:
        out = []
        for f in fields:
            name = prefix + f.name
            if isinstance(f.dataType, T.StructType):
                parts = build(f.dataType.fields, f"{name}.")
                cells = [F.nullif(F.col(f"`{leaf}`").cast("string"), F.lit("")) for leaf, _ in leaves(f.dataType, f"{name}.")]
                out.append(F.when(F.coalesce(*cells).isNotNull(), F.struct(*parts)).alias(f.name))
            else:
                cell = F.nullif(F.col(f"`{name}`").cast("string"), F.lit(""))
                out.append(cell.try_cast(f.dataType).alias(f.name))
        return out

    return df.select(*build(T.StructType.fromDDL(schema).fields, ""))


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """A review queue: quoted cells may hold line ends and quotes; every column is text."""
    return spark.read.option("header", "true").option("multiLine", "true").option("quote", '"').option("escape", '"').csv(path)


def write_queue(queue: DataFrame, path: str) -> None:
    """The whole queue as compressed CSV: its cells repeat each other, and as plain text take many times the disk."""
    queue.write.mode("overwrite").option("header", "true").option("quote", '"').option("escape", '"').option("emptyValue", "").option("compression", "gzip").csv(path)


def write_release(records: DataFrame, path: str) -> None:
    """Approved records in order, flat in Parquet and nested in JSON lines; an empty release keeps its columns."""
    ordered = records.orderBy("company", "assumption.stated_at", "record_id").persist(StorageLevel.DISK_ONLY)  # sorted once for both files
    flatten(ordered).write.mode("overwrite").parquet(f"{path}/parquet")
    ordered.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/jsonl")
    ordered.unpersist()


def write_unless_empty(df: DataFrame, path: str) -> bool:
    """Refuses to replace what is there with nothing."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_by_company(df: DataFrame, path: str, files: int = 8) -> None:
    """JSON lines in a folder for each ``cik``, dealt over up to ``files`` files there by the other columns' hash, so a large company is not one task; compressed."""
    rest = F.xxhash64(*[c for c in df.columns if c != "cik"])
    df.repartition("cik", F.pmod(rest, F.lit(files))).write.mode("overwrite").option("compression", "gzip").partitionBy("cik").json(path)
