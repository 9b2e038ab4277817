"""Deterministic identifiers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The digits of base 32 as ``conv`` writes them, and as they are written here: without I, L, O and U.
BASE_32, CROCKFORD = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def ulid(day: Column, key: Column) -> Column:
    """26 characters: the day's milliseconds, then the first ten bytes of the key's SHA-256.

    Ten letters hold the 48 bits of the day and eight each half of the bytes, so a key is hashed twice at most, under conditions too.
    """
    millis, digest = F.lpad(F.hex(F.unix_date(day).cast("long") * 86_400_000), 12, "0"), F.sha2(key, 256)
    pieces = [(millis, 10), (F.substring(digest, 1, 10), 8), (F.substring(digest, 11, 10), 8)]
    return F.translate(F.concat(*[F.lpad(F.conv(hexed, 16, 32), n, "0") for hexed, n in pieces]), BASE_32, CROCKFORD)


def custom_id(accession: Column, char_start: Column, method: Column) -> Column:
    return F.concat_ws("_", F.regexp_replace(accession, "-", ""), char_start.cast("string"), F.substring(method, 1, 3))
