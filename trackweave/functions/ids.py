"""Identifiers: name-based UUIDs, ids of position points and their tokens, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The alphabet of RFC 4648 Base32, in lower case.
ALPHABET = "abcdefghijklmnopqrstuvwxyz234567"
#: Ids in one cell.
PER_CELL = 4096
CELL_BITS = 52


def uuid3(name: Column | str) -> Column:
    """Version-3 (MD5) UUID of a string, without a namespace; null stays null."""
    h = F.md5(F.col(name) if isinstance(name, str) else name)
    third = F.concat(F.lit("3"), F.substring(h, 14, 3))
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3) + 8
    fourth = F.concat(F.lower(F.hex(nibble)), F.substring(h, 18, 3))
    parts = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), third, fourth, F.substring(h, 21, 12))
    return F.when(h.isNotNull(), parts)


def point_id(cell: str, n: str) -> Column:
    """The 52 low bits of the cell, then twelve bits of a number inside it; more than 4096 are an error."""
    checked = F.expr(f"CASE WHEN {n} >= 0 AND {n} < {PER_CELL} THEN cast({n} AS bigint) ELSE cast(raise_error(concat('too many points in cell ', {cell})) AS bigint) END")
    return F.shiftleft(F.col(cell).bitwiseAND(F.lit((1 << CELL_BITS) - 1)), 12) + checked


def base_and_number(identifier: str) -> tuple[Column, Column]:
    """The cell bits and the number that an id holds."""
    return F.shiftrightunsigned(F.col(identifier), 12), F.col(identifier).bitwiseAND(F.lit(PER_CELL - 1))


def token(identifier: str) -> Column:
    """Thirteen Base32 characters of the id's eight bytes, as xxxx-xxxx-xxxxx."""
    digits = [F.shiftrightunsigned(F.col(identifier), 59 - 5 * i).bitwiseAND(F.lit(31)) for i in range(12)]
    digits.append(F.shiftleft(F.col(identifier).bitwiseAND(F.lit(15)), 1))
    chars = [F.substring(F.lit(ALPHABET), (d + 1).cast("int"), F.lit(1)) for d in digits]
    return F.concat(*chars[:4], F.lit("-"), *chars[4:8], F.lit("-"), *chars[8:])


def register(spark) -> None:
    """SQL function uuid_from_string(text)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION uuid_from_string(s STRING) RETURNS STRING RETURN "
        "CASE WHEN s IS NOT NULL THEN concat(substr(md5(s), 1, 8), '-', substr(md5(s), 9, 4), '-3', substr(md5(s), 14, 3), '-', "
        "lower(hex((cast(conv(substr(md5(s), 17, 1), 16, 10) AS int) & 3) + 8)), substr(md5(s), 18, 3), '-', substr(md5(s), 21, 12)) END"
    )
