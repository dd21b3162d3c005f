"""Hash expressions, all built-in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields of the row hash, in the order they are joined (fixed by the reference).
ROW_HASH_FIELDS = ("user_trip_id", "start_time", "end_time",
                   "start_longitude", "start_latitude", "end_longitude", "end_latitude",
                   "service_name", "route_short_name", "mode",
                   "start_stop_name", "end_stop_name",
                   "source_file", "file_date_raw", "Origin_BG", "Dest_BG")
ROW_HASH_SEPARATOR = "|"


def row_hash_hex(fields: dict[str, Column] | None = None) -> Column:
    """H1: SHA-256 (hex) of the 16 fields joined by ``|``; null -> ''.

    ``fields`` maps a field name to the expression hashed for it (times are the
    raw text, coordinates the coerced numbers); missing names use the column of
    that name. A number hashes as its text, also ``0.0``.
    """
    fields = fields or {}
    parts = [F.coalesce(fields.get(name, F.col(name)).cast("string"), F.lit(""))
             for name in ROW_HASH_FIELDS]
    return F.sha2(F.concat_ws(ROW_HASH_SEPARATOR, *parts), 256)


def row_hash(fields: dict[str, Column] | None = None) -> Column:
    """H1 + H2: the 32-byte binary row hash."""
    return F.unhex(row_hash_hex(fields))


def utf16_sha256_hex(text) -> Column:
    """H3: SHA-256 of a Unicode key's UTF-16LE bytes, as hex."""
    t = F.col(text) if isinstance(text, str) else text
    return F.sha2(F.encode(t, "UTF-16LE"), 256)


def utf16_sha256(text) -> Column:
    """H3 as 32 bytes (``varbinary(32)``)."""
    return F.unhex(utf16_sha256_hex(text))
