"""JSON message bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"


def decode(body: Column, schema: StructType | str) -> Column:
    """Struct from JSON bytes or text; a malformed body gives a struct of nulls."""
    return F.from_json(body.cast("string"), schema)


def decode_marked(body: Column, schema: str) -> Column:
    """Like `decode`, with the raw text of unreadable bodies in an extra field."""
    marked = f"{schema}, {CORRUPT} STRING"
    return F.from_json(body.cast("string"), marked, {"columnNameOfCorruptRecord": CORRUPT})


def encode(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))
