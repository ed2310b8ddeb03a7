"""JSON sources whose files bring fields that nobody named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veriflux.sources.files import FILES_PER_TRIGGER, with_source_file

UNKNOWN, CORRUPT = "_unknown_fields", "_corrupt_record"


def unpack_json(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """The named fields of each line, all others as one VARIANT in `_unknown_fields` (null if there are none), and the text of
    lines that are no JSON object in `_corrupt_record`. All other columns of `lines` are kept."""
    names = StructType.fromDDL(schema).names
    text = F.col(column)
    read = F.from_json(text, schema)
    fields = F.from_json(text, "map<string,variant>")
    more = F.map_filter(fields, lambda name, _: ~name.isin(names))
    others = [c for c in lines.columns if c != column]
    marked = lines.select(*others, text, read.alias("_read"), fields.alias("_fields"), more.alias("_more"))
    return marked.select(
        *[F.col("_read")[n].alias(n) for n in names],
        F.when(F.size("_more") > 0, F.to_variant_object("_more")).alias(UNKNOWN),
        F.when(text.isNotNull() & F.col("_fields").isNull(), text).alias(CORRUPT), *others,
    )


def stream_json(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """JSON lines of a folder as they arrive. A stream fixes its columns when it starts; what later files bring besides is kept
    in `_unknown_fields`."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return unpack_json(with_source_file(reader.load(path)), schema)


def unknown_schema(rows: DataFrame) -> str:
    """What the unknown fields of all rows look like together, as the DDL of an object; `VOID` if there are none."""
    return rows.agg(F.schema_of_variant_agg(UNKNOWN)).first()[0]


def unknown(name: str, kind: str) -> Column:
    """An unknown field by name; null where it is absent or of another kind."""
    return F.try_variant_get(UNKNOWN, f"$.{name}", kind)
