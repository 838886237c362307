"""JSON text to records and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

CORRUPT = "_corrupt"


def decode(df: DataFrame, schema: T.StructType, value: str = "value", out: str = "event") -> DataFrame:
    """Read a JSON column into a struct; text that is no such record lands in ``_corrupt``
    (a null value as empty text).

    Unknown fields are ignored. JSON values of another kind inside a string map are
    kept as their JSON text.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = F.from_json(
        F.col(value), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    names = [field.name for field in schema.fields]
    # Out of a generator, so that later filters on the fields stay above it and do not decode again.
    decoded = df.select(*df.columns, F.explode(F.array(read)).alias("_read"))
    bad = F.col("_read").isNull() | F.col(f"_read.{CORRUPT}").isNotNull()
    return decoded.select(
        *df.columns,
        F.when(~bad, F.struct(*[F.col("_read")[n].alias(n) for n in names])).alias(out),
        F.when(bad, F.coalesce(F.col(f"_read.{CORRUPT}"), F.col(value), F.lit(""))).alias(CORRUPT),
    )


def decode_each_field(df: DataFrame, schema: T.StructType, value: str = "value",
                      time_format: str = "yyyy-MM-dd HH:mm:ss", default_time: Column | None = None) -> DataFrame:
    """Read every field on its own: one bad or missing field leaves the others intact.

    Times that are present but unreadable become ``default_time``; absent and null
    fields stay null.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    read = df.withColumn("_text", F.from_json(F.col(value), texts, {"mode": "PERMISSIVE"}))

    def field(f: T.StructField) -> Column:
        text = F.col(f"_text.{f.name}")
        if isinstance(f.dataType, T.StringType):
            return text.alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            time = F.try_to_timestamp(text, F.lit(time_format)).cast("timestamp_ntz")
            if default_time is not None:
                time = F.when(text.isNotNull(), F.coalesce(time, default_time))
            return time.alias(f.name)
        return text.try_cast(f.dataType).alias(f.name)

    return read.select(*df.columns, *[field(f) for f in schema.fields])


def encode(*columns: str | Column, time_format: str = "yyyy-MM-dd'T'HH:mm:ss") -> Column:
    """One JSON document per row. Null fields are left out."""
    return F.to_json(F.struct(*columns), {
        "timestampNTZFormat": time_format, "timestampFormat": time_format})
