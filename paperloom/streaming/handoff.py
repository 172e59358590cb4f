"""Row messages between the two stages: JSON, UTF-8, base64."""

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def encode_rows(df: DataFrame, into: str = "data") -> DataFrame:
    """One message per row, so a table of any size is never held as one message.

    Line breaks that the encoder may put into long messages are taken out again.
    """
    payload = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    message = F.translate(F.base64(F.encode(payload, "UTF-8")), "\r\n", "")
    return df.select(message.alias(into))


def decode_rows(messages: DataFrame, schema: str, column: str = "data") -> DataFrame:
    """Rows of the messages; one that cannot be read is kept in ``_corrupt_record``."""
    data = F.col(column)
    raw = F.try_validate_utf8(F.try_to_binary(data, F.lit("base64")).cast("string"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(raw, f"{schema}, {CORRUPT} string", options)
    rows = messages.select(data.alias("__data"), parsed.alias("__row"))
    corrupt = F.when(F.col("__row").isNull(), F.col("__data")).otherwise(F.col(f"__row.{CORRUPT}"))
    return rows.select("__row.*", corrupt.alias("__corrupt")).drop(CORRUPT).withColumnRenamed(
        "__corrupt", CORRUPT
    )


def publish(df: DataFrame, path: str) -> None:
    """Append the rows as messages to a folder that the second stage reads as a stream.

    The files are compressed: a message repeats the names of all its fields.
    """
    encode_rows(df).write.mode("append").option("compression", "gzip").text(path)


def read_messages(
    spark: SparkSession, path: str, schema: str, max_files: int = 1000
) -> DataFrame:
    """The folder of messages as a stream of rows, at most ``max_files`` files at a time."""
    raw = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return decode_rows(raw, schema, "value")


def encode_described(df: DataFrame, into: str = "data") -> DataFrame:
    """One message per row that holds the names and types of its fields beside their values."""
    fields = df.schema.json()
    payload = F.to_json(F.struct(F.lit(fields).alias("schema"), F.struct("*").alias("row")), {"ignoreNullFields": "false"})
    return df.select(F.translate(F.base64(F.encode(payload, "UTF-8")), "\r\n", "").alias(into))


def _merged(schemas: list[T.StructType]) -> T.StructType:
    """All fields in order of first sight; one that has several types is read as text."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            known = kinds.setdefault(field.name, field.dataType)
            if known != field.dataType:
                kinds[field.name] = T.StringType()
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def message_schema(messages: DataFrame, column: str = "data") -> T.StructType:
    """The fields of all messages together, from the schemas they carry.

    One text per version of the fields reaches the driver, not per message.
    """
    found = _documents(messages, column).select(F.try_variant_get("__doc", "$.schema", "string").alias("schema"))
    texts = sorted(r.schema for r in found.where("schema IS NOT NULL").distinct().collect())
    # The versions with the fewest fields are the oldest: their order of fields leads.
    schemas = [T.StructType.fromJson(json.loads(t)) for t in texts]
    return _merged(sorted(schemas, key=lambda s: (len(s), s.simpleString())))


def _documents(messages: DataFrame, column: str) -> DataFrame:
    data = F.col(column)
    raw = F.try_validate_utf8(F.try_to_binary(data, F.lit("base64")).cast("string"))
    # ``inline`` keeps the parser below; merged into the fields it would run once for each.
    return messages.select(F.inline(F.array(F.struct(data.alias("__data"), F.try_parse_json(raw).alias("__doc")))))


def decode_described(messages: DataFrame, column: str = "data", schema: T.StructType | None = None) -> DataFrame:
    """Rows of messages that carry their schemas, old and new ones together.

    A field that a message does not have is NULL, as is a value that does not fit its type; what
    is no such message is kept in ``_corrupt_record``. Without a ``schema`` the messages' own are
    merged first (``message_schema``).
    """
    schema = schema or message_schema(messages, column)
    rows = _documents(messages, column)

    def value(field: T.StructField) -> Column:
        kind, path = field.dataType.simpleString(), f"$.row['{field.name}']"
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.try_variant_get("__doc", path, "string").try_cast(field.dataType).alias(field.name)
        return F.try_variant_get("__doc", path, kind).alias(field.name)

    sound = F.try_variant_get("__doc", "$.schema", "string").isNotNull()
    corrupt = F.when(~F.coalesce(sound, F.lit(False)), F.col("__data")).alias(CORRUPT)
    return rows.select(*[value(f) for f in schema], corrupt)
