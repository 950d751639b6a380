"""Reviews as JSON messages, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.display import iso
from opinara.functions.ratings import parse_helpful
from opinara.functions.records import field_or, literal, typed
from opinara.schema import MESSAGE_DEFAULTS, REVIEW

CORRUPT = "_corrupt"
# Fields that are made numbers, whatever they arrive as.
NUMBERS = ("overall", "unixReviewTime", "sentiment")


def normalised(df: DataFrame) -> DataFrame:
    """Every column in a form JSON can carry: times become ISO text."""
    times = (T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[iso(F.col(f.name)).alias(f.name) if isinstance(f.dataType, times) else F.col(f.name) for f in df.schema]
    )


def to_json_value(df: DataFrame) -> Column:
    """All columns as one JSON object, nulls included."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")


def message_records(df: DataFrame, sent_at: Column | None = None) -> DataFrame:
    """The typed, defaulted fields of a message, in message order."""
    types = {f.name: f.dataType.simpleString() for f in REVIEW}
    fields = []
    for name, default in MESSAGE_DEFAULTS.items():
        if name in NUMBERS and name in df.columns:
            value = typed(F.col(name), types[name], default)
        elif name == "helpful" and name in df.columns:
            value = F.coalesce(parse_helpful(df, name), literal(default))
        else:
            value = field_or(df, name, default)
        fields.append(value.cast(types[name]).alias(name))
    sent = iso(F.current_timestamp()) if sent_at is None else sent_at
    return df.select(*fields, sent.alias("kafka_timestamp"))


def to_messages(df: DataFrame, sent_at: Column | None = None) -> DataFrame:
    """One JSON ``value`` per review. ``sent_at`` (ISO text) stands in for the clock."""
    records = message_records(df, sent_at)
    return records.select(to_json_value(records))


def decoded(messages: DataFrame) -> DataFrame:
    """The raw value, the parsed ``data``, ``corrupt`` (no JSON object) and ``bad_fields``.

    Every field is read as it comes and then cast on its own, so one that does not
    fit its type is null and named in ``bad_fields``, and the others stand. Votes
    may be an array or an array written as text.
    """
    value = F.col("value").cast("string")
    texts = [T.StructField(f.name, T.StringType()) for f in REVIEW.fields]
    schema = T.StructType([*texts, T.StructField(CORRUPT, T.StringType())])
    raw = F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # As rows of a generator: a filter on a field is not moved below it, where the message would be parsed once more.
    parsed = messages.select(value.alias("value"), F.inline(F.array(raw)))
    fields, bad = [], []
    for field in REVIEW.fields:
        column = F.col(field.name)
        cast = _as_type(column, field.dataType)
        fields.append(cast.alias(field.name))
        bad.append(F.when(column.isNotNull() & cast.isNull(), F.lit(field.name)))
    return parsed.select(
        "value",
        F.struct(*fields).alias("data"),
        F.col(CORRUPT).isNotNull().alias("corrupt"),
        F.concat_ws(", ", *bad).alias("bad_fields"),
    )


def _as_type(text: Column, to: T.DataType) -> Column:
    """A field's JSON text as its declared type; null where it does not fit."""
    if isinstance(to, T.ArrayType):
        return F.from_json(text, to)
    if isinstance(to, (T.IntegerType, T.LongType)):
        # Whole numbers may be written with a point.
        return F.coalesce(text.try_cast(to), text.try_cast("decimal(38,0)").try_cast(to))
    return text if isinstance(to, T.StringType) else text.try_cast(to)


def parse_messages(messages: DataFrame) -> DataFrame:
    """Review columns of each message; bad JSON gives a row of nulls."""
    return decoded(messages).select("data.*")


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of a Kafka topic; needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages from text files, one JSON ``value`` per line."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def send_to_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish messages; needs Spark's Kafka connector on the class path."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).option("kafka.acks", "all").option("kafka.retries", 3).save()


def send_to_files(messages: DataFrame, path: str, rows_per_file: int | None = None) -> str:
    """Write messages as text files for ``file_stream``, with at most so many rows in each."""
    writer = messages.write.mode("append")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.text(path)
    return path
