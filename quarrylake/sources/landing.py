"""The landing area: gzip JSON lines under hour folders, written and read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarrylake.schemas import Topic

HOUR_COLUMNS = ["year", "month", "day", "hour"]
CORRUPT_COLUMN = "_corrupt_record"
_FILES_AN_HOUR = 4


def write_landing(df: DataFrame, path: str, arrival: Column) -> None:
    """Write gzip JSON lines under ``year=/month=/day=/hour=`` of the arrival time.

    An hour's rows come into at most ``_FILES_AN_HOUR`` files, by hash of the row, so that a
    large hour is written by several tasks; small pieces share a task at run time.
    """
    patterns = dict(zip(HOUR_COLUMNS, ["yyyy", "MM", "dd", "HH"]))
    hours = {name: F.date_format(arrival, pattern) for name, pattern in patterns.items()}
    (
        df.withColumns(hours)
        .repartition(*HOUR_COLUMNS, F.pmod(F.xxhash64(*df.columns), F.lit(_FILES_AN_HOUR)))
        .write.mode("append")
        .partitionBy(*HOUR_COLUMNS)
        .option("compression", "gzip")
        .json(path)
    )


def _landing_options(topic: Topic) -> dict:
    # The hour folders say when a file arrived, not when the event took place; the
    # recursive lookup keeps them out of the columns.
    return {
        "schema": f"{topic.raw_ddl}, `{CORRUPT_COLUMN}` string",
        "options": {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT_COLUMN,
            "recursiveFileLookup": "true",
            "pathGlobFilter": "*.json*",
        },
    }


def _with_source_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"))


def read_landing(spark: SparkSession, topic: Topic, path: str) -> DataFrame:
    """All landed lines as a batch: the bulk load of history."""
    how = _landing_options(topic)
    return _with_source_file(spark.read.schema(how["schema"]).options(**how["options"]).json(path))


def stream_landing(
    spark: SparkSession, topic: Topic, path: str, max_files: int = 1000
) -> DataFrame:
    """Landed lines as a stream, at most ``max_files`` files per batch."""
    how = _landing_options(topic)
    reader = spark.readStream.schema(how["schema"]).options(**how["options"])
    return _with_source_file(reader.option("maxFilesPerTrigger", max_files).json(path))


def read_landing_hours(spark: SparkSession, topic: Topic, path: str) -> DataFrame:
    """Landed lines with their hour folders as columns; filters on them skip folders."""
    return spark.read.schema(topic.raw_ddl).json(path)


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """The unparsed lines, for a look at what the schema leaves out."""
    return spark.read.option("recursiveFileLookup", "true").text(path)


def parse_lines(lines: DataFrame, text: str, topic: Topic) -> DataFrame:
    """Parse JSON text; a broken line gives NULL fields and keeps its text."""
    schema = f"{topic.raw_ddl}, `{CORRUPT_COLUMN}` string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    return lines.select(F.from_json(F.col(text), schema, options).alias("_r")).select("_r.*")


def rescued(lines: DataFrame, text: str, topic: Topic) -> DataFrame:
    """The topic's columns, the whole line as VARIANT (``record``), and what the columns lost (``rescued``).

    ``rescued`` maps a top-level field to its raw value, as text or JSON: fields without a column,
    and fields whose value did not fit its column, wholly or in a nested part. A line that is no JSON
    object has no columns and no record, and is rescued whole under the name of the corrupt column.
    Lines that lost nothing, and NULL lines, have an empty map.
    """
    line = F.col(text)
    typed = F.from_json(line, topic.raw_ddl, {"mode": "PERMISSIVE"})
    rows = lines.select(
        line.alias("_line"), typed.alias("_typed"),
        F.from_json(line, "map<string,string>").alias("_raw"),
        F.try_parse_json(line).alias("record"),
    )
    lost = []
    for name, kind in topic.raw.items():
        raw, value = F.col("_raw")[name], F.col("_typed")[name]
        missed = value.isNull()
        if "<" in kind:  # a part may be lost while the rest was read: read the field alone, and look whether it fits
            alone = F.from_json(
                F.concat(F.lit('{"field":'), raw, F.lit("}")), f"field {kind}, {CORRUPT_COLUMN} string",
                {"columnNameOfCorruptRecord": CORRUPT_COLUMN},
            )
            missed = missed | alone[CORRUPT_COLUMN].isNotNull()
        lost.append(F.when(raw.isNotNull() & missed, F.lit(name)))
    rows = rows.withColumn("_lost", F.array_compact(F.array(*lost)))
    unfit = F.map_filter(
        "_raw", lambda field, raw: raw.isNotNull() & (~field.isin(list(topic.raw)) | F.array_contains("_lost", field))
    )
    whole = F.create_map(F.lit(CORRUPT_COLUMN), F.col("_line"))
    none = F.map_filter(whole, lambda field, raw: F.lit(False))
    kept = F.when(F.col("_line").isNull(), none).when(F.col("_raw").isNull(), whole).otherwise(unfit)
    # a caller's filter on the map, also the one that explode() brings, would repeat all parsing for each
    # field of a line; filters do not pass below a column that is exploded
    once = F.explode(F.array(kept)).alias("rescued")
    return rows.select(*[F.col("_typed")[name].alias(name) for name in topic.raw], "record", once)


# The fields of a message envelope.
ENVELOPE_DDL = "Type string, MessageId string, TopicArn string, Message string, Timestamp string"


def unwrap_envelope(lines: DataFrame, text: str, message: str | StructType) -> DataFrame:
    """The message inside an envelope, with the envelope's id and time."""
    envelope = F.from_json(F.col(text), ENVELOPE_DDL)
    return lines.select(envelope.alias("_e")).select(
        F.col("_e.MessageId").alias("message_id"),
        F.col("_e.Timestamp").alias("sent_at"),
        F.from_json("_e.Message", message).alias("_m"),
    ).select("message_id", "sent_at", "_m.*")
