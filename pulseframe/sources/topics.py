"""Message topics: subscribe, decode, encode, publish."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.readings import parse_time, patient_or_unknown, with_vitals

# Message key of a reading without patient, reasons for quarantine.
UNKNOWN_KEY = "unknown"
MALFORMED = "malformed message"
NO_VITALS = "no usable vital"


def subscribe(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", most_per_batch: int = 1_000_000, **options
) -> DataFrame:
    """Streaming frame of a Kafka topic; offsets live in the query's checkpoint.

    A micro-batch takes ``most_per_batch`` messages at most; the rest wait for the next
    one. Needs the Kafka connector on the class path. File streams, whose counterpart is
    ``maxFilesPerTrigger``, go through the same decoder.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", most_per_batch)
    )
    return reader.options(**options).load()


def parsed(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages with ``body``, a VARIANT; NULL where the message is not a JSON object."""
    message = F.col(value).cast("string")
    return messages.withColumn("body", F.when(F.ltrim(message).startswith("{"), F.try_parse_json(message)))


def decode(messages: DataFrame, value: str = "value", for_cleaning: bool = True) -> DataFrame:
    """Readings from JSON messages; ``body`` is NULL where the message is not a JSON object.

    Other message columns (offset, partition, ...) are kept.
    """
    bodies = parsed(messages, value)
    text = lambda path: F.try_variant_get("body", path, "string")
    told = bodies.withColumns({"patient_id": patient_or_unknown(text("$.patient_id")), "timestamp": text("$.timestamp")})
    timed = told.withColumns({"ts": parse_time(F.col("timestamp")), "device_id": text("$.device_id")})
    return with_vitals(timed, F.try_variant_get("body", "$.vital_signs", "variant"), for_cleaning)


def rejection(decoded: DataFrame) -> Column:
    """Why a decoded message cannot be scored, NULL if it can."""
    return F.when(F.col("body").isNull(), MALFORMED).when(F.size("vitals") == 0, NO_VITALS)


def only(decoded: DataFrame, condition: Column) -> DataFrame:
    """The rows for which a condition on decoded columns holds.

    It is a generator rather than a filter: Spark would push a filter below the decoding
    and so decode every message twice.
    """
    return decoded.withColumn("_passed", F.explode(F.when(condition, F.array(F.lit(True))))).drop("_passed")


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings with at least one vital, quarantined messages with a reason)."""
    reason = rejection(decoded)
    return (
        only(decoded, reason.isNull()),
        decoded.withColumn("reason", F.explode(F.array_compact(F.array(reason)))),
    )


def encode(readings: DataFrame, topic: str, sent_at: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """Key and JSON value per reading, keyed by patient, with producer metadata."""
    body = [F.col(c) for c in (columns or readings.columns)]
    meta = F.struct(
        F.date_format(sent_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("sent_at"), F.lit(topic).alias("topic")
    )
    return readings.select(
        F.coalesce(F.col("patient_id").cast("string"), F.lit(UNKNOWN_KEY)).alias("key"),
        F.to_json(F.struct(*body, meta.alias("producer_metadata"))).alias("value"),
    )


def counted(messages: DataFrame, name: str = "sent") -> tuple[DataFrame, Observation]:
    """Messages with their total, encodable and failed counts observed while they are written."""
    seen = Observation(name)
    good = F.col("value").isNotNull()
    return messages.observe(
        seen,
        F.count(F.lit(1)).alias("total"),
        F.count_if(good).alias("successful"),
        F.count_if(~good).alias("failed"),
    ), seen


def publish(messages: DataFrame, servers: str, topic: str) -> dict[str, int]:
    """Write a batch to a topic and return its counts."""
    observed, seen = counted(messages)
    (
        observed.filter(F.col("value").isNotNull())
        .write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )
    return seen.get
