"""Bus message -> log event -> enriched event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from authwatch.functions import classify
from authwatch.schema import BUS_EVENT, BUS_TIMES, ENRICHED, LOG_EVENT


CORRUPT = "_corrupt_record"


def _decoded(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``_raw``, the event columns, and the text of messages that are no JSON.

    The event is the output of a generator. Filters, also those of later steps,
    therefore stay above it, and each message is parsed exactly once; through a
    projection Catalyst would copy ``from_json`` into every filter.
    """
    raw = df.select(F.col("value").cast("string").alias("_raw"))
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    event = F.from_json("_raw", wanted, {"columnNameOfCorruptRecord": CORRUPT})
    return raw.select("_raw", F.inline(F.array(event)))


def decode_event_json(df: DataFrame, schema: T.StructType = BUS_EVENT,
                      keep_malformed: bool = False, corrupt_col: str | None = None) -> DataFrame:
    """Decode the ``value`` column into event columns.

    A message that is no JSON is left to :func:`malformed_events`;
    ``keep_malformed`` passes it on as an event whose fields are all NULL, and
    ``corrupt_col`` adds its text. A readable message without a key is an event
    like others. Times may be text or epoch numbers. A narrow ``schema`` parses
    only its fields.
    """
    out = _decoded(df, schema)
    unreadable = F.col("_raw").isNull() | F.col(CORRUPT).isNotNull()
    if not keep_malformed:
        out = out.filter(~unreadable)
    times = {c: text_time(F.col(f"`{c}`")) for c in schema.names if c in BUS_TIMES}
    if corrupt_col:
        times[corrupt_col] = F.when(unreadable, F.coalesce("_raw", F.lit("")))
    return (out.withColumns(times).drop("_raw", CORRUPT)
            .withColumnRenamed("@timestamp", "ingest_time"))


def malformed_events(df: DataFrame, schema: T.StructType = BUS_EVENT) -> DataFrame:
    """Raw text of the messages that :func:`decode_event_json` leaves out."""
    kept = decode_event_json(df, schema, keep_malformed=True, corrupt_col="_corrupt")
    return kept.filter(F.col("_corrupt").isNotNull()).select("_corrupt")


def epoch_time(number: Column) -> Column:
    """Epoch number by magnitude: above 1e12 milliseconds, above 1e9 seconds, else nanoseconds."""
    return (F.when(number > 1_000_000_000_000, F.timestamp_millis(number))
            .when(number > 1_000_000_000, F.timestamp_seconds(number))
            .otherwise(F.timestamp_micros(F.floor(number / 1000).cast("bigint"))))


def text_time(text: Column) -> Column:
    """Time from ISO text or from the digits of an epoch number; else NULL."""
    # Told apart by their form: a cast that fails costs far more than the pattern.
    return (F.when(text.rlike("^-?[0-9]+$"), epoch_time(text.try_cast("bigint")))
            .otherwise(text.try_cast("timestamp")))


def normalise_timestamps(df: DataFrame, cols=("ingest_time", "event_time",
                                              "event_time_kst_iso")) -> DataFrame:
    """Text times to timestamps, unreadable text to NULL; others unchanged."""
    kinds = dict(df.dtypes)
    text_cols = [c for c in cols if kinds.get(c) == "string"]
    return df.withColumns({c: F.col(c).try_cast("timestamp") for c in text_cols})


def epoch_to_timestamp(df: DataFrame, col: str = "event_time", unit: str = "auto") -> DataFrame:
    """Numeric or text times in ``col`` to timestamps, decided row by row.

    ``unit="ms"`` reads milliseconds and cuts to the whole second.
    ``unit="auto"`` goes by magnitude: above 1e12 milliseconds, above 1e9
    seconds, and smaller numbers are nanoseconds.
    """
    kind = df.schema[col].dataType
    value = F.col(col)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return df
    if isinstance(kind, T.StringType):
        return df.withColumn(col, value.try_cast("timestamp"))
    number = value.cast("bigint")
    if unit == "ms":
        out = F.date_trunc("second", F.timestamp_millis(number))
    elif unit == "s":
        out = F.timestamp_seconds(number)
    else:
        out = epoch_time(number)
    return df.withColumn(col, out)


def classify_log_level(df: DataFrame) -> DataFrame:
    return df.withColumn("log_level", classify.level(F.lower("message")))


def classify_error_type(df: DataFrame) -> DataFrame:
    return df.withColumn("error_type", classify.error_type(F.lower("message")))


def extract_user(df: DataFrame) -> DataFrame:
    return df.withColumn("user", classify.user(F.col("message")))


def extract_ip(df: DataFrame) -> DataFrame:
    return df.withColumn("ip", classify.ip(F.col("message")))


def extract_port(df: DataFrame) -> DataFrame:
    return df.withColumn("port", classify.port(F.col("message")))


def classify_message_pattern(df: DataFrame) -> DataFrame:
    return df.withColumn("pattern", classify.message_pattern(F.col("message")))


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.na.fill({"message": "", "log_level": classify.LEVEL_DEFAULT})


def enrich(df: DataFrame, keep=()) -> DataFrame:
    """log_event -> enriched, on a batch or a stream.

    The lower-cased text is its own column, so that it is computed once for
    both classifications. ``keep`` names further columns to pass through.
    """
    message, lower = F.col("message"), F.col("_lower")
    kst = "event_time_kst_iso"
    told = F.col(kst) if kst in df.columns else F.lit(None).cast("timestamp")
    out = df.select(*LOG_EVENT.names, told.alias(kst), *keep).withColumn(
        "_lower", F.lower(message))
    out = out.withColumns({
        # The same instant; only messages may say otherwise.
        kst: F.coalesce(kst, "event_time"),
        "log_level": classify.level(lower),
        "error_type": classify.error_type(lower),
        "user": classify.user(message),
        "ip": classify.ip(message),
        "port": classify.port(message),
    })
    return fill_defaults(out.select(*ENRICHED.names, *keep))


def reject_counts(df: DataFrame) -> list[Column]:
    """Counters of what :func:`enforce_schema` empties and of keys to be computed.

    For ``DataFrame.observe``; they cost no pass of their own.
    """
    def lost(name: str, kept: Column) -> Column:
        if name not in df.columns:
            return F.lit(False)
        return F.col(f"`{name}`").isNotNull() & kept.isNull()

    def cast(name: str) -> Column:
        return lost(name, F.col(f"`{name}`").try_cast(ENRICHED[name].dataType))

    reasons = {
        "total_rows": F.lit(True),
        "bad_ip": lost("ip", classify.valid_ipv4(F.col("ip").cast("string"))),
        "bad_port": cast("port"),
        "bad_time": cast("event_time"),
        "keyless": F.col("row_hash").isNull() if "row_hash" in df.columns else F.lit(True),
    }
    return [F.count_if(reason).alias(name) for name, reason in reasons.items()]


def enforce_schema(df: DataFrame, schema: T.StructType = ENRICHED) -> DataFrame:
    """Give ``df`` exactly the declared columns and types.

    A value that does not fit its type becomes NULL, and so does an ``ip``
    that is not a dotted quad. Missing columns are added as NULL.
    """
    present = set(df.columns)

    def fitted(field: T.StructField):
        if field.name not in present:
            value = F.lit(None).cast(field.dataType)
        else:
            value = F.col(f"`{field.name}`")
            if df.schema[field.name].dataType != field.dataType:
                value = value.try_cast(field.dataType)
            if field.name == "ip":
                value = classify.valid_ipv4(value)
        return value.alias(field.name)

    return df.select(*[fitted(f) for f in schema.fields])
