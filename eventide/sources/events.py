"""Event sources and sinks: Kafka, JSON lines, and their JSON encoding."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions import strict_json as js
from eventide.functions.plan import compute_once
from eventide.functions.rules import REQUIRED_TEXT

DEFAULT_BROKERS = "localhost:9092"
DEFAULT_TOPIC = "user-events"
DEFAULT_GROUP = "analyzer-group"

# Date-time with zone as JSON carries it; Spark's own cast would accept much more.
_INSTANT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\\.[0-9]+)?"
    r"(Z|[+-]([01][0-9]|2[0-3]):[0-5][0-9])\\z"
)

# How a record is read. Text is VARIANT, because a number must not pass as text;
# for the others a value of the wrong type cannot be taken for a right one.
_TYPED = {"duration_ms": "double", "metadata": "map<string,variant>", "timestamp": "string"}
_LAYOUT = {**dict.fromkeys(REQUIRED_TEXT, "variant"), **_TYPED}

_ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_kafka(
    spark: SparkSession,
    brokers: str = DEFAULT_BROKERS,
    topic: str = DEFAULT_TOPIC,
    group: str = DEFAULT_GROUP,
    streaming: bool = True,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Raw records of one topic: ``value`` (text) and ``arrival`` (broker time).

    Spark assigns partitions to tasks and keeps offsets in its checkpoint; the
    group id only names the consumer at the broker. A limit per trigger slows
    the reader down instead of losing data. Needs the Kafka connector package
    on the class path.
    """
    reader = spark.readStream if streaming else spark.read
    limit = max_offsets_per_trigger if streaming else None
    options = kafka_read_options(brokers, topic, group, limit)
    return kafka_records(reader.format("kafka").options(**options).load())


def kafka_read_options(
    brokers: str, topic: str, group: str, max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": "earliest",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_write_options(brokers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def kafka_records(raw: DataFrame) -> DataFrame:
    """Value text and arrival time of the connector's rows."""
    return raw.select(
        F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrival")
    )


def read_json_lines(
    spark: SparkSession,
    path: str,
    streaming: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same two columns from files with one JSON record per line."""
    if streaming:
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = spark.read
    return reader.text(path).select(
        "value", F.col("_metadata.file_modification_time").alias("arrival")
    )


def decode_events(records: DataFrame, json_col: str = "value") -> DataFrame:
    """Parse JSON records: adds the struct ``event`` and the flag ``accepted``.

    A record is rejected when it is not exactly one JSON value or when a field
    has the wrong type or an unreadable timestamp. Keys are taken one after the other,
    in any letter case: a value replaces the one before, a null leaves it as it is, a
    wrong type rejects the record whatever follows, and a further metadata object adds
    its entries to those before (a null one clears them). Absent fields take
    the zero value ("", 0.0, null map); unknown keys are ignored.
    An absent timestamp stays null: such an event has no window.

    Rejected rows are kept, with a null ``event``, so that they can be counted and
    stored; see ``accepted_events`` and ``write_split``.
    """
    parsed = records.withColumn("_parsed", F.expr(js.read_object(json_col, _LAYOUT)))
    parsed = parsed.withColumn("_complete", F.expr(js.is_complete("_parsed", json_col)))
    # Null stands for an absent key, a JSON null, or a value of the wrong type. Only
    # records with such a field, or with a key that occurs twice, are read again, key by key.
    unclear = " OR ".join(f"get(_parsed, 0).{n} IS NULL" for n in _LAYOUT)
    lower_keys = f"transform(json_object_keys({json_col}), k -> lower(k))"
    parsed = parsed.withColumn(
        "_entries",
        F.expr(
            f"""CASE WHEN _complete AND get(_parsed, 0) IS NOT NULL
                AND ({unclear} OR {js.has_repeats(lower_keys)})
            THEN map_entries(get({js.read_entries(json_col)}, 0)) END"""
        ),
    )

    def given(name: str) -> str:
        return f"filter(_entries, x -> lower(x.key) = '{name}')"

    def set_values(name: str) -> str:
        """Values of a key other than null, in order."""
        return f"filter(transform({given(name)}, x -> x.value), x -> {js.kind('x')} <> 'VOID')"

    def all_are(name: str, test: str) -> str:
        return f"forall({set_values(name)}, x -> {test})"

    def last(name: str) -> str:
        return f"try_element_at({set_values(name)}, -1)"

    def direct(name: str) -> str:
        return f"get(_parsed, 0).{name}"

    texts = {
        n: (
            f"CASE WHEN _entries IS NULL THEN {js.text(direct(n))} ELSE {js.text(last(n))} END",
            f"CASE WHEN _entries IS NULL THEN {js.kind(direct(n))} IN ('STRING', 'VOID') ELSE {all_are(n, js.is_text('x'))} END",
        )
        for n in REQUIRED_TEXT
    }
    duration = f"CASE WHEN _entries IS NULL THEN {direct('duration_ms')} ELSE {js.number(last('duration_ms'))} END"
    fits = f"CASE WHEN _entries IS NULL THEN abs({direct('duration_ms')}) < double('Infinity') ELSE {all_are('duration_ms', js.is_number('x'))} END"
    instant = f"CASE WHEN _entries IS NULL THEN {direct('timestamp')} ELSE {js.text(last('timestamp'))} END"
    instants = all_are(
        "timestamp",
        f"{js.is_text('x')} AND {js.text('x')} RLIKE '{_INSTANT}' AND try_cast({js.text('x')} AS timestamp) IS NOT NULL",
    )
    # Objects after the last null; entries of all of them, one after the other.
    objects = f"""aggregate(transform({given('metadata')}, x -> x.value),
        cast(NULL AS array<struct<key: string, value: variant>>),
        (all, x) -> CASE WHEN {js.kind('x')} = 'VOID' THEN NULL ELSE concat(
            coalesce(all, array()), map_entries(try_variant_get(x, '$', 'map<string,variant>'))) END)"""
    pairs = f"CASE WHEN _entries IS NULL THEN map_entries({direct('metadata')}) ELSE {objects} END"
    maps = all_are("metadata", f"startswith({js.kind('x')}, 'OBJECT')")
    fields = parsed.select(
        *records.columns,
        F.expr(
            f"_complete AND (get(_parsed, 0) IS NULL OR ({' AND '.join(ok for _, ok in texts.values())}))"
        ).alias("_texts_ok"),
        *[F.expr(f"coalesce({value}, '')").alias(f"_{n}") for n, (value, _) in texts.items()],
        F.expr(f"coalesce({duration}, 0D)").alias("_duration_ms"),
        F.expr(f"coalesce({fits}, true)").alias("_duration_ok"),
        F.expr(f"CASE WHEN _entries IS NULL THEN true ELSE {maps} END").alias("_maps_ok"),
        F.expr(pairs).alias("_pairs"),
        F.expr(instant).alias("_instant"),
        F.expr(f"CASE WHEN _entries IS NULL THEN true ELSE {instants} END").alias("_instants_ok"),
    )
    timed = fields.withColumn(
        "_timestamp", F.expr(f"CASE WHEN _instant RLIKE '{_INSTANT}' THEN try_cast(_instant AS timestamp) END")
    )
    accepted = f"""coalesce(_texts_ok AND _duration_ok AND _maps_ok AND _instants_ok
        AND (_instant IS NULL OR _timestamp IS NOT NULL)
        AND (_pairs IS NULL OR forall(_pairs, x -> {js.kind('x.value')} IN ('STRING', 'VOID'))), false)"""
    # Of equal keys of the map the later entry counts.
    keys = "transform(_pairs, p -> p.key)"
    single = f"""CASE WHEN {js.has_repeats(keys)}
        THEN filter(_pairs, (x, i) -> NOT array_contains(slice({keys}, i + 2, size(_pairs)), x.key))
        ELSE _pairs END"""
    event = F.struct(
        *[F.col(f"_{n}").alias(n) for n in REQUIRED_TEXT],
        F.col("_duration_ms").alias("duration_ms"),
        F.expr(
            f"map_from_entries(transform({single}, x -> struct(x.key, coalesce({js.text('x.value')}, ''))))"
        ).alias("metadata"),
        F.col("_timestamp").alias("timestamp"),
    )
    judged = timed.withColumn("_accepted", F.expr(accepted))
    return compute_once(
        judged, F.when(F.col("_accepted"), event).alias("event"), F.col("_accepted").alias("accepted")
    ).select(*records.columns, "event", "accepted")


EVENT_COLUMNS = [*REQUIRED_TEXT, "duration_ms", "metadata", "timestamp"]


def accepted_events(decoded: DataFrame, *keep: str) -> DataFrame:
    """The readable events, without the raw record.

    ``keep`` names source columns to carry along, such as the arrival time.
    """
    return decoded.filter("accepted").select("event.*", *keep)


def event_json() -> Column:
    """One event as JSON text; null fields are written out."""
    return F.to_json(
        F.struct(*[F.col(n) for n in EVENT_COLUMNS]),
        {"ignoreNullFields": "false", "timestampFormat": _ISO_MICROS},
    )


def encode_events(events: DataFrame) -> DataFrame:
    """Message ``key`` and JSON ``value`` per event.

    The key is the user id, so all events of a user share a topic partition.
    """
    return events.select(F.col("user_id").alias("key"), event_json().alias("value"))


def write_kafka(
    events: DataFrame, brokers: str = DEFAULT_BROKERS, topic: str = DEFAULT_TOPIC
) -> None:
    """Send a batch of events; Spark retries failed tasks."""
    (
        encode_events(events)
        .write.format("kafka")
        .options(**kafka_write_options(brokers, topic))
        .save()
    )


def write_kafka_stream(
    events: DataFrame,
    checkpoint: str,
    brokers: str = DEFAULT_BROKERS,
    topic: str = DEFAULT_TOPIC,
):
    """Send a stream of events; returns the running query."""
    return (
        encode_events(events)
        .writeStream.format("kafka")
        .options(**kafka_write_options(brokers, topic))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_json_lines(events: DataFrame, path: str) -> None:
    """One JSON record per line, the file form of the topic."""
    encode_events(events).select("value").write.mode("append").text(path)


def write_split(verdicts: DataFrame, flag: str, path: str, run_id: str) -> str:
    """Store good and rejected rows of one run in one pass, as partitions of its folder.

    The flag becomes the partition column, so either side is read back without
    touching the other, and the parse behind it runs once. A repeated run replaces
    its own folder and no other. Returns the folder of the run.
    """
    target = f"{path}/run_id={run_id}"
    verdicts.write.mode("overwrite").partitionBy(flag).parquet(target)
    return target


def read_split(spark: SparkSession, flag: str, path: str, good: bool = True) -> DataFrame:
    """One side of all runs stored by ``write_split``; reads only its files."""
    stored = spark.read.parquet(path)
    return stored.filter(F.col(flag) == str(good).lower()).drop(flag, "run_id")
