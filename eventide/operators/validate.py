"""Event and window validation.

Every function adds the columns ``is_valid`` and ``errors`` (``array<string>``)
in one narrow pass without a shuffle. Splitting into a good and a rejected table
is a partitioned write of that one frame, see ``sources.events.write_split``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions import strict_json as js
from eventide.functions.plan import compute_once
from eventide.functions.rules import REQUIRED, rule_errors_sql, typed_errors_sql

# Order in which fields of an already parsed object are visited.
_BY_NAME = f"array({', '.join(repr(n) for n in sorted(REQUIRED))})"
_BY_POSITION = f"array({', '.join(repr(n) for n in REQUIRED)})"


def _with_verdict(df: DataFrame, errors_sql: str) -> DataFrame:
    return df.withColumn("errors", F.expr(errors_sql)).withColumn(
        "is_valid", F.size("errors") == 0
    )


def validate_events(events: DataFrame) -> DataFrame:
    """Check typed events against the six field rules."""
    return _with_verdict(events, typed_errors_sql({n: n for n in REQUIRED}))


def validate_windows(windows: DataFrame) -> DataFrame:
    """Check each window's average duration with the event rules.

    The other five fields are constants that always pass, so only the duration
    rule can fail; Catalyst folds the rest away.
    """
    fields = {
        "id": "'window'",
        "user_id": "'system'",
        "session_id": "'pipeline'",
        "event_type": "'page_view'",
        "page": "'/'",
        "duration_ms": "avg_duration_ms",
    }
    return _with_verdict(windows, typed_errors_sql(fields))


def validate_json_events(records: DataFrame, json_col: str = "value") -> DataFrame:
    """Check one JSON event per row.

    A record that cannot be read gives exactly one error starting with
    ``JSON parse error:``. Unknown keys are ignored, a repeated known key is an
    error, and so is anything after the record. An event may also be written as
    an array of its six fields in order.

    The error names the failing field; the line and column a text parser would
    append are not reproduced.
    """
    parsed = records.withColumn("_parsed", F.expr(js.read_object(json_col, js.EVENT_LAYOUT)))
    # Only records that are no object are read a second time.
    parsed = parsed.withColumn("_object", F.expr(js.is_complete("_parsed", json_col))).withColumn(
        "_values", F.expr(f"CASE WHEN NOT _object THEN {js.read_values(json_col)} END")
    )
    fields = f"""CASE
        WHEN _object AND get(_parsed, 0) IS NOT NULL THEN {js.fields_of_struct("get(_parsed, 0)")}
        WHEN {js.is_complete_values("_values", json_col)} AND size(get(_values, 0)) = 6
        THEN {js.fields_of_positions("get(_values, 0)")}
    END"""
    keys = f"CASE WHEN _object THEN json_object_keys({json_col}) ELSE {_BY_POSITION} END"
    read = parsed.withColumn("_fields", F.expr(fields)).withColumn("_keys", F.expr(keys))
    return _judge(
        read,
        why_unreadable="'invalid event'",
        order="_keys",
        repeated=js.repeated_field("_keys"),
    ).drop("_parsed", "_object", "_values", "_fields", "_keys")


def validate_batch(batches: DataFrame, json_col: str = "events") -> DataFrame:
    """Check JSON arrays of events: one row per element, ``pos`` keeps their order.

    Text that is no JSON array gives one failed row at ``pos`` 0; an empty array
    gives none. Within an element the last of several equal keys counts (see
    ``session.configure``). An all-object batch is read in one parse, only a batch
    with other elements is read again as VARIANT.
    """
    parsed = compute_once(batches, F.expr(js.read_object_batch(json_col)).alias("_parsed"))
    fields_type = "struct<" + ",".join(f"{n}:variant" for n in REQUIRED) + ">"
    element = f"struct<fields:{fields_type},why:string>"
    # A verdict needs either the fields or the reason why there are none.
    from_objects = f"""transform(get(_parsed, 0), x -> named_struct(
        'fields', CASE WHEN x IS NOT NULL THEN {js.fields_of_struct("x")} END,
        'why', 'invalid type: null, expected struct EventData'))"""
    from_values = f"""transform(get(_values, 0), x -> named_struct(
        'fields', CASE
            WHEN startswith(schema_of_variant(x), 'OBJECT') THEN {js.fields_of_object("x")}
            WHEN size(try_variant_get(x, '$', 'array<variant>')) = 6
            THEN {js.fields_of_positions("try_variant_get(x, '$', 'array<variant>')")}
        END,
        'why', CASE
            WHEN startswith(schema_of_variant(x), 'ARRAY') THEN concat('invalid length ',
                size(try_variant_get(x, '$', 'array<variant>')),
                IF(size(try_variant_get(x, '$', 'array<variant>')) < 6,
                    ', expected struct EventData with 6 elements',
                    ', expected fewer elements in array'))
            ELSE concat('invalid type: ', {js.found("x")}, ', expected struct EventData')
        END))"""
    # The second parse is bound to a name, so that its uses do not copy it.
    other = f"""get(transform(array({js.read_values(json_col)}), _values -> CASE
        WHEN {js.is_complete_values("_values", json_col)} AND get(_values, 0) IS NOT NULL
        THEN cast({from_values} AS array<{element}>)
        ELSE array(cast(named_struct('fields', NULL, 'why', 'invalid batch') AS {element})) END), 0)"""
    elements = f"""CASE
        WHEN {js.is_complete_batch("_parsed", json_col)} THEN cast({from_objects} AS array<{element}>)
        ELSE {other}
    END"""
    # Exploding adds a filter on its input; without this step it would copy both parses.
    exploded = compute_once(parsed, F.expr(elements).alias("_elements")).select(
        *batches.columns, F.posexplode("_elements").alias("pos", "_element")
    )
    read = exploded.withColumn("_fields", F.col("_element.fields"))
    return _judge(read, why_unreadable="_element.why", order=_BY_NAME).drop("_element", "_fields")


def _judge(
    read: DataFrame, why_unreadable: str, order: str, repeated: str = "cast(NULL AS string)"
) -> DataFrame:
    """Turn ``_fields`` (struct of VARIANT, or null) into a verdict."""
    explained = read.withColumn(
        "_why",
        F.expr(
            f"""CASE
            WHEN _fields IS NULL THEN {why_unreadable}
            ELSE coalesce(
                {js.field_error("_fields", order)},
                concat('duplicate field `', {repeated}, '`'))
            END"""
        ),
    ).withColumn("_typed", F.expr(js.typed_fields("_fields")))
    rules = rule_errors_sql({n: f"_typed.{n}" for n in REQUIRED})
    errors = f"""CASE WHEN _why IS NOT NULL THEN array(concat('JSON parse error: ', _why))
        ELSE {rules} END"""
    judged = compute_once(explained, F.expr(errors).alias("errors"))
    return judged.withColumn("is_valid", F.size("errors") == 0).drop("_why", "_typed")


def verdict_json(verdicts: DataFrame) -> DataFrame:
    """Add the verdict as text: ``{"is_valid":...,"errors":[...]}``."""
    return verdicts.withColumn("verdict", F.to_json(F.struct("is_valid", "errors")))


def validation_summary(verdicts: DataFrame) -> DataFrame:
    """Rows per outcome (``valid``, ``invalid``) and per failing rule.

    The rule is the part of the message before the colon. At most nine labels
    exist, so partial aggregation leaves nine rows per task to shuffle.
    """
    labels = F.concat(
        F.array(F.when(F.col("is_valid"), "valid").otherwise("invalid")),
        F.transform("errors", lambda e: F.substring_index(e, ":", 1)),
    )
    return (
        verdicts.select(F.explode(labels).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def register_sql_functions(spark: SparkSession) -> None:
    """Make the field rules callable from SQL.

    ``event_errors(id, user_id, session_id, event_type, page, duration_ms)``
    returns the violations of one event, an empty array for a good one.
    """
    arguments = ", ".join(
        f"{n} {'DOUBLE' if n == 'duration_ms' else 'STRING'}" for n in REQUIRED
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION event_errors({arguments}) "
        f"RETURNS ARRAY<STRING> RETURN {typed_errors_sql({n: n for n in REQUIRED})}"
    )
