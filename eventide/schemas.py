"""Fixed schemas of the event and window tables, and the value lists they use."""

from pyspark.sql import types as T

# The closed list of event types, in the order error texts print it.
EVENT_TYPES = ["click", "page_view", "purchase", "login", "logout", "search"]

# Limits of the validation rules.
MAX_ID_BYTES = 36
MAX_DURATION_MS = 300000

USER_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("duration_ms", T.DoubleType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

EVENT_COUNTS_TYPE = "map<string,bigint>"
TOP_PAGES_TYPE = "array<struct<page:string,count:bigint>>"

WINDOW = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("event_counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("unique_users", T.LongType()),
        T.StructField("avg_duration_ms", T.DoubleType()),
        T.StructField(
            "top_pages",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("page", T.StringType()),
                        T.StructField("count", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)

# The stored form keeps the two nested columns as JSON text.
WINDOW_AT_REST = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("unique_users", T.LongType()),
        T.StructField("avg_duration_ms", T.DoubleType()),
        T.StructField("top_pages", T.StringType()),
        T.StructField("event_counts", T.StringType()),
    ]
)

# The exchange form: scalars only.
WINDOW_EXPORT_COLUMNS = [
    "window_start",
    "window_end",
    "total_events",
    "unique_users",
    "avg_duration_ms",
]

# One mergeable counter per (window, dimension, key); see operators.windows.
CELL = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("dim", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("duration", T.DoubleType()),
    ]
)

# Counters as a log of batches.
CELL_LOG = T.StructType([*CELL.fields, T.StructField("batch_id", T.LongType())])
