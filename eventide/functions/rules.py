"""Event validation rules as SQL expression text.

The rules are kept as text so that the same definition serves DataFrames
(``F.expr``) and SQL functions (``CREATE TEMPORARY FUNCTION``). All of it runs
inside the JVM. Rules are independent and their messages accumulate in the
order of the list below. The message texts are fixed values.
"""

from eventide.functions.text import fixed2_sql
from eventide.schemas import EVENT_TYPES, MAX_DURATION_MS, MAX_ID_BYTES

# Required fields of an event, in declaration order.
REQUIRED_TEXT = ["id", "user_id", "session_id", "event_type", "page"]
REQUIRED = [*REQUIRED_TEXT, "duration_ms"]


def _sized_id(label: str, value: str) -> str:
    # The limit counts bytes, so octet_length and not length.
    return f"""CASE
        WHEN {value} = '' THEN '{label}: must not be empty'
        WHEN octet_length({value}) > {MAX_ID_BYTES}
        THEN concat('{label}: length ', octet_length({value}), ' exceeds {MAX_ID_BYTES} chars')
    END"""


def _user_id(value: str) -> str:
    # \z and not $: in Java $ would also accept a trailing line feed.
    return f"""CASE
        WHEN {value} = '' THEN 'user_id: must not be empty'
        WHEN NOT {value} RLIKE r'^[a-zA-Z0-9_-]+\\z'
        THEN 'user_id: contains invalid characters (allowed: a-z A-Z 0-9 _ -)'
    END"""


def _event_type(value: str) -> str:
    members = ", ".join(f"'{t}'" for t in EVENT_TYPES)
    return f"""CASE
        WHEN {value} NOT IN ({members})
        THEN concat('event_type: ''', {value}, ''' is not valid (allowed: {", ".join(EVENT_TYPES)})')
    END"""


def _page(value: str) -> str:
    return f"""CASE
        WHEN NOT startswith({value}, '/')
        THEN concat('page: ''', {value}, ''' must start with ''/''')
    END"""


def _duration(value: str) -> str:
    return f"""CASE
        WHEN {value} < 0 THEN concat('duration_ms: ', {fixed2_sql(value)}, ' must be >= 0')
        WHEN {value} > {MAX_DURATION_MS}
        THEN concat('duration_ms: ', {fixed2_sql(value)}, ' exceeds max {MAX_DURATION_MS} ms (5 minutes)')
    END"""


def rule_errors_sql(fields: dict[str, str]) -> str:
    """``array<string>`` of rule violations for non-null inputs.

    ``fields`` maps each name in ``REQUIRED`` to the SQL text of its value.
    """
    checks = [
        _sized_id("id", fields["id"]),
        _user_id(fields["user_id"]),
        _sized_id("session_id", fields["session_id"]),
        _event_type(fields["event_type"]),
        _page(fields["page"]),
        _duration(fields["duration_ms"]),
    ]
    return f"array_compact(array({', '.join(checks)}))"


def typed_errors_sql(fields: dict[str, str]) -> str:
    """Violations for typed columns, which may be null or not a number.

    An event reaches the rules as JSON, where neither can occur: a null is a
    parse failure there, and so is NaN or an infinity. The same holds here.
    """
    absent = "\n".join(
        f"WHEN {fields[name]} IS NULL THEN array('JSON parse error: invalid type: null, "
        f"expected {'f64' if name == 'duration_ms' else 'a string'}')"
        for name in REQUIRED
    )
    duration = fields["duration_ms"]
    return f"""CASE {absent}
        WHEN isnan({duration}) OR abs({duration}) = double('Infinity')
        THEN array('JSON parse error: duration_ms is not a JSON number')
        ELSE {rule_errors_sql(fields)}
    END"""
