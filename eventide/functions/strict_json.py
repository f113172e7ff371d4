"""Strict JSON reading of event records, as SQL expression text.

``from_json`` on its own is too lenient here: it turns 5 into "5", and it stops
reading after the first value. Two things make it strict:

* Known fields are read as VARIANT, so their JSON type stays visible: SQL NULL
  means the key is absent, ``VOID`` is a JSON null.
* The record is embedded in an array followed by a closing element that holds
  the record's own hash, ``[<record>,{"_end":<hash>}]``. Text after the record
  breaks the array, or leaves it without the closing element; a record cannot
  carry its own 64-bit hash.

So one parse per record gives the field values, their types, and the proof that
nothing trails the record.
"""

from eventide.functions.rules import REQUIRED, REQUIRED_TEXT

EVENT_LAYOUT = dict.fromkeys(REQUIRED, "variant")

_STRICT = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"


def _read(json: str, closing: str, schema: str) -> str:
    text = f"concat('[', {json}, ',', {closing}, ']')"
    return f"from_json({text}, '{schema}', {_STRICT})"


def _closing_object(json: str) -> str:
    return f"""concat('{{"_end":', xxhash64({json}), '}}')"""


def _closing_array(json: str) -> str:
    return f"concat('[', xxhash64({json}), ']')"


def _field_list(layout: dict[str, str]) -> str:
    return ",".join(f"{n}:{kind}" for n, kind in layout.items())


def read_object(json: str, layout: dict[str, str]) -> str:
    """``array<struct<fields, _end>>`` with the given field types."""
    return _read(
        json, _closing_object(json), f"array<struct<{_field_list(layout)},_end:bigint>>"
    )


def is_complete(parsed: str, json: str) -> str:
    """True when ``parsed`` is the record plus its closing element."""
    return f"coalesce(size({parsed}) = 2 AND get({parsed}, 1)._end = xxhash64({json}), false)"


def read_entries(json: str) -> str:
    """``array<map<string,variant>>``: every key of the record, in any spelling."""
    return _read(json, _closing_object(json), "array<map<string,variant>>")


def has_repeats(keys: str) -> str:
    """True when a name occurs twice in an ``array<string>``."""
    return f"coalesce(size(array_distinct({keys})) < size({keys}), false)"


def whole_object(json: str) -> str:
    """``map<string,variant>`` of text that is exactly one JSON object, else null."""
    parsed = read_entries(json)
    closing = "try_variant_get(try_element_at(element_at(p, 2), '_end'), '$', 'bigint')"
    return f"""get(transform(array({parsed}),
        p -> CASE WHEN size(p) = 2 AND {closing} = xxhash64({json}) THEN element_at(p, 1) END), 0)"""


def whole_array(json: str, layout: dict[str, str]) -> str:
    """``array<struct>`` of text that is exactly one JSON array of objects, else null."""
    parsed = _read(
        json, f"concat('[', {_closing_object(json)}, ']')", f"array<array<struct<{_field_list(layout)},_end:bigint>>>"
    )
    return f"""get(transform(array({parsed}), p -> CASE WHEN size(p) = 2
        AND get(element_at(p, 2), 0)._end = xxhash64({json}) THEN element_at(p, 1) END), 0)"""


def whole_number(variant: str) -> str:
    """A count as a bigint: a number cut to its whole part, or text that spells one."""
    return f"""CASE WHEN {is_number_kind(f'schema_of_variant({variant})')} THEN try_cast({number(variant)} AS bigint)
        WHEN {is_text(variant)} THEN try_cast({text(variant)} AS bigint) END"""


def read_values(json: str) -> str:
    """``array<array<variant>>`` for a record that is a JSON array."""
    return _read(json, _closing_array(json), "array<array<variant>>")


def is_complete_values(parsed: str, json: str) -> str:
    return (
        f"coalesce(size({parsed}) = 2 AND "
        f"try_variant_get(get(get({parsed}, 1), 0), '$', 'bigint') = xxhash64({json}), false)"
    )


def read_object_batch(json: str) -> str:
    """``array<array<struct>>`` for an array whose elements are all objects."""
    return _read(
        json,
        f"concat('[', {_closing_object(json)}, ']')",
        f"array<array<struct<{_field_list(EVENT_LAYOUT)},_end:bigint>>>",
    )


def is_complete_batch(parsed: str, json: str) -> str:
    return (
        f"coalesce(size({parsed}) = 2 AND get({parsed}, 0) IS NOT NULL AND "
        f"get(get({parsed}, 1), 0)._end = xxhash64({json}), false)"
    )


def fields_of_object(variant: str) -> str:
    """Known fields of an object held as VARIANT."""
    return _struct({n: f"try_variant_get({variant}, '$.{n}', 'variant')" for n in REQUIRED})


def fields_of_positions(values: str) -> str:
    """Known fields of an event written as a six-element array."""
    return _struct({n: f"get({values}, {i})" for i, n in enumerate(REQUIRED)})


def fields_of_struct(parsed: str) -> str:
    return _struct({n: f"{parsed}.{n}" for n in REQUIRED})


def _struct(values: dict[str, str]) -> str:
    return f"named_struct({', '.join(f'{k!r}, {v}' for k, v in values.items())})"


def kind(variant: str) -> str:
    """JSON type of a value; an absent one counts as null."""
    return f"coalesce(schema_of_variant({variant}), 'VOID')"


def is_number_kind(kind: str) -> str:
    return f"{kind} RLIKE '^(BIGINT|DOUBLE|FLOAT|DECIMAL)'"


def is_number(variant: str) -> str:
    """JSON number that fits a double."""
    return (
        f"({is_number_kind(f'schema_of_variant({variant})')} "
        f"AND abs({number(variant)}) < double('Infinity'))"
    )


def is_text(variant: str) -> str:
    return f"schema_of_variant({variant}) = 'STRING'"


def text(variant: str) -> str:
    return f"try_variant_get({variant}, '$', 'string')"


def number(variant: str) -> str:
    return f"try_variant_get({variant}, '$', 'double')"


def found(variant: str) -> str:
    """What a type error says was found in place of the expected type."""
    kind = f"schema_of_variant({variant})"
    value = text(variant)
    return f"""CASE
        WHEN {kind} = 'VOID' THEN 'null'
        WHEN {kind} = 'BOOLEAN' THEN concat('boolean `', {value}, '`')
        WHEN {kind} = 'BIGINT' THEN concat('integer `', {value}, '`')
        WHEN {kind} = 'STRING' THEN concat('string "', {value}, '"')
        WHEN startswith({kind}, 'ARRAY') THEN 'sequence'
        WHEN startswith({kind}, 'OBJECT') THEN 'map'
        ELSE concat('floating point `', {value}, '`')
    END"""


def field_error(fields: str, order: str) -> str:
    """Text of the first unusable field, or null when all six are usable.

    Type errors come first, in the order the reader meets the keys (``order``,
    an ``array<string>``); an absent field is only noticed afterwards, in
    declaration order.
    """
    wrong = []
    for name in REQUIRED:
        value = f"{fields}.{name}"
        usable = is_number(value) if name == "duration_ms" else is_text(value)
        expected = "f64" if name == "duration_ms" else "a string"
        wrong.append(
            f"CASE WHEN {value} IS NOT NULL AND NOT {usable} THEN named_struct("
            f"'at', array_position({order}, '{name}'), "
            f"'why', concat('invalid type: ', {found(value)}, ', expected {expected}')) END"
        )
    missing = "\n".join(
        f"WHEN {fields}.{name} IS NULL THEN 'missing field `{name}`'" for name in REQUIRED
    )
    usable = " AND ".join(
        [is_text(f"{fields}.{n}") for n in REQUIRED_TEXT]
        + [is_number(f"{fields}.duration_ms")]
    )
    # The first branch keeps good records away from the costly explanation.
    return f"""CASE
        WHEN coalesce({usable}, false) THEN NULL
        ELSE coalesce(
            array_min(array_compact(array({", ".join(wrong)}))).why,
            CASE {missing} END)
    END"""


def repeated_field(keys: str) -> str:
    """First known key that occurs twice in ``keys``, or null."""
    known = ", ".join(f"'{n}'" for n in REQUIRED)
    first = f"get(filter({keys}, (k, i) -> k IN ({known}) AND array_position({keys}, k) <= i), 0)"
    return f"CASE WHEN {has_repeats(keys)} THEN {first} END"


def typed_fields(fields: str) -> str:
    """``struct`` of the six fields with their SQL types."""
    values = {n: text(f"{fields}.{n}") for n in REQUIRED_TEXT}
    values["duration_ms"] = number(f"{fields}.duration_ms")
    return _struct(values)
