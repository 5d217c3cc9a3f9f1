"""Typed attribute values -> plain JSON text, as Spark SQL expressions.

A typed value is a one-key object ``{tag: payload}``; ``M`` holds a map of
typed values and ``L`` a list of them, so values nest to any depth. Spark has
no recursive type, so the decoder is unrolled to a fixed depth and works on
JSON text: ``from_json`` reads one level into ``map<string,map<string,string>>``
(name -> tag -> payload), which splits every child into tag and payload, and
hands nested payloads on as their raw text for the next level. Map entries
and list elements go through the same ``transform`` (list elements get a
null name), so every level refers to the next exactly once, the expression
grows linearly with the depth and holds one lambda per level.

The expression is generated once per option set as SQL text and handed to
``F.expr``: one call instead of thousands of Column calls through the
Python-JVM bridge.

Output is the text the per-row decoder wrote: attributes in payload order,
``", "`` and ``": "`` separators, numbers as JSON strings with their text as
is. Binary values come out as their base64 text and sets as compact arrays
of strings (the per-row decoder failed on both; ``strict_types`` restores
that). Non-ASCII characters are written as they are, and control characters
are escaped with upper-case hex digits.

Failures never disappear silently. A value that cannot be decoded becomes
SQL NULL, the enclosing ``array_join`` turns that NULL into ``BAD`` and the
marker travels up to the top, where the row becomes an error row. A value
nested deeper than ``max_depth`` becomes ``DEEP`` instead.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.config import DecodeOptions

# Markers. Both are control characters, which JSON text
# always escapes, so they cannot occur in decoded text by accident.
BAD = "\u0000"
DEEP = "\u0001"
_BAD_SQL = "chr(0)"
_DEEP_SQL = "chr(1)"

# Separators of the decoded JSON text (those of Python's json.dumps).
ITEM_SEP = ", "
NAME_SEP = ": "

# The text of a number payload is a decimal literal.
NUMBER_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"

_LEVEL_MAP = "map<string,map<string,string>>"
_LEVEL_LIST = "array<map<string,string>>"
_CHILDREN = "array<struct<key:string,value:map<string,string>>>"


def _lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quote_sql(text_sql: str) -> str:
    """SQL for a string as a JSON string literal (quotes and escapes added)."""
    return f"btrim(to_json(array({text_sql})), '[]')"


def _value_sql(wrapper: str, depth: int, opts: DecodeOptions) -> str:
    """SQL for the text of one typed value held as ``map<string,string>``."""
    if depth > opts.max_depth:
        return _DEEP_SQL
    tag = f"element_at(map_keys({wrapper}), 1)"
    val = f"element_at(map_values({wrapper}), 1)"
    branches = [
        f"WHEN size({wrapper}) <> 1 THEN NULL",
        f"WHEN {tag} = 'S' THEN {quote_sql(val)}",
        f"WHEN {tag} = 'N' THEN CASE WHEN {val} RLIKE {_lit(NUMBER_TEXT)} THEN {quote_sql(val)} END",
        f"WHEN {tag} IN ('M', 'L') THEN {_container_sql(tag, val, depth, opts)}",
        f"WHEN {tag} = 'BOOL' THEN CASE WHEN {val} IN ('true', 'false') THEN {val} END",
        f"WHEN {tag} = 'NULL' THEN 'null'",
    ]
    if not opts.strict_types:
        branches += [
            f"WHEN {tag} = 'B' THEN {quote_sql(val)}",
            f"WHEN {tag} IN ('SS', 'NS', 'BS') THEN CASE WHEN startswith({val}, '[') "
            f"AND from_json({val}, 'array<string>') IS NOT NULL THEN {val} END",
        ]
    return "CASE " + " ".join(branches) + " END"


def _container_sql(tag: str, text: str, depth: int, opts: DecodeOptions, sort_sql: str | None = None) -> str:
    """SQL for the text of an ``M`` (object) or ``L`` (array) payload given as JSON text.

    ``sort_sql`` (top level only): a boolean SQL expression; when true the
    object's attributes come out sorted by name (canonical keys).
    """
    var = f"c{depth}"
    is_map = f"({tag} = 'M')"
    listed = (
        f"cast(arrays_zip(array_repeat(cast(NULL AS STRING), json_array_length({text})), "
        f"from_json({text}, '{_LEVEL_LIST}')) AS {_CHILDREN})"
    )
    entries = f"map_entries(from_json({text}, '{_LEVEL_MAP}'))"
    if sort_sql is not None:
        entries = f"CASE WHEN {sort_sql} THEN array_sort({entries}, {_BY_NAME}) ELSE {entries} END"
    children = f"CASE WHEN {is_map} THEN {entries} ELSE {listed} END"
    name = f"CASE WHEN {is_map} THEN concat({quote_sql(var + '.key')}, {_lit(NAME_SEP)}) ELSE '' END"
    part = f"concat({name}, {_value_sql(var + '.value', depth + 1, opts)})"
    return (
        f"concat(CASE WHEN {is_map} THEN '{{' ELSE '[' END, "
        f"array_join(transform({children}, {var} -> {part}), {_lit(ITEM_SEP)}, {_BAD_SQL}), "
        f"CASE WHEN {is_map} THEN '}}' ELSE ']' END)"
    )


@lru_cache(maxsize=64)
def decode_map_sql(text_sql: str, opts: DecodeOptions) -> str:
    """SQL for the text of a JSON object of typed values, given as JSON text."""
    return _container_sql("'M'", text_sql, 0, opts)


_BY_NAME = "(l, r) -> CASE WHEN l.key < r.key THEN -1 WHEN l.key > r.key THEN 1 ELSE 0 END"


@lru_cache(maxsize=64)
def decode_maps_sql(text_sqls: tuple[str, ...], opts: DecodeOptions, sorted_first: bool = False) -> str:
    items = ", ".join(
        f"named_struct('t', {t}, 's', {'true' if (i == 0 and sorted_first) else 'false'})" for i, t in enumerate(text_sqls)
    )
    body = _container_sql("'M'", "o.t", 0, opts, sort_sql="o.s")
    return f"transform(array({items}), o -> CASE WHEN o.t IS NOT NULL THEN {body} END)"


def decode_maps(text_sqls: tuple[str, ...], opts: DecodeOptions, sorted_first: bool = False) -> Column:
    """Several images decoded by one instance of the decoder.

    Returns an array of texts in the order given; NULL entries stay NULL.
    Planning cost grows with the size of the expression, so keys, new and
    old image share one copy of it instead of three. ``sorted_first``: the
    first object (the keys) comes out with its attributes sorted by name.
    """
    return F.expr(decode_maps_sql(tuple(text_sqls), opts, sorted_first))


def key_map(text_sql: str, names: tuple[str, ...]) -> Column:
    """The named attributes of an object of typed values, as ``map<string,map<string,string>>``.

    NULL when the text is not such an object. Turned back into JSON text,
    it is the keys object; the decoder sorts it (``sorted_first``).
    """
    wanted = ", ".join(_lit(n) for n in names)
    return F.expr(f"map_filter(from_json({text_sql}, '{_LEVEL_MAP}'), (k, v) -> array_contains(array({wanted}), k))")


def has_marker(text: Column, marker: str) -> Column:
    return F.instr(text, marker) > 0
