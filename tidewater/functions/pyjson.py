"""A small per-value Python decoder.

Used in two places only: the Arrow UDF for the rare values nested deeper
than the native expression goes, and brute-force checks in the tests. It
yields the same text as the native decoder.
"""

from __future__ import annotations

import json
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Ship this module's code with the UDF, so Python workers need no copy of
# the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Same number syntax as the native decoder.
_NUMBER = re.compile(r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?")


class DecodeError(ValueError):
    pass



class Pairs(list):
    """An object as (name, value) pairs: a name given twice stays twice, as in the native decoder."""


def decode_value(value, strict_types: bool = False):
    """One typed value ``{tag: payload}`` -> plain Python value (objects as ``Pairs``)."""
    if not isinstance(value, Pairs) or len(value) != 1:
        raise DecodeError("typed value must be an object with one tag")
    ((tag, payload),) = value
    if tag == "S":
        return _text(payload)
    if tag == "N" and payload is not None and _NUMBER.fullmatch(_text(payload)):
        return _text(payload)
    if tag == "BOOL" and _text(payload) in ("true", "false"):
        return _text(payload) == "true"
    if tag == "NULL":
        return None
    if tag == "M" and isinstance(payload, Pairs):
        return Pairs((name, decode_value(v, strict_types)) for name, v in payload)
    if tag == "L" and _is_list(payload):
        return [decode_value(v, strict_types) for v in payload]
    if not strict_types:
        if tag == "B":
            return _text(payload)
        if tag in ("SS", "NS", "BS") and _is_list(payload):
            return _Compact(payload)
    raise DecodeError(f"unsupported typed value with tag {tag!r}")


def _is_list(payload) -> bool:
    return isinstance(payload, list) and not isinstance(payload, Pairs)


def _text(payload) -> str | None:
    """A payload as the native decoder reads it: text as it stands, anything else as compact JSON."""
    return payload if payload is None or isinstance(payload, str) else _compact(payload)


class _Compact(list):
    """A set: rendered as a compact JSON array, like the native decoder."""


def _compact(value) -> str:
    if isinstance(value, Pairs):
        return "{" + ",".join(f"{_quote(k)}:{_compact(v)}" for k, v in value) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_compact, value)) + "]"
    return _quote(value) if isinstance(value, str) else json.dumps(value)


_ESCAPE = re.compile(r"\\(u[0-9a-f]{4}|.)")


def _quote(text: str) -> str:
    """A JSON string, control characters with upper-case hex digits."""
    return _ESCAPE.sub(lambda m: "\\u" + m[1][1:].upper() if len(m[1]) > 1 else m[0], json.dumps(text, ensure_ascii=False))


def _render(value) -> str:
    if isinstance(value, _Compact):
        return _compact(list(value))
    if isinstance(value, Pairs):
        return "{" + ", ".join(f"{_quote(k)}: {_render(v)}" for k, v in value) + "}"
    if isinstance(value, list):
        return "[" + ", ".join(_render(v) for v in value) + "]"
    return _quote(value) if isinstance(value, str) else json.dumps(value)


def dumps(value) -> str:
    """Decoded text: names in payload order, ``", "`` / ``": "`` separators; a lone surrogate is ``?``, as in the JVM."""
    return _render(value).encode("utf-8", "replace").decode("utf-8")


def decode_map_text(text: str | bytes | None, strict_types: bool = False, by_name: bool = False) -> str | None:
    """JSON text of an object of typed values -> decoded text; None if invalid.

    ``by_name`` sorts the object's own attributes (canonical keys). Bytes that are no UTF-8 become U+FFFD, as in the
    native decoder. Whatever goes wrong with one value (nesting beyond Python's stack, say) makes that value invalid and
    no other.
    """
    if text is None:
        return None
    try:
        text = text.decode("utf-8", "replace") if isinstance(text, bytes) else text
        obj = json.loads(text, object_pairs_hook=Pairs)
        if not isinstance(obj, Pairs):
            return None
        out = Pairs((name, decode_value(v, strict_types)) for name, v in obj)
        return dumps(Pairs(sorted(out, key=lambda pair: pair[0].encode("utf-8", "replace"))) if by_name else out)
    except Exception:  # noqa: BLE001 - one bad record must not end the job
        return None


def deep_image_udf(strict_types: bool, by_name: bool = False):
    """Arrow UDF for the depth fallback, from the text's bytes (which need not be UTF-8); NULL for rows without one."""

    @F.pandas_udf(StringType())
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: decode_map_text(text, strict_types, by_name), na_action="ignore").astype(object)

    return lambda text: decode(text.cast("binary"))
