"""Python's text of nested JSON values (T1, R6), in Spark's own functions.

``str`` of a dict or a list prints its items as ``repr`` does. JSON text and
that text differ only in their tokens: a string's quotes and escapes, ``true``,
``false``, ``null``, float literals, and a blank after each comma and colon. So
the JSON text is cut into tokens, each is rewritten, and they are joined.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rectext.functions.render import py_float_str

# A JSON token (no repeated group that could overflow Java's stack), and what Python prints as an escape.
TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{},:]|[^\s\[\]{},:"]++'
_SHOWN = {"\\n": "\n", "\\t": "\t", "\\r": "\r"}
_HIDDEN = r"[\x00-\x1f\x7f-\xa0\xad\p{Cf}\p{Co}\p{Cn}\p{Zl}\p{Zp}\p{Cs}]|(?! )\p{Zs}"


def _escaped(c: Column) -> Column:
    """Characters that Python's ``repr`` doesn't print become its escapes."""
    shown = c
    for name, char in _SHOWN.items():
        shown = F.replace(shown, F.lit(char), F.lit(name))
    parts = F.regexp_extract_all(shown, F.lit(f"(?s)(?:{_HIDDEN})|(?:(?!{_HIDDEN}).)++"), F.lit(0))

    def one(p):
        n = F.conv(F.hex(F.encode(p, "UTF-32")), 16, 10).cast("long")
        code = F.lower(F.hex(n))
        text = (F.when(n < 256, F.concat(F.lit("\\x"), F.lpad(code, 2, "0"))).when(n < 65536, F.concat(F.lit("\\u"), F.lpad(code, 4, "0")))
                .otherwise(F.concat(F.lit("\\U"), F.lpad(code, 8, "0"))))
        return F.when(p.rlike(f"^(?:{_HIDDEN})$"), text).otherwise(p)

    return F.when(shown.rlike(_HIDDEN), F.array_join(F.transform(parts, one), "")).otherwise(shown)


def py_repr(text: Column) -> Column:
    """``repr`` of a Python string: single quotes, or double ones for a text
    with single quotes alone."""
    body = _escaped(F.replace(text, F.lit("\\"), F.lit("\\\\")))
    double = text.contains("'") & ~text.contains('"')
    return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))


def py_text_of_json(json: Column) -> Column:
    """``str`` of the Python value of a JSON text, for objects and lists of
    any depth; null for text that isn't JSON. A scalar prints as its ``repr``."""
    def one(t):
        string = F.try_variant_get(F.try_parse_json(t), "$", "string")
        return (F.when(t.startswith('"'), py_repr(string)).when(t == "true", F.lit("True")).when(t == "false", F.lit("False")).when(t == "null", F.lit("None"))
                .when(t == ",", F.lit(", ")).when(t == ":", F.lit(": "))
                .when(t.rlike(r"^-?\d+$"), F.regexp_replace(t, r"^-0$", "0")).when(t.rlike(r"^-?\d"), py_float_str(t.try_cast("double"))).otherwise(t))

    tokens = F.regexp_extract_all(json, F.lit(TOKEN), F.lit(0))
    return F.when(F.try_parse_json(json).isNotNull(), F.array_join(F.transform(tokens, one), ""))


def py_text(v: Column) -> Column:
    """The same of a variant."""
    return py_text_of_json(F.to_json(v))
