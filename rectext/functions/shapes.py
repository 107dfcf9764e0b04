"""Rendering by shape: records of known fields and types without a walk.

A batch has few shapes (the field names and types of a record). Of each shape
found in a bounded sample, the text, timestamp and label become plain
expressions over the record's fields, which Spark compiles. A record whose
shape isn't among them (absent, additional, null or mistyped fields) takes the
walk of ``render_records``; the result is the same either way, so the sample
decides on speed alone.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rectext.functions.render import (FIELD_SEPARATOR, ISO_TIMESTAMP_KEY, LABEL_KEY, TIMESTAMPS_KEY, first_timestamp, format_value, iso_epoch, py_float_str,
                                      render_records, struct_of, vtype)

#: Rows of the sample, shapes kept of it, and fields of all of them together.
SAMPLE_ROWS, MAX_SHAPES, MAX_FIELDS = 2000, 8, 160


def shape_of(v: Column) -> Column:
    """A variant's type, with one name for all numbers that print as floats."""
    t = vtype(v)
    return F.when(t.contains("DECIMAL"), F.regexp_replace(t, r"DECIMAL\((\d+,[1-9]\d*|(1[0-8]|[1-9]),0)\)", "DOUBLE")).otherwise(t)


def parse_shape(shape: str) -> list[tuple[str, str]] | None:
    """``(name, type)`` of the fields of ``OBJECT<...>``; None for another type."""
    if not (shape.startswith("OBJECT<") and shape.endswith(">")):
        return None
    out, body, i = [], shape[7:-1], 0
    while i < len(body):
        if body[i] == "`":
            j = i + 1
            while body[j] != "`" or body[j:j + 2] == "``":
                j += 2 if body[j] == "`" else 1
            name, i = body[i + 1:j].replace("``", "`"), j + 1
        else:
            j = body.index(":", i)
            name, i = body[i:j], j
        start = i = i + 2                          # ": "
        depth, quoted = 0, False
        while i < len(body) and (body[i] != "," or depth or quoted):
            quoted ^= body[i] == "`"
            depth += 0 if quoted else (body[i] in "<(") - (body[i] in ">)")
            i += 1
        out.append((name, body[start:i]))
        i += 2                                     # ", "
    return out


def _path(names: list[str]) -> str | None:
    if any(("'" in n and '"' in n) or "\\" in n for n in names):
        return None
    return "$" + "".join(f"['{n}']" if "'" not in n else f'["{n}"]' for n in names)


def _text(v: Column, names: list[str], kind: str) -> Column:
    """T1 of a field of a known type."""
    path = _path(names)
    if kind in ("STRING", "BIGINT"):
        return F.variant_get(v, path, "string")
    if kind == "BOOLEAN":
        return F.when(F.variant_get(v, path, "boolean"), F.lit("True")).otherwise(F.lit("False"))
    if kind == "DOUBLE":
        return py_float_str(F.variant_get(v, path, "double"))
    if kind == "VOID":
        return F.lit("None")
    return format_value(F.variant_get(v, path, "variant"), F.lit(kind))


def _joined(parts: list[Column]) -> Column:
    glue = [x for p in parts for x in (F.lit(FIELD_SEPARATOR), p)][1:]
    return F.concat(*glue) if glue else F.lit("")


def renderable(shape: str | None) -> bool:
    """Whether ``shaped`` takes a shape: not where a name can't be part of a
    path, or without any field (such a record isn't valid)."""
    fields = parse_shape(shape) if shape else None
    names = [n for n, k in fields or ()] + [s for n, k in fields or () for s, _ in parse_shape(k) or ()]
    return bool(fields) and all(_path([n]) is not None for n in names)


def shaped(v: Column, shape: str) -> Column:
    """``struct<text, timestamp, label, bad>`` of records of this (``renderable``) shape."""
    fields = parse_shape(shape)
    parts, candidate, bad = [], None, F.lit(False)
    for name, kind in fields:
        lower, inner = name.lower(), parse_shape(kind) if kind != "OBJECT<>" else []
        if lower == TIMESTAMPS_KEY:
            candidate = (False, [name])
        elif lower == ISO_TIMESTAMP_KEY:
            epoch = iso_epoch(F.variant_get(v, _path([name]), "string")) if kind == "STRING" else F.lit(None).cast("double")
            candidate, bad = (True, epoch), bad | epoch.isNull()
        elif lower != LABEL_KEY:
            if inner is None:
                parts.append(F.concat(F.lit(f"[{name}] "), _text(v, [name], kind)))
                continue
            own = [F.concat(F.lit(f"[{n}] "), _text(v, [name, n], k)) for n, k in inner if n.lower() not in (LABEL_KEY, TIMESTAMPS_KEY)]
            parts.append(F.concat(F.lit(f"[{name}] {{"), _joined(own), F.lit("}")))
            stamps = [n for n, _ in inner if n.lower() == TIMESTAMPS_KEY]
            if stamps:
                candidate = (False, [name, stamps[-1]])
    if candidate is None:
        stamp = F.struct(F.lit(None).cast("double").alias("value"), F.lit(False).alias("bad"))
    elif candidate[0]:
        stamp = F.struct(candidate[1].alias("value"), F.lit(False).alias("bad"))
    else:
        of = F.struct(F.lit(False).alias("iso"), F.variant_get(v, _path(candidate[1]), "variant").alias("v"), F.lit(None).cast("double").alias("epoch"))
        stamp = struct_of(first_timestamp(of))
    kind = dict(fields).get(LABEL_KEY, "VOID")
    label = F.lit(None).cast("string") if kind == "VOID" else F.to_json(F.variant_get(v, "$.label", "variant")) if kind.startswith(("OBJECT", "ARRAY")) else _text(v, [LABEL_KEY], kind)
    return F.struct(_joined(parts).alias("text"), stamp.alias("stamp"), label.alias("label"), bad.alias("bad"))


def common_shapes(records: DataFrame, v: str = "v", rows: int = SAMPLE_ROWS) -> list[str]:
    """Shapes of the first ``rows`` records, the commonest first, within the
    bounds. Only as many tasks run as it takes to find so many rows."""
    found = Counter(r[0] for r in records.select(shape_of(F.col(v))).head(rows))
    out, fields = [], 0
    for shape, _ in sorted(found.items(), key=lambda x: (-x[1], x[0] or "")):
        if len(out) < MAX_SHAPES and renderable(shape) and fields + len(parse_shape(shape)) <= MAX_FIELDS:
            out.append(shape)
            fields += len(parse_shape(shape))
    return out


def render_shaped(df: DataFrame, shapes: list[str], v: str = "v", keep: list[str] | None = None, with_error: bool = False) -> DataFrame:
    """As ``render_records``, with the fast way for records of ``shapes``."""
    keep = keep or []
    if not shapes:
        return render_records(df, v, keep, with_error)
    x = df.select(*keep, F.col(v).alias("_v0"), shape_of(F.col(v)).alias("_shape"))
    by_shape = F.lit(None)
    for s in reversed(shapes):
        by_shape = F.when(F.col("_shape") == s, shaped(F.col("_v0"), s)).otherwise(by_shape)
    x = x.select(*keep, "_v0", by_shape.alias("_s"))
    x = x.select(*keep, "_s", F.when(F.col("_s").isNull(), F.col("_v0")).alias("_v"))
    x = render_records(x, "_v", [*keep, "_s"], with_error=True)
    err = F.col("_s.bad") | F.col("_s.stamp.bad")
    known = F.col("_s").isNotNull()

    def either(fast, name):
        return F.when(known, fast).otherwise(F.col(name)).alias(name)

    return x.select(*keep,
                    either(F.when(err, F.lit("")).otherwise(F.col("_s.text")), "text_representation"),
                    either(F.when(~err, F.col("_s.stamp.value")), "timestamp"),
                    either(F.when(~err, F.col("_s.label")), "label"),
                    *([either(err, "is_error")] if with_error else []))
