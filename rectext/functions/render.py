"""Record-to-text expressions (T1-T7), built from Spark's own functions.

A record is a ``VARIANT`` object (one row per record, fields differ per row).
Rendering walks its fields in ascending key order with higher-order
functions, so everything stays in the JVM: no Python worker, no shuffle.

Contract, per record:

* every field but ``label`` / ``timestamps`` / ``@timestamp`` (any case)
  becomes ``[name] value``; fields are joined by one space;
* an object field becomes ``[name] {[sub] value ...}`` (one level; ``label``
  and ``timestamps`` inside it are left out as well);
* a list becomes its items joined by ``", "``; scalars print as Python's
  ``str`` does (``None``, ``True``, ``100.0``, ...); objects and lists below
  that level print as JSON text;
* the timestamp comes from the last candidate in field order: a top-level
  ``timestamps`` value, a top-level ``@timestamp`` ISO text, or a
  ``timestamps`` value inside an object field; a list gives its first item;
* a bad ``@timestamp`` anywhere at the top, or a first list item that is not
  a number, makes the whole row an error row ``("", null, null)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that the output format depends on.
LABEL_KEY = "label"
TIMESTAMPS_KEY = "timestamps"
ISO_TIMESTAMP_KEY = "@timestamp"
FIELD_SEPARATOR = " "
LIST_SEPARATOR = ", "
# ISO text accepted for ``@timestamp``: date, 'T', time, 1 to 6 fraction digits, 'Z'.
ISO_PATTERN = r"^(?i)\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}Z$"

_EXACT_INT_DECIMAL = r"^DECIMAL\((1[0-8]|[1-9]),0\)$"


def _lit(s: str) -> Column:
    return F.lit(s)


# ---------------------------------------------------------------- numbers

def py_float_str(x: Column) -> Column:
    """Python ``str(float)`` of a double column (shortest digits, Python's
    switch points between positional and exponent notation)."""
    a = F.abs(x)
    java = x.cast("string")
    big = F.regexp_replace(
        F.regexp_replace(x.cast("decimal(38,10)").cast("string"), r"0+$", ""), r"\.$", ".0")
    small = F.regexp_replace(
        F.regexp_replace(x.cast("decimal(38,24)").cast("string"), r"0+$", ""), r"\.$", ".0")
    mant = F.regexp_replace(F.regexp_extract(java, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    exp = F.regexp_extract(java, r"E(-?[0-9]+)$", 1).cast("int")
    sci = F.concat(mant, _lit("e"), F.when(exp < 0, "-").otherwise("+"),
                   F.lpad(F.abs(exp).cast("string"), 2, "0"))
    # the common range first: there Java's and Python's shortest digits agree
    return (F.when((a >= 1e-3) & (a < 1e7), java)
            .when(x.isNull(), None)
            .when(a == 0, java)
            .when(F.isnan(x), "nan")
            .when(x == float("inf"), "inf")
            .when(x == float("-inf"), "-inf")
            .when(a < 1e16, F.when(a >= 1e7, big).when(a >= 1e-4, small).otherwise(sci))
            .otherwise(sci))


# ---------------------------------------------------------------- variant values

def vtype(v: Column) -> Column:
    """Type name of a variant value (``BIGINT``, ``STRING``, ``OBJECT<...>``, ``VOID``...)."""
    return F.schema_of_variant(v)


def format_scalar(v: Column, t: Column | None = None) -> Column:
    """Python ``str`` of one variant value; nested objects / lists as JSON text.
    Branches are ordered by how common the type is (strings first)."""
    t = vtype(v) if t is None else t
    return (F.when(t == "STRING", v.cast("string"))
            .when(t == "BIGINT", v.cast("string"))
            .when(v.isNull() | (t == "VOID"), _lit("None"))
            .when(t == "BOOLEAN",
                  F.when(F.try_variant_get(v, "$", "boolean"), _lit("True")).otherwise(_lit("False")))
            # a float literal is stored as an exact DECIMAL (100.0 without a scale): print it as a float;
            # an integer past a long is a DECIMAL without a scale as well, and longer than those
            .when((t == "DOUBLE") | (t.startswith("DECIMAL") & (t.rlike(_EXACT_INT_DECIMAL) | ~t.endswith(",0)"))),
                  py_float_str(F.try_variant_get(v, "$", "double")))
            .when(t.startswith("OBJECT") | t.startswith("ARRAY"), F.to_json(v))
            .otherwise(v.cast("string")))


def as_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def as_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def format_value(v: Column, t: Column | None = None) -> Column:
    """A list prints its items joined by ``", "``; anything else as a scalar."""
    t = vtype(v) if t is None else t
    return (F.when(t.startswith("ARRAY"),
                   F.array_join(F.transform(as_list(v), lambda e: format_scalar(e)), LIST_SEPARATOR))
            .otherwise(format_scalar(v, t)))


def format_list(arr: Column) -> Column:
    """T1 for a typed array column: items as Python ``str``, joined by ``", "``.
    The item type is constant, so Catalyst keeps one branch."""
    return F.array_join(F.transform(arr, lambda e: F.coalesce(
        F.when(F.typeof(e) == "boolean", F.initcap(e.cast("string")))
        .when(F.typeof(e).isin("double", "float"), py_float_str(e.try_cast("double")))
        .otherwise(e.cast("string")), _lit("None"))), LIST_SEPARATOR)


def annotated_fields(v: Column) -> Column:
    """Fields of a variant object in ascending key order, each with its
    lower-cased key and type name computed once:
    ``array<struct<k, lk, v, t>>``; null when ``v`` is not an object."""
    return F.transform(
        F.map_entries(as_object(v)),
        lambda e: F.struct(e["key"].alias("k"), F.lower(e["key"]).alias("lk"),
                           e["value"].alias("v"), vtype(e["value"]).alias("t")))


def _object_text(v: Column) -> Column:
    """The inside of ``{...}`` for an object field, one level deep."""
    inner = F.filter(annotated_fields(v),
                     lambda s: (s["lk"] != LABEL_KEY) & (s["lk"] != TIMESTAMPS_KEY))
    return F.array_join(
        F.transform(inner, lambda s: F.concat(_lit("["), s["k"], _lit("] "), format_value(s["v"], s["t"]))),
        FIELD_SEPARATOR)


def fields_text(fields: Column) -> Column:
    """``[name] value`` for the kept top-level fields, joined by a space."""
    kept = F.filter(fields, lambda a: ~a["lk"].isin(LABEL_KEY, TIMESTAMPS_KEY, ISO_TIMESTAMP_KEY))
    return F.array_join(F.transform(kept, lambda a: F.when(
        a["t"].startswith("OBJECT"),
        F.concat(_lit("["), a["k"], _lit("] {"), _object_text(a["v"]), _lit("}")))
        .otherwise(F.concat(_lit("["), a["k"], _lit("] "), format_value(a["v"], a["t"])))),
        FIELD_SEPARATOR)


# ---------------------------------------------------------------- timestamps

def _try_cast_ltz(s: Column) -> Column:
    return s.try_cast("timestamp_ltz")


def iso_epoch(s: Column) -> Column:
    """ISO text (ending in Z) to epoch seconds as double; null if it does not parse."""
    u = F.upper(s)
    return F.when(u.rlike(ISO_PATTERN), F.unix_micros(_try_cast_ltz(u)) / F.lit(1e6))


def timestamp_candidates(fields: Column) -> Column:
    """T5: candidates in field order,
    ``array<struct<iso: boolean, v: variant, epoch: double>>``.

    A top-level ``timestamps`` value, a top-level ``@timestamp`` value (its
    epoch parsed here, once), or the last ``timestamps`` value inside an
    object field; the last candidate wins."""
    no_epoch = F.lit(None).cast("double")

    def per_field(a):
        nested = F.try_element_at(
            F.filter(F.map_entries(as_object(a["v"])), lambda s: F.lower(s["key"]) == TIMESTAMPS_KEY),
            F.lit(-1))
        return (F.when(a["lk"] == LABEL_KEY, None)
                .when(a["lk"] == TIMESTAMPS_KEY,
                      F.struct(F.lit(False).alias("iso"), a["v"].alias("v"), no_epoch.alias("epoch")))
                .when(a["lk"] == ISO_TIMESTAMP_KEY,
                      F.struct(F.lit(True).alias("iso"), a["v"].alias("v"),
                               F.when(a["t"] == "STRING", iso_epoch(a["v"].cast("string"))).alias("epoch")))
                .when(a["t"].startswith("OBJECT") & nested.isNotNull(),
                      F.struct(F.lit(False).alias("iso"), nested["value"].alias("v"), no_epoch.alias("epoch"))))
    return F.filter(F.transform(fields, per_field), lambda c: c.isNotNull())


def first_timestamp(c: Column) -> tuple[Column, Column]:
    """T7 on the winning candidate: ``(epoch double, is_error)``.

    A list gives its first item as a number (a numeric string converts, any
    other item is an error); a number gives itself; anything else null."""
    v = c["v"]
    t = vtype(v)
    arr = F.when(t.startswith("ARRAY"), as_list(v))     # no failing cast on scalars
    first = F.try_element_at(arr, F.lit(1))
    first_t = vtype(first)
    first_num = F.try_variant_get(first, "$", "double")
    value = (F.when(c.isNull(), None)
             .when(c["iso"], c["epoch"])
             .when(arr.isNotNull(),
                   F.when((F.size(arr) == 0) | first.isNull() | (first_t == "VOID"), None)
                   .otherwise(first_num))
             .when((t == "STRING") | (t == "VOID"), None)
             .otherwise(F.try_variant_get(v, "$", "double")))
    bad = (c.isNotNull() & ~c["iso"] & arr.isNotNull() & (F.size(arr) > 0)
           & first.isNotNull() & (first_t != "VOID") & first_num.isNull())
    return value, F.coalesce(bad, F.lit(False))


def iso_error(candidates: Column) -> Column:
    """Any top-level ``@timestamp`` that is not valid ISO text (null
    included). Every such field is a candidate, so the check reuses the
    epoch parsed there."""
    return F.exists(candidates, lambda c: c["iso"] & c["epoch"].isNull())


def label_of(v: Column) -> Column:
    """Value of the exact key ``label`` as text, null when absent or null."""
    lab = F.try_variant_get(v, "$." + LABEL_KEY, "variant")
    return F.when(lab.isNull() | (vtype(lab) == "VOID"), None).otherwise(format_scalar(lab))


# ---------------------------------------------------------------- whole record

FEATURE_SCHEMA = T.StructType([
    T.StructField("text_representation", T.StringType(), True),
    T.StructField("timestamp", T.DoubleType(), True),
    T.StructField("label", T.StringType(), True),
])


_COLUMNS: dict = {}


def _shared(key: str, build) -> Column:
    """Build a large expression once per SparkContext and reuse it.

    The renderer's expressions only name fixed internal columns, so the same
    (unresolved) Column serves every DataFrame; building the tree costs
    thousands of Python-to-JVM calls, planning it per query does not."""
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    k = (sc.applicationId if sc is not None else None, key)
    col = _COLUMNS.get(k)
    if col is None:
        col = _COLUMNS[k] = build()
    return col


def render_records(df: DataFrame, v: str = "v", keep: list[str] | None = None,
                   with_error: bool = False) -> DataFrame:
    """Render a DataFrame with a variant column of records into
    ``text_representation, timestamp, label`` (plus ``keep`` columns).

    Staged projections. The annotated field array (structs of variants, the
    costly part to copy) is built once and consumed by the very next
    projection, which derives the text, the timestamp candidates and the
    label from it; later steps only carry those small columns."""
    keep = keep or []
    step1 = df.select(*keep, F.col(v).alias("_v"),
                      _shared("fields", lambda: annotated_fields(F.col("_v"))).alias("_f"))
    step2 = step1.select(*keep,
                         _shared("text", lambda: fields_text(F.col("_f"))).alias("_text"),
                         _shared("cands", lambda: timestamp_candidates(F.col("_f"))).alias("_cs"),
                         _shared("label", lambda: label_of(F.col("_v"))).alias("_label"))
    step3 = step2.select(*keep, "_text", "_label",
                         F.try_element_at(F.col("_cs"), F.lit(-1)).alias("_c"),
                         _shared("iso_bad", lambda: iso_error(F.col("_cs"))).alias("_iso_bad"))
    step4 = step3.select(*keep, "_text", "_label",
                         _shared("ts", lambda: struct_of(first_timestamp(F.col("_c")))).alias("_t"),
                         "_iso_bad")
    err = F.col("_iso_bad") | F.col("_t.bad")
    return step4.select(
        *keep,
        F.when(err, _lit("")).otherwise(F.col("_text")).alias("text_representation"),
        F.when(err, F.lit(None).cast("double")).otherwise(F.col("_t.value")).alias("timestamp"),
        F.when(err, F.lit(None).cast("string")).otherwise(F.col("_label")).alias("label"),
        *([err.alias("is_error")] if with_error else []))


def struct_of(pair: tuple[Column, Column]) -> Column:
    value, bad = pair
    return F.struct(value.alias("value"), bad.alias("bad"))


# ---------------------------------------------------------------- typed input

def _typed_value(c: Column, dt: T.DataType, depth: int = 0) -> Column:
    """Python ``str`` of a typed column value (T1/T2 on a known schema)."""
    if isinstance(dt, T.StringType):
        s = c
    elif isinstance(dt, T.BooleanType):
        s = F.when(c, _lit("True")).otherwise(_lit("False"))
    elif isinstance(dt, (T.DoubleType, T.FloatType)):
        s = py_float_str(c.cast("double"))
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        # Spark prints the fraction without trailing zeros, Python prints all
        # six digits (and none when the fraction is zero)
        t = c.cast("string")
        s = F.when(t.contains("."), F.rpad(t, 26, "0")).otherwise(t)
    elif isinstance(dt, T.DateType):
        s = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(dt, T.ArrayType):
        if depth > 0:
            s = F.to_json(c)
        else:
            s = F.array_join(F.transform(c, lambda e: _typed_value(e, dt.elementType, depth + 1)),
                             LIST_SEPARATOR)
    elif isinstance(dt, T.StructType):
        if depth > 0:
            s = F.to_json(c)
        else:
            parts = [F.concat(_lit(f"[{f.name}] "), _typed_value(c[f.name], f.dataType, depth + 1))
                     for f in dt.fields if f.name.lower() not in (LABEL_KEY, TIMESTAMPS_KEY)]
            s = F.concat(_lit("{"), F.concat_ws(FIELD_SEPARATOR, *parts) if parts else _lit(""), _lit("}"))
    elif isinstance(dt, T.MapType):
        s = F.to_json(c)
    else:
        s = c.cast("string")
    return F.when(c.isNull(), _lit("None")).otherwise(s)


def typed_text(df: DataFrame, columns: list[str] | None = None) -> Column:
    """T2 on a typed DataFrame: ``[col] value`` in declared column order,
    ``label`` / ``timestamps`` / ``@timestamp`` columns left out. The
    expression is built once per schema and reused."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    fields = [f for f in fields if f.name.lower() not in (LABEL_KEY, TIMESTAMPS_KEY, ISO_TIMESTAMP_KEY)]

    def build():
        parts = [F.concat(_lit(f"[{f.name}] "), _typed_value(F.col(f"`{f.name}`"), f.dataType))
                 for f in fields]
        return F.concat_ws(FIELD_SEPARATOR, *parts) if parts else _lit("")
    key = "typed_text:" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in fields)
    return _shared(key, build)


def _typed_first_timestamp(c: Column, dt: T.DataType) -> tuple[Column, Column]:
    """T7 on a typed candidate column: ``(epoch double, is_error)``."""
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
               T.DecimalType, T.BooleanType)
    no = F.lit(False)
    if isinstance(dt, T.ArrayType):
        first = F.try_element_at(c, F.lit(1))
        et = dt.elementType
        if isinstance(et, numeric):
            return first.cast("double"), no
        if isinstance(et, T.StringType):
            val = first.try_cast("double")
            return val, F.coalesce(first.isNotNull() & val.isNull(), no)
        return F.lit(None).cast("double"), F.coalesce(first.isNotNull(), no)
    if isinstance(dt, numeric):
        return c.cast("double"), no
    return F.lit(None).cast("double"), no


def render_typed(df: DataFrame, keep: list[str] | None = None, with_error: bool = False) -> DataFrame:
    """J1 on a DataFrame with a known schema (the fast path: plain,
    code-generated expressions, no variant).

    Columns are fields in declared order. The timestamp rules are resolved
    from the schema: the last candidate column wins (``timestamps``,
    ``@timestamp``, or a ``timestamps`` field of a struct column); every
    ``@timestamp`` column must hold valid ISO text. Null counts as a JSON
    null (``None`` in the text), so use this path for complete records."""
    keep = keep or []
    fields = [f for f in df.schema.fields if f.name not in keep]
    cands = []          # (kind, column, type) in field order
    iso_cols = []
    for f in fields:
        lk = f.name.lower()
        col = F.col(f"`{f.name}`")
        if lk == LABEL_KEY:
            continue
        if lk == TIMESTAMPS_KEY:
            cands.append(("ts", col, f.dataType))
        elif lk == ISO_TIMESTAMP_KEY:
            cands.append(("iso", col, f.dataType))
            iso_cols.append((col, f.dataType))
        elif isinstance(f.dataType, T.StructType):
            subs = [s for s in f.dataType.fields if s.name.lower() == TIMESTAMPS_KEY]
            if subs:
                cands.append(("ts", col[subs[-1].name], subs[-1].dataType))
    bad = F.lit(False)
    for col, dt in iso_cols:
        ok = iso_epoch(col).isNotNull() if isinstance(dt, T.StringType) else F.lit(False)
        bad = bad | ~F.coalesce(ok, F.lit(False))
    if not cands:
        ts, t7_bad = F.lit(None).cast("double"), F.lit(False)
    else:
        kind, col, dt = cands[-1]
        if kind == "iso":
            ts, t7_bad = (iso_epoch(col) if isinstance(dt, T.StringType) else F.lit(None).cast("double")), \
                F.lit(False)
        else:
            ts, t7_bad = _typed_first_timestamp(col, dt)
    label_field = next((f for f in fields if f.name == LABEL_KEY), None)
    label = (F.when(F.col(LABEL_KEY).isNull(), None).otherwise(_typed_value(F.col(LABEL_KEY), label_field.dataType))
             if label_field is not None else F.lit(None).cast("string"))
    staged = df.select(*keep, typed_text(df, [f.name for f in fields]).alias("_text"), ts.alias("_ts"),
                       label.alias("_label"),
                       (bad | t7_bad).alias("_err"))
    err = F.col("_err")
    return staged.select(
        *keep,
        F.when(err, _lit("")).otherwise(F.col("_text")).alias("text_representation"),
        F.when(err, F.lit(None).cast("double")).otherwise(F.col("_ts")).alias("timestamp"),
        F.when(err, F.lit(None).cast("string")).otherwise(F.col("_label")).alias("label"),
        *([err.alias("is_error")] if with_error else []))
