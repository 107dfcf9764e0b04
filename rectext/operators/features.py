"""Feature rows (J1 core, P9-P11) and label / token features (M1, M3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rectext.functions.render import render_typed
from rectext.functions.shapes import render_shaped
from rectext.operators.records import drop_corrupt, parse_lines

FEATURE_COLUMNS = ["text_representation", "timestamp", "label", "source_file"]


def featurize_records(records: DataFrame, keep: list[str] | None = None,
                      with_error: bool = False, shapes: list[str] | None = None) -> DataFrame:
    """Render valid records (column ``v``) into the published feature schema;
    those of ``shapes`` (``common_shapes``) the fast way."""
    keep = keep if keep is not None else ["source_file"]
    out = render_shaped(records, shapes or [], "v", keep=keep, with_error=with_error)
    first = ["text_representation", "timestamp", "label"]
    return out.select(*first, *[c for c in out.columns if c not in first])


def featurize(lines: DataFrame, value_col: str = "value", keep: list[str] | None = None,
              with_error: bool = False) -> DataFrame:
    """Lines ``(value, source_file, ...)`` -> ``text_representation,
    timestamp, label, source_file``. Corrupt lines are dropped (P1/P2);
    one narrow plan: no shuffle and no Python worker."""
    records = drop_corrupt(parse_lines(lines, value_col))
    return featurize_records(records, keep=keep, with_error=with_error)


def featurize_typed(df: DataFrame, keep: list[str] | None = None, with_error: bool = False) -> DataFrame:
    """J1 fast path for records whose schema is known (a typed table, or
    JSON read with a declared schema): same contract, fields in declared
    order, expressions Spark compiles to code."""
    keep = keep if keep is not None else [c for c in ["source_file"] if c in df.columns]
    out = render_typed(df, keep=keep, with_error=with_error)
    first = ["text_representation", "timestamp", "label"]
    return out.select(*first, *[c for c in out.columns if c not in first])


# M1: fixed values -- the eleven label names and their codes.
LABEL_CODES = {
    "benign": 0,
    "dirb": 1,
    "wpscan": 2,
    "service_scans": 3,
    "network_scans": 4,
    "privilege_escalation": 5,
    "dnsteal": 6,
    "reverse_shell": 7,
    "service_stop": 8,
    "webshell": 9,
    "cracking": 10,
}


def encode_label(label: Column) -> Column:
    """M1: label name to its code (int), null for any other name. A literal
    map lookup: narrow, no join, no broadcast."""
    m = F.create_map(*[x for k, v in LABEL_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, label)


# White space at either end; the look-behind keeps a run of blanks inside from being tried at each of its places.
_ENDS = r"^\s+|(?<!\s)\s+$"

MAX_TOKENS = 512
SPECIAL_TOKENS = 2


def tokens(text: Column) -> Column:
    """Whitespace tokens of a text (leading / trailing whitespace ignored)."""
    return F.split(F.regexp_replace(text, _ENDS, ""), r"\s+")


def truncate_tokens(text: Column, max_tokens: int = MAX_TOKENS - SPECIAL_TOKENS) -> Column:
    """M3: the first ``max_tokens`` whitespace tokens (510 = 512 minus the two
    special tokens of the encoder), as an array. The text isn't split past
    the cut."""
    return F.slice(F.split(F.regexp_replace(text, _ENDS, ""), r"\s+", max_tokens + 1), 1, max_tokens)
