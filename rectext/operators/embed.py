"""Text embedding (M2) and the per-batch user-function hook.

The default encoder is a hashing bag of tokens with an L2 norm, in native
expressions: JVM-side, no Python worker. A real model is plugged in through
``predict_batch_udf`` (Arrow batches, the model loaded once per Python
worker), the way Spark runs batch inference.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rectext.operators.features import MAX_TOKENS, SPECIAL_TOKENS, tokens, truncate_tokens

DEFAULT_DIM = 64


def embed_text(df: DataFrame, text_col: str = "text", out_col: str = "embedding",
               dim: int = DEFAULT_DIM, make_predict_fn: Callable | None = None,
               batch_size: int = 64, max_tokens: int | None = MAX_TOKENS - SPECIAL_TOKENS) -> DataFrame:
    """M2 (+M3): ``out_col`` = ``array<float>`` embedding of ``text_col``.

    Without ``make_predict_fn``: counts of the first ``max_tokens``
    whitespace tokens (None: all) in ``dim`` buckets (the first eight hex
    digits of a token's md5, modulo ``dim``), L2-normalised; a text without
    tokens gives zeros. With it: the function must return
    ``predict(np.ndarray[str]) -> np.ndarray[n, dim]`` and is run by
    ``predict_batch_udf`` on whole texts, since a model truncates by its own
    tokens."""
    if make_predict_fn is not None:
        from pyspark.ml.functions import predict_batch_udf
        udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()),
                                batch_size=batch_size)
        return df.withColumn(out_col, udf(F.col(text_col)))

    own = tokens(F.col(text_col)) if max_tokens is None else truncate_tokens(F.col(text_col), max_tokens)
    # A text's buckets as one string, a character a token: what a bucket counts is then the
    # characters that go when its own is left out, which Spark does in compiled code.
    symbols = "".join(chr((48 if dim <= 64 else 0x100) + i) for i in range(dim))
    bucket = lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint"), F.lit(dim))
    marks = F.transform(F.filter(F.coalesce(own, F.array().cast("array<string>")), lambda t: t != ""), lambda t: F.substring(F.lit(symbols), bucket(t).cast("int") + 1, F.lit(1)))
    names = [_unused(n, df.columns) for n in ("marks", "counts", "norm")]
    marked, counts, norm = (F.col(n) for n in names)
    staged = df.withColumn(names[0], F.array_join(marks, ""))
    staged = staged.withColumn(names[1], F.array(*[F.length(marked) - F.length(F.replace(marked, F.lit(c), F.lit(""))) for c in symbols]))
    staged = staged.withColumn(names[2], F.sqrt(F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, c: s + c.cast("bigint") * c).cast("double")))
    return staged.withColumn(out_col, F.transform(counts, lambda c: F.when(norm > 0, c / norm).otherwise(0.0).cast("float"))).drop(*names)


def _unused(name: str, names: list[str]) -> str:
    while name in names:
        name += "_"
    return name


def embed_inputs(df: DataFrame, make_predict_fn: Callable, keep: list[str], ids: str = "input_ids", pad_id: int = 0, batch_size: int = 64,
                 out_col: str = "embedding", padding_col: str = "n_padding") -> DataFrame:
    """M2 on token ids (``subword_inputs``): columns ``keep``, the model's
    vector ``out_col`` (array<float>) and ``padding_col``, the pads that the
    row got in its batch.

    Rows are sorted by length within each partition and go to the model
    ``batch_size`` at a time, each batch padded to its own longest row, so
    little is padded whatever the lengths are. ``make_predict_fn()`` runs once
    a task and returns ``predict(ids[n, length], mask[n, length]) -> [n, dim]``,
    for an encoder usually the first token's state. Null ids give null. The
    sort is within a partition, so nothing is shuffled."""
    known = df.filter(F.col(ids).isNotNull()).select(*[f"`{c}`" for c in keep], F.col(f"`{ids}`").alias(ids)).sortWithinPartitions(F.size(ids))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out_col, T.ArrayType(T.FloatType())), T.StructField(padding_col, T.IntegerType())])

    def run(batches):
        import numpy as np
        import pandas as pd

        predict = make_predict_fn()
        for pdf in batches:
            for at in range(0, len(pdf), batch_size):
                part = pdf.iloc[at:at + batch_size]
                lengths = part[ids].map(len).to_numpy()
                tokens = np.full((len(part), lengths.max()), pad_id, np.int64)
                mask = np.arange(lengths.max()) < lengths[:, None]
                tokens[mask] = np.concatenate(part[ids].tolist())
                vectors = np.asarray(predict(tokens, mask.astype(np.int64)), np.float32)
                yield part[keep].assign(**{out_col: pd.Series(list(vectors), index=part.index), padding_col: (lengths.max() - lengths).astype(np.int32)})

    unknown = df.filter(F.col(ids).isNull()).select(*[f"`{c}`" for c in keep], F.lit(None).cast("array<float>").alias(out_col), F.lit(0).alias(padding_col))
    return known.mapInPandas(run, schema).unionByName(unknown)


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """Run ``fn(pandas.DataFrame) -> pandas.DataFrame`` on every Arrow
    batch of every partition (``mapInPandas`` with the iterator signature it
    requires). For custom per-row logic that Spark functions cannot express."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def _fits(got, schema) -> bool:
    """Whether each column of a frame converts to its field: the part of
    ``pa.Table.from_pandas`` that can fail, without the cost it has for small frames."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    if not isinstance(got, pd.DataFrame) or not got.columns.is_unique:
        return False
    try:
        columns = [got[f.name] for f in schema]
        return all(pa.array(c.to_numpy() if isinstance(c.dtype, np.dtype) else c, type=f.type, from_pandas=True).null_count == 0 or f.nullable
                   for f, c in zip(schema, columns))
    except Exception:                              # from_pandas tells what is wrong
        return False


def isolated(fn: Callable, pdf, schema, failed: Callable):
    """``fn(pdf)`` with rows that make it raise set apart; ``failed(row,
    error)`` (``row``: a dict of its values; gives a dict) takes the place of
    each. ``schema`` (Arrow): what ``fn`` returns must fit it. Returns a list
    of frames and such dicts in the order of the rows.

    If the whole frame raises, blocks are tried from the front, about as long
    as the rows so far leave an even chance of an error. Halving a block that
    raises finds its first bad row: a half behind one that passes isn't tried
    for itself. A row counts as bad only if it raises alone."""
    import pyarrow as pa

    n, out, rows = len(pdf), [], None

    def tried(start, end):
        """None if the rows pass, else the error."""
        try:
            got = fn((pdf.iloc[start:end] if end - start < n else pdf).reset_index(drop=True))
            if not _fits(got, schema):
                pa.Table.from_pandas(got, schema=schema, preserve_index=False)
        except Exception as error:                 # a user's function may raise anything
            return error
        out.append(got)

    at, size, passed, bad, error = 0, n, 0, 0, None
    while at < n:
        end = min(n, at + size)
        error = tried(at, end)
        if error is None:
            at, passed = end, passed + 1
            size *= 1 + (passed > 1)
            continue
        alone = end - at == 1
        while end - at > 1:
            middle = (at + end) // 2
            first = tried(at, middle)
            if first is None:
                at, alone = middle, False
            else:
                end, error, alone = middle, first, middle - at == 1
        if alone or (error := tried(at, end)) is not None:
            rows = rows or [dict(zip(pdf.columns, x)) for x in pdf.itertuples(index=False, name=None)]
            out.append(failed(rows[at], error))
            bad += 1
        at, passed = end, 0
        size = max(1, int(0.69 * at / max(bad, 1)))
    return out


def map_batches_isolated(df: DataFrame, fn: Callable, schema, defaults: dict | None = None, keep: list[str] | None = None,
                         error_col: str = "is_error", reason_col: str = "reason") -> DataFrame:
    """U1 + P12: as ``map_batches`` for functions that treat each row by
    itself, but a row for which ``fn`` raises becomes an error row and the job
    goes on. ``schema`` is what ``fn`` returns; the result has ``is_error`` and
    ``reason`` (type and text of the error) beside it.

    An error row has the values of ``defaults`` (others null) and, of the
    columns ``keep``, those of its input row. A batch without an error is one
    call; each bad row costs about the logarithm of the rows between two bad
    ones in calls (see ``isolated``). ``fn`` must not depend on which rows come together; an empty batch isn't passed
    to it. A frame of another length than the batch's is not an error."""
    from pyspark.sql.pandas.types import to_arrow_schema

    own = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(own)
    names, keep, defaults = own.fieldNames(), keep or [], defaults or {}
    out = T.StructType([*own.fields, T.StructField(error_col, T.BooleanType()), T.StructField(reason_col, T.StringType())])

    def failed(row, error):
        return {n: row[n] if n in keep else defaults.get(n) for n in names} | {reason_col: f"{type(error).__name__}: {error}"}

    def run(batches):
        import pandas as pd

        for pdf in batches:
            if not len(pdf):
                continue
            # Object columns, so that numbers beside a missing value keep their type.
            whole: dict = {c: [] for c in [*names, error_col, reason_col]}
            for p in isolated(fn, pdf, arrow, failed):
                bad = isinstance(p, dict)
                for n in names:
                    whole[n] += [p[n]] if bad else p[n].tolist()
                size = 1 if bad else len(p)
                whole[error_col] += [bad] * size
                whole[reason_col] += [p[reason_col] if bad else None] * size
            yield pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in whole.items()})

    return df.mapInPandas(run, out)
