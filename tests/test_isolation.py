"""Rows that make a user's function raise are set apart."""

import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rectext.operators.embed import isolated, map_batches_isolated


@pytest.mark.parametrize("n, bad", [(1, {0}), (1, set()), (64, set()), (64, {0, 63}), (100, {17}), (33, set(range(33))), (200, set(range(0, 200, 9)))])
def test_only_bad_rows_fail_and_order_stays(n, bad):
    calls = []

    def fn(pdf):
        calls.append(len(pdf))
        if set(pdf["i"]) & bad:
            raise ValueError("bad")
        return pdf.assign(j=pdf["i"] * 2)

    parts = isolated(fn, pd.DataFrame({"i": range(n)}), pa.schema([("i", pa.int64()), ("j", pa.int64())]), lambda row, e: {"i": row["i"], "error": str(e)})
    seen = [x for p in parts for x in ([(p["i"], None)] if isinstance(p, dict) else zip(p["i"], p["j"]))]
    assert seen == [(i, None if i in bad else 2 * i) for i in range(n)]
    assert len(calls) <= 1 + 2 * len(bad) * max(1, n.bit_length())


def test_error_rows_have_defaults_kept_columns_and_reason(spark):
    def fn(pdf):
        if (pdf["i"] % 5 == 3).any():
            raise KeyError("five")
        # a value that doesn't fit the schema is an error of its row as well
        return pd.DataFrame({"i": pdf["i"], "t": ["x" if i % 7 else 7.5 for i in pdf["i"]], "n": [i if i % 2 else None for i in pdf["i"]], "a": [[i, None] for i in pdf["i"]]})

    df = spark.range(200).withColumnRenamed("id", "i").repartition(3)
    got = {r["i"]: r for r in map_batches_isolated(df, fn, "i long, t string, n long, a array<long>", {"t": ""}, keep=["i"]).collect()}
    assert len(got) == 200
    for i, r in got.items():
        if i % 5 == 3 or i % 7 == 0:
            assert (r["t"], r["n"], r["a"], r["is_error"]) == ("", None, None, True)
            assert r["reason"].startswith("KeyError: 'five'" if i % 5 == 3 else "Arrow")
        else:
            assert (r["t"], r["n"], r["a"], r["is_error"], r["reason"]) == ("x", i if i % 2 else None, [i, None], False, None)
    assert map_batches_isolated(df.limit(0), fn, "i long, t string, n long, a array<long>").count() == 0


def test_rows_may_be_dropped_or_added(spark):
    fn = lambda pdf: pdf[pdf["id"] % 2 == 0] if 5 not in set(pdf["id"]) else 1 / 0
    got = map_batches_isolated(spark.range(10).coalesce(1), fn, "id long").orderBy(F.col("id").asc_nulls_last()).collect()
    assert [(r["id"], r["is_error"]) for r in got] == [(0, False), (2, False), (4, False), (6, False), (8, False), (None, True)]


def test_many_bad_rows_cost_about_half_a_call_a_row():
    n, calls = 5000, []
    order = [i * 7 % n for i in range(n)]

    def fn(pdf):
        calls.append(len(pdf))
        wrong = [i for i in pdf["i"] if i % 9 == 0]
        if wrong:
            raise ValueError(f"bad {wrong[0]}")
        return pdf

    parts = isolated(fn, pd.DataFrame({"i": [i if i % 2 else (i * 31) % n for i in order]}), pa.schema([("i", pa.int64())]), lambda row, e: {"i": row["i"], "error": str(e)})
    bad = [p for p in parts if isinstance(p, dict)]
    assert all(p["error"] == f"bad {p['i']}" for p in bad) and sum(len(p) for p in parts if not isinstance(p, dict)) + len(bad) == n
    assert len(calls) < 0.65 * n, len(calls)


def test_a_row_that_passes_alone_is_no_error_row():
    seen = []

    def fn(pdf):                                   # raises for the frame as a whole only
        seen.append(len(pdf))
        if len(pdf) > 1:
            raise ValueError("several rows")
        return pdf

    parts = isolated(fn, pd.DataFrame({"i": range(20)}), pa.schema([("i", pa.int64())]), lambda row, e: {"i": -1})
    assert [int(p["i"].iloc[0]) for p in parts] == list(range(20))
