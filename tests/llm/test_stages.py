"""The pipeline's stages on tables with clashing columns, nulls, repeated
rows, and without rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rectext.llm import lang_id, line_dedup, near_dedup, quality
from rectext.llm.words_bpe import WordEncoder, encoder

CLASHING = ["score", "lang_pred", "guess", "_guess", "_key", "_id", "row", "key", "id", "n_removed", "removed", "cuts", "kept", "key.with.dot"]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (None, "the and of to in", None, "s", 16), (10**6 + 2, "x" * 200_000, "fr", "s", 200_000)],
                                  docs.schema)
    both = docs.unionByName(extra).unionByName(docs.limit(3))
    marked = both.withColumns({c: F.lit(f"mine {c}") for c in CLASHING if "." not in c}).withColumn("key.with.dot", F.lit("mine key.with.dot"))
    return marked.withColumn("some", F.map_from_arrays(F.array(F.lit("a")), F.array(F.col("n_chars"))))


@pytest.mark.parametrize("stage", [lambda d: lang_id.recognised(d, 0.35), quality.good_documents, line_dedup.without_repeats, near_dedup.representatives])
def test_stages_keep_columns_of_any_name(odd, stage):
    got = stage(odd)
    assert got.columns == odd.columns and [f.dataType for f in got.schema] == [f.dataType for f in odd.schema]
    rows = got.collect()
    assert 50 < len(rows) <= odd.count()
    for r in rows:
        assert all(r[c] == f"mine {c}" for c in CLASHING)
    assert stage(odd.limit(0)).count() == 0


def test_language_stage_runs_the_model_once_a_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = lang_id.recognised(docs, 0.35)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("BatchEvalPython") == 1
    got = lang_id.recognised(docs, 0.35).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert len(got) > 150 and np.mean([r["lang"] == truth[r["doc_id"]] for r in got]) > 0.95


def dense_ftrl(rows, n_classes, how):
    """FTRL-proximal written out feature by feature."""
    z = [[0.0] * (how.dim + 1) for _ in range(n_classes)]
    g2 = [[0.0] * (how.dim + 1) for _ in range(n_classes)]

    def weight(c, i):
        if abs(z[c][i]) <= how.l1:
            return 0.0
        return -(z[c][i] - np.sign(z[c][i]) * how.l1) / ((how.beta + np.sqrt(g2[c][i])) / how.alpha + how.l2)

    order = np.random.default_rng(0)
    for _ in range(how.epochs):
        for j in order.permutation(len(rows)):
            at, v, y = rows[j]
            x = {**dict(zip(at.tolist(), v.tolist())), how.dim: 1.0}
            w = {(c, i): weight(c, i) for c in range(n_classes) for i in x}
            logit = np.array([sum(w[c, i] * x[i] for i in x) for c in range(n_classes)])
            p = np.exp(logit - logit.max())
            p /= p.sum()
            for c in range(n_classes):
                for i in x:
                    g = (p[c] - (c == y)) * x[i]
                    sigma = (np.sqrt(g2[c][i] + g * g) - np.sqrt(g2[c][i])) / how.alpha
                    z[c][i] += g - sigma * w[c, i]
                    g2[c][i] += g * g
    return np.array([[weight(c, i) for i in range(how.dim + 1)] for c in range(n_classes)])


def test_ftrl_and_temperature_match_plain_versions():
    how = lang_id.Fit(dim=64, l1=0.2)
    rnd = random.Random(1)
    texts = [("".join(rnd.choice(letters) for _ in range(40)), y) for y, letters in enumerate(("abc d", "cdé f", "xyz a")) for _ in range(20)]
    idf = np.linspace(1, 2, 64)
    rows = []
    for t, y in texts:
        at, n = lang_id.ngram_counts(t, 64)
        v = np.array([np.log(1 + k) * idf[i] for i, k in zip(at, n)])
        assert np.allclose(lang_id.tfidf(at, n, idf), v / np.sqrt((v**2).sum()))
        rows.append((at, lang_id.tfidf(at, n, idf), y))
    w = lang_id.ftrl(rows, 3, how)
    assert np.allclose(w, dense_ftrl(rows, 3, how)) and np.abs(w).max() > 0.1 and (w == 0).any()
    rng = np.random.default_rng(2)
    y = rng.integers(0, 4, 500)
    logits = rng.normal(size=(500, 4)) * 3 + 2 * np.eye(4)[y]
    loss = lambda t: -np.log(lang_id.softmax(logits / t)[np.arange(500), y]).mean()
    grid = np.exp(np.linspace(np.log(0.5), np.log(20), 4000))
    assert abs(lang_id.temperature(logits, y) / grid[np.argmin([loss(t) for t in grid])] - 1) < 0.01


def test_every_language_is_learned(spark):
    words = {f"l{i}": [chr(0x400 + 9 * i + j) * 3 for j in range(8)] for i in range(30)}
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choices(words[k], k=30)), k) for i, k in enumerate([k for k in words for _ in range(4 if k != "l0" else 200)])]
    rows += [(9000 + i, "1 2 3", "digits") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.fit(df)
    assert model["langs"] == sorted(words)
    assert lang_id.Fit().of(30).dim == 1 << 15 and lang_id.Fit().of(7000).dim * 7000 <= 1 << 23 and lang_id.Fit().of(7000).sample == 8


def test_words_encode_like_the_tokenizer_for_all_pairs_of_characters():
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    coder, ids = WordEncoder(path, cache=2000), lambda t: np.array(encoder(path).tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    chars = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(160, 256)]]
    for a in chars:
        text = " ".join(f"x{a}{b}y {a}{b} {b}'s" for b in chars)
        assert coder.encode(text) == ids(text)


def test_many_texts_at_once_have_the_tokenizers_ids():
    import public_tokenizers

    from rectext.llm.words_bpe import WordEncoder
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["", " ", "  a  b ", "\t\nA", "ÀÉ ß\r\nµ¼ 12x don't CAN'T", "<|endoftext|> a", "日本 a", "a\x0bb a\xa0b", "~!@#$%^&*()_+{}|:\"<>?`-=[];',./ ''s'll'", "ab" * 999]
    texts += [" ".join(f"{w}{i % 7}é" for w in ("one", "Zwei", "trois,")) for i in range(200)]
    for cache, block in ((500_000, 4_000_000), (8, 50)):
        coder = WordEncoder(path, cache=cache, block=block)
        assert coder.encode_all(texts) == [coder.whole(t) for t in texts]
    assert coder.encode_all([]) == [] and [coder.encode(t) for t in texts[:9]] == coder.encode_all(texts[:9])


def test_few_mb_of_a_batch_become_python_objects_at_once(spark):
    import pyarrow as pa

    from rectext.llm.common import map_rows, parts

    df = spark.range(0, 1500, 1, 1).selectExpr("id", "if(id % 7 = 0, null, repeat(chr(cast(97 + id % 26 as int)), 20000)) AS text")
    counted = map_rows(df, "id long, size long, together long",
                       lambda: lambda ids, texts: {"id": ids, "size": [len(t or b"") for t in texts], "together": [sum(len(t or b"") for t in texts)] * len(ids)})
    rows = sorted(counted.collect())
    assert [r["id"] for r in rows] == list(range(1500))
    assert all(r["size"] == (20000 if r["id"] % 7 else 0) for r in rows)
    assert max(r["together"] for r in rows) <= 6 << 20     # all 25 MB before

    texts = pa.array(["a" * 900, None, "", "b" * 3000, *"xyz"] * 50)
    got = list(parts(texts, 4000))
    assert len(got) > 10 and pa.concat_arrays(got).equals(texts)
    assert not list(parts(texts[:0])) and len(list(parts(pa.array(["a" * 99]), 1))) == 1
    batch = pa.RecordBatch.from_arrays([pa.array(range(350)), texts], ["n", "t"])
    assert pa.Table.from_batches(parts(batch, 4000)).combine_chunks().equals(pa.Table.from_batches([batch]))


def test_models_as_columns_take_every_row_once(spark):
    """Null and empty texts and languages among texts of several parts of a batch."""
    from rectext.llm import lang_id, quality

    texts = [None, "", " 12 ", "the cat and the dog " * 9000, "el perro y la gata " * 9000] * 12
    docs = spark.createDataFrame([(i, t, (None, "", "en", "es")[i % 4]) for i, t in enumerate(texts)], "doc_id long, text string, lang string").coalesce(1)
    model = {"langs": ["en", "es"], "weights": np.zeros((65, 2), np.float32), "idf": np.ones(64), "temperature": 1.0, "dim": 64}
    model["weights"][-1] = [0, 1]
    got = sorted(lang_id.predict(docs, model).select("doc_id", "lang_pred", "score").collect())
    assert [r["lang_pred"] for r in got] == ["es" if i % 5 > 2 else "und" for i in range(60)]
    assert all(r["score"] == 0 if r["lang_pred"] == "und" else r["score"] > 0.7 for r in got)
    refs = quality.language_references(docs)
    one = quality.assessor(refs)
    said = sorted(docs.select("doc_id", quality.passes(docs["text"], refs, lang=docs["lang"]).alias("kept")).collect())
    assert [r["kept"] for r in said] == [one(None if t is None else t.encode(), (None, "", "en", "es")[i % 4])[6] for i, t in enumerate(texts)]


@pytest.mark.parametrize("step", [lambda d: near_dedup.sketches(d, 8), lambda d: lang_id.predict(d, None), lambda d: quality.good_documents(d, lang="text"),
                                  lambda d: line_dedup.found_seeds(d, line_dedup.Chunking(), "doc_id", "text")])
def test_few_mb_go_to_python_in_one_batch(spark, step):
    """Wide texts, few of them: a batch of 10,000 rows would hold them all."""
    import pyarrow as pa

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    step(spark.createDataFrame([(1, "a few words")], "doc_id long, text string"))
    wide = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat(chr(cast(97 + id % 26 as int)), 8000) AS text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "size": [b.nbytes]})

    got = wide.mapInArrow(sizes, "rows long, size long").collect()
    assert sum(r["rows"] for r in got) == 3000 and max(r["size"] for r in got) <= 5 << 20      # 24 MB before
    one = wide.select("doc_id", F.array_repeat("doc_id", 1000).alias("x"), F.lit(0).alias("g")).groupBy("g")
    both = one.cogroup(one).applyInPandas(lambda a, b: a[["doc_id"]].merge(b[["doc_id"]]), "doc_id long")
    assert sorted(r["doc_id"] for r in both.collect()) == list(range(3000))     # groups stay whole over batches
    spark.conf.set(key, "1m")
    step(wide.limit(1))
    assert spark.conf.get(key) == "1m"
    spark.conf.unset(key)
