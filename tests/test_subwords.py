"""Subword ids against the tokenizers library and a plain longest match."""

import random

import pytest
from pyspark.sql import functions as F

from rectext.operators.subwords import SPECIAL, Subwords, read_vocabulary, subword_inputs


def library(vocabulary, lower=True):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers
    t = Tokenizer(models.WordPiece({x: i for i, x in enumerate(vocabulary)}, unk_token="[UNK]", max_input_chars_per_word=100))
    t.normalizer, t.pre_tokenizer = normalizers.BertNormalizer(lowercase=lower), pre_tokenizers.BertPreTokenizer()
    return lambda text: t.encode(text, add_special_tokens=False).ids


def vocabulary_of(texts, n=3000):
    """Special tokens, characters, and beginnings and inner parts of words."""
    words = sorted({w for t in texts for w in Subwords(list(SPECIAL.values())).words(t)})
    rnd = random.Random(1)
    parts = {p for w in words for p in (w[0], f"##{w[-1]}")} | {f"##{c}" for w in words for c in w if rnd.random() < 0.98}
    for w in rnd.sample(words, min(n, len(words))):
        a, b = sorted((rnd.randrange(len(w) + 1), rnd.randrange(len(w) + 1)))
        parts |= {w[:b] or w, f"##{w[a:b]}" if b > a else w}
    return [*SPECIAL.values(), *sorted(parts)]


ODD = ["", " \t\n", "ÀÉÎõü ñandú", "hello, world! it's $5.00+tax ~x^y`z|", "日本語テキスト and 漢字kanji", "a\u0000b\u0007c�d​e", "İstanbul ẞtraße ﬁne Ǆ", "x" * 100, "x" * 101,
       "été naïve", "“quotes” – dash… ¿qué?", " nbsp em line", "привет мир", "한국어 텍스트", "ᾳ ὈΔΥΣΣΕΎΣ", "emoji 😀👍🏽", "tab\tnew\nline\r\n", "[CLS] [SEP] [PAD]"]


def test_ids_equal_the_library_on_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    vocabulary = vocabulary_of([*list(texts.values())[:300], *ODD])
    encode = library(vocabulary)
    number = {t: i for i, t in enumerate(vocabulary)}
    rows = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    got = subword_inputs(docs.unionByName(rows), F.col("text"), vocabulary).collect()
    cut = 0
    for r in got:
        ids = encode(r["text"])
        cut += len(ids) > 510
        assert r["input_ids"] == [number["[CLS]"], *ids[:510], number["[SEP]"]], r["text"][:80]
        assert r["attention_mask"] == [1] * len(r["input_ids"])
    assert cut > 100 and len(got) == 1000 + len(ODD)


def test_cased_and_plain_longest_match():
    vocabulary = [*SPECIAL.values(), "A", "a", "ab", "##b", "##bc", "##c", "É", "##x", "B"]
    coder, encode = Subwords(vocabulary, lower=False), library(vocabulary, lower=False)
    rnd = random.Random(2)
    for _ in range(500):
        text = "".join(rnd.choice("AaBbcÉx ,") for _ in range(12))
        assert coder.ids(text, 10**6) == encode(text)
    assert coder.ids("abc abc abc", 3) == encode("abc abc abc")[:3]


def test_padding_nulls_and_bad_vocabularies(spark, tmp_path):
    path = tmp_path / "vocab.txt"
    path.write_text("\n".join([*SPECIAL.values(), "a", "##b"]) + "\n")
    vocabulary = read_vocabulary(spark, str(path))
    assert vocabulary == [*SPECIAL.values(), "a", "##b"]
    df = spark.createDataFrame([(1, "ab a ab", 9), (2, None, 9), (3, "", 9)], "i long, t string, input_ids int")
    got = {r["i"]: (r["input_ids"], r["attention_mask"]) for r in subword_inputs(df, F.col("t"), vocabulary, max_length=6, pad=True).collect()}
    assert got == {1: ([1, 4, 5, 4, 4, 2], [1] * 6), 2: (None, None), 3: ([1, 2, 3, 3, 3, 3], [1, 1, 0, 0, 0, 0])}
    with pytest.raises(ValueError):
        subword_inputs(df, F.col("t"), ["a"])
    with pytest.raises(ValueError):
        subword_inputs(df, F.col("t"), vocabulary, max_length=1)


def test_batches_of_like_lengths_pad_little(spark):
    import numpy as np
    from rectext.operators.embed import embed_inputs
    rnd = random.Random(3)
    rows = [(i, [rnd.randrange(4, 99) for _ in range(rnd.choice([2, 5, 40, 300, 512]))], "x") for i in range(900)] + [(9000, None, "x"), (9001, [7], "x")]
    df = spark.createDataFrame(rows, "i long, input_ids array<int>, embedding string").repartition(3)

    def make():
        loads = []

        def predict(tokens, mask):
            assert tokens.shape == mask.shape and len(tokens) <= 32 and (tokens[mask == 0] == 3).all()
            return np.column_stack([(tokens * mask).sum(1), mask.sum(1)])
        loads.append(1)
        return predict

    got = {r["i"]: r for r in embed_inputs(df, make, ["i"], pad_id=3, batch_size=32).collect()}
    assert len(got) == 902 and got[9000]["embedding"] is None
    for i, ids, _ in rows:
        assert ids is None or got[i]["embedding"] == [float(sum(ids)), float(len(ids))]
    tokens, padded = sum(len(x) for _, x, _ in rows if x), sum(r["n_padding"] for r in got.values())
    assert padded / (padded + tokens) < 0.2, "padded to the longest of all it would be two thirds"
    assert embed_inputs(df.limit(0), make, ["i"]).count() == 0
