"""Unigram models against the sentencepiece library; exact near-dedup against the sketches' result."""

import random
import struct

import pytest

from rectext.llm import near_dedup, sentence_pieces


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(*parts):
    """Protobuf fields ``(number, value)``: ints, floats, text or bytes."""
    out = b""
    for number, value in parts:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            raw = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(raw)) + raw
    return out


def unigram(byte_fallback, extra_norm=(), extra_spec=(), extra=()):
    """A written-out unigram model: no training."""
    rnd = random.Random(4)
    words = ["▁", "▁the", "▁of", "the", "of", "in", "ing", "er", "▁a", "an", "and", "▁and", "river", "riv", "er▁", "stone", "st", "on", "one", "é", "▁é", "日", "日本"]
    texts = dict.fromkeys([*words, *"abcdefghijklmnopqrstuvwxyz.,'"])
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if byte_fallback else []
    pieces += [(t, round(-2.0 - rnd.random() * 9 / len(t), 3), 1) for t in texts]
    spec = message((3, 1), *([(35, 1)] if byte_fallback else []), *extra_spec)
    norm = message((1, "identity"), (3, 1), (4, 1), *extra_norm)
    return b"".join(message((1, message((1, t), (2, s), (3, k)))) for t, s, k in pieces) + message((2, spec), (3, norm), *extra)


TEXTS = ["the river of stone", "  two  blanks ", "", " ", "unknown: Ω€ x", "日本日 日本", "été and the ending", "theandof ing er one", "a" * 300, "ΩΩΩ the ΩΩ", "x\ty\nz", "😀 stone 😀😀"]


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_unigram_models_encode_like_the_library(spark, tmp_path, byte_fallback):
    import sentencepiece
    raw = unigram(byte_fallback)
    path = tmp_path / "u.model"
    path.write_bytes(raw)
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    coder = sentence_pieces.Coder(str(path))
    rnd = random.Random(5)
    texts = TEXTS + ["".join(rnd.choice("theofandriverstone  .é日Ω") for _ in range(rnd.randrange(60))) for _ in range(200)]
    for t, got in zip(texts, coder.encode(texts)):
        assert got == sp.encode(t), t
    if byte_fallback:
        assert coder.decode([sp.encode(t) for t in texts]) == [sp.decode(sp.encode(t)) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = sentence_pieces.encode_documents(df, str(path)).collect()
    assert len(rows) == len(texts) and all(r["parity"] and r["ids"] == sp.encode(texts[r["doc_id"]]) for r in rows)


@pytest.mark.parametrize("change", [{"extra_norm": [(5, 0)]}, {"extra_spec": [(24, 1)]}, {"extra": [(5, message((2, b"x")))]}, {"extra": [(1, message((1, "sym"), (2, 0.0), (3, 4)))]}])
def test_settings_that_are_not_rebuilt_raise(change):
    with pytest.raises(ValueError, match="not supported"):
        sentence_pieces.read_model(unigram(False, **change))


def merged(byte_fallback, mark, prefix, one_blank):
    """A written-out BPE model: merges in the order of the scores."""
    texts = [*(["▁"] if mark else []), *"abehnot.", "th", "the", "an", "on", "to", "ot", "at", "en"]
    texts += ["▁t", "▁the", "▁a", "▁an", "▁▁", "▁▁▁"] if mark else []
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if byte_fallback else []
    pieces += [(t, -float(i), 1) for i, t in enumerate(texts)]
    norm = message((1, "identity"), (3, int(prefix)), (4, int(one_blank)))
    return b"".join(message((1, message((1, t), (2, s), (3, k)))) for t, s, k in pieces) + message((2, message((3, 2), *([(35, 1)] if byte_fallback else []))), (3, norm))


@pytest.mark.parametrize("byte_fallback, mark, prefix, one_blank", [(True, True, True, False), (False, True, True, False), (True, False, True, False), (True, True, False, False), (True, True, True, True)])
def test_bpe_models_encode_like_the_library(tmp_path, byte_fallback, mark, prefix, one_blank):
    import sentencepiece
    raw = merged(byte_fallback, mark, prefix, one_blank)
    path = tmp_path / "b.model"
    path.write_bytes(raw)
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    coder = sentence_pieces.Coder(str(path), block=7)
    rnd = random.Random(6)
    texts = ["", " ", "▁", "a▁", "the  an", "the▁▁an", "Ω▁Ω ΩΩ", "the the\nthe", "the" * 20, "the\0 the \0an", " \0"]
    texts += ["".join(rnd.choice("thehanoeto.  ▁éΩ\n") for _ in range(rnd.randrange(60))) for _ in range(400)]
    texts = [t.replace("▁", " ") for t in texts] if one_blank else texts
    said = [sp.encode(t) for t in texts]
    assert coder.encode(texts) == said and [coder.encode([t])[0] for t in texts] == said
    assert coder.decode(said) == [coder.tokenizer.decode(x, skip_special_tokens=False) for x in said]


class Counted:
    """A tokenizer that keeps what it was asked."""

    def __init__(self, tokenizer):
        self.tokenizer, self.encoded, self.decoded, self.most = tokenizer, 0, 0, 0

    def encode_batch_fast(self, texts, **kw):
        self.encoded, self.most = self.encoded + sum(map(len, texts)), max(self.most, len(texts))
        return self.tokenizer.encode_batch_fast(texts, **kw)

    def decode(self, ids, **kw):
        self.decoded += 1
        return self.tokenizer.decode(ids, **kw)

    def decode_batch(self, rows, **kw):
        self.decoded += len(rows)
        return self.tokenizer.decode_batch(rows, **kw)


def test_a_word_is_encoded_once_and_utf8_needs_no_tokenizer():
    import sentencepiece
    from rectext.llm.queries import PIECE_BPE
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    coder = sentence_pieces.Coder(PIECE_BPE)
    coder.tokenizer = Counted(coder.tokenizer)
    words = ["river", "stone,", "été", "日本", "😀", "a\tb", "x" * 30]
    rnd = random.Random(7)
    texts = [" ".join(rnd.choice(words) for _ in range(50)) for _ in range(200)]
    got = coder.encode(texts)
    assert got == [sp.encode(t) for t in texts]
    assert coder.tokenizer.encoded == sum(len(w) + 1 for w in words)
    spaced = ["  " + t.replace(" é", "   é") for t in texts]              # words behind runs of blanks
    assert coder.encode(spaced) == [sp.encode(t) for t in spaced]
    assert coder.tokenizer.encoded < 2000
    assert coder.decode(got) == texts and coder.tokenizer.decoded == 0
    rows = [[rnd.randrange(3, 300) if rnd.random() < 0.6 else rnd.randrange(32100) for _ in range(rnd.randrange(12))] for _ in range(2000)]
    assert coder.decode(rows) == coder.tokenizer.tokenizer.decode_batch(rows, skip_special_tokens=False)
    assert 0 < coder.tokenizer.decoded < len(rows), "byte pieces that aren't UTF-8"
    few = sentence_pieces.Coder(PIECE_BPE, block=50, group=3)
    few.tokenizer = Counted(few.tokenizer)
    whole = [t + " " for t in texts[:20]]                                 # not cut into words
    assert few.encode(whole) == [sp.encode(t) for t in whole] and few.tokenizer.most == 3


def test_exact_near_dedup_equals_the_sketches_result(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = [sorted(map(tuple, near_dedup.near_duplicates(docs, exact=e).collect())) for e in (False, True)]
    assert got[0] == got[1] and sum(not r[3] for r in got[0]) > 5
