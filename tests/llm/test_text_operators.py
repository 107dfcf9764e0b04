"""Brute-force checks of the operators on texts, with nulls, empty and long
texts, ties, repeated rows and clashing column names."""

import array
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest

from rectext.llm import licenses, packing, quality, sentence_pieces, token_counts

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", "   \n\t ", "short", "a\nb\na\n\na", "x " * 5000,
    "Released under the MIT License. See the Apache License, Version 2.0 or the GNU General Public License v3.",
    "permit licenses; mit-license MIT LICENSE mit license", "Ärzte für ÄÖÜ: l'été, naïve 日本語 \U0001F600 Σας İstanbul é",
    " ".join(f"w{i % 40}" for i in range(200)), "one two three four five six seven eight nine ten " * 3,
    "don't we'll 12,345.67 <|endoftext|> a²b ½ µm ...!? x y\x1cz​", "\n".join(f"line {i % 7}" for i in range(50)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 7, "p") for i, t in enumerate(TEXTS)] + [(3, "short", 8, "q"), (None, TEXTS[6], 9, "r")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, ids string").repartition(3)


def by_id(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


def test_license_base_places(docs):
    got = by_id(licenses.license_scan(docs))
    assert len(got) == docs.count()
    for r in got:
        text = TEXTS[6 if r["doc_id"] is None else r["doc_id"]] or ""
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        at = [(i, label) for p, label in licenses.BASE for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        assert (r["n_words"], r["n_base"]) == (len(words), len(at))
        assert (r["first_word"], r["last_word"]) == (min(at)[0] if at else None, max(at)[0] if at else None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1


def test_license_rules_are_many_and_suppress():
    assert len(licenses.rules()) > 200
    kept = licenses.suppressed([(50, 2, 5, "a", .5), (90, 1, 6, "b", 1.0), (10, 5, 8, "c", .2), (90, 1, 6, "b", 1.0)])
    assert [d[3] for d in kept] == ["b", "c"]
    import random
    rnd = random.Random(1)
    for _ in range(300):
        found = [(rnd.choice([1, 2, 3]), s := rnd.randrange(12), s + rnd.randrange(5), "x", .1) for _ in range(rnd.randrange(12))]
        plain = []
        for d in sorted(set(found), key=lambda d: (-d[0], d[1] - d[2], d[1], d[3])):
            if not any(k[1] <= d[1] and d[2] <= k[2] for k in plain):
                plain.append(d)
        assert licenses.suppressed(found) == plain


def test_license_abbreviations(spark):
    cases = {"It is licensed under the GPL v3.": "gpl", "GPLv2 or later": "gpl", "See GPL-3.0-only": "gpl", "under the LGPL 2.1": "lgpl", "LGPL, version 3": "lgpl",
             "AGPLv3": "agpl", "MPL 2.0": "mpl", "released under the EPL-1.0": "epl", "CC BY-SA 4.0": "cc-by-sa", "cc-by-nc-nd 3.0": "cc-by-nc-nd",
             "Text under CC BY": "cc-by", "version 2 of the GNU GPL": "gpl", "GPL licensed": "gpl",
             "a simple example": "", "cc by mail": "", "the EPL season": "", "deployment 2.0": "", "gplus 3": ""}
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = by_id(licenses.license_scan(df))
    assert [r["labels"] for r in got] == list(cases.values())
    assert all(r["base_labels"] == "" and (r["score"] > 0) == (r["labels"] != "") for r in got)


def test_license_metadata_forms(spark):
    cases = {"License: MIT": "mit", "license = Apache-2.0": "apache", "BSD-3-Clause": "bsd-3-clause", "the 2-clause BSD license": "bsd-2-clause", "Licence: GPLv3": "gpl",
             "This file is proprietary and confidential.": "proprietary", "confidential and proprietary, all rights reserved": "proprietary",
             "under the EPL rules": "", "released under the EPL": "epl", "licensed mitigation": "", "a driving license mitigates": ""}
    got = by_id(licenses.license_scan(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")))
    assert [set(r["labels"].split(",")) >= {want} if want else r["labels"] == "" for r, want in zip(got, cases.values())] == [True] * len(cases), [r["labels"] for r in got]


def test_keyword_gate_loses_no_rule(spark):
    """Every rule's own keyword stands in what it matches, so the gate can't hide it: each
    pattern's plainest reading is found by the scan."""
    import re
    for rule in licenses.rules():
        plain = rule.pattern.replace(r"\w+", "x")
        while "(?:" in plain:                      # first alternative of each group; optional ones left out
            plain = re.sub(r"\(\?:([^()|]*)[^()]*\)(\??)", lambda m: "" if m[2] else m[1], plain)
        plain = re.sub(r"\[([^\]])[^\]]*\](\??)|(.)\?", lambda m: (("" if m[2] else m[1]) if m[1] else ""), plain)
        assert re.fullmatch(rule.pattern, plain) and rule.keyword in plain, (rule, plain)


def test_quality_counts(docs):
    got = by_id(quality.quality_rules(docs, []))
    for r in got:
        text = TEXTS[6 if r["doc_id"] is None else r["doc_id"]] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text)) and r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(words) < 20 or 100 * len(covered) > 30 * len(words)) and r["kept"] != r["base_failed"]


def test_quality_divergence_rejects_junk(spark):
    import random
    rnd = random.Random(3)
    prose = [" ".join(rnd.choice("the of and to in water river stone house light".split()) + rnd.choice(["", "", "x" * rnd.randrange(4)]) for _ in range(300)) for _ in range(40)]
    junk = " ".join(rnd.choice(["#$%", "@@1", "0x9"]) + str(rnd.randrange(10**6)) for _ in range(300))
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose)] + [(99, junk, None)], "doc_id long, text string, lang string")
    refs = quality.language_references(df)
    assert [r["lang"] for r in refs] == ["en"] and dict(refs[0]["words"])
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df, refs).collect()}
    assert not got.pop(99) and all(got.values())
    assert quality.language_references(df.limit(0)) == [] and quality.quality_rules(df.limit(0), refs).count() == 0


def test_quality_keeps_clean_texts_of_small_languages(spark):
    import random
    rnd = random.Random(4)
    en, ru = "the of and to in water river stone house light".split(), "и в не на что река камень вода дом свет".split()
    rows = [(i, " ".join(rnd.choice(en) for _ in range(300)), "en") for i in range(120)]
    small = " ".join(rnd.choice(ru) + rnd.choice(ru) + rnd.choice(ru) for _ in range(25))
    rows += [(200, small, "ru"), (201, small, "en"), (202, small, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = quality.language_references(df)
    assert [(r["lang"], r["share"] < 0.001) for r in refs] == [("en", False), ("ru", True)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df, refs).collect()}
    assert got[200] and not got[201] and not got[202], "its reference judges its own documents only"
    few = quality.language_references(df, quality.Rules(max_languages=1))
    assert [r["lang"] for r in few] == ["en"]
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df, few).collect()}
    assert got[200] and not got[201] and not got[202], "no reference of its language: passes"


def test_quality_limits_follow_length():
    import random
    rnd = random.Random(6)
    common = [w.encode() for w in "the of and to in is on for with this".split()]
    other = lambda: "".join(rnd.choice("abcdefghilmnoprstu") for _ in range(7)).encode()
    prose = lambda n: b" ".join(rnd.choice(common) if rnd.random() < 0.3 else other() for _ in range(n)) + b"."
    whole = prose(20000)
    h, letters = Counter(whole), quality.common_words_of(whole)
    shares = [sum(n for b, n in h.items() if quality._class_of_byte()[b] == i) / len(whole) for i in range(len(quality.CLASSES))]
    ref = {"lang": "en", "classes": shares, "words": sorted((w, letters[w] / 20000) for w in common), "share": 1.0}
    kept = lambda raw: quality.assessor([ref])(raw, "en")[6]
    assert all(kept(prose(n)) for n in (45, 60, 100, 140, 400) for _ in range(20)), "clean texts of any length"
    bars = lambda n: b" | ".join(other() for _ in range(n))
    assert not any(kept(bars(n)) for n in (30, 60, 97, 140) for _ in range(20)), "a table's cells, letter runs below 150"


def encoded(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORD_BPE).encode(text or "", add_special_tokens=False).ids


def test_packing_round_trip(docs):
    rows = by_id(packing.pack(docs, WORD_BPE))
    assert len({r["sequence_id"] for r in rows}) == len(rows) and all(r["offset"] == 0 for r in rows)
    for i, t in enumerate(TEXTS):
        want = [*encoded(t), 2]
        own = sorted((r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in rows if r["doc_id"] == i)
        own = sorted(set(own))
        assert array.array("I", b"".join(x[3] for x in own)).tolist() == want
        assert all(n & (n - 1) == 0 and n <= 4096 and zlib.crc32(b) == c and len(b) == 4 * n for _, n, c, b in own)
    assert packing.cuts(4096 * 2 + 5) == [(0, 4096), (4096, 4096), (8192, 4), (8196, 1)]
    assert packing.pack(docs.limit(0), WORD_BPE).count() == 0


def test_token_counts(docs):
    lengths = [len(encoded(TEXTS[6 if r["doc_id"] is None else r["doc_id"]])) for r in docs.select("doc_id").collect()]
    hist = token_counts.length_histogram(token_counts.encoded_lengths(docs, WORD_BPE))
    table = token_counts.limits_table(hist, band=4)
    rows = {r["context_limit"]: r for r in table.collect()}
    assert set(rows) == set(lengths)
    for limit, r in rows.items():
        assert r["n_docs"] == lengths.count(limit) and r["docs_up_to"] == sum(x <= limit for x in lengths)
        assert r["tokens_truncated"] == sum(min(x, limit) for x in lengths) and r["tokens_total"] == sum(lengths)
    assert token_counts.truncated_total(hist, 3).first()[0] == sum(min(x, 3) for x in lengths)
    assert token_counts.length_quantile(table, 0.5).first()[0] == sorted(lengths)[(len(lengths) - 1) // 2]
    assert token_counts.limits_table(hist.limit(0)).count() == 0


def test_sentence_pieces(docs):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    out = sentence_pieces.encode_documents(docs, PIECE_BPE)
    for r in by_id(out):
        text = TEXTS[6 if r["doc_id"] is None else r["doc_id"]] or ""
        assert r["ids"] == sp.encode(text) and r["parity"] and r["round_trip"] and r["n_pieces"] == len(r["ids"])
    back = {r["doc_id"]: r["text"] for r in sentence_pieces.decode_documents(out, PIECE_BPE).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(TEXTS))
    coder = sentence_pieces.Coder(PIECE_BPE, block=5)     # blocks end before a run of marks
    odd = ["▁▁▁ ▁a  b" * 9, "x" * 50, " ", "", "a b c d e f g h " * 5]
    assert coder.encode(odd) == [sp.encode(x) for x in odd]
    spelled = [[sp.piece_to_id(f"<0x{b:02X}>") for b in "▁é".encode()]]
    assert coder.decode(spelled) == [sp.decode(spelled[0])] == ["▁é"]
    assert sentence_pieces.encode_documents(docs.limit(0), PIECE_BPE).count() == 0
