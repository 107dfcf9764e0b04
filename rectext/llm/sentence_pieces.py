"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model's protobuf is read field by field; from it come the normaliser (the
compiled character map, extra blanks, the dummy prefix), the metaspace
marker, the pieces with their scores as a unigram or a BPE model, and byte
fallback. ``parity`` compares the ids with the ``sentencepiece`` library.
"""

from __future__ import annotations

import array
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rectext.llm.common import map_rows

MARK = "▁"
CUT = "\0"            # put between words; texts that hold it are not cut there
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(raw: bytes):
    """``(number, value)`` of a protobuf message: ints, 4 or 8 bytes, or bytes."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, raw[at:at + n]
            at += n


@dataclass
class Model:
    pieces: list          # (text, score, type)
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    one_blank: bool


def read_model(raw: bytes) -> Model:
    """A model's pieces and settings. Settings that change the result and
    aren't rebuilt here (blanks kept as they are or marked behind a word, a
    denormaliser, symbols defined by the user) raise an error."""
    pieces, spec, norm, back = [], {}, {}, {}
    for number, value in fields(raw):
        if number == 1:
            p = dict(fields(value))
            pieces.append((p.get(1, b"").decode(), struct.unpack("<f", p[2])[0] if 2 in p else 0.0, p.get(3, NORMAL)))
        elif number == 2:
            spec = dict(fields(value))
        elif number == 3:
            norm = dict(fields(value))
        elif number == 5:
            back = dict(fields(value))
    odd = [name for name, found in (("escape_whitespaces", not norm.get(5, 1)), ("treat_whitespace_as_suffix", spec.get(24, 0)), ("denormalizer", back.get(2)),
                                    ("user-defined symbols", any(kind == USER_DEFINED for *_, kind in pieces))) if found]
    if odd:
        raise ValueError(f"not supported in a model: {', '.join(odd)}")
    return Model(pieces, spec.get(3, UNIGRAM), bool(spec.get(35, 0)), norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1)))


def build(model: Model):
    """A ``Tokenizer`` with the model's pieces. Its input is what
    ``normalised`` gives: marks for blanks, with the prefix. Decoding keeps a
    mark that byte pieces spell."""
    from tokenizers import Tokenizer, decoders, models
    ids = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    unk = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk, model.byte_fallback)
    elif model.kind == BPE:
        usable = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
        merges = sorted(((-s, ids[p], p[:i], p[i:]) for p, s in usable.items() for i in range(1, len(p)) if p[:i] in usable and p[i:] in usable),
                        key=lambda m: (m[0], m[1], ids[m[2]], ids[m[3]]))
        core = models.BPE(ids, [(a, b) for _, _, a, b in merges], unk_token=model.pieces[unk][0], fuse_unk=True,
                          byte_fallback=model.byte_fallback, cache_capacity=0)
    else:
        raise ValueError(f"model type {model.kind} has no counterpart in the tokenizers library")
    t = Tokenizer(core)
    lead = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    t.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *lead])
    return t


class Coder:
    """``encode(texts)`` and ``decode(ids)``. A long text is cut into blocks
    that end before a run of marks (no piece goes on into one), so that the
    work grows with its length; ``group`` blocks go to the tokenizer in one
    batch, which its ``threads`` share. For the same reason a word with the marks
    before it has the same ids in every text of a BPE model: of the texts
    given at once, each distinct word goes there once."""

    def __init__(self, path: str, threads: int = 2, block: int = 4096, group: int = 64):
        import os
        os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = "true", str(threads)
        with open(path, "rb") as f:
            self.model = read_model(f.read())
        from tokenizers import normalizers
        self.charsmap = normalizers.Precompiled(self.model.charsmap) if self.model.charsmap else None
        self.tokenizer, self.group = build(self.model), group
        usable = {p for p, _, kind in self.model.pieces if kind in (NORMAL, USER_DEFINED)}
        inner = any(MARK in p.lstrip(MARK) for p in usable)
        self.blocks = re.compile("(?s).+" if inner or self.model.kind == UNIGRAM and not self.model.byte_fallback
                                 else f"(?s).{{1,{block}}}{MARK}*[^{MARK}]*")
        self.by_word = self.model.kind == BPE and not inner and MARK in usable
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(len(self.model.pieces))]
        self.opens = np.array([t in usable and t.startswith(MARK) for t in tokens])
        self.marks = np.array([t in usable and not t.strip(MARK) for t in tokens])
        byte = re.compile("<0x([0-9A-Fa-f]{2})>")
        # What each id stands for in a decoded text; the last entry is for ids the model doesn't have.
        self.spelt = pa.array([bytes.fromhex(m[1]) if (m := byte.fullmatch(t)) else t.replace(MARK, " ").encode() for t in tokens] + [b""], pa.large_binary())

    def normalised(self, text: str) -> str:
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if self.model.one_blank:
            text = re.sub(" {2,}", " ", text.strip(" "))
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.tolist() for x in self.encode_normalised([self.normalised(t) for t in texts])]

    def encode_normalised(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's ids, as little-endian unsigned 32-bit numbers."""
        out: list = [None] * len(texts)
        # Texts with marks before each word and nowhere else.
        worded = [i for i, t in enumerate(texts) if self.by_word and t[:1] == MARK != t[-1] and CUT not in t]
        for i, x in zip(worded, self.of_words([texts[i] for i in worded])):
            out[i] = x
        rest = [i for i, x in enumerate(out) if x is None]
        cut = [self.blocks.findall(texts[i]) for i in rest]
        coded = iter(self.of_blocks([c for row in cut for c in row]))
        for i, row in zip(rest, cut):
            out[i] = np.concatenate([np.empty(0, "<u4"), *(next(coded) for _ in row)])
        return out

    def of_blocks(self, blocks: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for at in range(0, len(blocks), self.group)          # bounds the encodings held at once
                for e in self.tokenizer.encode_batch_fast(blocks[at:at + self.group], add_special_tokens=False)]

    def of_words(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        words = pc.split_pattern(pa.array([t.replace(MARK, CUT + MARK).replace(MARK + CUT, MARK)[1:] for t in texts], pa.large_string()), CUT)
        ends, coded = words.offsets.to_numpy(), words.flatten().dictionary_encode()
        at, distinct = coded.indices.to_numpy(), "".join(coded.dictionary.to_pylist())
        ids = np.concatenate(self.of_blocks(self.blocks.findall(distinct)))
        # A distinct word begins where a piece does with a mark, and no mark stands before it.
        start = np.flatnonzero(self.opens[ids] & ~np.r_[False, self.marks[ids[:-1]]])
        size = np.diff(start, append=len(ids))[at]
        begin = np.r_[0, np.cumsum(size)]
        out = ids[np.arange(begin[-1]) + np.repeat(start[at] - begin[:-1], size)]
        of_text = begin[ends - ends[0]].tolist()
        return [out[a:b] for a, b in zip(of_text, of_text[1:])]

    def decode(self, ids: list) -> list[str]:
        """Texts of lists or arrays of ids. What the ids stand for is joined
        as bytes; where byte pieces aren't UTF-8, the tokenizer decodes."""
        if not ids:
            return []
        end = np.cumsum([len(row) for row in ids])
        flat = np.concatenate([np.asarray(row, "<u4") for row in ids])
        spelt = self.spelt.take(pa.array(np.minimum(flat, len(self.spelt) - 1)))
        at = np.frombuffer(spelt.buffers()[1], np.int64)[np.r_[0, end]].tolist()
        raw, out = memoryview(spelt.buffers()[2] or b""), []
        for row, a, b in zip(ids, at, at[1:]):
            try:
                text = str(raw[a:b], "utf-8")
                out.append(text[1:] if self.model.dummy_prefix and text[:1] == " " else text)
            except UnicodeDecodeError:
                out.append(self.tokenizer.decode([*map(int, row)], skip_special_tokens=False))
        return out


SCHEMA = "doc_id long, n_pieces long, ids_crc32 long, parity boolean, round_trip boolean, ids array<int>"


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", verify: bool = True,
                     with_ids: bool = True, threads: int = 2, group: int = 64) -> DataFrame:
    """One row per document over its whole text: the ids, their crc32
    (little-endian unsigned 32-bit), ``parity`` (equal to the sentencepiece
    library's ids; null without ``verify``) and ``round_trip`` (decoding
    gives the normalised text again). A null or empty text has no pieces.
    Equal rows give equal rows, null ids stay, other columns are not read."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def start():
        coder = Coder(path, threads, group=group)
        checker = None
        if verify:
            import sentencepiece
            checker = sentencepiece.SentencePieceProcessor(model_file=path)

        def f(ids, raws):
            rows = []
            texts = [r.decode() if r else "" for r in raws]
            normal = [coder.normalised(t) for t in texts]
            got = coder.encode_normalised(normal)
            for i, text, t, x, back in zip(ids, texts, normal, got, coder.decode(got)):
                plain, own = t.replace(MARK, " "), x.tobytes()
                rows.append((i, len(x), zlib.crc32(own), array.array("I", checker.encode_as_ids(text)).tobytes() == own if checker else None,
                             back == (plain[1:] if coder.model.dummy_prefix else plain), x.tolist() if with_ids else None))
            return dict(zip(names, map(list, zip(*rows))))

        return f

    out = map_rows(docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")), SCHEMA, start)
    return out if with_ids else out.drop("ids")


def decode_documents(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, text`` of ``ids``; null ids give an empty text."""
    def start():
        coder = Coder(path)
        return lambda keys, rows: {"doc_id": keys, "text": coder.decode([x or [] for x in rows])}

    return map_rows(encoded.select(F.col(doc_id).cast("long"), F.col(ids)), "doc_id long, text string", start)
