"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

N-grams of the letters of a text (lower-cased, all else one blank) are hashed
into ``dim`` features; their document frequencies are counted over all
documents that may be learned from. The classifier is fitted on a bounded
sample by follow-the-regularised-leader with elastic-net penalties, and one
temperature, fitted on a part of the sample that the classifier hasn't seen,
calibrates its probabilities.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rectext.llm.common import arrow_schema, columns, in_batches, map_rows, parts

UNKNOWN = "und"


@dataclass(frozen=True)
class Fit:
    """``sample``: bound on the documents of each language that the fit
    sees; ``rows``: bound on all of them, shared equally (``least`` a language
    if there are very many). ``weights``: bound on languages x features; the
    features are halved from ``dim`` until it holds. ``alpha, beta``: FTRL step
    sizes, ``l1, l2``: elastic net, ``epochs``: passes over the sample. One in
    ``calibrate`` sample documents is for the temperature."""

    dim: int = 1 << 15
    sample: int = 400
    rows: int = 8000
    least: int = 8
    weights: int = 1 << 23
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-3
    epochs: int = 3
    calibrate: int = 4

    def of(self, languages: int) -> "Fit":
        """The bounds for so many languages: every language that occurs is learned."""
        dim = self.dim
        while dim > 64 and dim * languages > self.weights:
            dim //= 2
        return replace(self, dim=dim, sample=min(self.sample, max(self.least, self.rows // languages)))


_OTHER = re.compile(r"[\W\d_]+")
# Odd multipliers of the characters of an n-gram.
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ngram_counts(text: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of the 1-, 2- and 3-grams of a whole text, with counts."""
    points = np.frombuffer(f" {_OTHER.sub(' ', text.lower()).strip()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(dim, np.int64)
    shift = np.uint32(32 - (dim.bit_length() - 1))
    for n in (1, 2, 3):
        m = len(points) - n + 1
        if m > 0:
            h = np.full(m, n, np.uint32)
            for i in range(n):
                h = (h ^ points[i:m + i]) * _FACTORS[i]
                h ^= h >> np.uint32(15)
            total += np.bincount((h * np.uint32(0x27D4EB2F)) >> shift, minlength=dim)
    at = np.flatnonzero(total)
    return at, total[at]


def tfidf(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf[at]
    return v / max(np.sqrt((v * v).sum()), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list, n_classes: int, how: Fit) -> np.ndarray:
    """Weights (classes x (dim + 1), the last for the bias) of ``rows`` =
    [(features, values, class)]."""
    z, g2 = np.zeros((2, n_classes, how.dim + 1))

    def weights(z, g2):
        return np.where(np.abs(z) <= how.l1, 0, -(z - np.sign(z) * how.l1) / ((how.beta + np.sqrt(g2)) / how.alpha + how.l2))

    order = np.random.default_rng(0)
    for _ in range(how.epochs):
        for i in order.permutation(len(rows)):
            at, v, y = rows[i]
            at, v = np.r_[at, how.dim], np.r_[v, 1.0]
            w = weights(z[:, at], g2[:, at])
            p = softmax(w @ v)
            p[y] -= 1
            g = p[:, None] * v
            sigma = (np.sqrt(g2[:, at] + g * g) - np.sqrt(g2[:, at])) / how.alpha
            z[:, at] += g - sigma * w
            g2[:, at] += g * g
    return weights(z, g2)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits (0.5 to 20) with the least log loss, by golden section. A sample without
    an error would drive it to zero, so it stops at the lower bound."""
    def loss(t):
        return -np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()

    lo, hi, r = np.log(0.5), np.log(20.0), (np.sqrt(5) - 1) / 2
    a, b = hi - r * (hi - lo), lo + r * (hi - lo)
    for _ in range(60):
        if loss(a) <= loss(b):
            hi, b = b, a
            a = hi - r * (hi - lo)
        else:
            lo, a = a, b
            b = lo + r * (hi - lo)
    return float(np.exp((lo + hi) / 2))


def fit(labelled: DataFrame, how: Fit = Fit()) -> dict | None:
    """Model from ``doc_id, text, lang``; None without any language to
    learn. Frequencies cover all rows; the sample is drawn by a hash of the
    id, at most ``how.sample`` rows a language, whatever the input's size.
    Every language of a text with a letter is learned."""
    known = labelled.filter(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    langs, how = sorted(sizes), how.of(len(sizes))

    out = arrow_schema("feature int, n long")

    def frequencies(batches):
        df, n = np.zeros(how.dim, np.int64), 0
        for batch in batches:
            for part in parts(batch):
                for (raw,) in zip(*columns(part)):
                    df[ngram_counts(raw.decode(), how.dim)[0]] += 1
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"feature": [*at.tolist(), -1], "n": [*df[at].tolist(), n]}, schema=out)

    counted = in_batches(known.select("text")).mapInArrow(frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(how.dim + 1)
    for r in counted:
        df[r["feature"]] = r["n"]                  # feature -1, the number of documents, comes last
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, 1.5 * how.sample / sizes[k] + 50 / sizes[k]))])
    draw = F.xxhash64("doc_id", F.lit(11))
    drawn = known.filter(F.col("lang").isin(langs) & (F.pmod(draw, F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)))
    first = Window.partitionBy("lang").orderBy(draw, "doc_id", F.xxhash64("text"))
    drawn = drawn.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= how.sample).select("lang", "r", "text")

    def features():
        def f(lang, r, texts):
            got = [ngram_counts(t.decode(), how.dim) for t in texts]
            return {"lang": [x.decode() for x in lang], "r": r, "at": [a for a, _ in got], "v": [tfidf(a, c, idf) for a, c in got]}
        return f

    rows = map_rows(drawn, "lang string, r int, at array<int>, v array<double>", features)

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["r", "lang"])
        of = {k: i for i, k in enumerate(langs)}
        data = [(np.asarray(a), np.asarray(v), of[k]) for a, v, k in zip(pdf["at"], pdf["v"], pdf["lang"])]
        hold = (pdf["r"] % how.calibrate == 0).to_numpy()
        w = ftrl([d for d, h in zip(data, hold) if not h], len(langs), how)
        kept = [d for d, h in zip(data, hold) if h]
        t = temperature(np.array([w[:, a] @ v + w[:, -1] for a, v, _ in kept]), np.array([y for *_, y in kept])) if kept else 1.0
        at = [np.flatnonzero(x) for x in w]
        return pd.DataFrame({"lang": langs, "at": at, "w": [x[a] for x, a in zip(w, at)], "temperature": t})

    fitted = rows.withColumn("all", F.col("r") * 0).groupBy("all").applyInPandas(train, "lang string, at array<int>, w array<double>, temperature double").collect()
    weights = np.zeros((how.dim + 1, len(langs)))
    for r in fitted:
        weights[r["at"], langs.index(r["lang"])] = r["w"]
    return {"langs": langs, "weights": weights.astype(np.float32), "idf": idf, "temperature": fitted[0]["temperature"] if fitted else 1.0, "dim": how.dim}


def guessed(docs: DataFrame, model: dict | None, text: str, into: str) -> DataFrame:
    """``docs`` with a struct ``into`` of ``lang`` and ``score``. The model
    runs once a text, also where a filter on the struct follows."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def guess(texts: pa.Array) -> pa.Array:
        m = sent.value
        langs, scores = [], []
        for part in parts(texts):
            for t in part.to_pylist():
                if m is None or not has_letter(t):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at, c = ngram_counts(t, m["dim"])
                p = softmax((tfidf(at, c, m["idf"]) @ m["weights"][at] + m["weights"][-1]) / m["temperature"])
                best = int(np.argmax(p))
                langs.append(m["langs"][best])
                scores.append(float(p[best]))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    # Spark would push a filter on the result below the projection, and so run the model there as well.
    return in_batches(docs).withColumn(into, guess.asNondeterministic()(F.col(f"`{text}`").cast("string")))


def unused(name: str, names: list[str]) -> str:
    while name in names:
        name += "_"
    return name


def predict(docs: DataFrame, model: dict | None, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with columns ``lang`` and ``score`` (calibrated probability)
    of the whole text, under names of choice. A text that is null or has no
    letter is ``und`` with score 0, as is every text without a model. Only the
    text is read; equal texts get equal results, an empty table stays empty.
    Columns of ``docs`` named like a result are replaced, all others pass through."""
    g = unused("guess", [*docs.columns, lang, score])
    return guessed(docs, model, text, g).withColumns({lang: F.col(f"{g}.lang"), score: F.col(f"{g}.score")}).drop(g)


def recognised(docs: DataFrame, least: float, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", how: Fit = Fit()) -> DataFrame:
    """The documents whose language is predicted with a score of ``least`` or
    more; that language becomes their ``lang``. The model learns from the
    documents that aren't held out.

    Documents without a letter (null and empty texts too) go, and so do all
    if there is nothing to learn from; repeated rows are kept or go alike.
    Documents without an id aren't learned from, but judged. All other columns
    stay as they are, whatever their names; an empty table stays empty."""
    model = fit(_labelled(docs, doc_id, text, lang), how)
    g = unused("guess", docs.columns)
    seen = guessed(docs, model, text, g).filter((F.col(f"{g}.lang") != UNKNOWN) & (F.col(f"{g}.score") >= least))
    return seen.select(*[F.col(f"{g}.lang").alias(c) if c == lang else F.col(f"`{c}`") for c in docs.columns])


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """True for every fifth document by crc32 of the id as text; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 0, F.lit(False))


def _labelled(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """``doc_id, text, lang`` of what may be learned from."""
    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
            .filter(F.col("doc_id").isNotNull() & ~held_out()))


def identify(docs: DataFrame, how: Fit = Fit(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Fit on the documents that aren't held out (and have an id and a
    language), predict all: ``doc_id, held_out, lang_pred, score``."""
    model = fit(_labelled(docs, doc_id, text, lang), how)
    base = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return predict(base.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
