"""Language identification with error-correcting output codes.

Every language has a codeword; one binary classifier per bit, on hashed character n-grams, predicts the codeword of a
text.  Decoding sums each bit's logistic loss against a codeword, weighted by how well the bit was learned, and takes the
codeword with the least; texts whose two best codewords are close are flagged as ambiguous.

The model is fitted on a bounded sample: about ``SAMPLE`` training rows in all, the same number for each language.
Features are computed where the texts lie; the driver gets one half-precision row of ``BUCKETS`` numbers a sampled text.

Defined results: null texts and texts without a letter are ``und`` with score 0; without any labelled row all are; with
one language every text with a letter is that; ill-formed bytes are no letters; texts are whole however long; repeated rows give equal results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import chunks, discard, octets, shown_text, sliced
from loomgraph.llm.samples import is_held_out, sampled

SAMPLE = 4000
LEAST_PER_LANGUAGE = 50
#: More languages than this are taken for a fault in the labels; it bounds the sample (20,000 rows) and the codes.
LANGUAGES = 400
BUCKETS = 4096
CHUNK = 1 << 20
EPOCHS = 15
AMBIGUOUS = 0.2

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def has_letter(text: bytes | None) -> bool:
    """Whether any character is of Unicode's category L; numbers such as fractions and Roman numerals are not."""
    if not text:
        return False
    if text.isascii():
        return any(x != 32 for x in text[:64].translate(_FOLD)) or bool(text.translate(_FOLD).strip())
    return any(c.isalpha() for c in shown_text(text))


def features(texts: list[bytes | None]) -> np.ndarray:
    """Rows of unit length: logarithms of the counts of byte 2-, 3- and 4-grams, hashed.  Texts may have any length."""
    rows = np.zeros((len(texts), BUCKETS), np.float32)
    for a, b in chunks(texts, lambda t: len(t or b"") + 4, CHUNK):
        for i, at, piece in _pieces(texts, a, b):
            data = np.frombuffer(piece, np.uint8).astype(np.uint32)
            codes = []
            pair = data[:-1] | data[1:] << 8
            triple = pair[:-1] | data[2:] << 16
            four = triple[:-1] | data[3:] << 24
            for k, gram in enumerate((pair, triple, four)):
                mixed = (gram ^ np.uint32(0x9E3779B9 * (k + 1) & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                mixed ^= mixed >> 15
                mixed *= np.uint32(0xC2B2AE35)
                codes.append((mixed >> 20, gram & 0xFF, len(gram)))
            owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
            for code, first, n in codes:
                blank = (data[:n] == 32) & (data[1 : n + 1] == 32)
                flat = owner[:n].astype(np.int64) * BUCKETS + code
                flat = flat[~blank]
                rows[i : i + len(at) - 1] += np.bincount(flat, minlength=(len(at) - 1) * BUCKETS).reshape(-1, BUCKETS)
    np.log1p(rows, out=rows)
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def _pieces(texts: list, a: int, b: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Folded texts a to b in one buffer of bounded size; a longer text comes in pieces that overlap by three bytes."""
    if b - a == 1 and len(texts[a] or b"") > CHUNK:
        folded = b" " + texts[a].translate(_FOLD) + b"   "
        for s in range(0, len(folded) - 3, CHUNK):
            part = folded[s : s + CHUNK + 3]
            yield a, np.array([0, len(part)]), part
        return
    parts = [b" " + (t or b"").translate(_FOLD) + b"   " for t in texts[a:b]]
    yield a, np.append(0, np.cumsum([len(p) for p in parts])), b"".join(parts)


def codewords(n: int) -> np.ndarray:
    """Rows of +1 and -1: all splits of up to seven languages, else random splits with the largest least distance of many."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        splits = 2 ** (n - 1) - 1
        return np.array([[1 if r == 0 else -1 if (s >> (r - 1)) & 1 else 1 for s in range(1, splits + 1)] for r in range(n)], float)
    rng = np.random.default_rng(3)
    width, best, top = math.ceil(10 * math.log2(n)) + 15, None, -1
    for _ in range(50):
        code = np.where(rng.random((n, width)) < 0.5, -1.0, 1.0)
        code = code[:, np.abs(code.sum(0)) < n]
        least = int(((code.shape[1] - code @ code.T) / 2 + np.eye(n) * width).min())
        if least > top:
            best, top = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float], list[bool]]:
        lettered = [has_letter(t) for t in texts]
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)
        names, scores, unsure = [], [], []
        for s in range(0, len(texts), 256):
            margins = features(texts[s : s + 256]) @ self.weights + self.bias
            # loss of each codeword: the sum of log(1 + exp(-c m)) over its bits, weighted by trust
            plus, minus = np.logaddexp(0, -margins) * self.trust, np.logaddexp(0, margins) * self.trust
            loss = plus @ (self.codes.T > 0) + minus @ (self.codes.T < 0)
            likely = np.exp(loss.min(1, keepdims=True) - loss)
            likely /= likely.sum(1, keepdims=True)
            order = np.argsort(-likely, axis=1, kind="stable")
            for i in range(len(margins)):
                best = order[i, 0]
                ok = lettered[s + i]
                names.append(self.languages[best] if ok else "und")
                scores.append(float(likely[i, best]) if ok else 0.0)
                unsure.append(bool(ok and len(self.languages) > 1 and likely[i, best] - likely[i, order[i, 1]] < AMBIGUOUS))
        return names, scores, unsure


def learned(rows: np.ndarray, labels: np.ndarray, languages: list[str]) -> Model:
    codes = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, codes, np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32), np.ones(1, np.float32))
    target = codes[labels].astype(np.float32)
    rng = np.random.default_rng(7)
    w, b = np.zeros((BUCKETS, codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for s in range(0, len(order), 256):
            i = order[s : s + 256]
            x, y = rows[i].astype(np.float32), target[i]
            g = -y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30))) / len(i)
            gw = x.T @ g + 1e-5 * w
            step += 1
            m += 0.1 * (gw - m)
            v += 0.01 * (gw * gw - v)
            w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            b -= 0.5 * g.sum(0)
    right = np.zeros(codes.shape[1])
    for s in range(0, len(rows), 512):
        right += ((rows[s : s + 512].astype(np.float32) @ w + b) * target[s : s + 512] > 0).sum(0)
    trust = np.clip(2 * right / len(rows) - 1, 0.05, 1).astype(np.float32)
    return Model(languages, codes, w, b, trust)


def fitted(docs: DataFrame) -> Model:
    """Learns from text and lang of the rows that are not held out."""
    spark = docs.sparkSession
    train = docs.where(~is_held_out(F.col("doc_id"))).select("doc_id", F.col("lang").cast("string").alias("label")).where("label is not null")
    languages = sorted(r.label for r in train.select("label").distinct().limit(LANGUAGES + 1).collect())
    if len(languages) > LANGUAGES:
        raise ValueError(f"lang has over {LANGUAGES} values, such as {', '.join(languages[:5])}")
    if not languages:
        return learned(np.zeros((0, BUCKETS)), np.zeros(0, int), [])
    sample, path = sampled(docs.where(~is_held_out(F.col("doc_id"))), train, max(LEAST_PER_LANGUAGE, SAMPLE // len(languages)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            x = features(octets(b.column("text"))).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.string()), b.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "label", "x"])

    got = sorted(sample.mapInArrow(rows, "doc_id string, label string, x binary").collect())
    discard(spark, path)
    at = {name: i for i, name in enumerate(languages)}
    x = np.stack([np.frombuffer(r.x, np.float16) for r in got]) if got else np.zeros((0, BUCKETS), np.float16)
    return learned(x, np.array([at[r.label] for r in got], int), languages)


def predictions(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous."""
    model = model or fitted(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            names, scores, unsure = shared.value.predict(octets(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")
