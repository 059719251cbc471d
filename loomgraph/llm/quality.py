"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every document of a bounded labelled sample has a sparse random index vector.  A word's vector is the sum of the index
vectors of the documents it occurs in (random indexing), scaled to unit length, plus an index vector of its own; a text
is the mean of its words' vectors, rarer words weighing more.  A two-layer numpy network turns that into a logit, and one
temperature, fitted on a part of the sample that the network has not seen, turns logits into calibrated probabilities.

Words are white-space tokens.  What their letters hide is added as further words: the shape of each token without its
lower-case letters (capitals, digits and marks only), and a word for each token that repeats the one before it.  The
``VOCABULARY`` commonest words that ``LEAST_DOCUMENTS`` documents of the sample have get a vector each; all other words,
also those that the sample lacks, share ``RARE`` vectors by hash.  So every word of every text counts, in training as in
scoring, and the model is a few MB whatever the corpus.  Only the sample is bounded: ``SAMPLE`` documents of each label.

Defined results: null and empty texts are scored as texts without words; without labels of both kinds every score is the
share of label 1 in the sample (0.5 without any); a document labelled more than once counts by the majority, 1 in a tie;
whole texts are read however long; repeated rows give equal results; other columns may have any names.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import chunks, discard, octets, sliced
from loomgraph.llm.samples import is_held_out, sampled

SAMPLE = 2000
VOCABULARY = 20_000
LEAST_DOCUMENTS = 3
RARE = 4096
WIDTH = 128
ONES = 8
HIDDEN = 32
EPOCHS = 40
THRESHOLD = 0.7
CHUNK = 4 << 20

#: Capitals count as A and digits as 0; lower-case letters and non-ASCII bytes go.
_SHAPE = bytes(65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_PLAIN = bytes([*range(97, 123), *range(128, 256)])
_AGAIN = b"\x00again"


def words_of(text: bytes | None) -> Counter:
    """Every word of the text with its count, the added ones too."""
    tokens = (text or b"").split()
    out = Counter(tokens)
    for shape, n in Counter((text or b"").translate(_SHAPE, _PLAIN).split()).items():
        out[b"\x00" + shape] = n
    again = sum(map(operator.eq, tokens, tokens[1:]))
    if again:
        out[_AGAIN] = again
    return out


class Numbers(dict):
    """Words to rows of the vectors, from 0; words of no row of their own share the ``RARE`` rows behind, by hash."""

    def __missing__(self, word: bytes) -> int:
        return len(self) + zlib.crc32(word) % RARE

    def __reduce__(self):
        return Numbers, (dict(self),)


def index_vectors(n: int, seed: int) -> np.ndarray:
    """n sparse random vectors of ``ONES`` entries +1 or -1."""
    rng = np.random.default_rng(seed)
    out = np.zeros((n, WIDTH), np.float32)
    for _ in range(ONES):
        out[np.arange(n), rng.integers(0, WIDTH, n)] += rng.choice([-1.0, 1.0], n)
    return out


@dataclass
class Model:
    vocabulary: Numbers = field(default_factory=Numbers)
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((RARE, WIDTH), np.float32))
    layers: tuple | None = None
    temperature: float = 1.0
    prior: float = 0.5

    def pooled(self, texts: list[bytes | None]) -> np.ndarray:
        """The mean of each text's word vectors, over its tokens."""
        number = self.vocabulary.__getitem__
        out = np.zeros((len(texts), WIDTH), np.float32)
        for a, b in chunks(texts, lambda t: len(t or b""), CHUNK):
            ids, owner, total = [], [], []
            for t in texts[a:b]:
                tokens = (t or b"").split()
                mine = [*map(number, tokens)]
                for shape, n in Counter((t or b"").translate(_SHAPE, _PLAIN).split()).items():
                    mine += [number(b"\x00" + shape)] * n
                if again := sum(map(operator.eq, tokens, tokens[1:])):
                    mine += [number(_AGAIN)] * again
                total.append(max(1, len(tokens)))
                ids.append(np.array(mine, np.int64))
                owner.append(np.full(len(mine), len(total) - 1))
            code = np.concatenate(owner) * len(self.vectors) + np.concatenate(ids)
            code, count = np.unique(code, return_counts=True)
            doc, word = np.divmod(code, len(self.vectors))
            first = np.searchsorted(doc, np.arange(b - a))
            for i in range(b - a):
                last = first[i + 1] if i + 1 < b - a else len(doc)
                if last > first[i]:
                    out[a + i] = count[first[i] : last].astype(np.float32) @ self.vectors[word[first[i] : last]] / total[i]
        return out

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.layers is None:
            return np.full(len(texts), self.prior)
        logit, _ = _forward(self.layers, self.pooled(texts))
        return 1 / (1 + np.exp(-np.clip(logit.astype(float) / self.temperature, -40, 40)))


def _forward(layers: tuple, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean, scale, w1, b1, w2, b2 = layers
    hidden = np.maximum((x - mean) / scale @ w1 + b1, 0)
    return hidden @ w2 + b2, hidden


def network(x: np.ndarray, y: np.ndarray) -> tuple[tuple, float]:
    """The trained layers and the temperature that makes the fifth of the sample kept aside most likely."""
    rng = np.random.default_rng(11)
    order = rng.permutation(len(x))
    aside = order[: max(1, len(x) // 5)]
    train = order[len(aside) :] if len(x) > 5 else order
    mean, scale = x[train].mean(0), x[train].std(0) + 1e-4
    params = [rng.normal(0, (2 / WIDTH) ** 0.5, (WIDTH, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32), rng.normal(0, (2 / HIDDEN) ** 0.5, HIDDEN).astype(np.float32), np.zeros((), np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    z = (x - mean) / scale
    step = 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(train), max(1, len(train) // 64)):
            hidden = np.maximum(z[part] @ params[0] + params[1], 0)
            logit = hidden @ params[2] + params[3]
            d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[part]) / len(part)
            back = d[:, None] * params[2] * (hidden > 0)
            grads = [z[part].T @ back + 1e-3 * params[0], back.sum(0), hidden.T @ d + 1e-3 * params[2], d.sum()]
            step += 1
            for k, (g, (m, v)) in enumerate(zip(grads, moments, strict=True)):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                params[k] = params[k] - 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    layers = (mean, scale, *params)
    logit, _ = _forward(layers, x[aside])
    sign = np.where(y[aside] > 0, 1.0, -1.0)
    choices = np.geomspace(0.25, 8, 60)
    return layers, float(choices[np.argmin([np.logaddexp(0, -sign * logit / t).mean() for t in choices])])


def labels_of(labels: DataFrame) -> DataFrame:
    """doc_id and label (0 or 1) of the rows to learn from: labelled, and not held out."""
    known = labels.where("quality is not null and doc_id is not null").where(~is_held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("label"))


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    sample, path = sampled(docs, labels_of(labels), SAMPLE)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            rows = [words_of(t) for t in octets(b.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([list(r) for r in rows], pa.list_(pa.binary()))], names=["words"])

    frequent = (
        sample.mapInArrow(counted, "words array<binary>")
        .select(F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= LEAST_DOCUMENTS)
        .orderBy(F.desc("n"), "word")
        .limit(VOCABULARY)
        .collect()
    )
    vocabulary = Numbers({bytes(r.word): i for i, r in enumerate(frequent)})
    shared = spark.sparkContext.broadcast(vocabulary)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for b in sliced(batches):
            ids, counts, total = [], [], []
            for t in octets(b.column("text")):
                summed: Counter = Counter()
                for w, n in words_of(t).items():
                    summed[number[w]] += n
                pairs = sorted(summed.items())
                ids.append(np.array([p[0] for p in pairs], np.int32).tobytes())
                counts.append(np.array([p[1] for p in pairs], np.int32).tobytes())
                total.append(max(1, len((t or b"").split())))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.string()), b.column("label").cast(pa.int32()), pa.array(ids, pa.binary()), pa.array(counts, pa.binary()), pa.array(total, pa.int64())], names=["doc_id", "label", "ids", "counts", "total"])

    rows = sorted(sample.mapInArrow(sparse, "doc_id string, label int, ids binary, counts binary, total bigint").collect())
    discard(spark, path)
    y = np.array([r.label for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return Model(prior=float(y.mean()) if len(y) else 0.5)
    contexts, vectors = index_vectors(len(rows), 1), np.zeros((len(vocabulary) + RARE, WIDTH), np.float32)
    documents = np.zeros(len(vectors))
    parsed = [(np.frombuffer(r.ids, np.int32), np.frombuffer(r.counts, np.int32)) for r in rows]
    for i, (ids, counts) in enumerate(parsed):
        vectors[ids] += np.log1p(counts)[:, None].astype(np.float32) * contexts[i]
        documents[ids] += 1
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors / np.where(norm > 0, norm, 1) + index_vectors(len(vectors), 2) / ONES**0.5
    vectors *= np.log1p(len(rows) / np.maximum(1, documents))[:, None]
    model = Model(vocabulary, vectors.astype(np.float32))
    x = np.stack([counts.astype(np.float32) @ model.vectors[ids] / r.total for (ids, counts), r in zip(parsed, rows, strict=True)])
    model.layers, model.temperature = network(x, y)
    return model


def scored(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = model or fitted(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            p = shared.value.scores(octets(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    model = model or fitted(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            yield b.filter(pa.array(shared.value.scores(octets(b.column("text"))) >= THRESHOLD, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
