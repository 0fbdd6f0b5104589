"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text, both bounded samples of the
training rows, are described by features of the whole text: its shape, and how
familiar its four-byte sequences, words and word pairs are, by their counts
(hashed into ``BINS`` bins each) in the trusted positives.  The positives are
in two halves by their text; a sampled text is described by the counts of the
half it is not in, any other by the mean of both.  A first network
tells positives from unlabelled text; the least ratio of unlabelled to
positive rows above a threshold of its output estimates the class prior.  A
second network then minimises the non-negative unbiased risk

    prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])

with the logistic loss.  Rows labelled 0 are never used.  Learning reads at
most ``POSITIVES`` and ``UNLABELLED`` rows; scoring reads every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tierstat.llm.common import ship, text_or_empty, written

POSITIVES = 4000
UNLABELLED = 8000
HIDDEN = 24
STEPS = 400
SHAPE = 16  # features of a text's shape
KINDS = 3  # four-byte sequences, words, word pairs
BITS = 15
BINS = 1 << BITS  # of each kind
FEATURES = SHAPE + KINDS
ship(__name__)

# Classes of bytes: letter (and any byte of a longer character), capital, digit, blank, sentence mark, other sign.
_LETTER, _CAPITAL, _DIGIT, _BLANK, _MARK, _SIGN = range(6)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[128:] = _LETTER
_CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[ord("A") : ord("Z") + 1] = _CAPITAL
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = _BLANK
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = _MARK


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_MIX = np.random.default_rng(17).integers(0, 1 << 32, (64, 256), dtype=np.uint32)  # by place in the word and byte
_FACTOR = np.uint32(0x9E3779B1)  # any odd number


def _bin(h: np.ndarray) -> np.ndarray:
    return (h * _FACTOR) >> np.uint32(32 - BITS)


def _words(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of each word."""
    inside = np.concatenate([[False], kinds != _BLANK, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2] - edges[::2]


def grams(data: np.ndarray, lengths: np.ndarray, kinds: np.ndarray) -> list[np.ndarray]:
    """Bins of the four-byte sequences, words and word pairs of the bytes ``data``, A-Z as a-z."""
    low = _LOWER[data]
    b = low.astype(np.uint32)
    fours = b[3:] << np.uint32(24) | b[2:-1] << np.uint32(16) | b[1:-2] << np.uint32(8) | b[:-3]
    if not len(lengths):
        return [_bin(fours), fours[:0], fours[:0]]
    first = np.cumsum(lengths) - lengths
    letters = low[kinds != _BLANK]
    place = (np.arange(len(letters)) - np.repeat(first, lengths)) & 63
    h = np.add.reduceat(_MIX[place, letters], first, dtype=np.uint32)
    return [_bin(fours), _bin(h), _bin(h[1:] * _FACTOR ^ h[:-1])]


def describe(text: str | None, known: np.ndarray) -> list[float]:
    """The features of one text (null: as empty); ``known`` (kinds, bins) tells how familiar a bin is."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * FEATURES
    octets = np.frombuffer(data, np.uint8)
    kinds = _CLASS[octets]
    share = np.bincount(kinds, minlength=6) / len(data)
    starts, lengths = _words(kinds)
    last = kinds[starts + lengths - 1]
    n, lines = len(words), [x for x in data.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words[1:], words[:-1])) / n
    distinct = len(set(words))
    letters = share[_LETTER] + share[_CAPITAL]
    return [
        np.log1p(n), float(share[_CAPITAL] / max(letters, 1e-9)), float(share[_DIGIT]), float(share[_MARK]), float(share[_SIGN]),
        float((last == _SIGN).mean()), float((last == _MARK).mean()), float(lengths.mean()), float(lengths.std()),
        float((lengths == 1).mean()), distinct / n, float(np.log(distinct + 1) / np.log(n + 1)), same,
        len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), float((kinds[starts] == _CAPITAL).mean()),
        *(float(known[k][g].mean()) if len(g) else 0.0 for k, g in enumerate(grams(octets, lengths, kinds))),
    ]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (half, text) to rows (half, kind, bin, n)."""
    counts = np.zeros((2, KINDS, BINS), np.int64)
    for batch in batches:
        for half, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            kinds = _CLASS[data]
            for k, g in enumerate(grams(data, _words(kinds)[1], kinds)):
                counts[half, k] += np.bincount(g, minlength=BINS)
    half, kind, at = np.nonzero(counts)
    columns = [pa.array(half, pa.int32()), pa.array(kind, pa.int32()), pa.array(at, pa.int32()), pa.array(counts[half, kind, at])]
    yield pa.RecordBatch.from_arrays(columns, names=["half", "kind", "bin", "n"])


def familiarity(counts: np.ndarray) -> np.ndarray:
    """Log of how much likelier each bin (last axis) is than if all were alike, one more counted in each; at most 0 if nothing was."""
    total = counts.sum(axis=-1, keepdims=True)
    return np.log((counts + 1.0) * counts.shape[-1] / (total + counts.shape[-1])).astype(np.float32)


def features(known: np.ndarray):
    """The features of (text, half) as a column: by the counts of the other half."""

    @F.pandas_udf(ArrayType(DoubleType()))
    def described(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, halves in batches:
            yield pd.Series([[float(x) for x in describe(t, known[1 - h])] for t, h in zip(texts, halves, strict=True)], dtype=object)

    return described


@dataclass
class Model:
    """Standardised features, one hidden layer, one output; ``known`` is for ``describe``."""

    mean: np.ndarray
    scale: np.ndarray
    params: list[np.ndarray]
    prior: float
    known: np.ndarray | None = None

    def output(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.params[0] + self.params[1]) @ self.params[2] + self.params[3]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def slopes(gp: np.ndarray, gu: np.ndarray, prior: float | None) -> np.ndarray:
    """What each output (positives, then unlabelled) adds to the step.

    Without ``prior`` the derivative of the plain logistic risk, positive
    against unlabelled; with it that of the non-negative risk, and where its
    negative part has fallen below zero that of the part itself, reversed.
    """
    up, down_p, down_u = -_sigmoid(-gp) / len(gp), _sigmoid(gp) / len(gp), _sigmoid(gu) / len(gu)
    if prior is None:
        return np.concatenate([up, down_u])
    negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    if negative >= 0:
        return np.concatenate([prior * (up - down_p), down_u])
    return np.concatenate([prior * down_p, -down_u])


def _fit(zp: np.ndarray, zu: np.ndarray, prior: float | None, seed: int) -> list[np.ndarray]:
    """Parameters: plain positive against unlabelled without ``prior``, the non-negative risk with it."""
    rng = np.random.default_rng(seed)
    d = zp.shape[1]
    p = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for t in range(1, STEPS + 1):
        xp = zp[rng.integers(0, len(zp), min(512, len(zp)))]
        xu = zu[rng.integers(0, len(zu), min(1024, len(zu)))]
        x = np.concatenate([xp, xu])
        a = np.tanh(x @ p[0] + p[1])
        g = a @ p[2] + p[3]
        d_out = slopes(g[: len(xp)], g[len(xp) :], prior)
        da = d_out[:, None] * p[2][None, :] * (1 - a * a)
        for i, grad in enumerate((x.T @ da + 1e-4 * p[0], da.sum(axis=0), a.T @ d_out + 1e-4 * p[2], d_out.sum(keepdims=True))):
            m[i], v[i] = 0.9 * m[i] + 0.1 * grad, 0.99 * v[i] + 0.01 * grad * grad
            p[i] = p[i] - 0.02 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)
    return p


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from outputs of a positive-against-unlabelled model.

    Above any threshold the unlabelled hold at least prior * (share of the
    positives above it), so every ratio of the two shares bounds the prior from
    above.  The least ratio, each raised by two standard errors so that few rows do
    not pull it down, over thresholds that keep at least half of the positives.
    """
    positive, unlabelled = np.sort(positive), np.sort(unlabelled)
    at = np.quantile(positive, np.linspace(0.0, 0.5, 51))
    p = np.maximum(1 - np.searchsorted(positive, at, "left") / len(positive), 1e-9)
    u = np.maximum(1 - np.searchsorted(unlabelled, at, "left") / len(unlabelled), 1e-9)
    error = np.sqrt((1 - p) / p / len(positive) + (1 - u) / u / len(unlabelled))
    return float(np.clip((u / p * (1 + 2 * error)).min(), 0.05, 0.95))


def fit(positive: np.ndarray, unlabelled: np.ndarray, hp: np.ndarray, hu: np.ndarray) -> Model:
    """A model from the features of trusted positives and of unlabelled rows (either may be empty), and the half of each."""
    if not len(positive) or not len(unlabelled):
        base = [np.zeros((FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)]
        return Model(np.zeros(FEATURES), np.ones(FEATURES), base, 0.5)
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-6)
    zp, zu = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    # Each half is judged by a network that learned from the other.
    judged: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    for h in (0, 1):
        if (hp != h).any() and (hu != h).any():
            other = Model(mean, scale, _fit(zp[hp != h], zu[hu != h], None, 3), 0.5)
            judged[0].append(other.output(positive[hp == h]))
            judged[1].append(other.output(unlabelled[hu == h]))
    scores_p, scores_u = (np.concatenate(x) if x else np.zeros(0) for x in judged)
    prior = estimate_prior(scores_p, scores_u) if len(scores_p) and len(scores_u) else 0.5
    return Model(mean, scale, _fit(zp, zu, prior, 5), prior)


def fold(doc_id: str | Column) -> Column:
    """crc32 of the id as text, modulo 3 (null id: 0); 1 is held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 3


def train(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on the training rows (``fold`` not 1): positives marked 1 in ``labels``, unlabelled from all documents.

    The samples are the first ids by a hash of the id, so reruns agree.
    """
    ids = documents.select(F.col(doc_id).alias("id")).where(F.col("id").isNotNull() & (fold("id") != 1)).distinct()
    trusted = labels.where(F.col(label) == 1).select(F.col(doc_id).alias("id")).distinct()
    by_hash = [F.xxhash64("id"), "id"]
    sample = (
        ids.join(trusted, "id").orderBy(*by_hash).limit(POSITIVES).withColumn("role", F.lit("p"))
        .unionByName(ids.orderBy(*by_hash).limit(UNLABELLED).withColumn("role", F.lit("u")))
    )
    wanted = F.broadcast(sample)  # POSITIVES + UNLABELLED rows at most
    texts = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(wanted, "id")
    # Repeated ids: the smallest text speaks for the id, so the sample stays bounded.
    texts = texts.groupBy("id", "role").agg(F.min(text_or_empty("text")).alias("text"))
    # The half goes by the text, so that equal texts are in one half in both samples.
    texts = written(texts.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")), "sample")
    bins = texts.where("role = 'p'").select("half", "text").mapInArrow(_counted, "half int, kind int, bin int, n long")
    found = bins.groupBy("half", "kind", "bin").agg(F.sum("n").alias("n")).toPandas()  # 2 * KINDS * BINS rows at most
    counts = np.zeros((2, KINDS, BINS))
    counts[found["half"], found["kind"], found["bin"]] = found["n"]
    known = familiarity(counts)
    rows = texts.select("id", "role", "half", features(known)("text", "half").alias("x")).orderBy("role", "id").collect()
    x = {r: np.array([row["x"] for row in rows if row["role"] == r]).reshape(-1, FEATURES) for r in "pu"}
    halves = {r: np.array([row["half"] for row in rows if row["role"] == r], np.int64) for r in "pu"}
    return replace(fit(x["p"], x["u"], halves["p"], halves["u"]), known=known.mean(axis=0))


def score(model: Model):
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if len(texts):
                yield pd.Series(_sigmoid(model.output(np.array([describe(t, model.known) for t in texts]))))
            else:
                yield pd.Series([], dtype="float64")

    return scored


def scored_documents(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per row of ``documents``.

    Null and empty texts get the score of a text whose features are all 0.
    Without any positive (or any document) the score is 0.5 for all.
    """
    model = train(documents, labels, doc_id, text)
    out = documents.select(
        F.col(doc_id).alias("doc_id"), (fold(doc_id) == 1).alias("held_out"), score(model)(F.col(text)).alias("score")
    )
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_quality(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``documents``, all columns, without the rows whose score is below ``threshold``."""
    model = train(documents, labels, doc_id, text)
    return documents.where(score(model)(F.col(text)) >= threshold)
