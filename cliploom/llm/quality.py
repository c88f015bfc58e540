"""Supervised subword embeddings for document quality.

Every token has a vector for itself and for each of its character n-grams, found by hashing. A document is the
average of all these vectors, a softmax layer gives its label; vectors and layer are trained together by
stochastic gradient descent in numpy.

The model is fitted in one task from a bounded, seeded sample of training documents (``per_class`` of each
label) and weighted back to the labels' real shares; every document is scored over its whole text on the
executors. Averages are linear, so a worker keeps one logit per token. All n-grams of a token count, however long it is.

Defined cases: null and empty texts have no vectors and get the layer's bias; rows with null ids are scored,
too; repeated rows give repeated results; an empty table gives no rows; without training rows of both labels
every score is the share of label 1 (0 without labels); other columns pass through, and the added one is named
``score_`` where there is a ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fitted, fresh
from .subwords import Subwords

BUCKET_BITS = 17
SIZES = (3, 4)
#: Tokens, and their characters, that one worker keeps scored; beyond that it starts afresh.
CACHE_TOKENS, CACHE_CHARS = 150_000, 4_000_000
#: Characters of text that are scored together.
CHUNK_CHARS = 500_000
#: Characters of text that the model is fitted on at most.
FIT_CHARS = 8_000_000

SUBWORDS = Subwords(SIZES, BUCKET_BITS)


def buckets(tokens: Sequence[str]) -> list[np.ndarray]:
    """Of each token, the numbers of its vectors: its own and those of its n-grams."""
    if not len(tokens):
        return []
    starts, n, found, whole = SUBWORDS(tokens)
    by_character = np.stack(found)
    out = []
    for lo, size, own in zip(starts, n, whole, strict=True):
        x = by_character[:, lo : lo + size].ravel()
        out.append(np.append(x[x > 0], own))
    return out


@dataclass
class Model:
    logits: np.ndarray  # by bucket, one column: its vector times the softmax layer's difference of the labels
    bias: float
    prior: float
    fitted: bool


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1200, most_chars: int = FIT_CHARS, size: int = 16, epochs: int = 12, rate: float = 0.3, seed: int = 7) -> Model:
    """labels: doc_id and the label, training rows alone. per_class and most_chars bound what the model is fitted on."""
    counts = {r[0]: r[1] for r in labels.groupBy(label).count().toLocalIterator()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    ids = labels.select("doc_id", F.col(label).alias("y"))
    return fitted(docs, ids, [0, 1], per_class, most_chars, lambda rows: _fit(rows, prior, size, epochs, rate, seed))


def _fit(rows: list[tuple[str, int]], prior: float, size: int, epochs: int, rate: float, seed: int) -> Model:
    if len({y for _, y in rows}) < 2:
        return Model(np.zeros((SUBWORDS.rows, 1), np.float32), 0.0, prior, False)
    rng = np.random.default_rng(seed)
    tokens = list(dict.fromkeys(chain.from_iterable(t.split() for t, _ in rows)))
    known = dict(zip(tokens, buckets(tokens), strict=True))
    data = []
    for text, y in rows:
        idx = [known[t] for t in text.split()]
        if idx:
            at, n = np.unique(np.concatenate(idx), return_counts=True)
            data.append((at, (n / n.sum())[:, None], y))
    vectors = rng.uniform(-1 / size, 1 / size, (SUBWORDS.rows, size))
    layer, bias = np.zeros((size, 2)), np.zeros(2)
    # adaptive steps: a bucket's share of a long document is tiny
    seen_v, seen_l = np.full((SUBWORDS.rows, 1), 1e-8), np.full((size, 2), 1e-2)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for k in rng.permutation(len(data)):
            at, share, y = data[k]
            h = (vectors[at] * share).sum(0)
            z = h @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            g = (layer @ p)[None, :] * share
            seen_v[at] += (g * g).mean(1, keepdims=True)
            outer = h[:, None] * p
            seen_l += outer * outer
            layer -= step * outer / np.sqrt(seen_l) + 1e-5 * layer
            bias -= 0.02 * step * p
            vectors[at] -= step * g / np.sqrt(seen_v[at])
    sampled_odds = np.log(sum(y for *_, y in data) / max(1, sum(1 - y for *_, y in data)))
    shift = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)) - sampled_odds
    logits = vectors @ (layer[:, 1:] - layer[:, :1])
    logits[0] = 0
    return Model(logits.astype(np.float32), float(bias[1] - bias[0] + shift), prior, True)


class _Tokens(dict):
    """Tokens and their numbers in the order of first use; total and n: by number, logits in all and how many vectors."""

    def __init__(self) -> None:
        self.chars, self.total, self.n = 0, np.zeros(0), np.zeros(0)

    def __missing__(self, token: str) -> int:
        self[token] = out = len(self)
        self.chars += len(token)
        return out

    def sums(self, texts: Sequence[str], logits: np.ndarray) -> np.ndarray:
        """Means over all vectors of each text; 0 for texts without a token."""
        tokens = [t.split() for t in texts]
        count = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.fromiter(map(self.__getitem__, chain.from_iterable(tokens)), np.int64, int(count.sum()))
        new = list(islice(self, len(self.total), None))
        if new:
            size = np.fromiter(map(len, new), np.int64, len(new)) + 2
            self.total = np.concatenate([self.total, SUBWORDS.sums(new, logits)[:, 0]])
            self.n = np.concatenate([self.n, 1 + sum(np.maximum(size - k + 1, 0) for k in SIZES)])
        owner = np.repeat(np.arange(len(tokens)), count)
        total, n = (np.bincount(owner, x[flat], len(tokens)) for x in (self.total, self.n))
        return total / np.maximum(n, 1)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds a column to every row: the softmax of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = fresh("score", docs.columns)
    schema = T.StructType([*docs.schema]).add(added, T.DoubleType())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        tokens = _Tokens()
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            z = np.full(len(texts), m.bias)
            at = 0
            while at < len(texts) and m.fitted:
                if len(tokens) > CACHE_TOKENS or tokens.chars > CACHE_CHARS:
                    tokens = _Tokens()
                upto, chars = at, 0
                while upto < len(texts) and (upto == at or chars + len(texts[upto]) <= CHUNK_CHARS):
                    chars += len(texts[upto])
                    upto += 1
                z[at:upto] += tokens.sums(texts[at:upto], m.logits)
                at = upto
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield batch.assign(**{added: p if m.fitted else np.full(len(texts), m.prior)})

    return docs.mapInPandas(run, schema)
