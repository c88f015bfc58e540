"""Toxic spans by a linear-chain conditional random field, document scores from its marginals.

Labels exist for documents only. Tokens are labelled from them: a word or word beginning counts as toxic
where it stands in many different contexts of toxic training documents and hardly in clean ones. The field
then learns from the labelled tokens; forward-backward marginals give spans with their offsets and, summed
up, a logistic score of the whole document.

The model is fitted in one task from a bounded, seeded sample of training documents (``per_class`` of each
label); every document is scored over its whole text on the executors.

Defined cases: null and empty texts score like a text without toxic words and have no spans; rows with null
ids are scored, too; repeated rows give repeated results; an empty table gives no rows; without training rows
of both labels every score is the share of toxic labels (0 without labels); other columns pass through, and the added
ones are named so that none of them is hidden (``score_`` where there is a ``score``); a very long text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fitted, fresh
from .crf import Chain, Tagger, Words

#: A word, wherever it stands in a token; longer runs are several.
_WORD = re.compile(r"\w{1,40}")
#: Sizes of a word's n-grams.
NGRAMS = (2, 3, 4, 5, 6)
#: Characters of text that the model is fitted on at most.
FIT_CHARS = 3_500_000
SPANS = "array<struct<start:int,end:int,p:double>>"


def lexicon(texts: list[str], toxic: list[int]) -> set[str]:
    """Words and beginnings of 4 to 6 letters that mark toxic texts: by distinct contexts, z of 4 at least."""
    counts: list[Counter[str]] = [Counter(), Counter()]
    known: list[set[int]] = [set(), set()]
    for text, y in zip(texts, toxic, strict=True):
        words = ["", *(w.lower() for w in _WORD.findall(text)), ""]
        for a, w, b in zip(words, words[1:], words[2:]):
            if len(w) > 2 and (c := hash((a, w, b))) not in known[y]:
                known[y].add(c)
                counts[y].update({f"w={w}", *(f"p={w[:k]}" for k in (4, 5, 6) if len(w) >= k)})
    n = [max(1, len(x)) for x in known]
    base = n[1] / (n[0] + n[1])
    out = set()
    for x, pos in counts[1].items():
        neg = counts[0][x]
        adjusted = (pos / n[1]) / (pos / n[1] + neg / n[0])
        if adjusted >= 0.9 and (pos / (pos + neg) - base) / np.sqrt(base * (1 - base) / (pos + neg)) >= 4:
            out.add(x)
    return out


def _marked(word: str, marks: set[str]) -> bool:
    return f"w={word}" in marks or any(f"p={word[:k]}" in marks for k in (4, 5, 6) if len(word) >= k)


@dataclass
class Model:
    chain: Chain
    weights: np.ndarray  # of what _evidence() gives
    prior: float
    fitted: bool

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(evidence), self.prior)
        return 1 / (1 + np.exp(-np.clip(evidence @ self.weights, -30, 30)))


def _evidence(bounds: np.ndarray, p: np.ndarray) -> np.ndarray:
    """By text: 1, log of expected toxic words, log of their share, highest marginal."""
    total = np.diff(np.concatenate([[0.0], np.cumsum(p[:, 1])])[bounds])
    n = np.diff(bounds)
    top = np.zeros(len(n))
    full = np.flatnonzero(n)
    if len(full):
        top[full] = np.maximum.reduceat(p[:, 1], bounds[:-1][full])
    total = np.maximum(total, 0)
    return np.stack([np.ones(len(n)), np.log1p(total), np.log1p(1000 * total / np.maximum(n, 1)), top], 1)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1200, most_chars: int = FIT_CHARS, rounds: int = 40) -> Model:
    """labels: doc_id and toxic, training rows alone. per_class and most_chars bound what the model is fitted on."""
    return fitted(docs, labels.select("doc_id", F.col("toxic").alias("y")), [0, 1], per_class, most_chars, lambda rows: _fit(rows, rounds))


def _fit(rows: list[tuple[str, int]], rounds: int) -> Model:
    texts, toxic = [r[0] for r in rows], np.array([r[1] for r in rows], int)
    chain = Chain(2, _WORD, sizes=NGRAMS)
    prior = float(np.mean(toxic)) if len(toxic) else 0.0
    if len(set(toxic)) < 2:
        return Model(chain, np.zeros(4), prior, False)
    marks = lexicon(texts, list(toxic))
    words = Words(_WORD)
    flat, bounds = words(texts)
    marked = np.array([_marked(w, marks) for w in words.rows])
    gold = (marked[flat] & (np.repeat(toxic, np.diff(bounds)) == 1)).astype(int)
    if not gold.any():
        return Model(chain, np.zeros(4), prior, False)
    starts = np.zeros(len(flat), bool)
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    chain.fit(list(words.rows), flat, starts, gold, rounds)
    found = np.vstack([_evidence(bounds, p) for _, _, bounds, p in Tagger(chain)(texts)])
    return Model(chain, _logistic(found, toxic.astype(float)), prior, True)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Newton's method for logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def _spans(text: str, p: np.ndarray, least: float = 0.5) -> list[dict]:
    """Runs of words whose marginal reaches least, as code point offsets."""
    hot = np.flatnonzero(p >= least)
    if not len(hot):
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    parts = np.split(hot, np.flatnonzero(np.diff(hot) != 1) + 1)
    return [{"start": at[x[0]][0], "end": at[x[-1]][1], "p": float(p[x].max())} for x in parts]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds two columns to every row: the score and the toxic spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = fresh("score", docs.columns), fresh("toxic_spans", docs.columns)
    schema = T.StructType([*docs.schema]).add(added[0], T.DoubleType()).add(added[1], T._parse_datatype_string(SPANS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        tagger = Tagger(m.chain)
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            scores, spans = np.zeros(len(texts)), [[] for _ in texts]
            for at, upto, bounds, p in tagger(texts):
                scores[at:upto] = m.score(_evidence(bounds, p))
                for k in range(at, upto) if m.fitted else ():
                    spans[k] = _spans(texts[k], p[bounds[k - at] : bounds[k - at + 1], 1])
            yield batch.assign(**{added[0]: scores, added[1]: spans})

    return docs.mapInPandas(run, schema)
