"""Language of every word, and of a document, by a linear-chain conditional random field.

States are the languages of the training rows. A word's features are its affixes, character n-grams and
learned lexicons (words seen almost always in one language). Training documents have one language each, so they are
also spliced: pieces of different documents in a row make code-switched sequences, from which the transitions are
learned along with the rest. Text is labelled word by word through forward-backward; a document's language is the one
with the most expected words, its score their share.

The model is fitted in one task from a bounded, seeded sample (``per_language`` documents of each language);
every document is labelled over its whole text on the executors.

Defined cases: null texts and texts without a letter are ``und`` with score 0; with no training rows all are;
rows with null ids are labelled, too; repeated rows give repeated results; an empty table gives no rows; other
columns pass through, and the added ones are named so that none of them is hidden; a very long text is labelled whole.
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

UNKNOWN = "und"
#: Characters of text that the model is fitted on at most.
FIT_CHARS = 2_000_000
#: Words of a spliced piece, and pieces of a spliced sequence.
PIECE, PIECES = (4, 16), 8
#: A word, wherever it stands in a token: a run of letters; longer runs are several.
_LETTERS = re.compile(r"[^\W\d_]{1,40}")


def lexicon(texts: list[str], langs: list[int], most: int = 50_000) -> dict[str, int]:
    """Words in five training texts or more of which nine in ten are of one language."""
    seen: Counter[tuple[str, int]] = Counter()
    for text, y in zip(texts, langs, strict=True):
        seen.update((w, y) for w in {w.lower() for w in _LETTERS.findall(text)})
    total: Counter[str] = Counter()
    for (w, _), n in seen.items():
        total[w] += n
    found = [(-n, w, y) for (w, y), n in seen.items() if n >= 5 and n >= 0.9 * total[w]]
    return {w: y for _, w, y in sorted(found)[:most]}


@dataclass
class Model:
    langs: list[str]
    chain: Chain | None


def fit(docs: DataFrame, per_language: int = 400, most_chars: int = FIT_CHARS, rounds: int = 30) -> Model:
    """docs: text and lang of training rows alone. per_language and most_chars bound what the model is fitted on."""
    known = docs.where("doc_id is not null and text is not null and lang is not null")
    langs = sorted(r[0] for r in known.select("lang").distinct().toLocalIterator())
    ids = known.select("doc_id", F.col("lang").alias("y")).distinct()
    return fitted(known, ids, langs, per_language, most_chars, lambda rows: _fit(rows, langs, rounds))


def spliced(flat: np.ndarray, bounds: np.ndarray, gold: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A piece of each text, shuffled and put together to sequences of several: words, whether a sequence begins, labels."""
    rng = np.random.default_rng(seed)
    words, labels, starts = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0, bool)]
    for k, text in enumerate(rng.permutation(len(gold))):
        size = bounds[text + 1] - bounds[text]
        piece = min(size, int(rng.integers(*PIECE)))
        at = bounds[text] + int(rng.integers(size - piece + 1))
        words.append(flat[at : at + piece])
        labels.append(np.full(piece, gold[text]))
        starts.append((np.arange(piece) == 0) & (k % PIECES == 0))
    found = np.concatenate(words), np.concatenate(starts), np.concatenate(labels)
    if len(found[1]):
        found[1][0] = True
    return found


def _fit(rows: list[tuple[str, int]], langs: list[str], rounds: int) -> Model:
    texts, gold = [r[0] for r in rows], np.array([r[1] for r in rows], int)
    words = Words(_LETTERS)
    flat, bounds = words(texts)
    if not len(flat):
        return Model([], None)
    chain = Chain(len(langs), _LETTERS, lexicon(texts, list(gold)), len(langs))
    starts = np.zeros(len(flat), bool)
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    parts = [(flat, starts, np.repeat(gold, np.diff(bounds))), spliced(flat, bounds, gold)]
    chain.fit(list(words.rows), *(np.concatenate(x) for x in zip(*parts, strict=True)), rounds)
    return Model(langs, chain)


def label(docs: DataFrame, model: Model, words: bool = False) -> DataFrame:
    """Adds lang_pred and score, and with words=True word_langs: the likeliest language of every word."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [fresh(c, docs.columns) for c in ("lang_pred", "score", *["word_langs"] * words)]
    schema = T.StructType([*docs.schema]).add(added[0], T.StringType()).add(added[1], T.DoubleType())
    if words:
        schema = schema.add(added[2], T.ArrayType(T.StringType()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        tagger = Tagger(m.chain) if m.chain else None
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            tags: list[list[str]] = [[] for _ in texts]
            for at, _, bounds, p in tagger(texts) if tagger else ():
                sums = np.diff(np.vstack([np.zeros((1, p.shape[1])), np.cumsum(p, 0)])[bounds], axis=0)
                for k in np.flatnonzero(np.diff(bounds)):
                    best = int(sums[k].argmax())
                    pred[at + k], score[at + k] = m.langs[best], min(1.0, sums[k][best] / sums[k].sum())
                    if words:
                        tags[at + k] = [m.langs[i] for i in p[bounds[k] : bounds[k + 1]].argmax(1)]
            yield batch.assign(**dict(zip(added, [pred, score, *[tags] * words], strict=True)))

    return docs.mapInPandas(run, schema)
