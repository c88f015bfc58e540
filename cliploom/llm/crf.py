"""A linear-chain conditional random field over words, in numpy.

Emissions are sums of the weights of a word's features (its hashed n-grams, affixes among them, itself, and a lexicon
entry), transitions are learned. Forward-backward runs over the concatenated words of many documents at once: the chain
is cut into equal blocks, every block's transfer matrix is found for all blocks together, blocks are linked one after the
other, and a second sweep fills in the messages. That is exact, and costs the same for one long text as for many short ones.

A position of a chain is a run of what the pattern matches, anywhere in a text; the pattern bounds a run's length, so longer
runs become several positions and every character of a text counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from itertools import chain, islice

import numpy as np

from .subwords import Subwords

#: Words that one worker keeps scored; beyond that it starts afresh.
CACHE_WORDS = 80_000
#: Longest token that is kept.
CACHE_LENGTH = 64
#: Characters of text that are scored together.
CHUNK_CHARS = 500_000

#: Steps between two rescalings of messages.
RESCALE = 8
#: Words that fitting looks at together.
FIT_TOKENS = 100_000
#: Sizes of n-grams, and bits of the table of weights.
SIZES, BITS = (1, 2, 3, 4, 5), 18


class Words(dict):
    """Words of tokens between white space: a token's number is that of its word, -1 if it has none, and below that
    stands for its words in ``several``. rows: words, lower-cased, and their numbers in the order of first use."""

    def __init__(self, pattern: re.Pattern[str]):
        self.find, self.rows, self.several, self.held = pattern.findall, {}, [], 0

    def __missing__(self, token: str) -> int:
        found = [self.rows.setdefault(w.lower(), len(self.rows)) for w in self.find(token)]
        if len(found) == 1:
            out = found[0]
        elif not found:
            out = -1
        else:
            self.several.append(found)
            self.held += len(found)
            out = -1 - len(self.several)
        if len(token) <= CACHE_LENGTH:
            self[token] = out
        return out

    def full(self) -> bool:
        return len(self) > CACHE_WORDS or len(self.rows) > CACHE_WORDS or self.held > CACHE_WORDS

    def __call__(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of the texts, and the texts' bounds."""
        tokens = [t.split() for t in texts]
        bounds = np.cumsum([0, *map(len, tokens)])
        found = np.fromiter(map(self.__getitem__, chain.from_iterable(tokens)), np.int64, int(bounds[-1]))
        odd = np.flatnonzero(found < 0)
        if not len(odd):
            return found, bounds
        count = np.ones(len(found), np.int64)
        count[odd] = [0 if c == -1 else len(self.several[-2 - c]) for c in found[odd]]
        upto = np.concatenate([[0], np.cumsum(count)])
        flat = np.repeat(found, count)
        for k in odd[count[odd] > 0]:
            flat[upto[k] : upto[k + 1]] = self.several[-2 - found[k]]
        return flat, upto[bounds]


def _blocks(n: int) -> tuple[int, int]:
    width = max(1, int(np.sqrt(n)))
    return width, -(-n // width)


def messages(emit: np.ndarray, starts: np.ndarray, init: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages, scaled to sum to 1. emit: positive potentials, one row a word;
    starts: whether a sequence begins at the word; init, trans: positive potentials."""
    n, s = emit.shape
    width, nb = _blocks(n)
    pad = width * nb - n
    e = np.vstack([emit, np.ones((pad, s))]).reshape(nb, width, s)
    st = np.concatenate([starts, np.ones(pad, bool)]).reshape(nb, width)
    st[0, 0] = True

    def sweep(step, entry):
        """Transfer matrices of all blocks, their chaining, then the messages inside the blocks."""
        m = np.tile(np.eye(s), (nb, 1, 1))
        for k, j in enumerate(step.order):
            m = step(m, j)
            if k % RESCALE == 0:
                m /= m.max((1, 2))[:, None, None]
        m /= m.max((1, 2))[:, None, None]
        v = np.empty((nb, 1, s))
        at = entry
        for b in step.chain:
            v[b, 0] = at
            at = at @ m[b]
            at = at / at.sum()
        out = np.empty((nb, width, s))
        for k, j in enumerate(step.order):
            v = step(v, j)
            if k % RESCALE == 0:
                v /= v.sum(2)[:, :, None]
            out[:, j] = v[:, 0]
        out /= out.sum(2)[:, :, None]
        return out.reshape(-1, s)[:n]

    def times(m, matrix):
        return (m.reshape(-1, s) @ matrix).reshape(m.shape)

    resets = [np.flatnonzero(st[:, j]) for j in range(width)]

    class Forward:
        order, chain = range(width), range(nb)

        def __call__(self, m, j):
            x = times(m, trans) * e[:, j][:, None, :]
            if len(r := resets[j]):
                x[r] = (init * e[r, j])[:, None, :]
            return x

    # what the word after each one contributes backwards; a start behind it cuts the chain
    nxt = np.concatenate([e.reshape(-1, s)[1:], np.ones((1, s))]).reshape(nb, width, s)
    cut = np.concatenate([st.reshape(-1)[1:], [True]]).reshape(nb, width)
    back = trans.T.copy()
    cuts = [np.flatnonzero(cut[:, j]) for j in range(width)]

    class Backward:
        order, chain = range(width - 1, -1, -1), range(nb - 1, -1, -1)

        def __call__(self, m, j):
            x = times(m * nxt[:, j][:, None, :], back)
            if len(c := cuts[j]):
                x[c] = 1.0
            return x

    uniform = np.full(s, 1.0 / s)
    return sweep(Forward(), uniform), sweep(Backward(), uniform)


class Chain:
    """The model: weights by feature and state, transition weights and start weights. pattern: what a word is; lexicon:
    entries of words, 0 up to kinds, as one more feature."""

    def __init__(self, states: int, pattern: re.Pattern[str], lexicon: dict[str, int] | None = None, kinds: int = 0, sizes: Sequence[int] = SIZES):
        self.pattern, self.lexicon, self.kinds, self.subwords = pattern, lexicon or {}, kinds, Subwords(sizes, BITS)
        self.weights = np.zeros((self.subwords.rows + kinds, states), np.float32)
        self.trans, self.init = np.zeros((states, states)), np.zeros(states)

    def _entries(self, words: Sequence[str]) -> np.ndarray:
        """Rows of the words' lexicon entries, 0 for those without."""
        return np.array([self.subwords.rows + k if (k := self.lexicon.get(w, -1)) >= 0 else 0 for w in words], np.int64)

    def scores(self, words: Sequence[str]) -> np.ndarray:
        """Emission scores of words."""
        return self.subwords.sums(words, self.weights) + self.weights[self._entries(words)]

    def fit(self, words: list[str], ids: np.ndarray, starts: np.ndarray, gold: np.ndarray, rounds: int = 40, rate: float = 0.15, ridge: float = 1.0) -> None:
        """Adam on the conditional log-likelihood with a ridge. ids: index into words of each token; gold: its state."""
        s = self.weights.shape[1]
        first, length, found, whole = self.subwords(words)
        owner = np.repeat(np.arange(len(words), dtype=np.int32), length)
        by_word = [whole, self._entries(words)]
        # only rows in use are trained
        used = np.unique(np.concatenate([*found, *by_word]))
        used = used[used > 0]
        number = np.zeros(len(self.weights), np.int32)
        number[used] = np.arange(1, len(used) + 1)
        found, by_word = [number[x] for x in found], [number[x] for x in by_word]
        firsts = np.flatnonzero(starts)
        cuts = [0, *(int(firsts[k]) for k in np.unique(np.searchsorted(firsts, np.arange(FIT_TOKENS, len(ids), FIT_TOKENS))) if k < len(firsts)), len(ids)]
        params = [np.zeros((len(used) + 1, s)), self.trans, self.init]
        mean, square = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
        for t in range(1, rounds + 1):
            by_character = params[0][found[0]]
            for x in found[1:]:
                by_character += params[0][x]
            score = np.add.reduceat(by_character, first, axis=0)
            for x in by_word:
                score += params[0][x]
            trans, init = np.exp(self.trans), np.exp(self.init)
            missed, grad_t, grad_i = np.zeros_like(score), np.zeros_like(trans), np.zeros_like(init)
            for lo, hi in zip(cuts, cuts[1:]):  # whole sequences, so many words at a time
                i, y, st = ids[lo:hi], gold[lo:hi], starts[lo:hi]
                inner, begin = np.flatnonzero(~st), np.flatnonzero(st)
                emit = score[i]
                emit = np.exp(emit - emit.max(1, keepdims=True))
                a, b = messages(emit, st, init, trans)
                p = a * b
                p /= p.sum(1, keepdims=True)
                pair = a[inner - 1][:, :, None] * trans * (emit[inner] * b[inner])[:, None, :]
                pair /= pair.sum((1, 2))[:, None, None]
                np.add.at(grad_t, (y[inner - 1], y[inner]), 1)
                grad_t -= pair.sum(0)
                grad_i += np.bincount(y[begin], minlength=s) - p[begin].sum(0)
                miss = -p
                miss[np.arange(len(i)), y] += 1
                for k in range(s):
                    missed[:, k] += np.bincount(i, miss[:, k], len(words))
            grad = np.zeros_like(params[0])
            for k in range(s):
                spread = missed[owner, k]
                for x in found:
                    grad[:, k] += np.bincount(x, spread, len(grad))
                for x in by_word:
                    grad[:, k] += np.bincount(x, missed[:, k], len(grad))
            grad[0] = 0
            for x, g, m, v in zip(params, [grad, grad_t, grad_i], mean, square, strict=True):
                g -= ridge * x
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        self.weights[used] = params[0][1:]

    def marginals(self, emit: np.ndarray, starts: np.ndarray) -> np.ndarray:
        emit = np.exp(emit - emit.max(1, keepdims=True))
        a, b = messages(emit, starts, np.exp(self.init), np.exp(self.trans))
        p = a * b
        return p / p.sum(1, keepdims=True)


class Tagger:
    """Marginals of the words of texts, in chunks; words are scored once and then kept."""

    def __init__(self, model: Chain):
        self.chain = model
        self._forget()

    def _forget(self) -> None:
        self.words, self.table = Words(self.chain.pattern), np.zeros((0, self.chain.weights.shape[1]))

    def __call__(self, texts: list[str]) -> Iterable[tuple[int, int, np.ndarray, np.ndarray]]:
        """Yields chunks: index of the first text and of the one behind the last, the texts' bounds, and a row of
        marginals for every word."""
        at = 0
        while at < len(texts):
            if self.words.full():
                self._forget()
            upto, chars = at, 0
            while upto < len(texts) and (upto == at or chars + len(texts[upto]) <= CHUNK_CHARS):
                chars += len(texts[upto])
                upto += 1
            flat, bounds = self.words(texts[at:upto])
            known = len(self.table)
            if len(self.words.rows) > known:
                self.table = np.vstack([self.table, self.chain.scores(list(islice(self.words.rows, known, None)))])
            starts = np.zeros(len(flat), bool)
            starts[bounds[:-1][np.diff(bounds) > 0]] = True
            p = self.chain.marginals(self.table[flat], starts) if len(flat) else np.zeros((0, self.table.shape[1]))
            yield at, upto, bounds, p
            at = upto
