"""Interpolated Kneser-Ney character models, one per class, kept in sorted hash arrays.

All classes share one sorted array of n-gram hashes and one of context hashes per order; beside each hash lies one row
of values, a column per class: the discounted probability of the n-gram, or the weight that its context leaves to the
next lower order. A probability is then two binary searches per order for all classes at once. Sequences are words with
a mark before and after; contexts do not cross words, so the model scores each distinct word of a batch once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np

#: Longest n-gram, in characters.
ORDER = 5
#: Size of the character set that the lowest order falls back to.
ALPHABET = 400
_P = np.uint64(0x9E3779B97F4A7C15)
_START, _STOP = 2, 3


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all words with their marks as one array, and where each word begins (with the end appended)."""
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    text = "".join(f"\x02{w}\x03" for w in words)
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64), np.concatenate([[0], np.cumsum(lengths)])


def _hashes(codes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """For each position the hash of the k characters that end there; where the word has fewer before, of those.

    A shorter n-gram at a word's start gets the hash that it has at its own length, since the mark before the word
    makes it a whole context.
    """
    at = np.arange(len(codes)) - np.repeat(starts[:-1], np.diff(starts))
    h = np.zeros(len(codes), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k - 1, -1, -1):
            c = np.zeros(len(codes), dtype=np.uint64)
            c[j:] = codes[: len(codes) - j]
            inside = at >= j
            h = np.where(inside, (h ^ c) * _P + (h >> np.uint64(29)) + c, h)
    return h


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return i, keys[i] == wanted


@dataclass
class CharModels:
    """Models of several classes. ``grams[k]`` and ``contexts[k]`` hold (sorted hashes, values per class) of order k+1."""

    classes: list[str]
    order: int = ORDER
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    @classmethod
    def train(cls, words: dict[str, Counter], order: int = ORDER) -> "CharModels":
        """Models of the classes' word counts. A class without words gets the uniform model."""
        model = cls(sorted(words), order)
        n = len(model.classes)
        per_class = [cls._counts(words[c], order) for c in model.classes]
        for k in range(order):
            grams = [pc[k] for pc in per_class]
            keys = np.unique(np.concatenate([g["gram"] for g in grams])) if n else np.zeros(0, np.uint64)
            ctx_keys = np.unique(np.concatenate([g["context"] for g in grams])) if n else np.zeros(0, np.uint64)
            values, left = np.zeros((len(keys), n), np.float32), np.ones((len(ctx_keys), n), np.float32)
            for j, g in enumerate(grams):
                if not len(g["gram"]):
                    continue
                once, twice = (g["count"] == 1).sum(), (g["count"] == 2).sum()
                d = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
                contexts, which = np.unique(g["context"], return_inverse=True)
                total, kinds = np.bincount(which, g["count"]), np.bincount(which)
                values[np.searchsorted(keys, g["gram"]), j] = np.maximum(g["count"] - d, 0) / total[which]
                left[np.searchsorted(ctx_keys, contexts), j] = np.minimum(1, d * kinds / total)
            model.grams.append((keys, values))
            model.contexts.append((ctx_keys, left))
        return model

    @staticmethod
    def _counts(words: Counter, order: int) -> list[dict[str, np.ndarray]]:
        """For each order its n-grams, contexts and counts: occurrences in the highest order, distinct left neighbours below."""
        empty = {"gram": np.zeros(0, np.uint64), "context": np.zeros(0, np.uint64), "count": np.zeros(0)}
        if not words:
            return [dict(empty) for _ in range(order)]
        kinds = list(words)
        codes, starts = _codes(kinds)
        weight = np.repeat(np.array([words[w] for w in kinds], dtype=np.float64), np.diff(starts))
        at = np.arange(len(codes)) - np.repeat(starts[:-1], np.diff(starts))
        hashes = [_hashes(codes, starts, k) for k in range(order + 1)]
        shifted = [np.concatenate([[np.uint64(0)], h[:-1]]) for h in hashes]
        out = []
        for k in range(1, order + 1):
            # N-grams that begin at the word's mark cannot be extended to the left: they keep their occurrences.
            predicted = at > 0
            whole = predicted & (at + 1 >= k)
            gram, context = hashes[k][whole], shifted[k - 1][whole]
            if k == order:
                keys, first, inverse = np.unique(gram, return_index=True, return_inverse=True)
                count = np.bincount(inverse, weight[whole])
            else:
                longer = hashes[k + 1][whole]
                at_start = at[whole] + 1 <= k
                pairs = np.unique(np.stack([gram, np.where(at_start, np.uint64(0), longer)]), axis=1)
                keys, first, inverse = np.unique(gram, return_index=True, return_inverse=True)
                count = np.zeros(len(keys))
                np.add.at(count, np.searchsorted(keys, pairs[0]), 1)
                starts_word = np.bincount(inverse, np.where(at_start, weight[whole], 0))
                count = np.where(starts_word > 0, starts_word, count)
            out.append({"gram": keys, "context": context[first], "count": count})
        return out

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Natural log probability of each word under each class, [words, classes]; the end mark is predicted too."""
        if not words:
            return np.zeros((0, len(self.classes)))
        codes, starts = _codes(words)
        at = np.arange(len(codes)) - np.repeat(starts[:-1], np.diff(starts))
        p = np.full((len(codes), len(self.classes)), 1.0 / ALPHABET)
        shifted = np.zeros(len(codes), dtype=np.uint64)
        for k in range(1, self.order + 1):
            h = _hashes(codes, starts, k)
            i, known = _find(self.contexts[k - 1][0], shifted)
            usable = (at + 1 >= k)[:, None] & known[:, None]
            left = np.where(usable, self.contexts[k - 1][1][i] if len(self.contexts[k - 1][0]) else 1.0, 1.0)
            i, known = _find(self.grams[k - 1][0], h)
            seen = np.where(usable & known[:, None], self.grams[k - 1][1][i] if len(self.grams[k - 1][0]) else 0.0, 0.0)
            p = seen + left * p
            shifted = np.concatenate([[np.uint64(0)], h[:-1]])
        logs = np.log(p)
        logs[starts[:-1]] = 0.0
        return np.add.reduceat(logs, starts[:-1], axis=0)
