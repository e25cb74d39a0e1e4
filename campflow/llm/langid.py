"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a label; neighbouring labels are tied by learned transitions, so that text which switches
between languages is labelled in stretches. A word's features are its inner character n-grams, its affixes (n-grams
that touch the word's begin or end) and, if the word is in the lexicon, the word itself. Weights and transitions are
learned together from labelled documents, by gradient ascent on the likelihood, with forward-backward for the
expectations. Forward-backward also gives the label probabilities of a text's words; the text has the language with the
highest mean, which is its score.

The model is fitted on a bounded sample: ``SAMPLE_DOCS`` documents per language, drawn by a hash from all labelled ones,
and ``SAMPLE_CHARS`` characters from a drawn place of each. Prediction reads whole texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE_DOCS, SAMPLE_CHARS = 250, 1200
BUCKETS, LEXICON_BUCKETS, LEXICON_COUNT = 1 << 16, 1 << 14, 3
#: Words of a chain. Longer texts are labelled in stretches of so many words; the chain begins anew in each.
STRETCH = 1024
_ROUNDS, _RATE, _SHRINK, _SWITCH_WORDS = 60, 0.5, 1e-6, (8, 40)
_CHUNK_CELLS = 1 << 22
UNKNOWN = "und"
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def letters(text: str) -> np.ndarray:
    """The text in lower case as UTF-8, with a space for every other ASCII character, and one at each end."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8).copy()
    raw[(raw < 97) | ((raw > 122) & (raw < 128))] = 32
    return raw


def word_starts(raw: np.ndarray) -> np.ndarray:
    full = raw != 32
    return np.flatnonzero(full[1:] & ~full[:-1]) + 1


def ngram_buckets(raw: np.ndarray) -> np.ndarray:
    """For every place and n from 1 to 4 the bucket of the n-gram that begins there; ``BUCKETS`` if there is none.

    An n-gram may hold the space before or after a word, but none inside and not spaces alone.
    """
    wide = raw.astype(np.uint32)
    full = raw != 32
    out = np.full((4, len(raw)), BUCKETS, np.int32)
    hashed = wide.copy()
    for n in range(1, 5):
        m = len(raw) - n + 1
        if n > 1:
            hashed = hashed[:m] * np.uint32(0x01000193) + wide[n - 1 :]
        inner = full[:m].copy() if n == 1 else full[:m] | full[n - 1 :]
        for k in range(1, n - 1):
            inner &= full[k : m + k]
        mixed = (hashed ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        out[n - 1, :m] = np.where(inner, (mixed >> np.uint32(16)).astype(np.int32), BUCKETS)
    return out


_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def word_hashes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.zeros(len(raw), np.int64)
    place[starts[0] :] = np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    value = np.where(raw != 32, raw.astype(np.uint64) * _POWERS[place % 64], np.uint64(0))
    return np.add.reduceat(value, starts)


@dataclass
class Model:
    """Languages in order, weights of n-grams and lexicon words (the last row of each is zero), and transitions."""

    languages: list[str]
    ngrams: np.ndarray
    lexicon: np.ndarray
    words: np.ndarray
    transitions: np.ndarray

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """The lexicon bucket of each word; ``LEXICON_BUCKETS`` for words that are not in it."""
        if not len(self.words):
            return np.full(len(hashes), LEXICON_BUCKETS)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, (hashes >> np.uint64(50)).astype(np.int64), LEXICON_BUCKETS)

    def emissions(self, raw: np.ndarray) -> np.ndarray:
        """A row of scores per word. Texts are taken in pieces that end between words, to bound the memory."""
        size, at, out = max(4096, _CHUNK_CELLS // max(1, len(self.languages))), 0, []
        while at < len(raw) - 1:
            end = min(at + size, len(raw))
            spaces = np.flatnonzero(raw[end - 1 :] == 32)
            end = end + int(spaces[0]) if len(spaces) else len(raw)
            piece = raw[at:end]
            starts = word_starts(piece)
            if len(starts):
                buckets = ngram_buckets(piece)
                score = self.ngrams[buckets[0]]
                for more in buckets[1:]:
                    score += self.ngrams[more]
                count = np.add.reduceat((buckets < BUCKETS).sum(axis=0), starts - 1)
                total = np.add.reduceat(score, starts - 1, axis=0) / count[:, None]
                out.append(total + self.lexicon[self.known(word_hashes(piece, starts))])
            at = end - 1
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)))

    def label(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        raws = [letters(t) if has_letter(t) else None for t in texts]
        full = [i for i, raw in enumerate(raws) if raw is not None]
        out = [(UNKNOWN, 0.0)] * len(texts)
        if not full or not self.languages:
            return out
        rows = [self.emissions(raws[i]) for i in full]
        lengths = np.array([len(r) for r in rows])
        chances = forward_backward(np.concatenate(rows), stretches(lengths), self.transitions)[0]
        ends = np.cumsum(lengths)
        means = np.add.reduceat(chances, ends - lengths, axis=0) / lengths[:, None]
        best = means.argmax(axis=1)
        for i, k, mean in zip(full, best, means):
            out[i] = (self.languages[k], round(float(min(1.0, max(0.0, mean[k]))), 6))
        return out


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    return _ASCII_LETTER.search(text.encode("utf-8", "replace")) is not None or any(map(str.isalpha, text))


def stretches(lengths: np.ndarray) -> np.ndarray:
    """Lengths of the chains of texts with so many words each, in order."""
    whole, rest = np.divmod(lengths, STRETCH)
    return np.concatenate([np.r_[np.full(w, STRETCH), [r] if r else []] for w, r in zip(whole, rest)]).astype(np.int64)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of every word of all chains, and the expected number of each transition.

    ``scores`` has the words of the chains one after the other. All chains take a step together, the longest first, so
    that those which still have words are always at the front.
    """
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    chance = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # chains with more than t words
    ahead, behind = np.empty_like(chance), np.ones_like(chance)
    a = chance[:0]
    for t in range(longest):
        at = begin[: active[t]] + t
        a = chance[at] if t == 0 else (a[: active[t]] @ step) * chance[at]
        a = a / a.sum(axis=1, keepdims=True)
        ahead[at] = a
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        b = (chance[at + 1] * behind[at + 1]) @ step.T
        behind[at] = b / b.sum(axis=1, keepdims=True)
    both = ahead * behind
    both /= both.sum(axis=1, keepdims=True)
    last = np.zeros(len(scores), bool)
    last[begin + sizes - 1] = True
    at = np.flatnonzero(~last)
    left, right = ahead[at], chance[at + 1] * behind[at + 1]
    norm = ((left @ step) * right).sum(axis=1, keepdims=True)
    return both, step * ((left / norm).T @ right) if len(at) else np.zeros_like(step)


def fit(samples: list[tuple[str, str]]) -> Model:
    """A model of (language, text) samples. The order of the samples does not matter.

    A third of the chains is one sample; the rest is spliced from samples of all languages, so that transitions between
    languages are seen.
    """
    samples = sorted((lang, text) for lang, text in samples if has_letter(text))
    languages = sorted({lang for lang, _ in samples})
    k = len(languages)
    model = Model(languages, np.zeros((BUCKETS + 1, k), np.float32), np.zeros((LEXICON_BUCKETS + 1, k), np.float32),
                  np.zeros(0, np.uint64), np.zeros((k, k)))
    if not samples:
        return model
    words, labels = [], []
    for lang, text in samples:
        raw = letters(text)
        starts = word_starts(raw)
        ends = np.append(starts[1:], len(raw)) - 1
        words.append([raw[a - 1 : b + 1] for a, b in zip(starts, ends)])
        labels.append(languages.index(lang))
    dice = np.random.default_rng(0)
    chains: list[list[tuple[int, int, int]]] = []  # (sample, from, to)
    for i in range(len(words)):
        chains.append([(i, 0, len(words[i]))])
    for _ in range(2 * len(words)):
        chain = []
        for _ in range(int(dice.integers(2, 5))):
            i = int(dice.integers(len(words)))
            n = int(dice.integers(*_SWITCH_WORDS))
            at = int(dice.integers(max(1, len(words[i]) - n)))
            chain.append((i, at, min(at + n, len(words[i]))))
        chains.append(chain)
    picked = [(i, j) for chain in chains for i, a, b in chain for j in range(a, b)]
    lengths = np.array([sum(b - a for _, a, b in chain) for chain in chains])
    lengths, truth = lengths[lengths > 0], np.array([labels[i] for i, _ in picked])

    # every sampled word's features once; the words of the chains point to them
    raw = np.concatenate([np.concatenate(w) for w in words])
    place = np.cumsum([0] + [len(w) for w in words])
    starts = word_starts(raw)
    buckets = ngram_buckets(raw)
    hashes = word_hashes(raw, starts)
    known, count = np.unique(hashes, return_counts=True)
    model.words = known[count >= LEXICON_COUNT]
    lexeme = model.known(hashes)
    word_of = np.searchsorted(starts - 1, np.arange(len(raw)), side="right") - 1
    n_grams = np.add.reduceat((buckets < BUCKETS).sum(axis=0), starts - 1)
    flat, owner = buckets.ravel(), np.tile(word_of, 4)
    owner, flat = owner[flat < BUCKETS], flat[flat < BUCKETS]
    share = 1.0 / n_grams[owner]
    which = np.array([place[i] + j for i, j in picked])
    same = np.ones(len(truth), bool)
    same[np.cumsum(lengths) - 1] = False
    seen_steps = np.zeros((k, k))
    np.add.at(seen_steps, (truth[:-1][same[:-1]], truth[1:][same[:-1]]), 1)
    wanted = np.eye(k)[truth]

    gram2 = np.full((BUCKETS + 1, k), 1e-3)
    lex2, step2 = np.full((LEXICON_BUCKETS + 1, k), 1e-3), np.full((k, k), 1e-3)
    grams, lexicon, steps = (np.zeros_like(x) for x in (gram2, lex2, step2))
    for _ in range(_ROUNDS):
        own = np.stack([np.bincount(owner, grams[flat, c] * share, len(starts)) for c in range(k)], axis=1) + lexicon[lexeme]
        chances, expected = forward_backward(own[which], lengths, steps)
        miss = wanted - chances
        by_word = np.stack([np.bincount(which, miss[:, c], len(starts)) for c in range(k)], axis=1)
        slopes = (
            np.stack([np.bincount(flat, by_word[owner, c] * share, BUCKETS + 1) for c in range(k)], axis=1),
            np.stack([np.bincount(lexeme, by_word[:, c], LEXICON_BUCKETS + 1) for c in range(k)], axis=1),
            seen_steps - expected,
        )
        slopes[1][-1] = 0
        for weights, squares, slope in zip((grams, lexicon, steps), (gram2, lex2, step2), slopes):
            slope = slope - _SHRINK * len(truth) * weights
            squares += slope * slope
            weights += _RATE * slope / np.sqrt(squares)
    model.ngrams, model.lexicon, model.transitions = grams.astype(np.float32), lexicon.astype(np.float32), steps
    return model


def held_out() -> Column:
    """Whether the remainder of the doc_id's checksum keeps it for testing; an unknown doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame) -> list[tuple[str, str]]:
    """(lang, text) of the drawn documents, from those with a language and a doc_id that are not held out."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    # as many rows as languages; a map of them lets every task drop what is not drawn before anything is shuffled
    sizes = {row.lang: row.n for row in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return []
    draw, scale = F.xxhash64("doc_id"), 1 << 20
    bound = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, -(-2 * SAMPLE_DOCS * scale // n))))
    near = usable.select("lang", "text", draw.alias("draw")).filter(F.pmod("draw", F.lit(scale)) < bound[F.col("lang")])
    spare = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    part = F.substring(F.col("text"), F.pmod(F.col("draw"), spare).cast("int") + 1, F.lit(SAMPLE_CHARS))
    first = near.select("lang", part.alias("text"), F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text")).alias("nth"))
    return [(row.lang, row.text) for row in first.filter(F.col("nth") <= SAMPLE_DOCS).collect()]


def identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``.

    Without a ``model`` one is fitted on those of ``docs`` that are not held out. Only the text is an input of a
    prediction. Null texts and texts without a letter are ``und`` with score 0, and so are all if nothing is labelled.
    Rows are treated one by one. Extra columns are carried; those with the name of a new column are replaced.
    """
    fitted = model or fit(training_sample(docs))

    def run(texts: pd.Series) -> pd.DataFrame:
        found = [x for at in range(0, len(texts), 2000) for x in fitted.label([t if isinstance(t, str) else None for t in texts[at : at + 2000]])]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    guess = F.pandas_udf(run, "lang_pred string, score double")("text")
    out = docs.withColumns({"held_out": held_out(), "lang_pred": guess})
    return out.withColumns({"score": F.col("lang_pred.score"), "lang_pred": F.col("lang_pred.lang_pred")})
