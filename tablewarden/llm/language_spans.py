"""Language identification of mixed-language text: script ranges, word scores, Viterbi spans.

The script of a word's letters leaves the languages that are written in it. Each remaining language scores the word by
its pairs and triples of letters, with the word's ends, and by the word itself. Viterbi then labels every word of
the text, paying a penalty for each switch of language, so single words of another language do not break a span. The
main language is the one the text opens with if it has a fair share of the letters (a long quotation does not change
it), else the one with most letters.

Training uses a sample of labelled texts bounded by ``rows_per_language``; scoring covers every whole text.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0 and has no span; so is every text when
nothing was learned. Ties go to the language that sorts first. Repeated rows give repeated results, an empty table an
empty result; columns other than the named ones are not read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts
from .sampling import labelled_sample

UNKNOWN = "und"
LEAST_SCRIPT_SHARE = 0.01  # of a language's letters, for a script to count as one it is written in
SMOOTHING = 0.5
OPENING_SHARE = 0.25  # of the letters, from which on the language a text opens with is its main one
WORD_LIMIT = 6.0  # most that one word can say for or against a language
CACHE_WORDS = 400_000

# First and last code point of the scripts' letters, in order.
SCRIPT_RANGES = (
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF),
    ("tamil", 0xB80, 0xBFF), ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)


def script_of(letter: str) -> str:
    code = ord(letter)
    for name, first, last in SCRIPT_RANGES:
        if first <= code <= last:
            return name
    return "other"


def letters_of(chunk: str) -> str:
    low = chunk.lower()
    return low if low.isalpha() else "".join(c for c in low if c.isalpha())


def grams(word: str) -> list[str]:
    """Pairs and triples of letters with the word's ends, and the word itself."""
    padded = f"^{word}$"
    last = len(padded)
    return [padded[i:i + 2] for i in range(last - 1)] + [padded[i:i + 3] for i in range(last - 2)] + ["=" + word]


class LanguageModel:
    """Word scores per language, learned from (language, text) pairs."""

    def __init__(self, samples: list[tuple[str, str]]):
        counts: dict[str, Counter[str]] = defaultdict(Counter)
        letters: dict[str, Counter[str]] = defaultdict(Counter)
        for lang, text in samples:
            words = Counter(w for w in map(letters_of, unicodedata.normalize("NFC", text).split()) if w)
            for word, n in words.items():
                letters[lang][script_of(word[0])] += n * len(word)
                for gram in grams(word):
                    counts[lang][gram] += n
        self.languages = sorted(lang for lang in counts if counts[lang])
        self.scripts = {
            lang: {s for s, n in letters[lang].items() if n >= LEAST_SCRIPT_SHARE * sum(letters[lang].values())}
            for lang in self.languages
        }
        known = Counter()
        for lang in self.languages:
            known.update(counts[lang])
        self.index = {g: i for i, g in enumerate(sorted(g for g, n in known.items() if n > 1))}
        size, width = len(self.index), max(1, len(self.languages))
        table = np.full((size + 1, width), SMOOTHING)  # the last row stands for what was never seen
        for at, lang in enumerate(self.languages):
            for gram, n in counts[lang].items():
                if gram in self.index:
                    table[self.index[gram], at] += n
        table = np.log(table / table.sum(axis=0))
        table -= table.mean(axis=1, keepdims=True)
        table[-1] = 0.0
        self.table = table.astype(np.float32)

    def words(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of words per language, and their numbers of letters."""
        plain = [letters_of(c) for c in chunks]
        width = self.table.shape[1]
        get, unseen = self.index.get, len(self.index)
        rows: list[int] = []
        ends = []
        for word in plain:
            rows += [get(g, unseen) for g in grams(word)]
            ends.append(len(rows))
        starts = np.concatenate(([0], np.array(ends[:-1], np.int64))).astype(np.int64)
        scores = np.add.reduceat(self.table[np.array(rows, np.int64)], starts, axis=0) / 2  # a letter is in about
        scores -= scores.max(axis=1, keepdims=True)                                         # two pairs or triples each
        script = [script_of(w[0]) if w else "" for w in plain]
        kinds = sorted(set(script))
        fits = np.array([[s in self.scripts[lang] for lang in self.languages] for s in kinds]).reshape(len(kinds), width)
        fits[~fits.any(axis=1)] = True  # no language of this script: all may be it
        place = {s: i for i, s in enumerate(kinds)}
        scores[~fits[[place[s] for s in script]]] = -2 * WORD_LIMIT
        sizes = np.array([len(w) for w in plain])
        scores[sizes == 0] = 0.0
        return np.maximum(scores, -2 * WORD_LIMIT).astype(np.float32), sizes


def viterbi(texts: list[np.ndarray], scores: np.ndarray, penalty: float) -> list[np.ndarray]:
    """Best labels for sequences of word numbers, all sequences at once, one step for each word position."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order])
    longest = int(lengths[0]) if len(lengths) else 0
    if longest == 0:
        return [np.zeros(0, np.int32) for _ in texts]
    total = int(lengths.sum())
    flat = np.concatenate([texts[i] for i in order])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    active = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")  # sequences that reach a step
    value = np.zeros((len(texts), scores.shape[1]), np.float32)
    offsets = np.concatenate(([0], np.cumsum(active)))
    best = np.zeros(total, np.int32)
    stays = np.zeros((total, scores.shape[1]), bool)
    for step in range(longest):
        n = active[step]
        now = value[:n]
        if step:
            top = now.argmax(axis=1)
            moved = now[np.arange(n), top][:, None] - penalty
            at = slice(offsets[step], offsets[step + 1])
            best[at] = top
            stays[at] = now >= moved
            now = np.maximum(now, moved)
        value[:n] = now + scores[flat[starts[:n] + step]]
    labels = np.zeros(total, np.int32)
    state = value.argmax(axis=1)
    for step in range(longest - 1, -1, -1):
        n = active[step]
        labels[starts[:n] + step] = state[:n]
        if step:
            at = offsets[step]
            keep = stays[at:at + n][np.arange(n), state[:n]]
            state[:n] = np.where(keep, state[:n], best[at:at + n])
    found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
    for i, first, length in zip(order, starts, lengths):
        found[i] = labels[first:first + length]
    return found


class SpanLabeller:
    """Labels of whole texts, with word scores remembered for a task."""

    def __init__(self, model: LanguageModel, penalty: float):
        self.model, self.penalty = model, penalty
        self._reset()

    def _reset(self) -> None:
        self.number: dict[str, int] = {}
        self.scores = np.zeros((0, max(1, len(self.model.languages))), np.float32)
        self.letters = np.zeros(0, np.int64)

    def __call__(self, texts: list[str | None]) -> dict[str, list]:
        if len(self.number) > CACHE_WORDS:
            self._reset()
        split = [(t if unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t)).split()
                 for t in (t or "" for t in texts)]
        number = self.number
        fresh = sorted(set().union(*split).difference(number))
        languages = self.model.languages
        if fresh and languages:
            number.update(zip(fresh, range(len(number), len(number) + len(fresh))))
            scores, letters = self.model.words(fresh)
            self.scores, self.letters = np.concatenate((self.scores, scores)), np.concatenate((self.letters, letters))
        found = {"lang_pred": [], "score": [], "spans": []}
        if not languages or not number:
            return {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts), "spans": [[]] * len(texts)}
        scores, letters = self.scores, self.letters
        ids = [np.fromiter(map(number.__getitem__, c), np.int64, len(c)) for c in split]
        for words, labels in zip(ids, viterbi(ids, scores, self.penalty)):
            sizes = letters[words] if len(words) else np.zeros(0)
            if not sizes.sum():
                found["lang_pred"].append(UNKNOWN)
                found["score"].append(0.0)
                found["spans"].append([])
                continue
            share = np.bincount(labels, weights=sizes, minlength=len(languages)) / sizes.sum()
            opening = int(labels[np.flatnonzero(sizes)[0]])
            main = opening if share[opening] >= OPENING_SHARE else int(share.argmax())
            found["lang_pred"].append(languages[main])
            found["score"].append(min(1.0, float(share[main])))
            cuts = np.flatnonzero(np.diff(labels)) + 1
            edges = [0, *cuts.tolist(), len(labels)]
            found["spans"].append([f"{languages[labels[a]]}:{a}:{b}" for a, b in zip(edges, edges[1:])])
        return found


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", rows_per_language: int = 512
) -> LanguageModel:
    """A model from at most ``rows_per_language`` texts of each non-null language."""
    return LanguageModel(labelled_sample(docs, text, lang, rows_per_language))


def label_languages(
    docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    penalty: float = 8.0,
) -> DataFrame:
    """``keep``, ``lang_pred`` (the main language), ``score`` (its share of the letters) and ``spans`` of words
    (``language:first:end``) for every row."""
    return map_texts(
        docs, keep, text, lambda: SpanLabeller(model, penalty),
        {"lang_pred": pa.string(), "score": pa.float64(), "spans": pa.list_(pa.string())}, rows=4096,
    )
