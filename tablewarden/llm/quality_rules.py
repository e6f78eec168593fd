"""Quality rules: repetition counts and the fertility of a public tokenizer, with bands per language or script.

A subword vocabulary made from ordinary text spends few tokens on ordinary text. Three measures follow: characters
per token, the share of tokens that are single bytes (byte fallback), and the entropy of a text's token distribution.
Noise in capitals, symbols between words and menus of one word cost more tokens per character and use fewer distinct
ones. A text is rejected when a measure leaves the band of its language, or of its main script where the language is
NULL or has no band. Entropy grows with the number of tokens, so its band is a line in log2(tokens) with a ceiling.

Defined results: a NULL or empty text has no words, fails the base rule and has measures 0. Repeated rows give
repeated results, an empty table an empty result. Whole texts are measured; columns other than ``keep``, ``text`` and
``lang`` are not read.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50


@dataclass(frozen=True)
class Band:
    """Limits of the measures; entropy must reach min(ceiling, base + slope * log2(tokens))."""

    least_chars_per_token: float
    most_byte_share: float
    entropy_base: float = 2.6
    entropy_slope: float = 0.4
    entropy_ceiling: float = 6.25


# Fixed values for the 32k vocabulary. Languages first, measured on labelled texts; then scripts, which are guesses.
BANDS = {
    "en": Band(2.35, 0.3), "de": Band(2.30, 0.3), "fr": Band(2.12, 0.3), "es": Band(2.08, 0.3),
    "LATIN": Band(1.6, 0.4), "CYRILLIC": Band(1.2, 0.4), "GREEK": Band(0.8, 0.5), "ARABIC": Band(0.6, 0.6),
    "HEBREW": Band(0.6, 0.6), "CJK": Band(0.3, 0.9, 2.0, 0.3, 5.0), "HIRAGANA": Band(0.3, 0.9, 2.0, 0.3, 5.0),
    "HANGUL": Band(0.3, 0.95, 1.5, 0.3, 4.5), "OTHER": Band(0.2, 1.0, 1.0, 0.3, 4.0),
}


def main_script(text: str) -> str:
    """The script with most letters; OTHER without letters."""
    counts: Counter[str] = Counter()
    for char, n in Counter(text).items():
        if char.isalpha():
            name = unicodedata.name(char, "OTHER").partition(" ")[0].partition("-")[0]
            counts["HIRAGANA" if name == "KATAKANA" else name] += n
    script = max(counts, key=lambda s: (counts[s], s), default="OTHER")
    return script if script in BANDS else "OTHER"


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    size = len(words) - width + 1
    if size < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key = ids[:size]
    for step in range(1, width):  # a pair of numbers below the text's length becomes one number below it
        pair = key * len(number) + ids[step:step + size]
        key = np.unique(pair, return_inverse=True)[1] if step + 1 < width else pair
    _, place, counts = np.unique(key, return_inverse=True, return_counts=True)
    inside = np.zeros(len(words) + 1, np.int64)
    twice = np.flatnonzero(counts[place] > 1)
    np.add.at(inside, twice, 1)
    np.add.at(inside, twice + width, -1)
    return int((np.cumsum(inside)[:-1] > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()  # of bytes: exactly space and the control characters 9 to 13
    chars = len(text) - sum(map(text.count, "\x20\t\n\x0b\f\r"))
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if line in seen:
            repeated += 1
        elif line.strip("\x20\t\x0b\f\r"):
            seen.add(line)
    return len(words), chars, sum(map(text.count, SYMBOLS)), repeated, repeated_words(words)


class Fertility:
    """Measures of a text under one vocabulary file."""

    def __init__(self, file: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=file)
        self.bytes = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])

    def measure(self, text: str | None) -> tuple[int, float, float, float]:
        """Tokens, characters per token, byte-fallback share, entropy in bits; white space counts as one space."""
        plain = b" ".join((text or "").encode().split()).decode()
        ids = np.asarray(self.pieces.encode(plain), np.int64)
        if not len(ids):
            return 0, 0.0, 0.0, 0.0
        counts = np.bincount(ids)
        share = counts[counts > 0] / len(ids)
        return len(ids), len(plain) / len(ids), float(self.bytes[ids].mean()), float(-(share * np.log2(share)).sum())


def in_band(band: Band, tokens: int, per_token: float, byte_share: float, entropy: float) -> bool:
    least = min(band.entropy_ceiling, band.entropy_base + band.entropy_slope * math.log2(max(tokens, 1)))
    return per_token >= band.least_chars_per_token and byte_share <= band.most_byte_share and entropy >= least


def quality_signals(
    docs: DataFrame, file: str, text: str = "text", lang: str | None = "lang", keep: tuple[str, ...] = ("doc_id",),
    bands: dict[str, Band] = BANDS,
) -> DataFrame:
    """``keep``, the counts, the tokenizer's measures, ``base_failed`` and ``kept`` for every row."""
    carried = "language_of_the_text"
    rows = docs.select(*keep, text, (F.col(lang) if lang else F.lit(None).cast("string")).alias(carried))

    def make():
        fertility = Fertility(file)

        def run(texts):
            counts = [base_counts(t) for t in texts]
            measures = [fertility.measure(t) for t in texts]
            found = {k: list(v) for k, v in zip(
                ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), zip(*counts))}
            found |= {k: list(v) for k, v in zip(("n_tokens", "chars_per_token", "byte_share", "entropy"),
                                                 zip(*measures))}
            found["base_failed"] = [c[0] < LEAST_WORDS or 100 * c[4] > MOST_REPEATED_PERCENT * c[0] for c in counts]
            found["script"] = [main_script(t or "") for t in texts]
            return found

        return run

    count, real = pa.int64(), pa.float64()
    fields = {k: count for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")}
    fields |= {k: real for k in ("chars_per_token", "byte_share", "entropy")}
    fields |= {"base_failed": pa.bool_(), "script": pa.string()}
    found = map_texts(rows, (*keep, carried), text, make, fields)

    def band(field: str):
        value = F.lit(None).cast("double")
        for name, limits in bands.items():  # the language's band, else the script's
            if name.isupper():
                value = F.when(F.col("script") == name, getattr(limits, field)).otherwise(value)
        for name, limits in bands.items():
            if not name.isupper():
                value = F.when(F.col(carried) == name, getattr(limits, field)).otherwise(value)
        return value

    least = F.least(
        band("entropy_ceiling"),
        band("entropy_base") + band("entropy_slope") * F.log2(F.greatest(F.col("n_tokens"), F.lit(1))),
    )
    good = (
        (F.col("chars_per_token") >= band("least_chars_per_token")) & (F.col("byte_share") <= band("most_byte_share"))
        & (F.col("entropy") >= least)
    )
    return found.withColumn("kept", ~F.col("base_failed") & good).drop(carried)
