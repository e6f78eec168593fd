"""Byte-pair encoding by a tokenization automaton.

The automaton reads tokens. Its states are the last token read, and an arc for token ``t`` leaves state ``u`` if
``u t`` can stand side by side in an encoded word. It is compiled by one merge gadget per merge, in order. For the
merge ``x y -> w`` the gadget

* takes the arc ``y`` away from state ``x`` (from now on the pair is always merged),
* adds state ``w`` as a copy of state ``y`` (what may follow ``w`` is what may follow ``y``),
* adds an arc ``w`` beside every arc ``x`` (``w`` may follow whatever ``x`` may follow).

Copies are stored by reference: a state keeps the state it copies, an arc the arc it stands beside, both with the
number of the gadget that made them, and each state its removed arcs. Compilation is therefore linear in the merges,
and a transition table caches the composed arcs that texts use. A merge whose arc is already gone never applies and
is left out. Because the automaton is deterministic, each prefix of a word has one last token, so a word is encoded
along its one path, longest arcs first. Decoding
emits the labels of the arcs.

Defined results: NULL and empty texts give no token and an empty decoded text. Repeated rows give repeated results,
an empty table an empty result; columns other than ``keep`` and ``text`` are not read. Texts are encoded whole.
"""

from __future__ import annotations

import json
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_texts

# Fixed values of the vocabulary file's own rules: white space, words, and the visible form of bytes.
WHITE = "\t-\r \x85\xa0  -     　"
_WHITE_RUN = re.compile(f"[{WHITE}]+")
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
# Code points without a character in the standard that the vocabulary's library follows (version 16), and
# the capitals added since version 15, with their small letters.
LATER_CODES = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD-A7EF A7F1 AB6C-AB6D 107BB-107BF 10940-1095F "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DEF 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EDF 16FF2-16FF6 "
    "187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DFF 18E00-191DF 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF96 "
    "1DFCD-1DFFF 1E6C0-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
LATE_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
                 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LATE_CAPITALS |= {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}
_LATER = re.compile("[" + "".join(
    "-".join(chr(int(end, 16)) for end in codes.split("-")) for codes in LATER_CODES.split()
) + "]")
_LATE_CAPITAL = re.compile("[" + "".join(map(chr, LATE_CAPITALS)) + "]")
CACHE_WORDS = 400_000  # words whose encoding a task remembers; no effect on results


def visible_bytes() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class TokenAutomaton:
    """Compiled from a vocabulary file of merges; ``encode_word`` runs it on one pre-split word."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str = "</w>"):
        self.end, self.vocab = end, vocab
        self.born: dict[str, int] = {}   # gadget that made the state and the arc of a token; base symbols: -1
        self.copied: dict[str, str] = {}  # state a state copies: what follows w is what follows its right part
        self.beside: dict[str, str] = {}  # arc an arc stands beside: w comes where its left part may come
        self.removed: dict[tuple[str, str], int] = {}
        self.table: dict[tuple[str, str], bool] = {}
        for step, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self._gadget(step, left, right)
        self.reach: dict[str, int] = {}  # symbols of the longest token by its first two symbols
        for token in self.born:
            length = len(token) - (len(end) if token.endswith(end) else 0)
            self.reach[token[:2]] = max(length, self.reach.get(token[:2], 1))

    def _base(self, token: str) -> bool:
        return len(token) == 1 or token.endswith(self.end) and len(token) == len(self.end) + 1

    def _known(self, token: str) -> bool:
        return token in self.born or self._base(token)

    def _gadget(self, step: int, left: str, right: str) -> None:
        whole = left + right
        if not (self._known(left) and self._known(right)) or self._known(whole) or not self.arc(left, right, step):
            return
        self.removed[left, right] = step
        self.born[whole], self.copied[whole], self.beside[whole] = step, right, left

    def arc(self, state: str, token: str, step: int) -> bool:
        """Whether ``token`` leaves ``state`` once the gadgets before ``step`` are built."""
        born = self.born
        while True:
            gone = self.removed.get((state, token))
            if gone is not None and gone < step:
                return False
            made_state, made_arc = born.get(state, -1), born.get(token, -1)
            if made_state < 0 and made_arc < 0:
                return True
            if made_state > made_arc:  # the state was copied when the arc was there: look at the copied state then
                step, state = made_state, self.copied[state]
            else:  # the arc was added beside an older one, after the gadget removed its own pair
                step, token = made_arc + 1, self.beside[token]

    def follows(self, state: str, token: str) -> bool:
        key = (state, token)
        found = self.table.get(key)
        if found is None:
            found = self.table[key] = self.arc(state, token, 1 << 60)
            if len(self.table) > 2_000_000:
                self.table.clear()
        return found

    def encode_word(self, symbols: str) -> list[str]:
        """Tokens of a word given as visible bytes; its last symbol carries the word end.

        The accepting path is unique, and so is the last token at each position. Longest arcs are tried first; a
        position from which the word's end can't be reached is not entered again.
        """
        size, born, table = len(symbols), self.born, self.table
        whole = symbols + self.end
        if whole in born:
            return [whole]
        tokens: list[str] = []
        starts: list[int] = []
        dead: set[int] = set()
        at, length = 0, min(size, self.reach.get(symbols[:2], 1))
        while at < size:
            state = tokens[-1] if tokens else None
            while length:
                stop = at + length
                if stop not in dead:
                    token = symbols[at:stop] if stop < size else symbols[at:] + self.end
                    if length == 1 or token in born:
                        if state is None:
                            break
                        allowed = table.get((state, token))
                        if allowed is None:
                            allowed = self.follows(state, token)
                        if allowed:
                            break
                length -= 1
            if length:
                tokens.append(token)
                starts.append(at)
                at = stop
                length = min(size - at, self.reach.get(symbols[at:at + 2], 1))
            else:
                dead.add(at)
                tokens.pop()
                length = at - starts[-1] - 1
                at = starts.pop()
        return tokens


class WordCodec:
    """Encoding and decoding of whole texts with a vocabulary file whose words end in a suffix."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as source:
            content = json.load(source)
        model = content["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.automaton = TokenAutomaton(self.vocab, model["merges"], model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.labels = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.bytes = visible_bytes()
        self._split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._known: dict[str, tuple[int, ...]] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        self._plain = {b: c for b, c in enumerate(self.bytes)}

    def _word(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-split word."""
        found = self._words.get(word)
        if found is None:
            symbols = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self._plain)
            found = tuple([self.vocab[t] for t in self.automaton.encode_word(symbols)])
            if len(word) <= 32:
                self._words[word] = found
        return found

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a text without white space."""
        if chunk.isalpha():
            return self._word(chunk)
        if chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
            return self._word(chunk[:-1]) + self._word(chunk[-1])
        ids: list[int] = []
        shape = chunk if chunk.isprintable() else _LATER.sub("\ue000", chunk)
        for word in _WORD.finditer(shape):
            ids += self._word(chunk[word.start():word.end()])
        return tuple(ids)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        ids: list[int] = []
        parts = self._split_special.split(text) if self._split_special and "<|" in text else [text]
        known = self._known
        for part in parts:
            if part in self.special:
                ids.append(self.special[part])
                continue
            if not unicodedata.is_normalized("NFC", part):
                part = unicodedata.normalize("NFC", part)
            part = part.replace("Σ", "σ").lower()  # letter by letter: no final form of sigma
            if not part.isascii() and _LATE_CAPITAL.search(part):
                part = part.translate(LATE_CAPITALS)
            for chunk in _WHITE_RUN.split(part) if _ODD_SPACE.search(part) else part.split():
                found = known.get(chunk)
                if found is None:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                        self._words.clear()
                    found = self._chunk(chunk)
                    if len(chunk) <= 64:
                        known[chunk] = found
                ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        labels = self.labels
        return " ".join([labels[i] for i in ids])


def encode_texts(
    docs: DataFrame, file: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = False
) -> DataFrame:
    """``keep``, ``ids`` (array of int) and, if asked for, ``decoded`` (the text that the ids give) for every row."""

    def make():
        codec = WordCodec(file)

        def run(texts):
            ids = [codec.encode(t) for t in texts]
            found = {"ids": ids}
            if decoded:
                found["decoded"] = [codec.decode(i) for i in ids]
            return found

        return run

    fields = {"ids": pa.list_(pa.int32())} | ({"decoded": pa.string()} if decoded else {})
    return map_texts(docs, keep, text, make, fields)


def decode_ids(tokens: DataFrame, file: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``decoded`` for every row of encoded texts; NULL ids give an empty text."""

    def make():
        codec = WordCodec(file)
        return lambda rows: {"decoded": [codec.decode(r or []) for r in rows]}

    return map_texts(tokens, keep, ids, make, {"decoded": pa.string()})
