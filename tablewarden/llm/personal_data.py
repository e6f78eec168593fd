"""Personal data in texts, plain or disguised: e-mail and IP addresses, card and phone numbers.

Disguises are undone by transducers, each of which rewrites places of its input and remembers where they were
(:class:`Rewritten`):

1. *letters*: look-alikes of other scripts, wide and styled letters, digits of any script, odd spaces, dashes and dots
   become ASCII; invisible characters vanish;
2. *phrases*: ``name [at] host [dot] com`` and ``name at host dot com`` get their signs, spelled numbers
   (``plus four nine, one seven …``, also ``double five``) and letters standing for digits (``4O12``) become digits.

The patterns of plain identifiers run over the text itself and over the rewritten text. What they find there is mapped back
through the transducers to source code points and added if something in it was rewritten. Spans found in the text itself
always stay.

Defined results: NULL and empty texts have no spans. Repeated rows give repeated results, an empty table an empty result;
columns other than ``keep`` and the text are not read. Texts are searched whole, in time linear in their length.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The plain identifiers.

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# No digit run is entered in its middle and no repetition gives back: a text is read a bounded number of times.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){15,}+")  # shorter chains of digits can't hold 16 of them, from no start
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses. An address is found from its sign: its name is the run of name characters before it."""
    found, floor, sign = [], 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            floor = domain.end()
            found.append((start, floor))
        else:
            floor = sign + 1  # no name contains the sign
        sign = text.find("@", floor)
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the plain identifiers of a text, by kind and start."""
    found = [(EMAIL, *span) for span in emails(text)]
    found += [(IP, *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if len(digits) <= 19 and luhn(digits):
            found.append((CARD, *m.span()))
    if "+" in text:
        found += [(PHONE, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# Transducers.


class Rewritten:
    """A text with some places replaced, and the way back from spans of the result to spans of the text.

    ``edits`` are (start, end, replacement), sorted and apart. Memory beside the result follows the edits alone.
    """

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        pieces, self.begun, self.ended, at, shift = [], [], [], 0, 0
        self.edits = edits
        for start, end, put in edits:
            pieces += (source[at:start], put)
            self.begun.append(start + shift)  # places of the replacement in the result
            shift += len(put) - (end - start)
            self.ended.append(end + shift)
            at = end
        self.text = "".join((*pieces, source[at:])) if edits else source

    def _source(self, at: int, last: bool) -> int:
        """Place in the source of the result's character ``at``: its first, or its last, code point."""
        i = bisect_right(self.begun, at) - 1
        if i < 0:
            return at
        if at < self.ended[i]:
            return self.edits[i][1] - 1 if last else self.edits[i][0]
        return at - self.ended[i] + self.edits[i][1]

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self._source(start, False), self._source(end - 1, True) + 1

    def touches(self, start: int, end: int) -> bool:
        """Whether a character of the span is new or one vanished inside it."""
        i = bisect_right(self.ended, start)
        while i > 0 and self.ended[i - 1] >= start:
            i -= 1
        while i < len(self.edits) and self.begun[i] < end:
            if self.ended[i] > start and self.begun[i] < self.ended[i] or start < self.begun[i]:
                return True
            i += 1
        return False


# Letters of other scripts that look like ASCII letters, each beside its look-alike.
LOOK_ALIKES = (
    "Аа Aa Вв Bb Сс Cc Ее Ee Нн Hh Іі Ii Јј Jj Кк Kk Мм Mm Оо Oo Рр Pp Ѕѕ Ss Тт Tt Уу Yy Хх Xx Ԁԁ Dd Ԛԛ Qq Ԝԝ Ww "
    "Αα Aa Ββ Bb Εε Ee Ζ Z Ηη Hn Ιι Ii Κκ Kk Μ M Νν Nv Οο Oo Ρρ Pp Ττ Tt Υυ Yu Χχ Xx"
)
VANISHING = (
    "\u00ad\u034f\u061c\u115f\u180e\u200b\u200c\u200d\u200e"
    "\u200f\u2060\u2061\u2062\u2063\u2064\ufe0e\ufe0f\ufeff"
)
SIGNS = {
    "-": "\u2010\u2011\u2012\u2013\u2014\u2015\u2212\ufe58\ufe63",
    ".": "\u2024\u3002\ufe52\uff61\u00b7",
    " ": "\u00a0\u1680\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))),
}


def letter_table() -> dict[str, str]:
    """Character by character what the letters transducer writes: from Unicode's compatibility forms and digit values, and
    the lists above."""
    table = {}
    for code in range(0x100, 0x20000):  # no such forms further on
        c = chr(code)
        if unicodedata.category(c) == "Nd":
            table[c] = str(unicodedata.decimal(c))
        elif code >= 0x2000 and unicodedata.decomposition(c).startswith("<"):
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and " " < plain < "\x7f":
                table[c] = plain
    groups = LOOK_ALIKES.split(" ")
    for odd, plain in zip(groups[::2], groups[1::2]):
        table.update(zip(odd, plain))
    table.update((c, "") for c in VANISHING)
    table.update((c, sign) for sign, all_of in SIGNS.items() for c in all_of)
    return table


# How the signs and the digits are said in English, German, French and Spanish.
AT_WORDS = ("at", "arroba", "arobase", "klammeraffe")
DOT_WORDS = ("dot", "punkt", "punto", "point")
BARE_PAIRS = {"at": ("dot", "punkt"), "klammeraffe": ("punkt", "dot"), "arroba": ("punto", "dot"), "arobase": ("point", "dot")}
DIGIT_WORDS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
TIMES = {"double": 2, "triple": 3}
PLUS_WORDS, DASH_WORDS = ("plus", "más"), ("dash", "hyphen", "guión", "tiret")
#: Words after a bare "at" that no host starts with, and what a host of bare words may end in besides two letters.
NO_HOSTS = ("the", "a", "an", "this", "that", "these", "those", "my", "your", "his", "her", "its", "our", "their", "every")
ENDINGS = ("com", "org", "net", "edu", "gov", "mil", "info", "biz", "name", "app", "dev", "xyz", "online", "shop", "site")
LETTER_DIGITS = {"O": "0", "o": "0", "I": "1", "l": "1", "S": "5", "B": "8"}
LEAST_SPELLED = 3  # fewer number words side by side are left alone
LEAST_SPELLED_PHONE = 10  # so many digits, mostly spelled, are a phone number without a plus sign

_IN = r"[ \t]{0,3}"  # white space inside and around brackets; longer gaps part an address
_OPEN, _SHUT = rf"{_IN}[\[({{<]{_IN}", rf"{_IN}[\])}}>]{_IN}"
_AT_SET = frozenset(AT_WORDS)
_AT = re.compile(
    rf"{_OPEN}(?:{'|'.join(AT_WORDS)}|@){_SHUT}|(?<=[ \t])(?:{'|'.join(AT_WORDS)})(?=[ \t])|@{_IN}", re.IGNORECASE
)
_DOT_IN_BRACKETS = rf"{_OPEN}(?:{'|'.join(DOT_WORDS)}|\.){_SHUT}"
_DOT = re.compile(rf"{_DOT_IN_BRACKETS}|[ \t]{{1,3}}(?:{'|'.join(DOT_WORDS)})[ \t]{{1,3}}|\.", re.IGNORECASE)
_DOT_BEFORE = re.compile(rf"(?:{_DOT.pattern})\Z", re.IGNORECASE)
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_ATOM = frozenset(_LOCAL - {"."})
_GAP = re.compile(r"[ \t]{1,3}|,[ \t]?|-|[ \t]-[ \t]")  # between spoken digits
_TOKENS = re.compile(r"[^\W\d_]+|[0-9]")
_WORDS = re.compile(r"[^\W\d_]+")
SAID, JOIN, TIMES_KIND, PLUS_KIND = range(4)
#: What a spoken token is and what it becomes.
SPOKEN = (
    {word: (SAID, str(digit)) for word, digit in DIGIT_WORDS.items()} | {str(d): (SAID, str(d)) for d in range(10)}
    | {word: (JOIN, ".") for word in DOT_WORDS} | {word: (JOIN, "-") for word in DASH_WORDS}
    | {word: (TIMES_KIND, "") for word in TIMES} | {word: (PLUS_KIND, "+") for word in PLUS_WORDS}
)
_MIXED = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OoIlSB](?:[ ().-]{0,3}+[0-9OoIlSB]){7,}+(?![A-Za-z0-9])")


def _address_edits(text: str) -> list[tuple[int, int, str]]:
    """Signs for the disguised "at" and "dot" of addresses: a name, an "at", and labels with a "dot" between them."""
    edits: list[tuple[int, int, str]] = []
    floor = 0
    for sign in _AT.finditer(text):
        start, end = sign.span()
        said = sign[0].strip(" \t").lower()
        bare = said in BARE_PAIRS
        if bare:  # the white space around the word belongs to it
            while start > floor and text[start - 1] in " \t" and sign.start() - start < 3:
                start -= 1
            while end < len(text) and text[end] in " \t" and end - sign.end() < 3:
                end += 1
        elif said == "@":  # "name @host": a mention unless white space follows the sign
            if end - start > 1:
                while start > floor and text[start - 1] in " \t" and sign.start() - start < 3:
                    start -= 1
        if start < floor:
            continue
        dots, at, labels = [], end, []
        while True:
            label = _LABEL.match(text, at)
            if not label:
                break
            labels.append(label[0])
            at = label.end()
            dot = _DOT.match(text, at)
            if not dot:
                break
            dots.append(dot.span())
            at = dot.end()
        dots = dots[:len(labels) - 1] if labels else []
        if not dots:
            continue
        words = {text[a:b].strip(" \t").lower() for a, b in dots}
        last = labels[-1].lower()
        if not any(c.isalpha() for c in last):
            continue
        if bare:
            fit = words <= {*BARE_PAIRS[said], "."} or all(w[0] in "[({<" or w == "." for w in words)
            known = len(last) == 2 or last in ENDINGS
            if not fit or words == {"."} or not known or labels[0].lower() in NO_HOSTS:
                continue
        elif any(w in DOT_WORDS for w in words) and not (len(last) == 2 or last in ENDINGS):
            continue
        head, named = start, []
        while True:
            stop = head
            while head > floor and text[head - 1] in _ATOM:
                head -= 1
            if head == stop:
                if named:  # the dot before nothing is no part of the name
                    named.pop()
                break
            dot = _DOT_BEFORE.search(text, max(floor, head - 16), head)
            plain = dot and dot[0] != "." and dot[0].strip(" \t").lower() in DOT_WORDS
            if not dot or plain and not bare:
                break
            named.append(dot.span())
            head = dot.start()
        if text[start - 1:start] not in _ATOM or start == floor:
            continue
        here = [(a, b, ".") for a, b in reversed(named)] + [(start, end, "@")] + [(a, b, ".") for a, b in dots]
        edits += [e for e in here if text[e[0]:e[1]] != e[2]]
        floor = dots[-1][1]
    return edits


def _spoken(text: str, run: list[tuple[int, int, int, str]]) -> tuple[list[tuple[int, int, str]], bool]:
    """The edits of one run of spoken tokens (start, end, kind, word), and whether it is a phone number by itself."""
    while run and run[-1][2] != SAID:
        run.pop()
    if sum(kind == SAID and len(word) > 1 for _, _, kind, word in run) < LEAST_SPELLED:
        return [], False
    edits, digits, said, times, dotted, before = [], 0, 0, 1, False, run[0][0]
    for start, end, kind, word in run:
        gap = text[before:start]
        if gap and gap != ".":
            edits.append((before, start, ""))
        put = SPOKEN[word][1]
        if kind == SAID:
            put, times = put * times, 1
            digits += len(put)
            said += len(word) > 1
        elif kind == TIMES_KIND:
            times = TIMES[word]
        dotted = dotted or gap == "." or put == "."
        if put != text[start:end]:
            edits.append((start, end, put))
        before = end
    return edits, not dotted and LEAST_SPELLED_PHONE <= digits <= 15 and 2 * said > digits


def _number_edits(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]]]:
    """Digits for spelled numbers, and the spans of those long enough to be a phone number by themselves."""
    edits: list[tuple[int, int, str]] = []
    phones: list[tuple[int, int]] = []
    run: list[tuple[int, int, int, str]] = []

    def close():
        here, phone = _spoken(text, run) if run else ([], False)
        edits.extend(here)
        if phone:
            phones.append((run[0][0], run[-1][1]))
        run.clear()

    last = -1  # the end of the token before
    for token in _TOKENS.finditer(text):
        start, end = token.span()
        word = token[0].lower()
        kind, _ = SPOKEN.get(word, (None, None))
        if run:
            gap, digits = text[last:start], len(word) == 1 and len(run[-1][3]) == 1
            if not (_GAP.fullmatch(gap) or digits and gap in ("", ".")):
                if not gap:  # digits glued to letters are no spoken digits
                    while run and run[-1][1] == last and len(run[-1][3]) == 1:
                        last = run.pop()[0]
                close()
        glued, last = start == last, end
        if kind is None or kind == JOIN and (not run or run[-1][2] != SAID):
            close()
        elif kind == PLUS_KIND:
            close()
            run.append((start, end, kind, word))
        elif run or not glued:
            run.append((start, end, kind, word))
    close()
    return edits, phones


def _mixed_edits(text: str) -> list[tuple[int, int, str]]:
    """Digits for letters that stand among digits, where most signs are digits."""
    edits = []
    for mixed in _MIXED.finditer(text):
        letters = [(m, c) for m, c in enumerate(mixed[0], mixed.start()) if c in LETTER_DIGITS]
        if letters and 3 * len(letters) <= len(_digits(mixed[0])):
            edits += [(at, at + 1, LETTER_DIGITS[c]) for at, c in letters]
    return edits


class PersonalDataFinder:
    """All spans of a text: those of the plain patterns and those of the rewritten text."""

    def __init__(self):
        self.table = letter_table()
        low = "".join(sorted(c for c in self.table if c < "\u0100"))
        self._odd = re.compile(f"[{low}\u0100-\U0010ffff]")  # the table decides; a class of all its keys is slow

    def disguised_spans(self, text: str) -> list[tuple[int, int, int]]:
        """Spans that exist only in the rewritten text, mapped back to the text."""
        edits = []
        if not text.isascii():
            edits = [(m.start(), m.end(), self.table[m[0]]) for m in self._odd.finditer(text) if m[0] in self.table]
        letters = Rewritten(text, edits)
        words = _WORDS.findall(letters.text.lower())
        numbers, spelled = [], []
        if sum(map(DIGIT_WORDS.__contains__, words)) >= LEAST_SPELLED:
            numbers, spelled = _number_edits(letters.text)
        signed = "@" in letters.text or not _AT_SET.isdisjoint(words)
        addresses = _address_edits(letters.text) if signed else []
        taken, edits = -1, []
        for edit in sorted(numbers + addresses + _mixed_edits(letters.text)):
            if edit[0] >= taken:
                edits.append(edit)
                taken = edit[1]
        if not edits and not letters.edits:
            return []
        phrases = Rewritten(letters.text, edits)
        found = [(PHONE, *letters.back(*span)) for span in spelled]
        for kind, start, end in plain_spans(phrases.text):
            middle = phrases.back(start, end)
            if phrases.touches(start, end) or letters.touches(*middle):
                found.append((kind, *letters.back(*middle)))
        return found

    def find(self, text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Plain spans, and all spans, both by kind and start."""
        if not text:
            return [], []
        plain = plain_spans(text)
        added = [s for s in set(self.disguised_spans(text)) if not any(
            s[0] == k and a <= s[1] and s[2] <= b for k, a, b in plain[_first(plain, s):_first(plain, s) + 2]
        )]
        kept, reach = [], {}
        for kind, start, end in sorted(added, key=lambda s: (s[0], s[1], -s[2])):
            if end > reach.get(kind, -1):  # none inside another of its kind
                kept.append((kind, start, end))
                reach[kind] = end
        return plain, sorted(plain + kept)


def _first(plain: list[tuple[int, int, int]], span: tuple[int, int, int]) -> int:
    """Number of the last plain span of the same kind that starts no later, or the next one."""
    return max(0, bisect_right(plain, (span[0], span[1], sys.maxsize)) - 1)


def shown(spans: list[tuple[int, int, int]]) -> list[str]:
    return [f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans]


def find_personal_data(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``plain`` (spans of the plain patterns) and ``spans`` (those and the disguised ones) for every row.

    A span is ``kind:start:end`` in code points, the end exclusive; spans are sorted by kind as in ``KINDS``, then start.
    """

    def make():
        finder = PersonalDataFinder()

        def run(texts):
            found = [finder.find(t) for t in texts]
            return {"plain": [shown(p) for p, _ in found], "spans": [shown(s) for _, s in found]}

        return run

    return map_texts(docs, keep, text, make, {"plain": pa.list_(pa.string()), "spans": pa.list_(pa.string())})
