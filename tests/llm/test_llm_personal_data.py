"""Personal data: plain spans against the patterns as they are written, disguised ones against marked texts."""

import random
import re
import time

import pytest

from tablewarden.llm import personal_data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_plain(text):
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


@pytest.fixture(scope="module")
def finder():
    return personal_data.PersonalDataFinder()


@pytest.mark.parametrize("signs", ["ab.@_-é", "0123456789.", "0123456789 -", "+01 ().-9a", "a@.1+ -()", "4 2-0"])
def test_plain_spans(signs, finder):
    for seed in range(1500):
        dice = random.Random(seed)
        text = "".join(dice.choice(signs) for _ in range(dice.randint(0, 70)))
        assert personal_data.plain_spans(text) == brute_plain(text), text
        plain, spans = finder.find(text)
        assert set(plain) <= set(spans)


# The marked part is the disguised identifier.
DISGUISED = [
    ("email", "write to <<john dot smith at example dot com>> today"),
    ("email", "mail <<bob [at] host [dot] co.uk>> now"),
    ("email", "<<jane(at)mail.example.org>>."),
    ("email", "<<jane @ mail.org>> ok"),
    ("email", "<<ana arroba correo punto es>>"),
    ("email", "<<jo AT host DOT net>>"),
    ("email", "é <<jea​n@exаmple.com>> é"),
    ("email", "🙂 <<ｊｏｅ＠ｈｏｓｔ．ｃｏｍ>>"),
    ("phone", "call <<plus four nine one seven six five five five one two three four>> now"),
    ("phone", "<<zero one seven six double five five one two three four>>"),
    ("phone", "Tel. <<+33\xa01\xa023\xa045\xa067\xa089>>"),
    ("card", "card <<4O12 8888 8888 1881>> x"),
    ("card", "<<four zero one two eight eight eight eight eight eight eight eight one eight eight one>>"),
    ("card", "<<vier null eins zwei acht acht acht acht acht acht acht acht eins acht acht eins>>"),
    ("card", "<<4012–8888–8888–1881>>"),
    ("card", "<<٤٠١٢٨٨٨٨٨٨٨٨١٨٨١>>"),
    ("ip", "server <<one nine two dot one six eight dot zero dot one>> ok"),
    ("ip", "<<192․168․0․1>>"),
]


@pytest.mark.parametrize("kind, marked", DISGUISED)
def test_disguised(kind, marked, finder):
    start, end = marked.index("<<"), marked.index(">>") - 2
    text = marked.replace("<<", "").replace(">>", "")
    plain, spans = finder.find(text)
    assert plain == [] and personal_data.shown(spans) == [f"{kind}:{start}:{end}"]


@pytest.mark.parametrize("text", [
    "hello @user.name", "look at this point where", "we met at example.com", "we looked at the dot com era",
    "one two three go", "un deux trois soleil", "there are six of them at eight", "page 10-20, 2.5 and 3.7",
    "plus one", "4012 8888 8888 1882", "at dot at dot", "[at] [dot] com", "О компании и людях",
    "one two 3x four five six seven eight nine one two three",
])
def test_clean(text, finder):
    assert finder.find(text) == ([], [])


def test_plain_spans_stay(finder):
    text = "bob@example.com at host dot org 10.0.0.1"
    plain, spans = finder.find(text)
    assert personal_data.shown(plain) == ["email:0:15", "ip:32:40"] and set(plain) <= set(spans)


def test_long_texts_take_linear_time(finder):
    for part in ("1", "1.", " at ", "a dot ", "a at a dot com ", "one ", "+1 ", "O1", "a@", "( ", "​", "double ", "a@b."):
        started = time.time()
        finder.find(part * 60_000)
        assert time.time() - started < 8, part


def test_frame(spark):
    rows = [(1, "a@b.c or d [at] e [dot] fr"), (2, None), (3, ""), (1, "a@b.c or d [at] e [dot] fr"), (None, "x" * 200_000)]
    docs = spark.createDataFrame([(k, t, "s", "p") for k, t in rows], "doc_id long, text string, spans string, plain string")
    found = personal_data.find_personal_data(docs).collect()
    got = sorted(((r.doc_id, r.plain, r.spans) for r in found), key=str)
    one = (1, ["email:0:5"], ["email:0:5", "email:9:26"])
    assert got == sorted([one, one, (2, [], []), (3, [], []), (None, [], [])], key=str)
    assert personal_data.find_personal_data(docs.limit(0)).collect() == []
