"""Operators that read one text at a time: literal cases, reference tokenizers, odd rows, learned labels."""

import os
import random
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute
from tablewarden.llm import (
    bpe_codec, html_extract, language_spans, quality_rules, queries, secret_scan, toxicity,
)

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
EXTRA = "text_in string, kept_0 int, ids int, spans int, score int, script int, kept int"


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, one of them twice, with extra columns whose names clash."""
    rows = [(i, t, "en" if i % 2 else None, "x", 1, 2, 3, 4, 5, 6)
            for i, t in enumerate([*brute.ODD_TEXTS, brute.ODD_TEXTS[4]])]
    return spark.createDataFrame(rows + [(None, "no key", None, "x", 1, 2, 3, 4, 5, 6)],
                                 f"doc_id long, text string, lang string, {EXTRA}")


# Web pages

def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header><p>the site of the year</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div class="ad">buy the best of it</div><article><h1>The  head</h1><p>One &amp; two<br>three&nbsp;&#233;</p>
    <div class="share-buttons"><a>tweet</a></div><p>It<b>al</b>ic <!-- no --> end</p>
    <div id="comments"><p>I like it</p></div></article><aside><p>more of the same</p></aside>
    <form><input><p>sign up for the news</p></form><footer>&copy; us</footer></body></html>"""
    assert html_extract.main_text(page) == "The head One & two three é Italic end"


def test_page_without_a_marked_article():
    good = "The cat sat on the mat and it was the best of the days that a cat can have in the house by the sea."
    page = (f"<body><div><a href=1>one link to a page</a> <a href=2>and one more of them</a></div><div><p>{good}</p>"
            f"<p>Short one.</p><p>{good}</p></div><div><a href=3>the last link of the page is this one</a></div></body>")
    assert html_extract.main_text(page) == f"{good} Short one. {good}"


GOOD = "The cat sat on the mat and it was the best of the days that a cat can have in the house by the sea."
TEASER = "<article><h3><a href=1>A story of the other day</a></h3><p>What it was in the end.</p></article>"
LINKS = "<div><a href=1>one link to a page</a> <a href=2>and one more of them</a></div>"


@pytest.mark.parametrize("page,text", [
    # the body in plain divs, teasers marked as articles
    (f"<body><div><h1>Head</h1><p>{GOOD}</p><p>Short.</p><p>{GOOD}</p></div>{TEASER * 3}</body>", f"Head {GOOD} Short. {GOOD}"),
    # the body in the largest article, teasers beside it
    (f"<main>{TEASER}<article><h1>Head</h1><p>{GOOD}</p><p>Short.</p></article>{TEASER * 2}</main>", f"Head {GOOD} Short."),
    # unmarked boilerplate in main
    (f"<main>{LINKS}<p>Menu of the site</p>{LINKS}<h1>Head</h1><p>{GOOD}</p><p>{GOOD}</p>{LINKS}<p>Terms apply.</p>{LINKS}"
     "<p>© 2020 by the owner of the site</p></main>", f"Head {GOOD} {GOOD}"),
    # a headline around the marked body, part of the body behind it
    (f"<article><h1>Head</h1><div itemprop=articleBody><p>{GOOD}</p><p>{GOOD}</p></div></article>", f"Head {GOOD} {GOOD}"),
    # an article of short lines, nothing good in it, text around
    ("<p>Our site</p><article><p>One line of verse,</p><p>one more of it</p></article><p>By us</p>",
     "One line of verse, one more of it"),
    (f"<article><p>{GOOD}</p></article><article><p>{GOOD}</p></article>", f"{GOOD} {GOOD}"),
])
def test_marks_are_one_feature(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("just words", "just words"), ("<p>", ""), ("<p>a<p>b", "a b"), ("a &lt;b&gt; c", "a <b> c"),
    ("<article><p>cut off &amp", "cut off &"), ("<article>a<script>x", "a"), ("<article><p>a</p><p>b <a hre", "a b"),
])
def test_odd_pages(page, text):
    assert html_extract.main_text(page) == text


def test_pages_table(spark):
    df = spark.createDataFrame([(1, "u", "<article>a  b</article>", "x"), (1, "u", "<article>a  b</article>", "x"),
                                (None, None, None, None)], "page_id long, url string, html string, text_in string")
    rows = html_extract.extract_main_text(df).collect()
    assert sorted(map(str, rows)) == sorted([
        "Row(page_id=1, url='u', text='a b', n_chars=3)"] * 2 + ["Row(page_id=None, url=None, text='', n_chars=0)"])
    assert html_extract.extract_main_text(df.limit(0)).count() == 0


def test_articles_of_the_sample(spark):
    pages = pq.read_table(f"{SF}/pages.parquet").to_pandas()
    found = queries.QUERIES["op1_html_extraction"](spark, SF).toPandas().set_index("page_id")
    for page, html in zip(pages.page_id, pages.html):
        inner = re.search(r"<article>(.*)</article>", html, re.S)[1]
        words = html_extract.entities.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?!b>)[a-z0-9]+>", " ", inner))).split()
        assert found.text[page].split() == words


# Secrets

def spans(text):
    return secret_scan.joined(secret_scan.scan(text))


@pytest.mark.parametrize("text,found", [
    (None, ""), ("", ""), ("password=abc", ""), ("PassWord : 'abcdefgh'", "assign:0:20"),
    ("token = \"0123456789abcdef0123456789abcdef\"", "assign:0:41,hex:9:41"), ("AKIA0123456789AB", "access:0:16"),
    ("AKIA0123456789", ""), ("0123456789ABCDEF0123456789ABCDEF", ""), ("ſecret=abcdefgh1", ""),
    ("é api_key=abcdefgh", "assign:2:18"), ("secret=abcdefgh.secret=12345678", "assign:0:31"),
])
def test_patterns(text, found):
    assert ",".join(s for s in spans(text).split(",") if not s.startswith("literal")) == found


def test_constants_reach_sensitive_names():
    text = 'a = "xK9f2LmQ77pZ"\nb = a\nclient_secret = b\nname = "Kx9f2LmQ77pZ"'
    assert spans(text) == "literal:5:17"
    assert spans('db_passphrase: "corr3ct-horse"') == "literal:16:29"
    assert spans('private_key = "AAb3Cd9f" + "8E7Zz0Qq"') == "literal:15:23,literal:28:36"
    assert spans('public_key = "AAb3Cd9f8E7Zz0Qq"\ntoken_length = "AAb3Cd9f8E7Zz0Qq"') == ""
    assert spans("The author: nothing. Note: the token for it. a = b") == ""


def test_whole_constants_and_names():
    pieces = [f"xK9f2LmQ{i:02d}pZ" for i in range(40)]
    lines = [f'p{i} = "{p}"' for i, p in enumerate(pieces)]
    text = "\n".join([*lines, "whole = " + " + ".join(f"p{i}" for i in range(40)), "client_secret = whole"])
    found = [text[a:b] for a, b in secret_scan.named_literals(text)]
    assert found == pieces
    text = "settings." * 20 + 'private_key = "xK9f2LmQ77pZ"'
    assert [text[a:b] for a, b in secret_scan.named_literals(text)] == ["xK9f2LmQ77pZ"]
    text = 'auth_key = "xK9f2LmQ77pZ" +\n    "Yw3rT8vBn1sD"\n  + "Qm5zR0hJk4cE"\nother = 1'
    assert [text[a:b] for a, b in secret_scan.named_literals(text)] == ["xK9f2LmQ77pZ", "Yw3rT8vBn1sD", "Qm5zR0hJk4cE"]
    # an open sum and the lines of a diff
    text = 'auth_key = "xK9f2LmQ77pZ" + (\n+signing_key = "Yw3rT8vBn1sD"\n+private_key = "Qm5zR0hJk4cE"\n'
    assert [text[a:b] for a, b in secret_scan.named_literals(text)] == ["xK9f2LmQ77pZ", "Yw3rT8vBn1sD", "Qm5zR0hJk4cE"]
    # sums of sums: shared, not copied
    text = "\n".join(['a0 = "xK9f2LmQ77pZ"', *(f"a{i + 1} = a{i} + a{i}" for i in range(60)), "client_secret = a60"])
    assert secret_scan.named_literals(text) == [(6, 18)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="passwordtokenAKIA=:\"' 0123456789abcdef_É\n+", max_size=120))
def test_patterns_are_kept_whatever_the_text(text):
    base = [("assign", *m.span()) for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 8]
    base += [("access", *m.span()) for m in secret_scan.ACCESS.finditer(text) if len(m[0]) >= 16]
    base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    base.sort(key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))
    assert [s for s in secret_scan.scan(text) if s[0] != "literal"] == base


def test_scan_of_odd_rows(spark, odd):
    assert {tuple(r.spans) for r in secret_scan.scan_secrets(odd).collect()} == {()}
    assert secret_scan.scan_secrets(odd.limit(0)).count() == 0


# Quality

def repeated(words):
    three = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, t in enumerate(three) if three.count(t) > 1 for k in range(3)})


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n\t#|\x0b é\xa0", max_size=60))
def test_base_counts(text):
    words = brute.words_of(text)
    lines = text.split("\n")
    copies = sum(bool(brute.words_of(x)) and x in lines[:i] for i, x in enumerate(lines))
    assert quality_rules.base_counts(text) == (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, repeated(words))


def test_quality_of_odd_rows(spark, odd):
    found = quality_rules.quality_signals(odd, PIECES).toPandas()
    assert len(found) == 10 and not found.kept.any()
    assert found[found.doc_id == 5].n_repeat_words.item() == 20000
    assert quality_rules.quality_signals(odd.limit(0), PIECES).count() == 0


def test_measures_are_those_of_the_library():
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = pieces.encode("the cat of 漢 字")
    tokens, per, share, bits = quality_rules.Fertility(PIECES).measure(" the\tcat of \n漢 字 ")
    chance = np.unique(ids, return_counts=True)[1] / len(ids)
    assert (tokens, per) == (len(ids), len("the cat of 漢 字") / len(ids))
    assert share == pytest.approx(sum(map(pieces.is_byte, ids)) / len(ids))
    assert bits == pytest.approx(-(chance * np.log2(chance)).sum())


def test_verdicts_agree_with_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = pq.read_table(f"{sf}/labels.parquet").to_pandas()
    found = queries.QUERIES["op5_quality_rules"](spark, sf).toPandas().merge(labels, on="doc_id")
    found = found[~found.base_failed]
    assert (found.kept == (found.quality == 1)).mean() > 0.97
    assert found[found.quality == 1].kept.mean() > 0.99


# Byte-pair encoding

@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(WORDS)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.WordCodec(WORDS)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(
    st.text(max_size=8), st.text(alphabet="etaoinshrdlu' .,!-1Σςİß", max_size=14),
    st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", " ", "\x1c", "\x85", " ", "it's", "½", "ﬁ", "é"]),
), max_size=8).map("".join))
def test_encoding_is_that_of_the_library(codec, library, text):
    text = text.encode("utf-8", "ignore").decode()
    right = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == right
    assert codec.decode(right) == library.decode(right, skip_special_tokens=False)


def test_codec_of_odd_rows(spark, odd, library):
    found = bpe_codec.encode_texts(odd, WORDS, decoded=True, keep=("doc_id", "text"))
    for row in found.collect():
        right = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == right and row.decoded == library.decode(right, skip_special_tokens=False)
    again = bpe_codec.decode_ids(found, WORDS)
    assert {(r.doc_id, r.decoded) for r in again.collect()} == {(r.doc_id, r.decoded) for r in found.collect()}
    assert bpe_codec.encode_texts(odd.limit(0), WORDS).count() == 0


def test_gadgets_match_plain_merging():
    """The automaton against merging by rank, on vocabularies with merges that never apply."""
    import random
    dice = random.Random(5)
    for _ in range(60):
        merges, known = [], ["a", "b", "c", "a</w>", "b</w>", "c</w>"]
        for _ in range(12):
            pair = (dice.choice(known), dice.choice(known))
            if not pair[0].endswith("</w>") and pair not in merges and "".join(pair) not in known:
                merges.append(pair)
                known.append("".join(pair))
        machine = bpe_codec.TokenAutomaton({t: i for i, t in enumerate(known)}, [" ".join(p) for p in merges])
        for _ in range(60):
            word = "".join(dice.choice("abc") for _ in range(dice.randint(1, 9)))
            tokens = [*word[:-1], word[-1] + "</w>"]
            while True:
                ranks = [(merges.index(p), i) for i, p in enumerate(zip(tokens, tokens[1:])) if p in merges]
                if not ranks:
                    break
                rank = min(ranks)[0]
                out, i = [], 0
                while i < len(tokens):
                    if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) == merges[rank]:
                        out.append(tokens[i] + tokens[i + 1])
                        i += 2
                    else:
                        out.append(tokens[i])
                        i += 1
                tokens = out
            assert machine.encode_word(word) == tokens, (merges, word)


# Languages

def slow_viterbi(scores, penalty):
    value, back = scores[0].astype(float), []
    for row in scores[1:]:
        moved = value.max() - penalty
        back.append([i if value[i] >= moved else int(value.argmax()) for i in range(len(value))])
        value = np.maximum(value, moved) + row
    labels = [int(value.argmax())]
    for step in reversed(back):
        labels.append(step[labels[-1]])
    return labels[::-1]


def test_viterbi_of_many_texts_at_once():
    dice = np.random.default_rng(3)
    scores = dice.normal(size=(50, 3)).astype(np.float32)
    texts = [dice.integers(0, 50, n) for n in (0, 1, 7, 30, 30, 200)]
    for ids, labels in zip(texts, language_spans.viterbi(texts, scores, 2.0)):
        assert labels.tolist() == (slow_viterbi(scores[ids], 2.0) if len(ids) else [])


def test_viterbi_of_many_labels():
    scores = np.full((200, 200), -5, np.float32)
    np.fill_diagonal(scores, 0)
    found = language_spans.viterbi([np.repeat([150, 199, 3], 9)], scores, 8.0)
    assert found[0].tolist() == [150] * 9 + [199] * 9 + [3] * 9


def test_languages_by_script_and_letters(spark, odd):
    model = language_spans.LanguageModel([
        ("en", "the cat and the dog of the house with that thing"), ("de", "der hund und die katze mit dem haus ist nicht"),
        ("el", "η γάτα και ο σκύλος του σπιτιού"), ("ru", "кошка и собака этого дома"),
    ])
    labeller = language_spans.SpanLabeller(model, 4.0)
    found = labeller(["the thing and the dog", "και του σπιτιού", "этого дома", None, "12 !?", "日本",
                      "the cat and the dog of the house der hund und die katze mit dem haus"])
    assert found["lang_pred"][:5] == ["en", "el", "ru", "und", "und"] and found["lang_pred"][5] in ("de", "el", "en", "ru")
    assert found["spans"][6] == ["en:0:7", "de:7:16"]
    assert all(0 <= s <= 1 for s in found["score"])
    rows = language_spans.label_languages(odd, model).collect()
    assert len(rows) == 10 and {r.lang_pred for r in rows if r.doc_id in (0, 1, 2)} == {"und"}
    nothing = language_spans.train(odd.limit(0))
    assert {r.lang_pred for r in language_spans.label_languages(odd, nothing).collect()} == {"und"}


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    docs = pq.read_table(f"{sf}/documents.parquet").to_pandas()
    found = queries.QUERIES["op8_language_id"](spark, sf).toPandas().merge(docs, on="doc_id")
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]).all()
    held = found[found.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98


# Toxicity

def slow_kernel(s, t, order=3, decay=0.75):
    from itertools import combinations
    total = 0.0
    for a in combinations(range(len(s)), order):
        for b in combinations(range(len(t)), order):
            if [s[i] for i in a] == [t[i] for i in b]:
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_subsequence_kernel():
    words = ["idiot", "idxiot", "tidy", "dot", "io"]
    found = toxicity.kernel(toxicity.codes(words, 6, 0), toxicity.codes(words, 6, -1))
    own = toxicity.self_kernel(toxicity.codes(words, 6, 0))
    for i, a in enumerate(words):
        assert own[i] == pytest.approx(slow_kernel(a, a), rel=1e-4, abs=1e-6)
        for j, b in enumerate(words):
            assert found[i, j] == pytest.approx(slow_kernel(a, b), rel=1e-4, abs=1e-6)


def toxic_sample():
    import random
    dice = random.Random(2)
    plain = ["".join(dice.choice("aeioulmnprst") for _ in range(dice.randint(2, 8))) for _ in range(300)]
    bad = ["gribbox", "wazzock", "numpty"]
    out = []
    for i in range(240):
        words = [dice.choice(plain) for _ in range(40)]
        if i % 3 == 0:
            words.insert(dice.randrange(40), dice.choice(bad))
        out.append((int(i % 3 == 0), " ".join(words)))
    return out


def test_gapped_insults(spark, odd):
    model = toxicity.ToxicityModel(toxic_sample())
    scorer = toxicity.TextScorer(model)
    assert set(model.machine.landmarks) >= {"gribbox", "wazzock", "numpty"}
    bad = ["you gribbox!", "w-a-z-z-o-c-k", "n u m p t y", "gri_bbox", "GR1BBOX", "gribxbox", "wazzqock"]
    assert all(s > 0.5 for s in scorer(bad)["score"]), scorer(bad)
    assert all(s < 0.5 for s in scorer([None, "", "some plain words", "a b", "12 34"])["score"])
    rows = toxicity.score_toxicity(odd, model).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    nothing = toxicity.train(odd.limit(0).withColumn("toxic", odd.doc_id))
    assert {r.score for r in toxicity.score_toxicity(odd, nothing).collect()} == {0.0}


def plain_words(dice, n=300):
    return ["".join(dice.choice("aeioulmnprst") for _ in range(dice.randint(2, 8))) for _ in range(n)]


def test_many_and_rare_insults():
    import random
    dice = random.Random(3)
    plain = plain_words(dice)
    bad = ["".join(dice.choice("bcdfghjkqvwxyz") + dice.choice("aeiou") for _ in range(4)) for _ in range(60)]
    out = []
    for i in range(360):  # forty insults in two texts each, twenty in one
        words = [dice.choice(plain) for _ in range(30)]
        if i < 100:
            words.insert(dice.randrange(30), bad[i // 2 if i < 80 else i - 40])
        out.append((int(i < 100), " ".join(words)))
    scorer = toxicity.TextScorer(toxicity.ToxicityModel(out))
    score = scorer([f"you {w} there" for w in bad])["score"]
    assert sum(s > 0.5 for s in score[:40]) >= 38 and sum(s > 0.5 for s in score[40:]) >= 18, score
    clean = scorer([" ".join(dice.choice(plain) for _ in range(30)) for _ in range(100)])["score"]
    assert sum(s > 0.5 for s in clean) <= 5


def test_words_that_are_toxic_together():
    import random
    dice = random.Random(4)
    plain = plain_words(dice)
    out = []
    for i in range(400):
        words = [dice.choice(plain) for _ in range(20)]
        words[:2] = [["zorvak", "blicky"], ["zorvak", words[0]], [words[0], "blicky"], words[:2]][i % 4]
        dice.shuffle(words)
        out.append((int(i % 4 == 0), " ".join(words)))
    scorer = toxicity.TextScorer(toxicity.ToxicityModel(out))
    both, one, other = scorer(["zorvak or the blicky", "zorvak or the other", "other or the blicky"])["score"]
    assert both > 0.5 and one < 0.5 and other < 0.5, (both, one, other)


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    labels = pq.read_table(f"{sf}/labels.parquet").to_pandas()
    found = queries.QUERIES["op3_toxicity"](spark, sf).toPandas()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    held = found.merge(labels, on="doc_id").query("held_out")
    assert (held.predicted == held.toxic).mean() > 0.9


PROSE = "The house that is on the hill was built by a man who had come to the town with his family in the spring. " * 4


@pytest.mark.parametrize("words", [
    "content no-sidebar", "has-sidebar layout", "post comments-open", "article-search", "social-science", "header-fixed page",
    "page-header",
])
def test_a_word_in_the_class_of_the_whole_page_drops_nothing(words):
    inner = f"<p>{PROSE}</p>" * 3
    around = f'<div class="site-footer"><p>{PROSE}</p></div><div class="comments"><p>{PROSE}</p></div>'
    expected = " ".join([PROSE.strip()] * 3)
    for part in (inner, f"<article>{inner}</article>"):
        assert html_extract.main_text(f'<body><nav><a href=x>Home</a></nav><div class="{words}">{part}</div>{around}</body>') == expected
    assert html_extract.main_text(
        f'<div class="comment-list"><p>{PROSE * 9}</p></div><article>{inner}</article>{around}') == expected


def test_formulas_stay():
    assert "x=2" in html_extract.main_text(f"<article><p>{PROSE} <math><mi>x</mi>=<mn>2</mn></math> is {PROSE}</p></article>")


def test_tags_without_an_end_take_linear_time():
    import time

    for part in ('<a "x ', "<a ", "<a '\" ", "<a x='", "< ", "<b \"'"):
        started = time.time()
        html_extract.main_text(part * 150_000)
        assert time.time() - started < 10, part
    assert html_extract.main_text(f'<p>a <b {PROSE}</p><p title="1 > 0">{PROSE}</p>').endswith(PROSE.strip())


def test_many_assignments_take_linear_time():
    import time

    started = time.time()
    found = secret_scan.scan("".join(f'password = "hunter{i}Abc!x"\n' for i in range(30_000)))
    assert time.time() - started < 10 and len(found) >= 30_000


def test_literals_are_covered_like_by_comparing_all():
    dice = random.Random(11)
    parts = ['password = "', 'token: ', "AKIA" + "A" * 14, "0123456789abcdef" * 2, '"', "x9Kq!pLm2", "\n", "secret=", " ", "+", "key = "]
    for _ in range(400):
        text = "".join(dice.choice(parts) for _ in range(dice.randint(1, 25)))
        spans = secret_scan.scan(text)
        base = [(a, b) for kind, a, b in spans if kind != "literal"]
        told = [(a, b) for kind, a, b in spans if kind == "literal"]
        assert told == sorted((a, b) for a, b in secret_scan.named_literals(text) if not any(x <= a and b <= y for x, y in base))


def test_toxicity_without_shared_or_clean_words():
    for samples, learned in (([(1, "you idiot")], True), ([(1, "you idiot"), (0, "extraordinarily")], True), ([(0, "x")], False), ([], False)):
        assert (toxicity.ToxicityModel(samples).machine is not None) == learned


def test_slices_of_texts_by_bytes():
    import pyarrow as pa

    from tablewarden.llm.common import text_slices

    texts = ["a" * 10, None, "b" * 500, "é" * 30, "", "c" * 90] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    parts = [p.column(0).to_pylist() for p in text_slices(batch, 0, 4, 100)]
    assert sum(parts, []) == texts
    assert all(len(p) == 1 or len(p) <= 4 and sum(len((t or "").encode()) for t in p) <= 100 for p in parts)
    assert len(parts) < len(texts)
