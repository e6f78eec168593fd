"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewarden.llm import spelling


def near(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) - len(u) == 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute_groups(docs, least_length=5, least_count=3, damage_every=97):
    counts = Counter()
    for key, text in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            mark = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if mark % damage_every == 0:
                run = run[:mark % len(run)] + run[mark % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    forms, result = {}, []
    for word, n in words.items():
        found = sorted((v for v in words if near(word, v)), key=lambda v: (-words[v], v))
        forms[word] = (found[0] if found and words[found[0]] >= 2 * n else None, len(found))
    for word, n in words.items():
        form, n_near = forms[word]
        root = word
        while forms[root][0]:
            root = forms[root][0]
        result.append((word, form, root, n, n_near, words.get(form)))
    return sorted(result, key=str)


def entries(words, splits):
    """Words filed under both halves, with the open part halved so often again."""
    rows = []
    for word, n in words.items():
        for base in (len(word), len(word) - 1):
            if base < 2:
                continue
            parts = [(base // 2, 0), (0, base - base // 2)]
            for _ in range(splits):
                finer = []
                for head, tail in parts:
                    middle = base - head - tail
                    finer += [(head + middle // 2, tail), (head, tail + middle - middle // 2)] if middle > 1 else [(head, tail)]
                parts = finer
            rows += [(word, n, base, *part) for part in parts]
    return pa.table({c: [r[i] for r in rows] for i, c in enumerate(("word", "n", "base", "head", "tail"))})


@pytest.mark.parametrize("letters", ["ab", "abcé", "xy\U0001f642"])
def test_search_finds_every_near_word_once(letters):
    for seed in range(120):
        dice = random.Random(seed)
        words = {"".join(dice.choice(letters) for _ in range(dice.randint(2, 9))): dice.randint(1, 9)
                 for _ in range(dice.randint(1, 70))}
        found = spelling.shard_neighbours(entries(words, seed % 4)).to_pylist()
        expected = {}
        for word in words:
            others = sorted((v for v in words if near(word, v)), key=lambda v: (-words[v], v))
            if others:
                expected[word] = (len(others), others[0], words[others[0]])
        assert {r["word"]: (r["n_near"], r["form"], r["form_n"]) for r in found} == expected


def corpus(seed):
    dice = random.Random(seed)
    words = ["".join(dice.choice("abé") for _ in range(dice.randint(1, 8))) for _ in range(60)]
    rows = [(i, " ".join(dice.choice(words) for _ in range(60))) for i in range(30)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (98, None), (99, ""), (100, "ABABE Ababe ababÉ ababé,ababe;×ab÷ab " * 3)]
    return rows + [(101, "a" * 50_000 + " ") , (102, ("b" * 3_000 + " ") * 3), (103, ("b" * 2_999 + " ") * 9)]


def collected(frame):
    return sorted((tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_groups(spark):
    rows = corpus(1)
    docs = spark.createDataFrame([(k, t, "w", 1) for k, t in rows], "doc_id long, text string, word string, n long").repartition(3)
    assert collected(spelling.group_variants(docs)) == brute_groups(rows)
    assert collected(spelling.group_variants(docs.limit(0))) == []


def test_hot_halves_are_split(spark):
    dice = random.Random(5)
    listed = {"prefix" + "".join(dice.choice("abc") for _ in range(6)) for _ in range(300)}
    listed |= {"".join(dice.choice("abc") for _ in range(5)) + "suffix" for _ in range(300)}
    words = spark.createDataFrame([(w, dice.randint(1, 50)) for w in sorted(listed)], "word string, n long")
    split = spelling.split_hot(spelling.windows(words, 5), key_words=8)
    held = split.groupBy("key").agg(F.count("*").alias("held"), F.max(F.expr("base - head - tail")).alias("open"))
    assert held.where("held > 8 and open > 1").isEmpty()
    counts = {r.word: r.n for r in words.collect()}
    found = {r.word: (r.n_near, r.form, r.form_n) for r in spelling.neighbours(words, 5, key_words=8).collect()}
    expected = {}
    for word in counts:
        others = sorted((v for v in counts if near(word, v)), key=lambda v: (-counts[v], v))
        if others:
            expected[word] = (len(others), others[0], counts[others[0]])
    assert found == expected


def test_chains(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(20)] + [("a", "w03"), ("b", "a")]
    found = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert found == {w: "w20" for w, _ in chain}
