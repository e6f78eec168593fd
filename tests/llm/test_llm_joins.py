"""The joins over documents against plain Python, on corpora with copies, ties and odd rows."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute
from tablewarden.llm import decontaminate, line_dedup, ngram_join, repeats
from tablewarden.llm.components import connected_components

ROWS = brute.corpus(7) + [(100 + i, t) for i, t in enumerate(brute.ODD_TEXTS)] + [
    (3, brute.corpus(7)[3][1]), (None, "no key but words enough for a shingle or two of them"), (None, None),
]
# Clashing names of results and helpers; no operator may read or trip over them.
EXTRA = ", mark string, n long, key string, tokens int, links int, component int, spans int, batch int, kind string"


def frame(spark, rows, extra: bool = True):
    if extra:
        return spark.createDataFrame(
            [(k, t, "m", 1, "k", 2, 3, 4, 5, 6, "z") for k, t in rows], f"doc_id long, text string{EXTRA}"
        ).repartition(3)
    return spark.createDataFrame(rows, "doc_id long, text string")


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def collected(df, *columns):
    return order(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


def test_classes(docs):
    found = ngram_join.jaccard_classes(docs)
    assert collected(found, "doc_id", "n_shingles", "component") == order(brute.classes(ROWS))


def test_classes_of_a_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        words[(7 * i) % 120], words[(31 * i) % 120] = f"x{i}", f"y{i % 5}"
        rows.append((i, " ".join(words)))
    found = ngram_join.jaccard_classes(frame(spark, rows, extra=False))
    assert collected(found, "doc_id", "n_shingles", "component") == order(brute.classes(rows))


def test_components(spark):
    links = [(f"n{i:03}", f"n{i + 1:03}") for i in range(0, 40)] + [("a", "b"), ("c", "b"), ("z", "z")]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert {k: v for k, v in found.items() if k.startswith("n")} == {f"n{i:03}": "n000" for i in range(41)}
    assert (found["a"], found["b"], found["c"]) == ("a", "a", "a")


def test_lines(docs):
    found = line_dedup.dedup_lines(docs)
    expected = brute.dedup_lines(sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None)))
    assert collected(found, "doc_id", "n_lines", "n_removed", "text") == order(expected)


def test_lines_carry_other_columns(docs):
    found = line_dedup.dedup_lines(docs, carry=("tokens", "mark"))
    assert {(r.tokens, r.mark) for r in found.collect()} == {(2, "m")}
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs.withColumnRenamed("links", "n_lines"), carry=("n_lines",))


def test_near_copies_of_one_line(spark):
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        own = list(words)
        own[(11 * i) % 60] = f"x{i}"
        if i % 3 == 0:
            own[(29 * i) % 60] = f"y{i}"
        rows.append((i, " ".join(own) + f"\nline {i} of its own text that is not like others {i} {i}"))
    found = line_dedup.dedup_lines(frame(spark, rows, extra=False))
    assert collected(found, "doc_id", "n_lines", "n_removed", "text") == order(brute.dedup_lines(rows))


def test_contamination(spark, docs):
    some = [t for _, t in brute.corpus(7) if len(t.split()) > 30]
    items = [
        (1, " ".join(some[0].split()[3:25])), (2, " ".join(some[0].split()[10:40]).upper()), (10, some[1]),
        (3, "no such words anywhere in this corpus of invented ones at all"), (4, " ".join(some[2].split()[:3])),
        (5, None), (6, "---"), (7, some[0].split()[5]), (None, " ".join(some[3].split()[:12])), (1, some[4]),
        (8, "a a a a a a a a a a a a"),
    ]
    bench = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, hash int, size int")
    found = decontaminate.find_contamination(docs, bench)
    expected = brute.contamination(ROWS, items)
    assert collected(found, "doc_id", "n_words", "n_hit", "items") == order(expected)
    assert all(r.contaminated == (r.n_hit > 0) for r in found.collect())


def test_contamination_without_items(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.find_contamination(docs, bench, carry=("mark",))
    assert collected(found, "doc_id", "n_words", "n_hit", "items") == order(brute.contamination(ROWS, []))


@pytest.mark.parametrize("keep_first,crowd", [(False, 1000), (True, 1000), (False, 1), (True, 1)])
def test_repeats(docs, monkeypatch, keep_first, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    found = repeats.remove_repeats(docs, length=100, keep_first=keep_first)
    assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == order(
        brute.repeats(rows, 100, keep_first))


def test_repeats_within_one_long_text(spark):
    unit = "".join(f"{i:05d}," for i in range(200))
    rows = [(1, unit + "middle" + unit), (2, "z" * 5000), (3, "nothing of the kind " + "".join(f"{i}/" for i in range(900)))]
    found = repeats.remove_repeats(frame(spark, rows, extra=False))
    assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == order(brute.repeats(rows, 400))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    assert ngram_join.jaccard_classes(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert repeats.remove_repeats(none).count() == 0
    assert decontaminate.find_contamination(none, bench).count() == 0


def test_line_dedup_counts_in_compiled_code_and_drops_steps_once_read(spark, monkeypatch):
    steps, left, plans = {}, [], {}

    def watched(df, label, passing=None, write=line_dedup.written):
        if label == "removed":
            left.extend(name for name, path in steps.items() if os.path.exists(path.removeprefix("file:")))
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        found = write(df, label, passing)
        if passing:
            steps[label] = passing[-1]
        return found

    monkeypatch.setattr(line_dedup, "written", watched)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[: i % 50], f"x{i}", *base[i % 50:]])) for i in range(40)]
    found = line_dedup.dedup_lines(frame(spark, rows, extra=False))
    assert collected(found, "doc_id", "n_lines", "n_removed", "text") == order(brute.dedup_lines(rows))
    assert "lambda" not in plans["counters"]
    assert {"lines", "lists", "line-sets"} <= set(steps)
    assert not {"counters", "lines", "tokens", "lists", "open-lists", "line-sets"} & set(left)


def test_words_of_a_line(spark):
    lines = ["", " ", "a", " a", "a ", "a  b", "a b", "a\tb", "a\u00a0b c", "a\r", "\x0ba b", "a b\x0c c", "\u2028x y"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    found = df.select("line", line_dedup.line_words(df["line"]).alias("words")).collect()
    assert {r.line: r.words for r in found} == {x: [w for w in re.split(r"[\x20\x09-\x0D]+", x) if w] for x in lines}


def test_line_dedup_moves_few_rows_when_bit_tables_are_full(spark, monkeypatch):
    """Full tables let everything pass and counters tell nothing, as on a large corpus: only lines of pairs get token
    sets, and lines that share a passage without being similar make no pairs."""
    counted = {}

    def watched(df, label, passing=None, write=line_dedup.written):
        found = write(df, label, passing)
        if label in ("lists", "pairs", "more-pairs", "line-sets"):
            counted[label] = counted.get(label, 0) + found.count()
        return found

    monkeypatch.setattr(line_dedup, "written", watched)
    monkeypatch.setattr(line_dedup, "FILTER_BITS", 64)
    monkeypatch.setattr(line_dedup, "COUNTERS", 16)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([*(f"a{i}x{j}" for j in range(i % 20)), *passage, *(f"b{i}x{j}" for j in range(20 - i % 20))]))
            for i in range(60)]
    rows += [(100 + i, " ".join(f"c{i}x{j}" for j in range(40))) for i in range(60)]
    rows += [(200, " ".join(f"c{7}x{j}" if j != 39 else "z" for j in range(40)))]
    found = line_dedup.dedup_lines(frame(spark, rows, extra=False))
    assert collected(found, "doc_id", "n_lines", "n_removed", "text") == order(brute.dedup_lines(rows))
    assert counted["lists"] > 100
    assert counted["pairs"] + counted["more-pairs"] == 1
    assert counted["line-sets"] == 2


def test_parity_bits_are_no_more_than_different_tokens(spark):
    sets = [[], [5], [5, 5 + 128, 6], [-1, 2**57], list(range(-300, 300, 7)), list(range(-300, 307, 7)), list(range(500))]
    df = spark.createDataFrame([(t,) for t in sets], "tokens array<bigint>")
    found = [tuple(r) for r in df.select("tokens", *line_dedup.parity_bits(df["tokens"])).collect()]
    assert {x for _, *bits in found for x in bits} != {0}
    for t_1, *bits_1 in found:
        for t_2, *bits_2 in found:
            bits = sum(((a ^ b) % 2**64).bit_count() for a, b in zip(bits_1, bits_2))
            assert bits <= len(set(t_1) ^ set(t_2))
            assert bits % 2 == len(set(t_1) ^ set(t_2)) % 2
