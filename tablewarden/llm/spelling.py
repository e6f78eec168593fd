"""Spelling variants: words one edit apart, found in bidirectional FM-indexes, each led to its most frequent neighbour.

1. :func:`word_counts` counts the words of all texts; tasks add up their own counts before the shuffle.
2. :func:`windows` gives every word its search schemes. Of two words that differ by one inserted, deleted or replaced code
   point, with the shorter of length m, either the first m // 2 code points are equal or the last m - m // 2. So the word
   is filed under its first half (the error lies behind) and its last half (the error lies before), for m its own length
   and, as the longer word of a pair, for its length less one. Words under one key meet in one shard. A key with too many
   words is split in the same way: the open middle is halved again, until keys are small or the middle is one code point.
3. :func:`shard_neighbours` indexes the words of a shard, delimited, in both directions: suffix ranks of the text and of
   its mirror image. A search matches the exact half first, then extends across the open part with one replaced or inserted
   code point, then to the delimiter; every search keeps one direction, so its interval needs no twin in the other index.
   The longer word of a pair is found by the shorter one.
4. Each shard returns, per word, the number of neighbours it found and the best of them; a sum and a minimum join the shards.
5. :func:`roots` follows the forms by doubling: a form is at least twice as frequent, so chains are short.

Defined results: NULL and empty texts have no words; a NULL id counts as the empty text in the crc32. Repeated rows
count each. An empty table gives no rows. Other columns are not read. Texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

RUN = "[a-zÀ-ÿ]"  # after A-Z became small letters
KEY_WORDS = 4_096  # a key with more words is split while its middle allows it
SHARD_ENTRIES = 24_000
TASK_WORDS = 400_000  # distinct words a task holds before it hands its counts on


def word_counts(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = 5, least_count: int = 3,
    damage_every: int = 97,
) -> DataFrame:
    """``word`` and ``n`` for words of at least ``least_length`` code points and ``least_count`` occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which only A-Z is lower-cased. Where crc32 of
    ``<doc_id>:<run>`` is divisible by ``damage_every``, the run loses one code point; 0 damages none.
    """
    runs = re.compile(f"{RUN}{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush():
            words = pa.array(counts.keys(), pa.string())
            result = pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return result

        for batch in batches:
            for i in range(batch.num_rows):
                content = batch.column(1)[i].as_py()
                if not content:
                    continue
                key = batch.column(0)[i].as_py()
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                found = Counter(runs.findall(content.encode().lower().decode()))  # bytes: A-Z alone are lowered
                if damage_every:
                    for word, times in found.items():
                        mark = zlib.crc32(word.encode(), start)
                        if mark % damage_every == 0:
                            at = mark % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least_length:
                                continue
                        counts[word] += times
                else:
                    counts.update(found)
                if len(counts) > TASK_WORDS:
                    yield flush()
        yield flush()

    ids = F.col(f"`{doc_id}`").cast("string")
    parts = docs.select(ids.alias("id"), F.col(f"`{text}`").alias("content")).mapInArrow(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# Filing words under the parts that a neighbour shares.


def _keyed(entries: DataFrame) -> DataFrame:
    """``entries`` with the key of their exact parts: ``head`` code points in front and ``tail`` behind."""
    shared = F.xxhash64(
        "base", "head", "tail", F.substring("word", F.lit(1), F.col("head")), F.expr("right(word, tail)")
    )
    return entries.withColumn("key", shared)


def windows(words: DataFrame, least_length: int) -> DataFrame:
    """``words`` filed under both halves, as the shorter (``base`` is the word's length) and the longer of a pair."""
    size = F.length("word")
    base = F.explode(F.array(size, size - 1)).alias("base")
    filed = words.select("word", "n", base).where(F.col("base") >= least_length)
    half = F.floor(F.col("base") / 2).cast("int")
    none = F.lit(0)
    sides = F.array(
        F.struct(half.alias("head"), none.alias("tail")),
        F.struct(none.alias("head"), (F.col("base") - half).alias("tail")),
    )
    return _keyed(filed.select("word", "n", "base", F.inline(sides)))


def split_hot(entries: DataFrame, key_words: int = KEY_WORDS) -> DataFrame:
    """``entries`` with every key of more than ``key_words`` words replaced by two keys with longer exact parts.

    As with the halves, the one error lies in the left or the right part of the middle, so the other part is equal too.
    The keys that end with an open middle of one code point hold few words by themselves.
    """
    while True:
        middle = F.col("base") - F.col("head") - F.col("tail")
        hot = entries.groupBy("key").agg(F.count("*").alias("held"), F.max(middle).alias("open"))
        hot = written(hot.where((F.col("held") > key_words) & (F.col("open") > 1)).select("key"), "spelling-hot")
        if hot.isEmpty():
            return entries
        left = F.floor(middle / 2).cast("int")
        finer = F.array(
            F.struct((F.col("head") + left).alias("head"), F.col("tail")),
            F.struct(F.col("head"), (F.col("tail") + middle - left).alias("tail")),
        )
        split = entries.join(hot, "key", "left_semi").select("word", "n", "base", F.inline(finer))
        kept = entries.join(hot, "key", "left_anti").select("word", "n", "base", "head", "tail", "key")
        entries = written(kept.unionByName(_keyed(split)), "spelling-entries")


# The index of one shard.


class DelimitedIndex:
    """Suffix ranks of ``|w1|w2|...|wn|`` with steps that extend a match to the left.

    Words are dense codes from 1; 0 is the delimiter and the largest code ends the text. Words must be distinct and sorted by
    their codes: then places whose words end alike sort as they stand, and ranks need no more than a word's length.
    """

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, letters: int):
        count = len(sizes)
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)  # the delimiter before each word
        length = int(sizes.sum()) + count + 2
        text = np.zeros(length, np.int64)
        inside = np.ones(length, bool)
        inside[self.starts] = False
        inside[-2:] = False
        text[inside] = codes
        text[-1] = letters + 1
        self.letters, self.length = letters, length
        self.suffixes = self._ranked(text, int(sizes.max()) + 2, letters + 2)
        self.before = text[self.suffixes - 1]  # the code in front of each suffix
        order = np.argsort(self.before, kind="stable")
        self.steps = self.before[order] * (length + 1) + order  # sorted by code, then rank

    @staticmethod
    def _ranked(text: np.ndarray, reach: int, alphabet: int) -> np.ndarray:
        """Places in the order of their suffixes, compared over at least ``reach`` codes, ties by place."""
        bits = max(1, int(alphabet - 1).bit_length())
        packed, width = text.copy(), 1
        while width * 2 * bits <= 62:  # several codes in one number
            shifted = np.zeros_like(packed)
            shifted[:-width] = packed[width:]
            packed = (packed << (width * bits)) | shifted
            width *= 2
        while True:
            order = np.argsort(packed, kind="stable")
            if width >= reach:
                return order
            sorted_keys = packed[order]
            rank = np.empty(len(text), np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], sorted_keys[1:] != sorted_keys[:-1]]))
            if rank[order[-1]] == len(text) - 1:
                return order
            shifted = np.zeros_like(rank)
            shifted[:-width] = rank[width:] + 1
            packed = rank * (len(text) + 2) + shifted
            width *= 2

    def extend(self, codes, low, high):
        """The intervals of suffix ranks after one more code to the left."""
        at = codes * (self.length + 1)
        return np.searchsorted(self.steps, at + low), np.searchsorted(self.steps, at + high)

    def branches(self, low, high):
        """All letters that stand in front of the intervals: (number of the interval, letter), each pair once."""
        size, wide = high - low, self.letters * 4
        near = np.flatnonzero(size <= wide)
        owner = np.repeat(near, size[near])
        first = np.cumsum(size[near]) - size[near]
        place = np.arange(len(owner)) - np.repeat(first, size[near]) + low[owner]
        letter = self.before[place]
        real = (letter > 0) & (letter <= self.letters)
        pairs = np.unique(owner[real] * (self.letters + 2) + letter[real])
        owner, letter = pairs // (self.letters + 2), pairs % (self.letters + 2)
        far = np.flatnonzero(size > wide)
        if len(far):
            owner = np.concatenate([owner, np.repeat(far, self.letters)])
            letter = np.concatenate([letter, np.tile(np.arange(1, self.letters + 1), len(far))])
        return owner, letter

    def word_at(self, rank):
        """Number of the word in front of whose delimiter the suffix of a rank starts."""
        return np.searchsorted(self.starts, self.suffixes[rank])


def _search(index: DelimitedIndex, pattern, offset, size, exact, end, from_tail: bool):
    """Words one replaced or inserted code away from the patterns: (number of the pattern, number of the word).

    Patterns are read in the direction of the index. The first ``exact`` codes are equal, the error lies before ``end``. An
    inserted code that equals the next one could as well stand behind it, so it is only taken at the last such gap. The gap
    at the window's inner border belongs to the other half: at the start of searches ``from_tail``, and at the end of the
    others unless the window reaches the word's end.
    """
    live = np.arange(len(offset))
    none = np.zeros(len(live), np.int64)
    low, high = index.extend(none, none, none + index.length)
    for step in range(int(exact.max(initial=0))):
        moving = np.flatnonzero(exact > step)
        low[moving], high[moving] = index.extend(pattern[offset[moving] + step], low[moving], high[moving])
    at, alike = exact.copy(), np.ones(len(live), bool)
    pool = []
    while len(live):
        keep = (at[live] <= end[live]) & (high[live] - low[live] > 1)  # an interval of one holds the word itself
        live = live[keep]
        if not len(live):
            break
        owner, letter = index.branches(low[live], high[live])
        who = live[owner]
        place = at[who]
        inside = place < end[who]
        following = np.where(inside, pattern[offset[who] + np.minimum(place, size[who] - 1)], -1)
        new_low, new_high = index.extend(letter, low[who], high[who])
        there = (letter != following) & (new_high > new_low)
        replaced = there & inside
        if from_tail:
            at_start = place == exact[who]
            run = alike[who] & (letter == pattern[offset[who] + np.minimum(exact[who], size[who] - 1)])
            inserted = there & ~at_start & ~run
        else:
            inserted = there & (inside | (end[who] == size[who]))
        pool.append(np.stack([who[replaced], place[replaced] + 1, new_low[replaced], new_high[replaced]]))
        pool.append(np.stack([who[inserted], place[inserted], new_low[inserted], new_high[inserted]]))
        live = live[at[live] < end[live]]
        code = pattern[offset[live] + at[live]]
        alike[live] &= code == pattern[offset[live] + exact[live]]
        low[live], high[live] = index.extend(code, low[live], high[live])
        at[live] += 1
    if not pool:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    who, place, low, high = np.concatenate(pool, axis=1)
    found_who, found_rank = [], []
    while len(who):
        done = place >= size[who]
        code = np.where(done, 0, pattern[offset[who] + np.minimum(place, size[who] - 1)])
        low, high = index.extend(code, low, high)
        there = high > low
        found_who.append(who[done & there])
        found_rank.append(low[done & there])
        going = there & ~done
        who, place, low, high = who[going], place[going] + 1, low[going], high[going]
    if not found_who:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_who), index.word_at(np.concatenate(found_rank))


def _encoded(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All code points in a row, and the words' sizes and starts."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) for w in words], np.int64)
    return points, sizes, np.cumsum(sizes) - sizes


def near_pairs(words: list[str], asker, head, tail) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (number of the asking word, number of the near word) among distinct sorted ``words``.

    ``asker`` are numbers of words, each with the sizes of its exact parts ``head`` and ``tail``. A word finds the words of
    its own size and the longer ones.
    """
    points, sizes, starts = _encoded(words)
    alphabet, codes = np.unique(points, return_inverse=True)
    codes = codes.astype(np.int64) + 1
    letters = len(alphabet)
    askers, found = [], []
    for from_tail in (False, True):
        side = np.flatnonzero((tail > head) == from_tail)
        if not len(side):
            continue
        # The index extends to the left: as they stand for searches from the tail, mirrored for those from the head.
        if from_tail:
            order = np.arange(len(words))
            text = codes
        else:
            mirrored = [w[::-1] for w in words]
            order = np.array(sorted(range(len(words)), key=mirrored.__getitem__), np.int64)
            total = int(sizes.sum())
            owner = np.repeat(order, sizes[order])
            base = np.repeat(np.cumsum(sizes[order]) - sizes[order], sizes[order])
            text = codes[starts[owner] + sizes[owner] - 1 - (np.arange(total) - base)]
        index = DelimitedIndex(text, sizes[order], letters)
        who = asker[side]
        # Patterns run in the direction of the search: from the tail backwards, or from the head forwards.
        if from_tail:
            total = int(sizes.sum())
            owner = np.repeat(np.arange(len(words)), sizes)
            pattern = codes[starts[owner] + sizes[owner] - 1 - (np.arange(total) - starts[owner])]
            exact, end = tail[side], sizes[who] - head[side]
        else:
            pattern, exact, end = codes, head[side], sizes[who] - tail[side]
        asking, near = _search(index, pattern, starts[who], sizes[who], exact, end, from_tail)
        askers.append(who[asking])
        found.append(order[near])
    if not askers:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(askers), np.concatenate(found)


def shard_neighbours(entries: pa.Table) -> pa.Table:
    """Per word of a shard with neighbours there: ``word``, ``n``, how many, and the most frequent one (ties: smallest)."""
    listed = entries.column("word").to_pylist()
    count = dict(zip(listed, entries.column("n").to_pylist()))
    words = sorted(count)
    number = {w: i for i, w in enumerate(words)}
    held = np.array([number[w] for w in listed], np.int64)
    base, head, tail = (entries.column(c).to_numpy().astype(np.int64) for c in ("base", "head", "tail"))
    sizes = np.array([len(w) for w in words], np.int64)
    asks = sizes[held] == base
    left, right = near_pairs(words, held[asks], head[asks], tail[asks])
    longer = sizes[right] > sizes[left]  # words of one size find each other, longer ones are told
    who = np.concatenate([left, right[longer]])
    near = np.concatenate([right, left[longer]])
    n = np.array([count[w] for w in words], np.int64)
    order = np.lexsort((near, -n[near], who))
    who, near = who[order], near[order]
    first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate([first, [len(who)]]))
    return pa.table({
        "word": pa.array([words[i] for i in who[first]], pa.string()),
        "n_near": pa.array(times, pa.int64()),
        "form": pa.array([words[i] for i in near[first]], pa.string()),
        "form_n": pa.array(n[near[first]], pa.int64()),
    })


def neighbours(words: DataFrame, least_length: int = 5, key_words: int = KEY_WORDS) -> DataFrame:
    """``word``, ``n_near`` and the near word of largest ``n`` (``form``, ``form_n``) for words that have near words.

    ``words`` holds distinct ``word`` with ``n``, none shorter than ``least_length`` (2 at least) code points.
    """
    if least_length < 2:
        raise ValueError("words of one code point have no half to match exactly")
    entries = split_hot(windows(words, least_length), key_words)
    shards = max(1, -(-entries.count() // SHARD_ENTRIES))
    dealt = entries.withColumn("shard", F.pmod("key", F.lit(shards)))
    found = dealt.groupBy("shard").applyInArrow(
        shard_neighbours, "word string, n_near bigint, form string, form_n bigint"
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and the last word of its chain (``root``) for rows of ``word`` and ``form`` without NULLs or cycles.

    Each round doubles the steps that a root is ahead, so a chain of length k takes about log2(k) rounds.
    """
    step = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "spelling-roots")
    while not step.where("open").isEmpty():
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(step.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")
        ), "spelling-roots")
    return step.select("word", "root")


def group_variants(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = 5, least_count: int = 3,
    damage_every: int = 97, lead: int = 2,
) -> DataFrame:
    """Per word: ``form`` (its most frequent near word, if ``lead`` times as frequent), ``root``, ``n``, ``n_near``,
    ``form_n``."""
    counts = written(word_counts(docs, text, doc_id, least_length, least_count, damage_every), "spelling-words")
    near = written(neighbours(counts, least_length), "spelling-near")
    leads = F.col("form_n") >= lead * F.col("n")
    known = written(counts.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(leads, F.col("form")).alias("form"), F.when(leads, F.col("form_n")).alias("form_n"),
    ), "spelling-forms")
    ends = roots(known.where(F.col("form").isNotNull()))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
