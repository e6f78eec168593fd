"""Benchmark decontamination as a prefix-filtered set join on DataFrames.

An item is cut into windows of ``window`` consecutive words (an item of fewer words is one window), a window into
shingles of ``shingle`` words. A document contains a window only if it contains all of the window's shingles, so one
token is a sufficient prefix: the shingle that is rarest in the corpus. The join has these steps:

1. Occurrences of item shingles in the documents: one scan, joined on the shingle's hash. The item side is broadcast
   up to ``BROADCAST_SHINGLES`` rows and shuffled beyond.
2. Shingles ordered by their number of occurrences; the rarest of each window is its prefix token. A window with a
   shingle that never occurs is dropped.
3. Candidates: occurrences of prefix tokens, at the start they imply. Positional bound: the start is not negative.
   Length bound: the window ends inside the document.
4. Verification: the window's first and last shingle occur at their exact places. They cover all of its words.

Hits of a document are positions, so overlapping windows count once. Equal windows of several items are joined once
and lead to their items at the end.

Defined results: NULL and wordless texts have no word and no hit; items without words have no window; a NULL item id is
neither counted nor listed, but its windows hit. Repeated documents give repeated rows, equal item ids count once.
Empty tables give empty results or documents without hits. Columns other than the named ones are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# Fixed value: a word is a run of a-z, 0-9 and characters beyond ASCII, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_SHINGLES = 1_000_000  # rows of two longs: some 50 MB in memory


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def shingle_hashes(words: str, size: int) -> Column:
    """Hash of the ``size`` words from each position on; empty if there are fewer."""
    places = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(places, lambda i: F.xxhash64(F.lit(size), *[F.get(F.col(words), i + k) for k in range(size)]))


def item_windows(items: DataFrame, item_key: str, text: str, window: int, shingle: int) -> DataFrame:
    """One row per window: item, length, shingle size, and its shingles in order."""
    worded = items.select(
        F.col(f"`{item_key}`").alias("item"), F.transform(words_of(F.col(f"`{text}`")), lambda w: F.xxhash64(w)).alias("words")
    ).where(F.size("words") > 0).select("*", F.least(F.size("words"), F.lit(window)).alias("length"))
    cut = worded.select(
        "item", "length", F.least("length", F.lit(shingle)).alias("size"),
        F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("first"), "words",
    ).select("item", "length", "size", F.slice("words", F.col("first"), F.col("length")).alias("words"))
    hashes = F.lit(None).cast("array<bigint>")
    for size in range(1, shingle + 1):
        hashes = F.when(F.col("size") == size, shingle_hashes("words", size)).otherwise(hashes)
    return cut.select("item", "length", "size", hashes.alias("hashes"))


def find_contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
    item_key: str = "item_id", window: int = 10, shingle: int = 5, carry: tuple[str, ...] = (),
) -> DataFrame:
    """``key``, ``n_words``, ``n_hit``, ``items`` (ids as sorted strings), ``contaminated`` and the columns ``carry``
    for every document."""
    clash = {"n_words", "n_hit", "items", "contaminated", key} & set(carry)
    if clash:
        raise ValueError(f"carried columns {sorted(clash)} have names of results; rename them first")
    carried = [F.col(f"`{c}`").alias(f"carried_{i}") for i, c in enumerate(carry)]
    restored = [F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)]
    windows = written(
        item_windows(items, item_key, item_text, window, shingle).select(
            "*", F.element_at("hashes", 1).alias("head"), F.element_at("hashes", -1).alias("tail")
        ), "windows",
    )
    tokens = windows.select("length", "head", "tail", "size", F.posexplode("hashes").alias("offset", "hash")).distinct()
    wanted = written(tokens.select("hash", "size").distinct(), "item-shingles")
    known = {r["size"]: r["n"] for r in wanted.groupBy("size").agg(F.count("*").alias("n")).collect()}  # 5 rows at most

    source = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"),
        F.transform(words_of(F.col(f"`{text}`")), lambda w: F.xxhash64(w)).alias("words"),
    )
    found = []
    for size, rows in known.items():
        places = source.select(
            "key", "mark", F.size("words").alias("n"), F.posexplode(shingle_hashes("words", size)).alias("place", "hash")
        )
        sought = wanted.where(F.col("size") == size).select("hash")
        found.append(places.join(F.broadcast(sought) if rows <= BROADCAST_SHINGLES else sought, "hash"))
    if not found:
        return docs.select(
            F.col(f"`{key}`"), F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("n_words"),
            F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"),
            F.lit(False).alias("contaminated"), *[F.col(f"`{c}`") for c in carry],
        )
    occurrences = found[0]
    for more in found[1:]:
        occurrences = occurrences.unionByName(more)
    occurrences = written(occurrences.distinct(), "occurrences")

    rarity = occurrences.groupBy("hash").agg(F.count("*").alias("seen"))
    prefixes = (
        tokens.join(rarity, "hash", "left")
        .groupBy("length", "head", "tail", "size")
        .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "hash", "offset")).alias("rarest"))
        .where("rarest.seen > 0")
        .select("length", "head", "tail", "size", "rarest.hash", "rarest.offset")
    )
    candidates = (
        occurrences.join(prefixes, "hash")
        .withColumn("start", F.col("place") - F.col("offset"))
        .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n")))
        .select("key", "mark", "start", "length", "size", "head", "tail")
    )
    at = occurrences.select("key", "mark", "place", "hash")

    def confirmed(rows: DataFrame, place: Column, hash_: str) -> DataFrame:
        left = rows.withColumn("sought", place)
        same = (
            left["key"].eqNullSafe(at["key"]) & left["mark"].eqNullSafe(at["mark"])
            & (left["sought"] == at["place"]) & (left[hash_] == at["hash"])
        )
        return left.join(at, same, "left_semi").drop("sought")

    verified = confirmed(
        confirmed(candidates, F.col("start"), "head"), F.col("start") + F.col("length") - F.col("size"), "tail"
    )
    verified = written(verified, "verified")
    hits = verified.select(
        "key", "mark", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("place")
    ).groupBy("key", "mark").agg(F.countDistinct("place").alias("n_hit"))
    named = (
        verified.select("key", "mark", "length", "head", "tail").distinct()
        .join(windows.select("length", "head", "tail", "item").distinct(), ["length", "head", "tail"])
        .where(F.col("item").isNotNull())
        .select("key", "mark", F.col("item").cast("string").alias("item")).distinct()
        .groupBy("key", "mark").agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    every = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"),
        F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("n_words"), *carried,
    )
    for part in (hits, named):
        right = part.withColumnsRenamed({"key": "key_2", "mark": "mark_2"})
        every = every.join(
            right, every["key"].eqNullSafe(right["key_2"]) & every["mark"].eqNullSafe(right["mark_2"]), "left"
        ).drop("key_2", "mark_2")
    return every.select(
        F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), *restored,
    )
