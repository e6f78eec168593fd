"""Line dedup as an exact set-similarity join on DataFrames: later near copies of a line go, wherever they are.

A line's tokens are its shingles of five words (a shorter line is one token); blank lines have none and stay. Line B is
removed if an earlier line A (by document key, then place) has a Jaccard similarity of at least ``percent`` / 100 with
it. Lines are judged on the input, so A may itself be removed.

1. Lines of equal text become one, held at its first place; the other places are removed.
2. Tokens are ordered by rarity, by counts of hashed tokens over the whole corpus (``COUNTERS`` counters, a fixed size;
   a shared counter only changes the order, and any order is right).
3. Prefix filter: of a line with n tokens the first n - ceil(n * percent / 100) + 1 are kept. Tokens that one line alone
   has are counted out; the others form lists of lines. Tokens move with a number for their line only, as most of them
   belong to one line; the rest of the line is joined to those that are left. Bit tables of fixed size keep rows from
   moving while they are not full, and no step depends on that.
4. In each list every line is compared with the first line of the list and with the one that has most copies (the text
   that the others were changed from), if they are earlier, after the length, positional and parity filters. Lines that
   match are settled. Those that are left are compared with all other earlier lines of their lists. A large group of
   near copies needs about as many comparisons as it has lines. Parity filter: a line has 128 bits, each the
   parity of its tokens of one hash class. Two lines differ in as many tokens as in bits at least, so lines that only
   share a passage leave no row.
5. Verification on the lines' token sets.

Defined results: NULL texts have no line and stay NULL. A document whose lines all go has an empty text. Kept lines are
joined by line breaks. Rows equal in key and text count as one document and give equal results; documents without a key
come first; rows of one key and different texts are ordered by a hash of the text. Empty tables give empty results.
Columns other than the named ones are not read unless ``carry`` names them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import own_shuffle
from .common import delete_steps, written

# Fixed value: words are runs without ASCII white space.
SPACES = r"[\x20\x09-\x0D]+"
COUNTERS = 1 << 18  # token counters
FILTER_BITS = 1 << 22  # bits of a membership table, held as longs
PARITIES = ("parity_0", "parity_1")  # 64 parity bits each of a line's tokens
RARITY_SHIFT = 58  # the top bits of a token are its rarity class, the lower ones its hash
LOW = (1 << RARITY_SHIFT) - 1


def line_words(line: Column) -> Column:
    """Words of a line. Most lines have single spaces between words and nothing else; those need no pattern."""
    odd = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    for space in "\t\n\x0b\x0c\r":
        odd = odd | line.contains(space)
    return F.when(odd | (line == ""), F.array_remove(F.split(line, SPACES), "")).otherwise(F.split(line, " "))


def numbers(values: list[int], kind: str) -> Column:
    """A constant array."""
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), f"array<{kind}>")


def rarity_table(texts: DataFrame, size: int, passing: list[str] | None = None) -> list[int]:
    """Rarity classes of hashed tokens of ``size`` words, sixteen of four bits in a number.

    ``COUNTERS`` counters cover all tokens of the corpus. Class 0 is a counter that is no larger than many single tokens
    make it by chance; each further class is twice as far above that. Counting combines before the shuffle, and what
    comes to the driver has a fixed size. Words are cut at spaces and line breaks alone, and a text is taken as one line:
    tokens that this adds or leaves out only change the order. A row for each token is hashed in compiled code, which
    functions inside arrays are not. A row of counts holds sixteen counters, so that a task's counters are few groups.
    """
    words = texts.select(F.split(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), " ").alias("words"))
    token = F.xxhash64(*[F.xxhash64(F.get("words", F.col("i") + k)) for k in range(size)])
    counters = words.select(
        "words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))).alias("i")
    ).select(token.bitwiseAND(F.lit(COUNTERS - 1)).cast("int").alias("counter"))
    counts = written(
        counters.groupBy(F.shiftright("counter", 4).alias("word")).agg(
            *[F.sum((F.col("counter").bitwiseAND(F.lit(15)) == at).cast("bigint")).alias(f"n_{at}") for at in range(16)]
        ), "counters", passing,
    )
    every = sum((F.col(f"n_{at}") for at in range(16)), F.lit(0))
    expected = (counts.agg(F.sum(every)).first()[0] or 0) / COUNTERS
    chance = 4 * max(1.0, expected) ** 0.5

    def rank(at: int) -> Column:
        above = F.floor(F.log2(F.greatest((F.col(f"n_{at}") - expected) / chance, F.lit(0.5)))) + 1
        return F.shiftleft(F.least(above, F.lit(15)).cast("bigint"), 4 * at)

    ranks = rank(0)
    for at in range(1, 16):
        ranks = ranks.bitwiseOR(rank(at))
    packed = counts.select("word", ranks.alias("ranks")).where("ranks != 0")
    table = [0] * (COUNTERS // 16)
    for row in packed.collect():
        table[row["word"]] = row["ranks"]
    return table


def tokens_of(words: Column, size: int, table: list[int] | None = None) -> Column:
    """Different tokens of a line, hashes of ``size`` words each; with ``table`` in order of rarity, the class in the
    top bits. The words are hashed inside a one-element array, so that this is done once for a line."""

    def shingled(hashes: Column) -> Column:
        def one(first: Column, i: Column) -> Column:
            return F.xxhash64(first, *[F.get(hashes, i + k) for k in range(1, size)]).bitwiseAND(F.lit(LOW))

        whole = F.slice(F.transform(hashes, one), F.lit(1), F.size(hashes) - (size - 1))
        return F.when(F.size(hashes) >= size, whole).when(
            F.size(hashes) > 0, F.array(F.xxhash64(F.size(hashes), hashes).bitwiseAND(F.lit(LOW)))
        ).otherwise(F.array().cast("array<bigint>"))

    found = F.array_distinct(F.flatten(F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), shingled)))
    if table is None:
        return found
    classes = [(word >> (4 * at) & 15) << RARITY_SHIFT for word in table for at in range(16)]
    ranks = numbers(classes, "bigint")

    def ranked(token: Column) -> Column:
        return F.get(ranks, token.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")).bitwiseOR(token)

    return F.sort_array(F.transform(found, ranked))


def parity_bits(tokens: Column) -> list[Column]:
    """The parities of the tokens in each of 128 hash classes, as longs named ``PARITIES``. Two sets differ in at least
    as many tokens as these bits."""

    def flipped(part: int):
        def flip(bits: Column, token: Column) -> Column:
            mine = (F.shiftright(token, 6).bitwiseAND(F.lit(len(PARITIES) - 1)) == part).cast("bigint")
            return bits.bitwiseXOR(F.call_function("shiftleft", mine, token.bitwiseAND(F.lit(63)).cast("int")))

        return flip

    return [F.aggregate(tokens, F.lit(0).cast("bigint"), flipped(i)).alias(c) for i, c in enumerate(PARITIES)]


def bit_table(rows: DataFrame, hash_: Column) -> list[int]:
    """A membership table of ``FILTER_BITS`` bits, gathered as that many / 64 numbers at most."""
    words = rows.select(F.pmod(hash_, F.lit(FILTER_BITS)).alias("at")).selectExpr(
        "cast(at div 64 as int) as word", "shiftleft(1L, cast(at % 64 as int)) as bit"
    ).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = [0] * (FILTER_BITS // 64)
    for row in words.collect():
        table[row["word"]] = row["bits"]
    return table


def in_table(table: list[int], hash_: Column) -> Column:
    at = F.pmod(hash_, F.lit(FILTER_BITS))
    word = F.get(numbers(table, "bigint"), F.floor(at / 64).cast("int"))
    return F.call_function("getbit", word, (at % 64).cast("int")) == 1


def _lines(source: DataFrame) -> DataFrame:
    """One row per line with a word."""
    return source.select("key", "mark", F.posexplode(F.split("text", "\n")).alias("line", "content")).where(
        F.col("content").rlike(r"[^\x20\x09-\x0D]")
    )


def removed_lines(
    source: DataFrame, shingle: int, percent: int, passing: list[str] | None = None
) -> DataFrame:
    """``key``, ``mark`` and ``lines`` (numbers of the removed lines) for documents that lose a line. The paths of the
    steps that the result reads are added to ``passing``; the others are deleted as soon as their readers are written."""
    spark = source.sparkSession
    lines_steps, lists_steps, sets_steps = [], [], []
    lines = _lines(source)
    same_line = (F.xxhash64("content").alias("h1"), F.xxhash64(F.lit(1), "content").alias("h2"))
    table = rarity_table(source.select("text"), shingle, lines_steps)
    place = F.struct("key", "mark", "line")

    # 1 to 3: different lines with their prefixes.
    tokened = lines.select(
        place.alias("at"), *same_line, tokens_of(line_words(F.col("content")), shingle, table).alias("tokens"),
    ).withColumn("n", F.size("tokens"))
    kept = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    different = written(
        tokened.select("at", "h1", "h2", "n", F.slice("tokens", F.lit(1), kept).alias("prefix"),
                       *parity_bits(F.col("tokens")))
        .groupBy("h1", "h2").agg(F.min("at").alias("at"), F.first("n").alias("n"), F.first("prefix").alias("prefix"),
                                 *[F.first(c).alias(c) for c in PARITIES], F.count("*").alias("copies"))
        .withColumn("id", F.monotonically_increasing_id()),
        "lines", lines_steps,
    )
    entries = different.select("id", F.posexplode("prefix").alias("place", "token"))
    shared = written(entries.groupBy("token").agg(F.count("*").alias("size")).where("size > 1"), "tokens", lines_steps)
    known = bit_table(shared, F.xxhash64("token"))
    entries = written(
        entries.where(in_table(known, F.xxhash64("token"))).join(shared, "token").select("token", "size", "id", "place"),
        "entries", lines_steps,
    )
    # The token before, if other lines have it as well; others are equal to none.
    within = Window.partitionBy("id").orderBy("place")
    seen = F.when(F.lag("place").over(within) == F.col("place") - 1, F.lag("token").over(within))
    lists = written(
        entries.withColumn("seen", seen).join(different.select("id", "at", "n", *PARITIES, "copies"), "id")
        .select("token", "size", "at", "n", "place", "seen", *PARITIES, "copies"),
        "lists", lists_steps,
    )
    copies = written(different.where("copies > 1").select("h1", "h2", F.col("at").alias("first")), "copies", passing)
    delete_steps(spark, lines_steps)

    def possible() -> Column:
        """Length, positional and parity filters for a line and the one ``other``; a pair that shares several tokens in a
        row is taken at the first of them."""
        n_2 = F.col("other.n")
        most = F.least(F.col("n") - F.col("place"), n_2 - F.col("other.place"))
        bits = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"other.{c}"))) for c in PARITIES), F.lit(0))
        return (100 * F.least("n", n_2) >= percent * F.greatest("n", n_2)) & (
            (100 + percent) * most >= percent * (F.col("n") + n_2)
        ) & F.coalesce(F.col("seen") != F.col("other.seen"), F.lit(True)) & (
            (100 + percent) * bits <= (100 - percent) * (F.col("n") + n_2)
        )

    # 4: candidates, first against the first line of a list.
    line = F.struct("at", "n", "place", "seen", *PARITIES)
    heads = lists.groupBy("token", own_shuffle("token")).agg(
        F.min(line).alias("head"), F.max_by(line, F.struct("copies", -F.col("n"))).alias("model")
    ).drop("_spread")
    met = lists.join(heads, "token").select(
        "at", "n", "place", "seen", *PARITIES, F.explode(F.array_distinct(F.array("head", "model"))).alias("other")
    ).where(F.col("at") > F.col("other.at"))
    first_pairs = met.where(possible()).select("at", F.col("other.at").alias("before")).distinct()
    first_pairs = written(first_pairs, "pairs", passing)

    # 5: verification, with the token sets of the lines that are in pairs.
    def identity(column: str) -> Column:
        return F.xxhash64(f"{column}.key", f"{column}.mark", f"{column}.line")

    def matching(pairs: DataFrame) -> DataFrame:
        """Lines of ``pairs`` that match the line before them. Only lines of pairs get a token set: those that the bit
        table lets pass besides go with the join. Repeated documents give a line twice, which doesn't change which lines
        match."""
        ends = pairs.select(F.explode(F.array("at", "before")).alias("at")).distinct()
        wanted = bit_table(ends, identity("at"))
        sets = written(
            lines.where(in_table(wanted, F.xxhash64("key", "mark", "line"))).select(place.alias("at"), "content")
            .join(ends, "at", "left_semi")
            .select("at", tokens_of(line_words(F.col("content")), shingle).alias("tokens")), "line-sets", sets_steps,
        )
        two = pairs.join(sets.select("at", F.col("tokens").alias("t_1")), "at").join(
            sets.select(F.col("at").alias("before"), F.col("tokens").alias("t_2")), "before"
        )
        both = F.size(F.array_intersect("t_1", "t_2"))
        return two.where(100 * both >= percent * (F.size("t_1") + F.size("t_2") - both)).select("at").distinct()

    settled = written(matching(first_pairs), "settled", passing)
    delete_steps(spark, sets_steps)
    # The first line of a list has met all of it, so lists of two are done and others go on without their first line.
    open_lists = lists.where("size > 2").join(heads.select("token", F.col("head.at").alias("first")), "token").where(
        F.col("at") != F.col("first")).drop("first", "size")
    open_lists = written(open_lists, "open-lists", lists_steps)
    earlier = open_lists.select("token", line.alias("other"))
    more_pairs = (
        open_lists.join(settled, "at", "left_anti").join(earlier, "token")
        .where((F.col("other.at") < F.col("at")) & possible())
        .select("at", F.col("other.at").alias("before")).distinct().join(first_pairs, ["at", "before"], "left_anti")
    )
    more_pairs = written(more_pairs, "more-pairs", passing)
    delete_steps(spark, lists_steps)
    near = settled.union(written(matching(more_pairs), "settled-more", passing))
    delete_steps(spark, sets_steps)
    # Later places of equal lines; the bit table keeps most lines without copies from moving.
    hashed = lines.select(place.alias("at"), *same_line)
    copied = hashed.where(in_table(bit_table(copies, F.col("h1")), F.col("h1"))).join(copies, ["h1", "h2"]).where(
        F.col("at") != F.col("first")).select("at")
    return near.union(copied).select("at.*").groupBy("key", "mark").agg(F.collect_set("line").alias("lines"))


def dedup_lines(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5, percent: int = 75,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``key``, ``n_lines`` (with a word), ``n_removed``, ``text`` without the removed lines, and the columns ``carry``,
    for every document."""
    clash = {"n_lines", "n_removed", "text", key} & set(carry)
    if clash:
        raise ValueError(f"carried columns {sorted(clash)} have names of results; rename them first")
    source = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("text"),
        *[F.col(f"`{c}`").alias(f"carried_{i}") for i, c in enumerate(carry)],
    )
    passing: list[str] = []
    gone = written(removed_lines(source.select("key", "mark", "text"), shingle, percent, passing), "removed")
    delete_steps(docs.sparkSession, passing)
    marks = bit_table(gone, F.xxhash64("key", "mark"))
    touched = in_table(marks, F.xxhash64("key", "mark"))
    right = gone.withColumnsRenamed({"key": "key_2", "mark": "mark_2"})
    left = source.where(touched)
    cut = left.join(
        right, left["key"].eqNullSafe(right["key_2"]) & (left["mark"] == right["mark_2"]), "left"
    ).drop("key_2", "mark_2")
    every = cut.unionByName(source.where(~touched).withColumn("lines", F.lit(None).cast("array<int>")))
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("lines", i)), "\n")
    return every.select(
        F.col("key").alias(key),
        F.coalesce(F.size(F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("lines").isNull(), F.col("text")).otherwise(kept).alias("text"),
        *[F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)],
    )
