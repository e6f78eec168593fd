"""N-gram Jaccard join: a grouped prefix join over the shingle sets of whole documents.

Two documents link when their sets of word shingles have a Jaccard similarity of at least ``percent`` / 100. The join
is exact and finds the connected classes of linked documents. Its steps:

1. Sets. Words are hashed, a shingle is a hash of its words, a document a set of hashes.
2. Order. Shingles are counted over all documents and ordered by rarity (count, then hash). Counting is done on packed
   arrays: each batch of documents sends its different shingles once, split by hash; what comes back to the batch is
   the counts of those that occur twice or more. A shingle of one document can link nothing, so it only uses up its
   place in the prefix: most documents have a prefix of such shingles and leave the join here.
3. Groups. Documents with equal sets become one, and sets with equal prefixes and sizes one group. Groups meet in the
   lists of their prefix shingles, filtered by size and by position; a pair that shares several shingles in a row is
   taken at the first of them.
4. Members. In every list, and inside every group, all members are verified against one pivot, the member with the
   fewest shingles of its own (the text that others are changed copies of has none); linked ones form classes. What is
   left in a list, pairs of members of different classes, is then verified in full. A large group of near copies is so
   settled by about as many comparisons as it has members, and no link between classes is lost.

Defined results: NULL and wordless texts have an empty set and link with nothing; their component is their own key. A
text with fewer words than a shingle is one shingle. The smallest key of a component ignores NULL keys; repeated rows
give repeated results and link with each other. Empty tables give empty results. Columns other than ``key`` and
``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import own_shuffle
from .common import delete_steps, shingle_partitions, text_slices, written
from .components import connected_components

BATCH, BATCH_BYTES = 1024, 4 << 20  # documents that are counted together, and bytes of their texts
SEEN = 3  # prefix shingles before a shared one that tell whether a pair has met there already
KIND_DOCUMENT, KIND_COUNT, KIND_SHARED, KIND_RETURNED = 0, 1, 2, 3
WORD_CACHE = 300_000
HASH = np.uint64((1 << 56) - 1)  # a shingle's hash has 56 bits, which go as 7 bytes
MOST_OFTEN = 255  # count of a shingle in one batch, as a byte; counts only order shingles


class WordHashes(dict):
    """Hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < WORD_CACHE:
            self[word] = value
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted different shingle hashes of a text; words are runs without ASCII white space, A-Z lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64) & HASH
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    last = len(words) - size + 1
    value = np.zeros(last, np.uint64)
    for step in range(size):
        value = _mixed(value + ids[step:step + last] + np.uint64(step + 1))
    return np.unique(value & HASH)


def _packed(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens, "<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpacked(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8, 7 * size).reshape(size, 7)
    return out.view("<u8").ravel()


def _spread(df: DataFrame, key: str, text: str, size: int, parts: int) -> DataFrame:
    """Step 1 and the sending half of step 2."""
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = dict(rows.dtypes)["key"]
    schema = f"kind int, part int, batch bigint, doc int, key {kind}, n bigint, sig binary, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in text_slices(batch, 1, BATCH, BATCH_BYTES):
                sets = [shingle_set(t, size, hashes) for t in piece.column(1).to_pylist()]
                sigs = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                name = (task << 32) + number  # the same when a lost task runs again
                number += 1
                docs = len(sets)
                tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                owner = np.repeat(np.arange(docs, dtype=np.uint16), [len(s) for s in sets])
                order = np.argsort(tokens, kind="stable")
                tokens, owner = tokens[order], owner[order]
                first = np.ones(len(tokens), bool)
                first[1:] = tokens[1:] != tokens[:-1]
                often = np.diff(np.append(np.flatnonzero(first), len(tokens)))
                many = np.repeat(often > 1, often)
                shared = _packed(tokens[many]) + owner[many].tobytes()
                once, who, often = tokens[first], owner[first], np.minimum(often, MOST_OFTEN).astype(np.uint8)
                part = (once % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                once, who, often = once[order], who[order], often[order]
                edges = np.searchsorted(part[order], np.arange(parts + 1))
                blobs = [(p, _packed(once[a:b]) + who[a:b].tobytes() + often[a:b].tobytes())
                         for p, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
                kinds = [KIND_DOCUMENT] * docs + [KIND_SHARED] + [KIND_COUNT] * len(blobs)
                size_ = len(kinds)
                yield pa.RecordBatch.from_arrays([
                    pa.array(kinds, pa.int32()),
                    pa.array([(name + i) % parts for i in range(docs + 1)] + [p for p, _ in blobs], pa.int32()),
                    pa.array([name] * size_, pa.int64()),
                    pa.array([*range(docs)] + [None] * (size_ - docs), pa.int32()),
                    pa.concat_arrays([piece.column(0), pa.nulls(size_ - docs, piece.column(0).type)]),
                    pa.array([len(s) for s in sets] + [None] * (size_ - docs), pa.int64()),
                    pa.array(sigs + [None] * (size_ - docs), pa.binary()),
                    pa.array([None] * docs + [shared] + [b for _, b in blobs], pa.binary()),
                ], names=["kind", "part", "batch", "doc", "key", "n", "sig", "data"])

    return rows.mapInArrow(run, schema)


def _counted(spread: DataFrame, parts: int) -> DataFrame:
    """Counts of the shingles of each part; those found twice or more go back to their batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, tokens, owners, counts = [], [], [], []
        schema = None
        for batch in batches:
            schema = batch.schema
            counting = pc.equal(batch.column("kind"), KIND_COUNT)
            rest = batch.filter(pc.invert(counting))
            if rest.num_rows:
                yield rest
            mine = batch.filter(counting)
            for name, data in zip(mine.column("batch").to_pylist(), mine.column("data").to_pylist()):
                size = len(data) // 10
                names.append((name, size))
                tokens.append(_unpacked(data, size))
                owners.append(np.frombuffer(data, np.uint16, size, 7 * size))
                counts.append(np.frombuffer(data, np.uint8, size, 9 * size))
        if not names:
            return
        every = np.concatenate(tokens)
        _, place = np.unique(every, return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts))[place]
        at = 0
        out = []
        for (name, size), token, owner in zip(names, tokens, owners):
            seen = total[at:at + size]
            at += size
            keep = seen > 1
            if keep.any():
                out.append((name, _packed(token[keep]) + owner[keep].tobytes()
                            + np.minimum(seen[keep], 2**32 - 1).astype(np.uint32).tobytes()))
        for a in range(0, len(out), 256):
            some = out[a:a + 256]
            size = len(some)
            columns = {
                "kind": pa.array([KIND_RETURNED] * size, pa.int32()), "batch": pa.array([n for n, _ in some], pa.int64()),
                "data": pa.array([d for _, d in some], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema
            )

    return spread.repartition(parts, "part").mapInArrow(run, spread.schema)


def _prefixes(counted: DataFrame, percent: int) -> DataFrame:
    """The receiving half of step 2: for each document its prefix of shared shingles, if any is left."""
    schema = (
        f"key {dict(counted.dtypes)['key']}, n bigint, sig binary, alone bigint, prefix array<bigint>, "
        "shared array<bigint>"
    )

    def run(group: pa.Table) -> pa.Table:
        docs = group.filter(pc.equal(group.column("kind"), KIND_DOCUMENT)).sort_by("doc")
        tokens, owners, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.uint32)]
        pairs = (np.zeros(0, np.uint64), np.zeros(0, np.uint16))
        for kind, data in zip(group.column("kind").to_pylist(), group.column("data").to_pylist()):
            if kind == KIND_RETURNED:
                size = len(data) // 13
                tokens.append(_unpacked(data, size))
                owners.append(np.frombuffer(data, np.uint16, size, 7 * size))
                counts.append(np.frombuffer(data, np.uint32, size, 9 * size))
            elif kind == KIND_SHARED:
                size = len(data) // 9
                pairs = (_unpacked(data, size), np.frombuffer(data, np.uint16, size, 7 * size))
        token, owner, count = np.concatenate(tokens), np.concatenate(owners), np.concatenate(counts)
        order = np.argsort(token, kind="stable")
        token, owner, count = token[order], owner[order], count[order]
        if len(pairs[0]):  # shingles of several documents of the batch, of which only the first was sent
            first = np.ones(len(pairs[0]), bool)
            first[1:] = pairs[0][1:] != pairs[0][:-1]
            more_token, more_owner = pairs[0][~first], pairs[1][~first]
            more_count = count[np.searchsorted(token, more_token)]
            token, owner = np.concatenate((token, more_token)), np.concatenate((owner, more_owner))
            count = np.concatenate((count, more_count))
        order = np.lexsort((token, count, owner))
        token, owner = token[order].view(np.int64), owner[order]
        sizes = docs.column("n").to_numpy()
        edges = np.searchsorted(owner, np.arange(len(sizes) + 1))
        alone, prefix, shared = [], [], []
        for n, a, b in zip(sizes.tolist(), edges.tolist(), edges[1:].tolist()):
            single = n - (b - a)
            left = n + (-percent * n // 100) + 1 - single if n else 0
            alone.append(single)
            prefix.append(token[a:a + left] if left > 0 else token[:0])
            shared.append(token[a:b] if left > 0 else token[:0])

        def lists(arrays: list[np.ndarray]) -> pa.Array:
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, token[:0]])))

        return pa.table({
            "key": docs.column("key"), "n": docs.column("n"), "sig": docs.column("sig"),
            "alone": pa.array(alone, pa.int64()), "prefix": lists(prefix), "shared": lists(shared),
        })

    return counted.groupBy("batch").applyInArrow(run, schema)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among pairs of sets ``a``, ``b``. Only shingles of two documents or more can be in both."""
    left = sets.select(F.col("sig").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("shared_a"))
    right = sets.select(F.col("sig").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("shared_b"))
    both = F.size(F.array_intersect("shared_a", "shared_b"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both))
        .select("a", "b")
    )


def jaccard_classes(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5, percent: int = 75
) -> DataFrame:
    """``key``, ``n_shingles``, ``component`` (smallest key of the connected class) and ``links`` (verified links found
    at the document's set, 0 for most) for every document."""
    spark = docs.sparkSession
    parts = 2 * shingle_partitions(spark)
    # Counts are written before they go back to their batches, so that the shuffle they come from is free by then.
    sent: list[str] = []
    counted = written(_counted(_spread(docs, key, text, shingle, 3 * parts), parts), "counts", sent)
    rows = written(_prefixes(counted, percent), "prefixes")
    delete_steps(spark, sent)

    # Equal sets become one; equal prefixes and sizes one group.
    members = rows.where(F.size("prefix") > 0).select(
        "sig", "n", "alone", "prefix", "shared", F.xxhash64("n", "alone", "prefix").alias("group")
    )
    passing: list[str] = []  # steps that only the links are made from
    sets = written(members.dropDuplicates(["sig"]), "sets", passing)
    groups = sets.groupBy("group", "n", "alone").agg(F.min("sig").alias("sig"), F.count("*").alias("size"))
    inside = sets.select("group", "n", "sig").join(
        groups.where("size > 1").select("group", "n", F.col("sig").alias("pivot")), ["group", "n"]
    ).where(F.col("sig") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("sig").alias("b"))

    lists = sets.select("sig", "n", "group", F.posexplode("prefix").alias("i", "token"), "alone", "prefix").select(
        "token", "sig", "n", "group", "alone", (F.col("alone") + F.col("i")).alias("place"),
        F.slice("prefix", F.greatest(F.col("i") - SEEN + 1, F.lit(1)), F.least("i", F.lit(SEEN))).alias("before"),
    )

    def possible(n_1: str, place_1: str, before_1: str, n_2: str, place_2: str, before_2: str):
        """Size and position filters of a pair that meets at a prefix shingle, and whether it has met just before."""
        small, large = F.least(n_1, n_2), F.greatest(n_1, n_2)
        # At the first shared shingle of a linked pair nothing before it is shared.
        most = F.least(F.col(n_1) - F.col(place_1), F.col(n_2) - F.col(place_2))
        return (100 * small >= percent * large) & (
            (100 + percent) * most >= percent * (F.col(n_1) + F.col(n_2))
        ) & ~F.arrays_overlap(before_1, before_2)

    heads = lists.join(groups.select("sig"), "sig", "left_semi")
    pivots = heads.groupBy("token", own_shuffle("token")).agg(
        F.min(F.struct("alone", "sig", "n", "place", "before")).alias("pivot"), F.count("*").alias("size")
    ).where("size > 1").select("token", "pivot.*").drop("alone").withColumnsRenamed(
        {"n": "n_p", "sig": "pivot", "place": "place_p", "before": "before_p"}
    )
    across = (
        heads.join(pivots, "token").where(F.col("sig") != F.col("pivot"))
        .where(possible("n", "place", "before", "n_p", "place_p", "before_p"))
        .select(F.col("pivot").alias("a"), F.col("sig").alias("b"))
    )
    links = written(_verified(inside.union(across).distinct(), sets, percent), "links", passing)

    # Pairs of different classes that are left in a list: the smaller classes of the list against all of it.
    known = connected_components(links)
    classed = written(
        lists.join(known.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig")),
        "lists", passing,
    )
    sizes = classed.groupBy("token", "root").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("token", own_shuffle("token")).agg(
        F.max(F.struct("size", "root")).alias("top"), F.count("*").alias("classes")
    ).where("classes > 1").select("token", F.col("top.root").alias("main"))
    open_lists = classed.join(largest, "token")
    other = classed.select(
        "token", F.col("sig").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("place_b"),
        F.col("root").alias("root_b"), F.col("before").alias("before_b"),
    )
    rest = (
        open_lists.where(F.col("root") != F.col("main")).withColumnRenamed("sig", "a").join(other, "token")
        .where((F.col("root") != F.col("root_b")) & possible("n", "place", "before", "n_b", "place_b", "before_b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    links = written(links.union(_verified(rest, sets, percent)), "links")
    delete_steps(spark, passing)
    roots = connected_components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("sig")).groupBy("sig").agg(F.count("*").alias("links"))

    # From sets back to documents.
    every = rows.select("key", "n", "sig").join(roots.withColumnRenamed("node", "sig"), "sig", "left").join(
        degree, "sig", "left"
    ).withColumn("root", F.coalesce("root", "sig"))
    smallest = every.where("n > 0").groupBy("root", own_shuffle("root")).agg(F.min("key").alias("smallest")).drop("_spread")
    return every.join(smallest, "root", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("key")).alias("component"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )
