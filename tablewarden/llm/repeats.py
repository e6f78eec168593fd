"""Passages of at least ``length`` bytes that occur again, in the same document or another.

No array of longest previous factors is computed. A span only needs to know whether the longest previous factor of a place
reaches ``length`` bytes, which is so exactly if the same string of ``length`` bytes starts at an earlier place.

Comparing all suffixes of a corpus in one order would sort every byte of it. Equal strings are therefore brought
together first, by anchors: of the 32-byte hashes inside each window of ``length`` bytes the smallest is the window's
anchor, so equal windows have equal anchors at equal places. Consecutive windows with one anchor form a segment, a
text of less than twice ``length`` bytes.

1. Segments of all documents, as (anchor, content digest, place): one scan, a row for some 185 bytes of text.
2. Segments that occur twice as a whole are repeats. Only anchors with different segments stay open.
3. The different segments of open anchors are fetched as text and dealt into buckets by anchor. In a bucket, suffixes
   are ranked by their first ``length`` bytes (prefix doubling). Among suffixes of equal rank, sorted by position, the one
   before is an earlier match and the one behind a later copy.
4. Anchors with more than ``CROWD`` different segments would overfill a bucket (a passage in a third of all documents).
   For these each window goes by its own 128-bit digest through an aggregate that combines before the shuffle.

``keep_first`` removes later copies and keeps the first (by key, then place); without it every copy goes. Strings are
judged on the input, not on what is left, and overlapping strings count. Digests have 128 bits and are taken as equal
texts.

Defined results: NULL and empty texts have 0 bytes and nothing to remove, as has any text shorter than ``length``.
Repeated rows are occurrences like any others and give repeated results; with ``keep_first`` rows equal in key and text
count as one document. Documents without a key come first. An empty table gives an empty result; columns other than
``key`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import own_shuffle
from .common import delete_steps, shingle_partitions, written
from .line_dedup import bit_table, in_table

GRAM = 32  # bytes of an anchor's hash
PLACE_BITS = 26  # of a sort key; the others are hash
CHUNK = 1 << 20  # bytes that are hashed together
CROWD = 1000  # different segments of an anchor that share a bucket
BUCKET_BYTES = 1 << 20


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the 32 bytes at each place, and the place of each window's anchor."""
    hashed = _mixed(data.astype(np.uint64) + np.uint64(1))
    step = 1
    while step < GRAM:
        hashed = _mixed(hashed[:-step] * np.uint64(0xD6E8FEB86659FD93) + hashed[step:])
        step *= 2
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = (hashed & ~low) | np.arange(len(hashed), dtype=np.uint64)
    width = length - GRAM + 1
    step = 1
    while 2 * step <= width:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    if step < width:
        key = np.minimum(key[:len(key) - (width - step)], key[width - step:])
    return hashed, (key & low).astype(np.int64)


def segments(texts: list[bytes], length: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(text number, first window, last window, anchor, digest) of each segment."""
    pending: list[tuple[int, int, bytes]] = []
    filled = 0

    def flush() -> Iterator[tuple[int, int, int, int, bytes]]:
        joined = b"".join(p for _, _, p in pending)
        hashed, places = anchors(np.frombuffer(joined, np.uint8), length)
        base = 0
        for number, shift, piece in pending:
            own = places[base:base + len(piece) - length + 1]
            cuts = np.flatnonzero(np.diff(own)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)]):
                yield (number, shift + a, shift + b - 1, int(hashed[own[a]]),
                       xxhash.xxh3_128_digest(piece[a:b - 1 + length]))
            base += len(piece)

    for number, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), CHUNK):  # each window lies in one chunk
            piece = text[at:at + CHUNK + length - 1]
            pending.append((number, at, piece))
            filled += len(piece)
            if filled >= CHUNK:
                yield from flush()
                pending, filled = [], 0
    if pending:
        yield from flush()


def _segment_rows(source: DataFrame, length: int) -> DataFrame:
    schema = f"key {dict(source.dtypes)['key']}, mark bigint, first int, last int, anchor bigint, digest binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                texts = [(t or "").encode() for t in piece.column(2).to_pylist()]
                found = list(segments(texts, length))
                if not found:
                    continue
                number, first, last, anchor, digest = zip(*found)
                row = pa.array(number, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    piece.column(0).take(row), piece.column(1).take(row), pa.array(first, pa.int32()),
                    pa.array(last, pa.int32()), pa.array(np.array(anchor, np.uint64).view(np.int64)),
                    pa.array(digest, pa.binary()),
                ], names=["key", "mark", "first", "last", "anchor", "digest"])

    return source.select("key", "mark", "text").mapInArrow(run, schema)


def equal_ranks(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes from each start in suffix order, -1 for a string that occurs once.

    Prefix doubling; suffixes that are already unique leave, and so do those whose continuation is unique.
    """
    size = len(data)
    word = data.astype(np.uint64)
    step = 1
    while step < 8 and step < length:
        word = (word[:-step] << np.uint64(8 * step)) | word[step:]
        step *= 2
    active = np.arange(len(word), dtype=np.int64)
    rank = np.full(size, -1, np.int64)
    value = word
    while True:
        _, place, often = np.unique(value, return_inverse=True, return_counts=True)
        rank.fill(-1)
        again = often[place] > 1
        rank[active[again]] = place[again]
        active = active[again]
        if step >= length or not len(active):
            return rank[starts]
        ahead = min(step, length - step)
        active = active[active + ahead < size]
        after = rank[active + ahead]
        active, after = active[after >= 0], after[after >= 0]
        value = rank[active] * size + after
        step += ahead


def _windows_to_spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Bytes that the windows from sorted starts cover, as (first, end)."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.append(0, cuts + 1)].tolist(), (starts[np.append(cuts, len(starts) - 1)] + length).tolist()))


def _bucket_matches(texts: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """Spans of repeats among the segments of each bucket."""
    schema = f"key {dict(texts.dtypes)['key']}, mark bigint, first int, end int"

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("mark", "ascending"), ("first", "ascending")])
        places = list(zip(*(group.column(c).to_pylist() for c in ("key", "mark", "first"))))
        group = group.take([i for i, p in enumerate(places) if i == 0 or p != places[i - 1]])  # equal rows are one
        parts = group.column("text").to_pylist()
        sizes = np.array([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        bases = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        windows = sizes - length + 1
        starts = np.concatenate([np.arange(b, b + w) for b, w in zip(bases, windows)])
        rank = equal_ranks(data, starts, length)
        order = np.lexsort((starts, rank))
        ordered = rank[order]
        equal = (ordered[1:] == ordered[:-1]) & (ordered[1:] >= 0)
        repeated = np.zeros(len(starts), bool)
        repeated[order[1:][equal]] = True  # the neighbour before in suffix order is an earlier match
        if not keep_first:
            repeated[order[:-1][equal]] = True
        rows, firsts, ends = [], [], []
        base = 0
        for number, (shift, count) in enumerate(zip(group.column("first").to_pylist(), windows.tolist())):
            for a, b in _windows_to_spans(np.flatnonzero(repeated[base:base + count]), length):
                rows.append(number)
                firsts.append(shift + a)
                ends.append(shift + b)
            base += count
        row = pa.array(rows, pa.int64())
        return pa.table({"key": group.column("key").take(row), "mark": group.column("mark").take(row),
                         "first": pa.array(firsts, pa.int32()), "end": pa.array(ends, pa.int32())})

    return texts.groupBy("bucket").applyInArrow(run, schema)


def _window_rows(texts: DataFrame, length: int) -> DataFrame:
    schema = f"key {dict(texts.dtypes)['key']}, mark bigint, first int, window binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, first = batch.column("text")[i].as_py(), batch.column("first")[i].as_py()
                count = len(text) - length + 1
                row = pa.array([i] * count, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").take(row), batch.column("mark").take(row),
                    pa.array(range(first, first + count), pa.int32()),
                    pa.array([xxhash.xxh3_128_digest(text[k:k + length]) for k in range(count)], pa.binary()),
                ], names=["key", "mark", "first", "window"])

    return texts.select("key", "mark", "first", "text").mapInArrow(run, schema)


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.withColumnsRenamed({"key": "key_2", "mark": "mark_2"})
    return left.join(
        right, left["key"].eqNullSafe(right["key_2"]) & (left["mark"] == right["mark_2"]), how
    ).drop("key_2", "mark_2")


def _cut(rows: DataFrame) -> DataFrame:
    """Texts without the bytes of their spans."""
    schema = f"key {dict(rows.dtypes)['key']}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                out = []
                for text, spans in zip(piece.column("text").to_pylist(), piece.column("spans").to_pylist()):
                    data = (text or "").encode()
                    merged: list[list[int]] = []
                    for span in sorted((s["first"], s["end"]) for s in spans or []):
                        if merged and span[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], span[1])
                        else:
                            merged.append(list(span))
                    edges = [0, *[e for m in merged for e in m], len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    out.append((len(data), len(data) - len(kept), len(merged), kept))
                sizes, removed, spans_, kept_ = zip(*out)
                yield pa.RecordBatch.from_arrays([
                    piece.column("key"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(spans_, pa.int64()), pa.array(kept_, pa.binary()),
                ], names=["key", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.select("key", "text", "spans").mapInArrow(run, schema)


def remove_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = 400, keep_first: bool = False
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes) for every document."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    parts = shingle_partitions(docs.sparkSession)
    source = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("text")
    )
    passing: list[str] = []  # steps that only the spans are made from
    found = written(_segment_rows(source, length), "segments", passing)
    if keep_first:
        found = found.distinct()
    distinct = written(
        found.groupBy("anchor", "digest").agg(
            F.count("*").alias("times"), F.min(F.struct("key", "mark", "first", "last")).alias("at")
        ), "distinct-segments", passing,
    )
    again = distinct.where("times > 1").select("anchor", "digest", F.col("at").alias("at"))
    whole = found.join(again, ["anchor", "digest"])
    if keep_first:
        same = F.col("key").eqNullSafe(F.col("at.key")) & (F.col("mark") == F.col("at.mark")) & (
            F.col("first") == F.col("at.first"))
        whole = whole.where(~same)
    spans = whole.select("key", "mark", "first", (F.col("last") + length).alias("end"))

    open_anchors = distinct.groupBy("anchor", own_shuffle("anchor")).agg(
        F.count("*").alias("different"), F.min("times").alias("least")
    ).where((F.col("different") > 1) & (F.lit(keep_first) | (F.col("least") == 1))).select("anchor", "different")
    wanted = written(
        distinct.join(open_anchors, "anchor").select("anchor", "different", "at.*"), "open-segments", passing
    )
    holders = source.where(in_table(bit_table(wanted, F.col("mark")), F.col("mark")))
    texts = _joined(holders, wanted, "inner").select(
        "key", "mark", "first", "anchor", "different",
        F.substring(F.encode("text", "UTF-8"), F.col("first") + 1, F.col("last") - F.col("first") + length).alias("text"),
    )
    texts = written(texts, "open-texts", passing)
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(parts, total // BUCKET_BYTES + 1)
    few = texts.where(F.col("different") <= CROWD).withColumn("bucket", F.pmod("anchor", F.lit(buckets)))
    spans = spans.union(_bucket_matches(few.select("key", "mark", "first", "text", "bucket"), length, keep_first))
    windows = _window_rows(texts.where(F.col("different") > CROWD), length)
    shared = windows.groupBy("window", own_shuffle("window")).agg(
        F.count("*").alias("times"), F.min(F.struct("key", "mark", "first")).alias("at")
    ).where("times > 1").drop("_spread")
    crowd = windows.join(shared, "window")
    if keep_first:
        crowd = crowd.where(~(F.col("key").eqNullSafe(F.col("at.key")) & (F.col("mark") == F.col("at.mark"))
                              & (F.col("first") == F.col("at.first"))))
    spans = spans.union(crowd.select("key", "mark", "first", (F.col("first") + length).alias("end")))
    spans = written(spans.distinct(), "spans")
    delete_steps(docs.sparkSession, passing)

    marks = bit_table(spans, F.col("mark"))
    by_document = spans.groupBy("key", "mark").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    changed = _cut(_joined(source.where(in_table(marks, F.col("mark"))), by_document, "left"))
    whole_text = F.coalesce("text", F.lit(""))
    same = source.where(~in_table(marks, F.col("mark"))).select(
        "key", F.octet_length(whole_text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.encode(whole_text, "UTF-8").alias("kept"),
    )
    return changed.union(same).withColumnRenamed("key", key)
