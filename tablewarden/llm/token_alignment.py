"""Alignment of two tokenizations of the same texts, and how often tokens are linked in a corpus.

1. Both vocabularies encode a text with a space in front; a task keeps byte lengths of all entries, so byte offsets of tokens
   are running sums. A text whose tokens do not spell it in bytes is left without tokens.
2. :func:`shared_cuts` divides and conquers: in an interval of tokens it probes ends from the middle outwards, by bisecting
   the ends of the other side, splits at the first common end and goes on with both halves. An interval without one is a
   leaf: its tokens form one group. All open intervals of a chunk of texts advance together.
3. Inside the groups, tokens with overlapping bytes are links, one for each piece that the ends of both sides cut.
4. Counting: tasks work on chunks of texts, each written as rows of its texts (distinct pairs of ids and how often) and one row
   of the chunk (distinct pairs and how many of its texts hold them). Only the chunks' pairs are shuffled by pair: to be added
   up, and to take the corpus-wide counts back to their chunk. A pair has one row per chunk at most, however frequent it is.
   The highest count of each A id has one row per vocabulary entry, so it may be broadcast.
5. Texts and counts of a chunk meet by the chunk's number.

Defined results: NULL and empty texts, and those that the tokens do not spell, have zero counts and empty groups. Repeated
rows count each. An empty table gives no rows. Columns other than ``keep`` and the text are not read. Texts are encoded
whole; long ones in pieces that no token spans.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_shared_path
from .bpe_codec import visible_bytes
from .common import map_texts, text_slices, written

CHUNK_BYTES = 2 << 20  # of text; a longer text is a chunk of its own
PIECE = 1 << 18  # code points that go to an encoder at once
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Fixed value: how byte-level vocabularies split texts before their merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class may depend on the standard's version, and runs that the encoder for ranks is slow on.
_UNSETTLED = re.compile("[^\0-\u024f]")
LONG_RUN = 250
_LONG_SPACE = re.compile(rf"\s{{{LONG_RUN}}}")


def pieces(text: str) -> list[str]:
    """A text in parts of about ``PIECE`` code points, parted at single spaces, which go with neither part.

    No token of either kind reaches from behind a character to a space and further, and both encoders put a space in front
    of what they get.
    """
    if len(text) <= PIECE:
        return [text]
    parts, at = [], 0
    while True:
        cut = _CUT.search(text, at + PIECE)
        if cut is None:
            return [*parts, text[at:]]
        parts.append(text[at:cut.start()])
        at = cut.end()


def _settled(text: str) -> bool:
    return (
        (text.isascii() or not _UNSETTLED.search(text)) and not _LONG_SPACE.search(text)
        and max(map(len, text.split()), default=0) < LONG_RUN
    )


class ByteEncoder:
    """A byte-level vocabulary file; texts get a space in front, strings of special tokens are plain text.

    Where the file's merges are in the order of their ids and every entry encodes to itself, the ids are ranks, and texts whose
    characters every standard classes alike go to the faster encoder for ranks. All others go to the file's own library.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        byte = {c: b for b, c in enumerate(visible_bytes())}
        self.spelled = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.spelled[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.ranked = self._ranks(file)

    def _ranks(self, file: str):
        with open(file, encoding="utf-8") as source:
            content = json.load(source)
        model, splitter = content["model"], content.get("pre_tokenizer") or {}
        vocab = model["vocab"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        plain = (
            splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
            and not content.get("normalizer") and not model.get("ignore_merges") and made == sorted(made)
        )
        tokenize = self.tokenizer.model.tokenize
        if not plain or any(len(tokenize(token)) != 1 for token in vocab):
            return None
        import tiktoken

        ranks = {self.spelled[i]: i for i in vocab.values()}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        settled = [self.ranked is not None and _settled(t) for t in texts]
        others = self.tokenizer.encode_batch_fast(
            [" " + t for t, s in zip(texts, settled) if not s], add_special_tokens=False
        )
        rest = iter(others)
        return [self.ranked.encode_ordinary(" " + t) if s else next(rest).ids for t, s in zip(texts, settled)]


class PieceEncoder:
    """A sentence-piece model that puts a space in front by itself."""

    def __init__(self, file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=file)
        size = self.model.get_piece_size()
        names = self.model.id_to_piece(list(range(size)))
        self.spelled = [
            bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
            for i, n in enumerate(names)
        ]
        self.parts_apart = not any(re.search("[^▁]▁", n) for n in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of the sorted ``ends_a`` in the intervals ``low`` to ``high`` (of places, exclusive) are in ``ends_b`` too.

    After a probe between two cuts has failed it is not repeated but for the halves that share its gap, so the work is
    linear in the ends, times the bisection.
    """
    cut = np.zeros(len(ends_a), bool)
    tried = np.zeros(len(low), np.int64)
    while len(low):
        probe = (low + high) // 2 + np.where(tried % 2 == 1, -((tried + 1) // 2), tried // 2)
        hit = (probe >= low) & (probe < high)
        end = ends_a[probe[hit]]
        hit[hit] = ends_b[np.searchsorted(ends_b, end)] == end
        found = probe[hit]
        cut[found] = True
        again = ~hit & (tried < high - low)
        tried = np.concatenate([tried[again] + 1, np.zeros(2 * len(found), np.int64)])
        low, high = (
            np.concatenate([low[again], low[hit], found + 1]), np.concatenate([high[again], found, high[hit]])
        )
        real = high > low
        low, high, tried = low[real], high[real], tried[real]
    return cut


class Aligned:
    """Tokens, groups and links of a chunk of texts that both sides spell."""

    def __init__(self, ids_a: list[list[int]], ids_b: list[list[int]], size_a: np.ndarray, size_b: np.ndarray):
        self.n_a = np.array([len(x) for x in ids_a], np.int64)
        self.n_b = np.array([len(x) for x in ids_b], np.int64)
        self.a = np.fromiter(chain.from_iterable(ids_a), np.int64, int(self.n_a.sum()))
        self.b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(self.n_b.sum()))
        self.last_a, self.last_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        ends_a, ends_b = np.cumsum(size_a[self.a]), np.cumsum(size_b[self.b])  # texts end alike, so offsets may run on
        self.cut = shared_cuts(ends_a, ends_b, self.last_a - self.n_a, self.last_a - 1)
        self.cut[self.last_a - 1] = True
        self.cut_a = np.flatnonzero(self.cut)
        self.cut_b = np.searchsorted(ends_b, ends_a[self.cut_a])
        inside_b = np.ones(len(self.b), bool)
        inside_b[self.cut_b] = False
        inside_b = np.flatnonzero(inside_b)
        # A piece ends where a token ends; the piece belongs to the tokens of both sides that hold it.
        self.link_a = np.concatenate([np.arange(len(self.a)), np.searchsorted(ends_a, ends_b[inside_b])])
        self.link_b = np.concatenate([np.searchsorted(ends_b, ends_a), inside_b])
        self.n_groups = np.diff(np.searchsorted(self.cut_a, np.concatenate([[0], self.last_a])))
        self.n_links = self.n_a + self.n_b - self.n_groups

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text and distinct pair of ids: the text, the pair as one number, and its links."""
        text = np.searchsorted(self.last_a, self.link_a, side="right")
        pair = self.a[self.link_a] * width + self.b[self.link_b]
        order = np.lexsort((pair, text))
        text, pair = text[order], pair[order]
        first = np.concatenate([[True], (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])]) if len(pair) else np.zeros(0, bool)
        at = np.flatnonzero(first)
        return text[at], pair[at], np.diff(np.concatenate([at, [len(pair)]]))

    def groups(self, names: tuple[np.ndarray, ...]) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        plain, comma_a, next_a, comma_b, bar_b = names
        first_a = np.concatenate([[True], self.cut[:-1]])
        group_a = np.cumsum(first_a) - 1
        first_b = np.zeros(len(self.b), bool)
        first_b[0] = True
        first_b[self.cut_b[:-1] + 1] = True
        group_b = np.cumsum(first_b) - 1
        place_a = np.arange(len(self.a)) + np.concatenate([[0], self.cut_b[:-1] + 1])[group_a]
        place_b = np.arange(len(self.b)) + (self.cut_a + 1)[group_b]
        told = np.empty(len(self.a) + len(self.b), object)
        told[place_a] = np.where(first_a, next_a[self.a], comma_a[self.a])
        told[place_b] = np.where(first_b, bar_b[self.b], comma_b[self.b])
        begin = self.last_a - self.n_a
        told[place_a[begin]] = plain[self.a[begin]]
        stops = self.last_a + self.last_b
        return ["".join(told[s - n:s]) for s, n in zip(stops.tolist(), (self.n_a + self.n_b).tolist())]


class TokenAligner:
    """Both encoders, and alignment of lists of texts."""

    def __init__(self, file_a: str, file_b: str):
        self.first, self.second = ByteEncoder(file_a), PieceEncoder(file_b)
        self.size_a, self.size_b = (
            np.array([len(s) for s in e.spelled], np.int64) for e in (self.first, self.second)
        )
        self.width = len(self.second.spelled)
        a, b = ([str(i) for i in range(len(e.spelled))] for e in (self.first, self.second))
        self.names = tuple(
            np.array([sign + i for i in ids], object) for ids, sign in ((a, ""), (a, ","), (a, ";"), (b, ","), (b, "|"))
        )

    def encode(self, texts: list[str | None]) -> tuple[list[int], list[list[int]], list[list[int]]]:
        """Places of the texts that both sides spell, and their ids."""
        places, ids_a, ids_b = [], [], []
        whole = [i for i, t in enumerate(texts) if t]
        parts = [pieces(texts[i]) if self.second.parts_apart else [texts[i]] for i in whole]
        flat = [p for part in parts for p in part]
        found_a, found_b = iter(self.first.encode(flat)), iter(self.second.encode(flat))
        spell_a, spell_b = self.first.spelled.__getitem__, self.second.spelled.__getitem__
        for i, part in zip(whole, parts):
            a, b = next(found_a), next(found_b)
            if len(part) > 1:
                a = [*a, *chain.from_iterable(islice(found_a, len(part) - 1))]
                b = [*b, *chain.from_iterable(islice(found_b, len(part) - 1))]
            wanted = (" " + texts[i]).encode()
            if b"".join(map(spell_a, a)) == wanted == b"".join(map(spell_b, b)):
                places.append(i)
                ids_a.append(a)
                ids_b.append(b)
        return places, ids_a, ids_b

    def align(self, texts: list[str | None]) -> tuple[list[int], Aligned | None]:
        places, ids_a, ids_b = self.encode(texts)
        return places, Aligned(ids_a, ids_b, self.size_a, self.size_b) if places else None


def align_texts(
    docs: DataFrame, file_a: str, file_b: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep``, the ids of both sides (``ids_a``, ``ids_b``) and ``groups`` (``a1,a2|b1;a3|b2,b3``) for every row."""

    def make():
        aligner = TokenAligner(file_a, file_b)

        def run(texts):
            places, ids_a, ids_b = aligner.encode(texts)
            none = [[]] * len(texts)
            found = {"ids_a": list(none), "ids_b": list(none), "groups": [""] * len(texts)}
            if places:
                told = Aligned(ids_a, ids_b, aligner.size_a, aligner.size_b).groups(aligner.names)
                for i, a, b, groups in zip(places, ids_a, ids_b, told):
                    found["ids_a"][i], found["ids_b"][i], found["groups"][i] = a, b, groups
            return found

        return run

    fields = {"ids_a": pa.list_(pa.int32()), "ids_b": pa.list_(pa.int32()), "groups": pa.string()}
    return map_texts(docs, keep, text, make, fields, size=CHUNK_BYTES)


def _aligned_rows(inner: DataFrame, slots: list[str], file_a: str, file_b: str, digest: bool, pair_type) -> DataFrame:
    """Rows of texts (``kind`` 0) and of chunks (``kind`` 1), see :func:`score_alignments`."""
    kinds = dict(inner.dtypes)
    number = "int" if pair_type == pa.int32() else "bigint"
    measures = ("n_a", "n_b", "n_groups", "n_links")
    schema = ", ".join([f"{s} {kinds[s]}" for s in slots] + [
        "kind int", "chunk bigint", *[f"{m} bigint" for m in measures], "groups string", f"pairs array<{number}>", "times array<int>",
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = TokenAligner(file_a, file_b)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text_slices(batch, len(slots), 1 << 20, CHUNK_BYTES):
                rows = part.num_rows
                places, aligned = aligner.align(part.column(len(slots)).to_pylist())
                found = {m: np.zeros(rows + 1, np.int64) for m in measures}
                groups = [""] * rows + [None]
                sizes = np.zeros(rows + 1, np.int64)
                pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if aligned:
                    for m in measures:
                        found[m][places] = getattr(aligned, m)
                    for i, told in zip(places, aligned.groups(aligner.names)):
                        groups[i] = hashlib.sha256(told.encode()).hexdigest() if digest else told
                    text, pairs, times = aligned.pairs(aligner.width)
                    sizes[places] = np.bincount(text, minlength=len(places))
                    every, holders = np.unique(pairs, return_counts=True)
                    sizes[rows] = len(every)
                    pairs, times = np.concatenate([pairs, every]), np.concatenate([times, holders])
                bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                columns = [
                    pa.concat_arrays([part.column(i), pa.nulls(1, part.column(i).type)]) for i in range(len(slots))
                ]
                columns += [
                    pa.array([0] * rows + [1], pa.int32()), pa.array([chunk] * (rows + 1), pa.int64()),
                    *[pa.array(found[m]) for m in measures], pa.array(groups, pa.string()),
                    pa.ListArray.from_arrays(bounds, pa.array(pairs, pair_type)),
                    pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[
                    *slots, "kind", "chunk", *measures, "groups", "pairs", "times"
                ])
                chunk += 1

    return inner.mapInArrow(run, schema)


def score_alignments(
    docs: DataFrame, file_a: str, file_b: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), digest: bool = False
) -> DataFrame:
    """``keep``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` and the corpus-wide measures of every text.

    The count of a pair of ids is the number of texts that hold it linked. ``n_best`` is the number of links whose count is the
    highest of their A id, ``count_sum`` the sum of the counts over links. With ``digest`` the groups are told by their SHA-256
    (lowercase hex), so that their long texts are not moved; without tokens they are the empty text in either case.
    """
    results = ("kind", "chunk", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times", "n_best", "count_sum")
    clash = set(keep) & set(results)
    if clash:
        raise ValueError(f"kept columns {sorted(clash)} have names of results; rename them first")
    sizes = [len(e.spelled) for e in (ByteEncoder(file_a), PieceEncoder(file_b))]
    pair_type = pa.int32() if sizes[0] * sizes[1] < 1 << 31 else pa.int64()
    spark = docs.sparkSession
    slots = [f"kept_{i}" for i in range(len(keep))]
    inner = docs.select(*[F.col(f"`{k}`").alias(s) for k, s in zip(keep, slots)], F.col(f"`{text}`").alias("text_in"))
    rows = _aligned_rows(inner, slots, file_a, file_b, digest, pair_type)
    path = new_shared_path(spark, "alignment")
    rows.write.partitionBy("kind").parquet(path)
    schema = rows.drop("kind").schema
    stored = {kind: spark.read.schema(schema).parquet(f"{path}/kind={kind}") for kind in (0, 1)} if _any(spark, path) else {
        kind: spark.createDataFrame([], schema) for kind in (0, 1)
    }
    held = stored[1].select("chunk", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    counts = written(held.groupBy("pair").agg(F.sum("times").alias("n")), "alignment-counts")
    own = F.expr(f"pair div {sizes[1]}")
    highest = counts.groupBy(own.alias("a")).agg(F.max("n").alias("most"))  # a row per vocabulary entry at most
    rated = counts.withColumn("a", own).join(F.broadcast(highest), "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )
    told = held.select("chunk", "pair").join(rated, "pair")

    def finish(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return out.empty_table()
        pair = known.column("pair").to_numpy()
        order = np.argsort(pair)
        pair = pair[order]
        n = known.column("n").to_numpy()[order]
        best = known.column("best").to_numpy()[order]
        lists, times = (texts.column(c).combine_chunks() for c in ("pairs", "times"))
        bounds = lists.offsets.to_numpy()
        at = np.searchsorted(pair, lists.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]])
        weight = times.values.to_numpy(zero_copy_only=False)[times.offsets[0].as_py():times.offsets[-1].as_py()].astype(np.int64)
        bounds = bounds - bounds[0]

        def summed(values):
            return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])

        columns = [texts.column(c) for c in (*slots, "n_a", "n_b", "n_groups", "n_links", "groups")]
        return pa.table([*columns, summed(weight * best[at]), summed(weight * n[at])], schema=out)

    kinds = dict(stored[0].dtypes)
    listed = [*slots, "n_a", "n_b", "n_groups", "n_links", "groups"]
    ddl = ", ".join([*[f"{c} {kinds[c]}" for c in listed], "n_best bigint", "count_sum bigint"])
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(ddl))
    joined = stored[0].groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(finish, ddl)
    return joined.select(*[F.col(s).alias(k) for k, s in zip(keep, slots)], *joined.columns[len(slots):])


def _any(spark, path: str) -> bool:
    """Whether the written rows below a path have any: an empty table writes no partition folders."""
    return not spark.read.schema("chunk bigint, kind int").parquet(path).isEmpty()
