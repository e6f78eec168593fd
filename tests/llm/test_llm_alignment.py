"""Token alignment against the libraries and plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tablewarden.llm import token_alignment

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """Results of the contract, with sets of byte offsets."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    aligned, held = [], Counter()
    for _, text in rows:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        spelled_a = [bytes(byte[c] for c in first.id_to_token(i)) for i in a]
        spelled_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
                     else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(spelled_a) != (" " + text).encode() or b"".join(spelled_b) != (" " + text).encode():
            aligned.append(([], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(s) for s in spelled_a]).tolist(), np.cumsum([len(s) for s in spelled_b]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = []
        for begin, end in zip([0, *cuts], cuts):
            groups.append(",".join(str(i) for i, e in zip(a, ends_a) if begin < e <= end) + "|"
                          + ",".join(str(i) for i, e in zip(b, ends_b) if begin < e <= end))
        links = []
        for i, (e, s) in enumerate(zip(ends_a, spelled_a)):
            for j, (f, t) in enumerate(zip(ends_b, spelled_b)):
                if max(e - len(s), f - len(t)) < min(e, f):
                    links.append((a[i], b[j]))
        held.update(set(links))
        aligned.append((a, b, groups, links))
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return sorted(((key, len(a), len(b), len(groups), len(links), sum(held[x] == most[x[0]] for x in links),
                    sum(held[x] for x in links), ";".join(groups)) for (key, _), (a, b, groups, links) in zip(rows, aligned)), key=str)


def corpus():
    dice = random.Random(3)
    words = ["naïve", "the", "thing", "Straße", "  ", "\n\n", "漢字", "🙂👍🏽", "<|endoftext|>", "<s>", "</s>", "don't", "12345", "é",
             "\t", "x" * 30, "\x00", "ﬁ", "Ωμέγα", "_", "=====", " ", "I've", "ñandú"]
    rows = [(i, "".join(dice.choice(words) + dice.choice([" ", "", ", "]) for _ in range(dice.randint(1, 25)))) for i in range(60)]
    return rows + [(7, rows[7][1]), (None, "no key"), (90, None), (91, ""), (92, "a▁b"), (93, " "), (94, "<0x41> [UNK]"), (95, "a")]


def collected(found):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=str)


def test_scores(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, 1, "p") for k, t in rows], "doc_id long, text string, chunk long, pairs string").repartition(3)
    expected = brute(rows)
    assert collected(token_alignment.score_alignments(docs, *FILES)) == expected
    hashed = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in expected]
    assert collected(token_alignment.score_alignments(docs, *FILES, digest=True)) == hashed
    assert collected(token_alignment.score_alignments(docs.limit(0), *FILES)) == []
    empty = docs.where("text is null")
    assert collected(token_alignment.score_alignments(empty, *FILES)) == [(90, 0, 0, 0, 0, 0, 0, "")]


def test_texts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = token_alignment.align_texts(docs, *FILES).collect()
    assert sorted(((r.doc_id, len(r.ids_a), len(r.ids_b), r.groups) for r in found), key=str) == sorted(
        ((r[0], r[1], r[2], r[7]) for r in brute(rows)), key=str)


def test_cuts_by_halving():
    for seed in range(300):
        dice = random.Random(seed)
        size = dice.randint(1, 200)
        a = np.array(sorted({dice.randint(1, size) for _ in range(dice.randint(0, size))} | {size}))
        b = np.array(sorted({dice.randint(1, size) for _ in range(dice.randint(0, size))} | {size}))
        found = token_alignment.shared_cuts(a, b, np.array([0]), np.array([len(a) - 1]))
        assert a[found].tolist() == [x for x in a.tolist()[:-1] if x in set(b.tolist())]


def test_long_texts_in_pieces(monkeypatch):
    dice = random.Random(9)
    text = "".join(dice.choice(["ab", "thing", "é", ",", "'s", "1", "漢", "_"]) + dice.choice([" ", "", "  ", "\n"]) for _ in range(3000))
    aligner = token_alignment.TokenAligner(*FILES)
    whole = aligner.encode([text])
    monkeypatch.setattr(token_alignment, "PIECE", 50)
    assert len(token_alignment.pieces(text)) > 50
    assert aligner.encode([text]) == whole


def test_a_text_without_common_ends():
    places, aligned = token_alignment.TokenAligner(*FILES).align(["x" * 400_000, "a"])
    assert places == [0, 1] and int(aligned.n_links.sum()) == len(aligned.a) + len(aligned.b) - int(aligned.n_groups.sum())


def test_ranks_and_merges_give_the_same_ids():
    encoder = token_alignment.ByteEncoder(FILES[0])
    assert encoder.ranked is not None
    texts = [t.format(chr(c)) for c in range(0x250) for t in ("a{0}b", " {0} {0}", "1{0}1 {0}{0}x", "{0}'s{0}!", "\n{0}\n {0}  ")]
    dice = random.Random(4)
    texts += ["".join(chr(dice.choice([dice.randrange(0x250), 32, 10, 101])) for _ in range(80)) for _ in range(2000)]
    merged = encoder.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
    assert encoder.encode(texts) == [m.ids for m in merged]
