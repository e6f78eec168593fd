"""The pipeline against plain Python, stage by stage and as a whole."""

import os
import sys

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute
import corpus_pipeline
from tablewarden.llm import quality_rules

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with copies, junk and odd rows, and a benchmark with one passage of theirs."""
    path = str(tmp_path_factory.mktemp("sf"))
    texts = [t for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
             if len(t) < 6000][:70]
    rows = list(enumerate(texts)) + [(200 + i, t) for i, t in enumerate(brute.ODD_TEXTS)]
    rows += [(100 + i, " ".join(w if k % 60 else "changed" for k, w in enumerate(t.split(" "))))
             for i, t in enumerate(texts[:30])]
    rows += [(150 + i, t + "\n" + texts[3]) for i, t in enumerate(texts[10:20])]
    rows += [(300, "NOISE!! " * 80), (301, None), (5, texts[5]), (None, texts[8] + " and some more words")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet")
    passage = " ".join(max(texts, key=len).split()[5:30])
    spark.createDataFrame([(1, passage), (2, "not in any of these texts at all, and long enough for one")],
                          "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, [(1, passage), (2, "not in any of these texts at all, and long enough for one")]


def expected(rows, items):
    fertility = quality_rules.Fertility(public_tokenizers.path("piece_bpe_32k.model"))
    kept = []
    for key, text in rows:
        words, _, _, _, again = quality_rules.base_counts(text)
        good = quality_rules.in_band(quality_rules.BANDS["en"], *fertility.measure(text))
        if words >= 50 and 100 * again <= 50 * words and good:
            kept.append((key, text))
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    kept = [(k, t) for k, n, gone, t in brute.dedup_lines(kept) if n > gone]
    kept = [r for r, (k, _, least) in zip(kept, brute.classes(kept)) if k is None or k == least]
    kept = list(dict.fromkeys(kept))  # equal rows are one document
    kept = [r for r, (_, _, hit, _) in zip(kept, brute.contamination(kept, items)) if not hit]
    library = Tokenizer.from_file(WORDS)
    library.no_truncation()
    library.no_padding()
    return sorted(((str(k), library.encode(t, add_special_tokens=False).ids) for k, t in kept))


def test_whole_pipeline(spark, folder):
    path, rows, items = folder
    found = corpus_pipeline.run(spark, path)
    want = expected(rows, items)
    assert sorted((str(r.doc_id), r.ids) for r in found.collect()) == want
    assert 5 < len(want) < len(rows) - 10
    assert all(r.n_tokens == len(r.ids) for r in found.collect())


def test_stages_keep_the_columns(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "line_dedup", "near_duplicates", "decontamination", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert tuple(stage(spark, docs, path).columns) == corpus_pipeline.COLUMNS, name


def test_empty_documents(spark, folder, tmp_path):
    path, _, _ = folder
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_unrelated_texts_under_one_id_stay(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[i:i + 40]) for i in (0, 40, 80, 120)]
    near = texts[0] + " more"
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (2, near), (3, texts[1]), (3, texts[1]), (None, texts[0]), (4, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(
        [(1, texts[0]), (1, texts[1]), (2, texts[2]), (4, None), (None, texts[0])], key=str)
