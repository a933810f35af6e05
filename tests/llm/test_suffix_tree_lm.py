"""Language-model scores: exact base, a normalised tree, better than the base on held-out texts."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from askloom.llm import suffix_tree_lm
from askloom.llm.frames import read
from askloom.llm.queries import QUERIES
from askloom.llm.suffix_tree_lm import DEPTH, END, grams, learn, learn_tree, score_texts, symbols
from askloom.llm.tokens import slices, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_symbols(text):
    out = []
    for word in plain_words(text):
        b = word.encode()
        b += b" " if len(b) % 2 else b" \0"
        out += [b[k] << 8 | b[k + 1] for k in range(0, len(b), 2)]
    return [*out, END]


def test_symbols_and_grams():
    texts = ["", "Ab c", " éa\nxyz ", None, "a", "wörter im text " * 3]
    for i, j, data, offsets in slices(pa.array(texts, pa.string()), 20):
        symbol, first = symbols(data, words(data, offsets), j - i)
        key = grams(symbol, first)
        for d in range(j - i):
            want = plain_symbols(texts[i + d])
            assert symbol[first[d]:first[d + 1]].tolist() == want
            padded = [END] * DEPTH + want
            assert key[first[d]:first[d + 1]].tolist() == [
                sum(s << 16 * (DEPTH - m) for m, s in enumerate(padded[k:k + DEPTH + 1])) for k in range(len(want))]


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_scores(spark, monkeypatch, block):
    monkeypatch.setattr(suffix_tree_lm, "VOCABULARY_BLOCK", block)
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in read(spark, folder, "documents").collect()}
    count = collections.Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 10:
            count.update([*plain_words(t), None])
    n, v = sum(count.values()), len(count)
    got = QUERIES["op5_suffix_tree_lm"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        tokens = [*plain_words(texts[r["doc_id"]]), None]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(t in count for t in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[t] + .1) / (n + .1 * (v + 1))) for t in tokens))
        assert r["score"] < 0


def test_held_out_texts_score_above_the_base(spark):
    got = QUERIES["op5_suffix_tree_lm"](spark, "/root/testdata/sf0.1").where("held_out").agg(
        F.sum("score"), F.sum("base_score"), F.avg((F.col("score") > F.col("base_score")).cast("int"))).head()
    assert got[0] > 0.96 * got[1] and got[2] > 0.8  # sums are negative


def test_chances_sum_to_one(spark):
    docs = spark.createDataFrame([("the cat sat on the mat " * 9,), ("the dog sat on the log " * 7,)] * 20, "text string")
    tree, _ = learn(docs)
    assert len(tree.states[2]) and len(tree.states[1])
    for context in ("", "the cat sa", "the ", "zzzz"):
        before = ([END] * DEPTH + plain_symbols(context)[:-1])[-DEPTH:]
        base = sum(s << 16 * (DEPTH - k) for k, s in enumerate(before))
        total = (10 ** tree.log10(np.arange(1 << 16, dtype=np.uint64) | np.uint64(base))).sum()
        assert total == pytest.approx(1)


def test_a_passage_is_kept_whatever_the_size_of_the_corpus(spark):
    def key(*symbols):
        return sum(s << 16 * (DEPTH - k) for k, s in enumerate(symbols))

    passage = [(key(10, 11, 12, 13), 100), (key(30, 11, 12, 14), 100)]
    for filler in (100, 10 ** 11):
        rows = [*passage, (key(1, 2, 3, 4), filler), (key(1, 2, 3, 13), filler)]
        tree = learn_tree(spark.createDataFrame(rows, "key long, n long"))
        assert key(10, 11, 12, 13) in tree.nexts[3].tolist() and key(0, 0, 12, 13) in tree.nexts[1].tolist()
        assert tree.log10(np.array([key(10, 11, 12, 13)], np.uint64))[0] > -0.1


def test_blocks_of_the_tree(spark, monkeypatch):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None), (1, None), (1, ""), (1, "the end")], "doc_id long, text string")
    docs = docs.unionByName(odd)

    def got():
        tree, vocabulary = learn(docs)
        return tree.blocks(), sorted(map(tuple, score_texts(docs, tree, vocabulary).collect()), key=lambda r: (str(r[0]), r[1:]))

    one, want = got()
    monkeypatch.setattr(suffix_tree_lm, "TREE_BLOCK", 3000)
    monkeypatch.setattr(suffix_tree_lm, "VOCABULARY_BLOCK", 3000)
    many, have = got()
    assert one == 1 and many > 2 and len(have) == len(want)
    for a, b in zip(have, want):
        assert a[:3] == b[:3] and a[3:5] == pytest.approx(b[3:5]) and a[5] == b[5]


def test_odd_rows(spark):
    rows = [(None, "a b"), (1, None), (1, None), (2, ""), (3, "?"), (4, "long " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("known", F.lit("clash")).withColumn("key", F.lit(1))
    for training in (docs, docs.limit(0)):
        got = score_texts(docs, *learn(training)).collect()
        assert sorted(r["n_tokens"] for r in got) == [1, 1, 1, 2, 3, 20001]
        assert all(np.isfinite([r["score"], r["base_score"]]).all() for r in got)
    assert score_texts(docs.limit(0), *learn(docs)).count() == 0


def test_tree_is_built_in_little_memory():
    """A level's own arrays and few more, whatever its size."""
    import tracemalloc

    rng = np.random.default_rng(1)
    key = np.unique(rng.integers(0, 2**44, 400_000, np.uint64))
    rng.shuffle(key)
    n = rng.integers(2, 9, len(key), np.int32)
    total = np.full(len(key), 1 << 20, np.int32)
    tracemalloc.start()
    try:
        suffix_tree_lm.build_tree([(key, n, total)] * 2)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 110 * len(key)
