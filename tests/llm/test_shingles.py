"""Word shingles, the Jaccard join and decontamination against plain Python."""

import collections
import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from askloom.llm import jaccard
from askloom.llm.decontamination import contaminated
from askloom.llm.frames import read
from askloom.llm.jaccard import jaccard_components, tree_pairs
from askloom.llm.tokens import shingles, slices, words

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_set(text, width=5):
    w = plain_words(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


ODD = [None, "", " \t\n", "a", "A b C", "a b c", "one two three four five", "é É\x0bx\x85y z w q r s", "x " * 12, "the end the end the end the end"]


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_words_and_shingles(size):
    texts = ODD + ["".join(random.Random(i).choice("ab \néZ") for _ in range(i)) for i in range(60)]
    seen, back = {}, {}
    for i, j, data, offsets in slices(pa.array(texts, pa.string()), size):
        w = words(data, offsets)
        value, doc, at = shingles(w)
        for d in range(j - i):
            own = plain_words(texts[i + d])
            assert w.first[d + 1] - w.first[d] == len(own)
            got = [int(v) for v in value[doc == d]]
            want = [tuple(own[k:k + 5]) for k in range(len(own) - 4)] if len(own) >= 5 else ([tuple(own)] if own else [])
            assert len(got) == len(want)
            for v, s in zip(got, want):
                assert seen.setdefault(v, s) == s and back.setdefault(s, v) == v


# -- Jaccard


def plain_components(texts):
    """doc_id -> (size, component) over all pairs."""
    sets = {i: plain_set(t) for i, t in texts.items()}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    shared = collections.Counter()
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                shared[ids[a], ids[b]] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            comp[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_copies(rng, vocabulary, families, copies, length):
    texts = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + length // 30)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < .3:
                own = own[:int(len(own) * rng.uniform(.7, 1))]
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("part", [8, 1024])
def test_components_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(jaccard, "PART", part)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts = ODD + near_copies(rng, vocabulary, 12, 12, 60) + near_copies(rng, vocabulary, 1, 60, 90)
    texts += [f"{passage} {t}" for t in near_copies(rng, vocabulary, 40, 1, 40)] + ["x " * 12, "A B c"]
    table = dict(enumerate(texts))
    docs = spark.createDataFrame(list(table.items()), "doc_id long, text string").repartition(4)
    docs = docs.withColumn("node", F.lit("clash")).withColumn("token", F.lit(1))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert got == plain_components(table)


def test_near_copies_with_exact_copies_in_other_tasks(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = near_copies(rng, vocabulary, 30, 2, 80)
    table = dict(enumerate(texts + texts))
    # Four tasks: every text is read by two of them.
    rows = spark.sparkContext.parallelize(list(table.items()), 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    want = plain_components(table)
    assert got == want and len({c for _, c in want.values()}) < 50


@pytest.mark.parametrize("rows", [1, 2, 3, 100])
def test_rows_of_blocks_are_distinct(rows):
    token = [1, 1, 1, 2, 2, 3, 4, 4, 4, 4, 5]
    node = [7, 7, 8, 7, 7, 9, 5, 5, 6, 6, 5]
    table = pa.RecordBatch.from_pydict({"token": token, "node": node, "n": [4] * len(token)})
    batches = [table.slice(k, rows) for k in range(0, len(token), rows)]
    got = [(r["token"], r["node"]) for b in jaccard._shared(iter(batches)) for r in b.to_pylist()]
    assert got == [(1, 7), (1, 8), (4, 5), (4, 6)]


def test_components_of_the_tables(spark):
    docs = read(spark, FOLDER, "documents")
    table = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    want = plain_components(table)
    assert got == want and any(i != c for i, (_, c) in want.items())


def test_component_odd_rows(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (9, "A b c d e f"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, jaccard_components(docs).collect()), key=str)
    assert got == sorted([(None, 2, None, 1), (7, 2, 7, 3), (7, 2, 7, 3), (9, 2, 7, 3), (3, 0, 3, 1), (4, 0, 4, 1)], key=str)
    assert jaccard_components(docs.limit(0)).count() == 0


def test_pair_of_many_blocks_is_made_once():
    """Rows of two like nodes in forty blocks, a batch for each, as tasks read them."""
    rng = np.random.default_rng(4)
    held = rng.integers(0, 2**64, 200, np.uint64)
    counts = [jaccard._counts(np.unique(np.append(held, rng.integers(0, 2**64, 5, np.uint64)))).tobytes() for _ in range(2)]
    blocks = list(range(100, 140))
    batches = [pa.RecordBatch.from_arrays(
        [pa.array([t] * 2), pa.array([0] * 2), pa.array([0] * 2), pa.array([1, 2]), pa.array([205] * 2), pa.array([1, 2]), pa.array([0] * 2),
         pa.array(counts, pa.binary()), pa.array([blocks[max(0, k - jaccard.EARLIER):k]] * 2, pa.list_(pa.int64()))],
        ["token", "i", "j", "node", "n", "component", "side", "counts", "earlier"]) for k, t in enumerate(blocks)]
    assert [tuple(r.values()) for b in jaccard._tree_join(Fraction(3, 4))(iter(batches)) for r in b.to_pylist()] == [(1, 2)]


def points_of(sets):
    return jaccard.Points(pa.array([jaccard._counts(x).tobytes() for x in sets], pa.binary()))


def test_tree_loses_no_pair():
    """Sets of many sizes, on both sides of the borders between widths, against all pairs."""
    rng = np.random.default_rng(3)
    sets = []
    for size in (10, 300, 900, 1020, 1030, 1200, 2040, 2060, 5000):
        base = rng.integers(0, 2**64, size, np.uint64)
        for share in (1.0, .95, .9, .8, .7):
            own = base[:int(size * share)]
            sets.append(np.unique(np.concatenate([own, rng.integers(0, 2**64, size // 40, np.uint64)])))
        sets += [np.unique(rng.integers(0, 2**64, size, np.uint64)) for _ in range(6)]
    n, m = np.array([len(x) for x in sets]), len(sets)
    points, group = points_of(sets), np.arange(m) // 2
    got = [tuple(sorted(p)) for p in tree_pairs(points, n, group, np.zeros(m, np.int64), Fraction(3, 4)).tolist()]
    assert len(got) == len(set(got))
    linked = set()
    for i in range(m):
        for j in range(i + 1, m):
            shared = len(np.intersect1d(sets[i], sets[j]))
            assert shared <= points.room(np.array([i]), np.array([j]))[0]
            if group[i] != group[j] and 4 * shared >= 3 * (n[i] + n[j] - shared):
                linked.add((i, j))
    # Unrelated sets, of whatever size, hardly ever come out.
    assert linked <= set(got) and len(linked) > 30 and len(got) < 1.5 * len(linked)


def test_sides_and_full_counters():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**56, 2000, np.uint64)) for _ in range(2)]  # all in one group
    sets += [np.unique(rng.integers(0, 2**64, 2000, np.uint64)) for _ in range(2)]
    n, points = np.array([len(x) for x in sets]), points_of(sets)
    assert points.full.tolist() == [True, True, False, False]
    pairs = tree_pairs(points, n, np.arange(4), np.zeros(4, np.int64), Fraction(3, 4)).tolist()
    assert {tuple(sorted(p)) for p in pairs} == {(0, 1), (0, 2), (0, 3), (1, 2), (1, 3)}
    pairs = tree_pairs(points, n, np.arange(4), np.array([1, 1, 2, 2]), Fraction(3, 4)).tolist()
    assert {tuple(sorted(p)) for p in pairs} == {(0, 2), (0, 3), (1, 2), (1, 3)}


def test_large_sets(spark):
    """Sets of up to 70,000 shingles that share a passage, some of them near copies."""
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(50_000)]
    passage = [rng.choice(vocabulary) for _ in range(80)]
    texts = []
    for size in (10, 1_000, 10_000, 70_000):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for edits, cut in ((0, 1), (size // 60, 1), (0, .8), (size // 12, 1)):
            own = base[:int(size * cut)]
            for _ in range(edits):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own + passage))
        texts.append(" ".join([rng.choice(vocabulary) for _ in range(size)] + passage))
    table = dict(enumerate(texts))
    docs = spark.createDataFrame(list(table.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert got == plain_components(table)


# -- decontamination


def plain_pairs(docs, items):
    sets = {k: plain_set(t) for k, t in items.items()}
    out = set()
    for i, text in docs.items():
        own = plain_set(text)
        out |= {(i, k, len(own & s), len(s)) for k, s in sets.items() if s and 4 * len(own & s) >= 3 * len(s)}
    return out


def test_contamination_equals_brute_force(spark):
    docs, items = read(spark, FOLDER, "documents"), read(spark, FOLDER, "benchmark")
    got = {tuple(r)[:4] for r in contaminated(docs, items).collect()}
    want = plain_pairs(*({r[0]: r["text"] for r in t.collect()} for t in (docs, items)))
    assert got == want and want


def test_contamination_of_long_texts_and_odd_rows(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = {k: " ".join(rng.choice(vocabulary) for _ in range(n)) for k, n in enumerate((1, 3, 5, 6, 9, 12, 20, 40, 90, 300))}
    docs = {0: None, 1: "", 2: items[1].upper(), 3: items[2]}
    for k in items:
        for cut in (1.0, .85, .6):
            own = items[k].split()
            own = own[:max(1, int(len(own) * cut))]
            docs[len(docs)] = " ".join([*(rng.choice(vocabulary) for _ in range(5000)), *own, *(rng.choice(vocabulary) for _ in range(700))])
    half = items[8].split()
    docs[len(docs)] = " ".join(half[:45] + [rng.choice(vocabulary) for _ in range(3000)] + half[45:])
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([*items.items(), (5, items[5]), (None, None), (77, "")], "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = [tuple(r)[:4] for r in contaminated(table, bench).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_pairs(docs, items)
    assert contaminated(table.limit(0), bench).count() == 0 and contaminated(table, bench.limit(0)).count() == 0
    twice = table.where("doc_id = 3").unionAll(table.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    assert sorted((r["doc_id"] is None, r["item_id"]) for r in contaminated(twice, bench).collect()) == [(False, 2), (True, 2)]


def test_contamination_in_blocks(spark, monkeypatch):
    from askloom.llm import decontamination

    docs, items = read(spark, FOLDER, "documents"), read(spark, FOLDER, "benchmark")
    whole = {tuple(r) for r in contaminated(docs, items).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 3000)
    assert {tuple(r) for r in contaminated(docs, items).collect()} == whole


def test_tasks_take_and_send_bounded_batches(spark, monkeypatch):
    texts = [" ".join(f"w{i}x{k}" for k in range(400)) for i in range(300)]
    parts = jaccard._first_parts(np.zeros(0, np.uint64), Fraction(3, 4))
    sent = [b.num_rows for b in parts(iter([pa.RecordBatch.from_arrays([pa.array(texts * 4)], ["text"])]))]
    assert sum(sent) == 300 * 100 and max(sent) <= jaccard.BATCH_ROWS + 100
    values = [b.num_rows for b in jaccard._values(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))]
    assert sum(values) == 300 * 396 and max(values) <= jaccard.BATCH_ROWS + 396

    taken, describe = spark.sparkContext.accumulator(0), jaccard._describe

    def counted(batches):
        for batch in batches:
            taken.add(1)
            yield from describe(iter([batch]))

    monkeypatch.setattr(jaccard, "_describe", counted)
    monkeypatch.setattr(jaccard, "BATCH_BYTES", 1 << 16)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    assert jaccard_components(rows).where("component_id = doc_id AND n_shingles = 396").count() == 300
    assert taken.value >= 10 and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_frequent_shingles_take_few_bytes_in_the_driver(spark, monkeypatch):
    import tracemalloc

    monkeypatch.setattr(jaccard, "SAMPLED", 1)
    text = " ".join(f"w{k}" for k in range(60_004))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "a b c d e")], "row_id long, text string")
    assert len(jaccard._frequent(docs.limit(0))) == 0  # imports
    tracemalloc.start()
    found = jaccard._frequent(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 60_000 and (found[1:] > found[:-1]).all() and found.dtype == "uint64"
    assert peak < 60 * len(found)
