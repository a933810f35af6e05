"""Substring dedup against a brute-force scan of all strings of 100 bytes."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from askloom.llm import suffix_dedup
from askloom.llm.frames import read
from askloom.llm.suffix_dedup import previous_factors, remove_repeats, suffix_order
from askloom.session import configured

FOLDER = "/root/testdata/sf0.001"


def plain(docs):
    """docs: (doc_id, text) in order."""
    seen, out = set(), []
    for key, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            s = data[p:p + 100]
            if s in seen:
                gone[p:p + 100] = True
            seen.add(s)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone]) if len(data) else b""
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
        out.append((key, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, remove_repeats(frame).collect()), key=str)


def test_tables(spark):
    docs = read(spark, FOLDER, "documents")
    want = plain([(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()])
    assert got(docs) == want and any(r[2] for r in want)


def made_up(rng):
    letters = "abcdé \n"
    passages = ["".join(rng.choice(letters) for _ in range(n)) for n in (60, 99, 100, 101, 180, 700)]
    docs = []
    for k in range(160):
        parts = ["".join(rng.choice(letters) for _ in range(rng.randrange(150))) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passages))
        docs.append("".join(parts + ([passages[4]] if k % 3 else [])))
    docs += ["a" * 99, "a" * 100, "a" * 101, "ab" * 200, "ab" * 100 + "é", None, "", "\0" * 150, "\0" * 120 + "x"]
    docs += [docs[3], docs[7] + "tail", "head " + docs[7], "".join(rng.choice("ab") for _ in range(4000)) + docs[5] * 3]
    return docs


@pytest.mark.parametrize("least, share, held, array", [(64, 1000, 1 << 19, 4 << 20), (2, 1 << 30, 50, 3000)])
def test_made_up_texts(spark, monkeypatch, least, share, held, array):
    for name, value in (("CUT_LEAST", least), ("CUT_SHARE", share), ("HELD", held), ("ARRAY_BYTES", array), ("SAMPLED", 2)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = list(enumerate(made_up(random.Random(2))))
    docs = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id long, text string").repartition(5)
    docs = docs.withColumn("doc", F.lit("clash")).withColumn("start", F.lit(1))
    assert got(docs) == plain(rows)


def test_odd_rows(spark):
    text = "".join(random.Random(6).choice("xyz ") for _ in range(300))
    rows = [(5, text), (5, text), (None, text + "!"), (None, None), (9, "short"), (5, "other " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert got(docs) == plain(order)
    assert remove_repeats(docs.limit(0)).count() == 0


def test_previous_factors():
    rng = random.Random(9)
    data = np.frombuffer("".join(rng.choice("ab") * rng.choice((1, 9, 60)) for _ in range(200)).encode(), np.uint8)
    place = np.arange(len(data) - 99)
    order, common = suffix_order(data, place, place)
    text = data.tobytes()
    for a, b, c in zip(order[:-1], order[1:], common[1:]):
        s, t = text[a:a + 100], text[b:b + 100]
        assert s <= t and c == next((k for k in range(100) if s[k] != t[k]), 100)
    factors = np.empty(len(place), np.int64)
    factors[order] = previous_factors(place[order], common, 1)
    for p in range(0, len(place), 7):
        best = 0
        for q in range(p):
            k = next((k for k in range(100) if text[p + k] != text[q + k]), 100)
            best = max(best, k)
        assert factors[p] == best


def test_only_strings_that_have_an_equal_one_are_ordered(monkeypatch):
    """Three segments of one anchor, two of which share a string."""
    ordered, whole = [], suffix_dedup.suffix_order
    monkeypatch.setattr(suffix_dedup, "suffix_order", lambda data, place, rank: ordered.append(len(place)) or whole(data, place, rank))
    shared = bytes(range(100, 200))
    rows = [(7, 1, 5 << 16, b"abcd" + shared), (7, 2, 0, shared + b"efg"), (7, 3, 0, shared[:60] + bytes(60))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["anchor", "doc", "place", "bytes"])
    [found] = suffix_dedup._factors(iter([batch]))
    assert found.to_pylist() == [{"doc": 2, "start": 0, "end": 100}]
    assert ordered == [2]


def test_texts_are_shuffled_once(spark):
    with configured(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold=-1):
        plan = remove_repeats(read(spark, FOLDER, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReusedExchange \[doc#\d+L, text#", plan)
