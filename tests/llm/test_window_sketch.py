"""Removal of repeated word windows against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from askloom.llm import window_sketch as module
from askloom.llm.tokens import words
from askloom.llm.window_sketch import Sketch, remove_repeated_words, segments

SCHEMA = "doc_id long, text string, doc string, gram int, place string"


def plain(rows):
    """Rows (doc_id, text) to (doc_id, n_words, n_removed, hash), windows judged one by one."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen, out = set(), []
    for doc, text in order:
        held = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(held) - 19):
            window = tuple(held[i:i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(held) if i not in gone)
        out.append((doc, len(held), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, parts=3):
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in remove_repeated_words(table).collect()), key=repr)


def corpus():
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)] + ["Word", "word", "ünï", "x y"]

    def text(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    passage, long = text(60), text(400)
    rows = []
    for d in range(60):
        body = text(rnd.randrange(0, 150))
        if d % 3 == 0:
            at = rnd.randrange(len(body) + 1)
            body[at:at] = passage
        if d % 7 == 0:
            copy = list(long)
            for _ in range(d // 7):
                copy[rnd.randrange(len(copy))] = "edit"
            body += copy
        rows.append((d, rnd.choice([" ", "\n", "\t "]).join(body)))
    return rows


def test_against_plain(spark):
    rows = corpus()
    assert run(spark, rows) == plain(rows)


def test_hot_passages_and_periodic_texts(spark):
    rows = [(d, f"a{d} " + "one line that very many documents have in common and that is longer than twenty words, so "
             "that it holds windows of its own here" + f" b{d} c{d}") for d in range(300)]
    rows += [(1000, "a " * 500), (1001, "a b " * 100), (1002, "b a " * 100), (1003, "a " * 20), (1004, "a " * 19)]
    assert run(spark, rows, 9) == plain(rows)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text), (5, text), (None, text), (None, text), (None, None), (3, None), (4, ""), (1, " \t\n"),
            (2, "W0 " + text[3:]), (9, text + " " + text), (8, ("\x0b\x0c".join(text.split()))), (6, "é" * 100_000)]
    assert run(spark, rows) == plain(rows)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == plain([(1, None)])


@pytest.mark.parametrize("cells, held", [(1, 1), (64, 50)])
def test_a_full_sketch_loses_nothing(monkeypatch, cells, held):
    """With so few cells everything seems repeated, or much; the segments that are must be there in any case."""
    monkeypatch.setattr(module, "CELLS", cells)
    monkeypatch.setattr(module, "HELD", held)
    import pyarrow as pa

    rows = corpus()
    halves = [pa.RecordBatch.from_pydict({"doc": [r[0] for r in part], "text": [r[1] for r in part]})
              for part in (rows[:20], rows[20:45], rows[45:])]
    dealt = pa.Table.from_batches([b for half in halves for b in module._dealt(3)(iter([half]))]).sort_by("slice")
    found = pa.Table.from_batches(list(module._merged(iter(dealt.to_batches(max_chunksize=37)))))
    every = [[], []]
    for doc, text in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        gram, segment, _, first, count = segments(words(raw, np.array([0, len(raw)]), False))
        every[0] += gram.tolist()
        every[1] += [(g, s, doc, f << 8 | c) for g, s, f, c in zip(gram.tolist(), segment.tolist(), first.tolist(), count.tolist())]
    twice = {g for g in every[0] if every[0].count(g) > 1}
    got = set(zip(*(found.column(k).to_pylist() for k in range(4))))
    assert {r for r in every[1] if r[0] in twice} <= got <= set(every[1])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(-50, 50), max_size=200))
def test_sketch_never_underestimates(values):
    sketch = Sketch()
    for k in range(0, len(values), 13):
        sketch.add(np.array(values[k:k + 13], np.int64))
    for v in set(values):
        assert sketch.repeated(np.array([v]))[0] or values.count(v) < 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=80))
def test_segments_cover_all_windows_once(letters):
    raw = np.frombuffer(" ".join(letters).encode(), np.uint8)
    *_, first, count = segments(words(raw, np.array([0, len(raw)]), False))
    covered = [f + k for f, c in zip(first, count) for k in range(c)]
    assert covered == list(range(max(0, len(letters) - 19)))
