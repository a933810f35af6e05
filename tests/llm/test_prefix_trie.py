"""The prefix trie against a trie built in plain Python."""

import hashlib
import math
import zlib

from askloom.llm import prefix_trie as module
from askloom.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, place int, words string, depth int, d1 int"


def built(rows):
    own = {}
    for conv, turn, role, text in sorted(((c, t, r or "", x or "") for c, t, r, x in rows if c is not None),
                                         key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3])):
        own.setdefault(conv, []).append((role, text))
    whole = {}
    for c in own:
        base, h = c - int(math.fmod(c, 20)), zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own[c]) if base == c else tuple(own.get(base, [])[:h] + own[c][h:])
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)

    sums = {}  # deepest nodes first
    for p in sorted(nodes, key=len, reverse=True):
        below = [sums[q] for q in children.get(p, [])]
        own_saved = (len(nodes[p]) - 1) * len(p[-1][1].split()) if p else 0
        sums[p] = (sum(b[0] for b in below) or 1 if below else 1, own_saved + sum(b[1] for b in below))
    out = []
    for p, members in nodes.items():
        ends = sorted(c for c in members if len(whole[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])), *sums[p],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def run(spark, rows, parts=3):
    table = spark.createDataFrame([(*r, 1, "w", 2, 3) for r in rows], SCHEMA).repartition(parts)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = prefix_trie(table)
    assert found.columns == columns
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (r[1], r[0]))


def test_trie_of_shared_prefixes(spark):
    rows = []
    for c in range(47):  # conversations 40.. have no base
        if c in (20, 21):
            continue
        for t in range(c % 11 + 1):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of kind {c % 3 if t > 2 else 0}"))
    rows += [(200, t, "user", "again and again") for t in range(60)]  # many blocks
    rows += [(201, t, "user", "again and again") for t in range(75)]
    rows += [(-7, 0, "user", "minus"), (-20, 0, "user", "minus")]
    assert run(spark, rows) == built(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, "second"), (1, 1, "user", None), (1, 1, "", ""), (1, 1, "user", None),
        (3, 5, "user", "gap"), (3, 9, "user", "gap"), (None, 0, "user", "nobody"),
        (0, 0, "user", ""), (0, 1, "us", "er"), (2, 0, "use", "r"), (45, 0, "user", "word " * 50_000),
    ]
    assert run(spark, rows, 1) == built(rows) == run(spark, rows, 7)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 0, "user", "x")]) == []
    # Conversation 41 takes its first turn from 40, which is not there: nothing is left of it.
    lost = next(c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4)
    assert run(spark, [(lost, 0, "user", "x")]) == built([(lost, 0, "user", "x")]) == [
        (lost, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest())]


def test_ids_of_a_node_in_many_pieces(spark, monkeypatch):
    rows = [(c * 20, 0, "user", "the same") for c in range(500)]
    monkeypatch.setattr(module, "PIECE", 100)
    assert run(spark, rows, 5) == built(rows)


def test_very_long_conversation_lies_in_several_tasks(spark):
    rows = [(40, t, "user", f"t{t % 7}") for t in range(1_500)] + [(60, t, "user", f"t{t % 7}") for t in range(1_400)]
    assert run(spark, rows, 4) == built(rows)
