"""The filter audit against all orders played through in plain Python."""

from fractions import Fraction
from itertools import permutations

from hypothesis import given, settings, strategies as st

from askloom.llm.filter_audit import audit_filters, shapley_weights

DOCS = "doc_id long, text string, source string, part string, pattern int, copy string"
LONG = "word%d " * 250 % tuple(range(250))


def fails(text):
    words = text.split()
    return (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), any(c in "#$%&*|" for c in text))


def played(docs, labels):
    """Every order, filter by filter, over every document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    rows = []
    for d, text, source in docs:
        text = text or ""
        rows.append((source or "", d, (*fails(text), d is not None and d > first[text])))
    out = {}
    for part in {r[0] for r in rows}:
        here = [r for r in rows if r[0] == part]
        total = [0] * 5
        for order in permutations(range(5)):
            left = here
            for step, i in enumerate(order, 1):
                gone = [r for r in left if r[2][i]]
                left = [r for r in left if not r[2][i]]
                total[i] += len(gone)
                out[part, "".join("ABCDE"[k] for k in order), step] = [
                    len(left), len(gone), sum(r[2][i] for r in here) - len(gone),
                    sum(r[2][i] and sum(r[2]) == 1 for r in here),
                    sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone), i]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = total[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


def run(spark, docs, labels):
    docs = spark.createDataFrame([(*d, "x", 1, "y") for d in docs], DOCS)
    found = audit_filters(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in found}
    assert len(got) == len(found)
    return got


def test_against_play(spark):
    docs = [
        (0, LONG, "a"), (1, LONG, "a"), (2, LONG, "b"), (3, "same same same", "a"), (4, "SHOUT # now", "a"), (5, None, "b"),
        (6, "", "b"), (7, "ab " * 300, "b"), (8, "ab " * 300, None), (9, LONG + "#", ""), (10, "AB" * 40 + " x" * 300, "a"),
        (None, LONG, "a"), (None, LONG, "a"), (3, "same same same", "a"), (11, "same same same", "b"), (11, "same same same", "a"),
        (12, "é" * 10 + "A", "c"), (13, "x\x0by\x0cz w " * 100, "c"), (14, "w " * 100_000, "c"),
    ]
    labels = [(0, 1, 0), (1, 1, 1), (2, 0, 1), (3, 1, 0), (3, 0, 1), (4, None, 1), (None, 1, 1), (11, 1, None), (99, 1, 1)]
    assert run(spark, docs, labels) == played(docs, labels)


def test_words_break_at_the_six_blanks_only(spark):
    # A no-break space is no blank: 199 words, one too few.
    assert run(spark, [(1, " ".join(f"w{i}" for i in range(199)) + " x", "a")], [])["a", "ABCDE", 1][1] == 1


def test_empty(spark):
    assert run(spark, [], [(1, 1, 1)]) == {}
    assert len(run(spark, [(1, None, None)], [])) == 600


@settings(max_examples=30, deadline=None)
@given(st.integers(2, 5), st.data())
def test_weights_are_shapley_values(n, data):
    """The fit against the mean over all orders, for any game."""
    v = data.draw(st.lists(st.integers(-1000, 1000), min_size=2**n, max_size=2**n))
    weights, below = shapley_weights(n)
    for i in range(n):
        orders = list(permutations(range(n)))
        total = 0
        for o in orders:
            before = sum(1 << k for k in o[:o.index(i)])
            total += v[before | 1 << i] - v[before]
        assert Fraction(sum(c * x for c, x in zip(weights[i], v)), below) == Fraction(total, len(orders))
