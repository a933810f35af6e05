"""N-gram Jaccard join by count vectors and R-trees.

A document is the set of its distinct five-word shingles; two link when the shared part is
at least three quarters of the union.  Shingles are hashed into groups, and the counts of a
set by group are a point.  No two sets share more than the sum, over the groups, of the smaller
counts, and no set shares more with any member of a tree node than the sum of the minima with
the node's upper corner.  Blocks are joined by such trees, and what survives is verified on
whole sets.

Groups that hold many shingles have like counts in unlike sets.  So a larger set has more groups:
a power of two, ``PER_GROUP`` shingles in one on average at most.  Groups are the leading bits
of the hash, so a point is brought to half its groups by adding neighbours; sets that can link
are of nearly one size and never more than one such step apart.

A tree over all points would not prune: sets of one size have similar counts.  So blocks
come first.  Shingles have one global order, those that a sample finds frequent last, and a
linked pair shares one of the first ``n - ceil(0.75 n) + 1`` shingles of both (the first part
below).  A block is the sets with one such shingle; this loses no link.

Equal sets are one node.  Blocks of near copies are large, so first every node is compared
with its block's leader only, and components are taken.  Trees then look for links
between different components of a block.  A large block is split into cells for every pair
of its parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from askloom.llm.components import components
from askloom.llm.frames import written
from askloom.llm.tokens import buffers, distinct, mixed, shingles, slices, words
from askloom.operators.windows import running_number
from askloom.session import configured

GROUPS, PER_GROUP = 256, 4
LEAF = 16
#: Counters compared at once.
COUNTERS = 1 << 22
#: Blocks of a node just before each of its blocks that a row knows, to leave out pairs that met there.
EARLIER = 8
#: Rows of a block that one tree takes; larger blocks are split into cells of pairs of parts.
PART = 1024
#: One of so many documents tells which shingles are frequent: those that two of them hold, or one
#: in ``FREQUENT`` of them.  The order of shingles decides how large blocks get, never which pairs link.
SAMPLED, FREQUENT = 8, 20_000
#: Bytes of texts that a task turns into sets at once, bytes of an Arrow batch, and rows that a task sends on in one:
#: what the workers of an executor hold beside its heap.
SET_BYTES, BATCH_BYTES, BATCH_ROWS = 1 << 18, 1 << 22, 1 << 16
#: Ids of nodes to fetch that may be sent to all tasks (about 24 bytes each); more are joined.
BROADCAST_IDS = 1 << 20
TOP = np.uint64(1) << np.uint64(63)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _node(values: np.ndarray) -> int:
    """Identity of a set: a hash of all its shingles."""
    return int(mixed(np.array([mixed(values ^ TOP).sum() + np.uint64(len(values))], np.uint64)).view(np.int64)[0])


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of every row of a text column."""
    for i, j, data, offsets in slices(column, SET_BYTES):
        value, doc, _ = shingles(words(data, offsets))
        held, first = distinct(value, doc, j - i)
        for d in range(j - i):
            yield i + d, held[first[d]:first[d + 1]]


def _counts(held: np.ndarray) -> np.ndarray:
    """Counts by group; a set too large for its counters has all of them full, which prunes nothing."""
    bits = max(GROUPS.bit_length() - 1, (-(-len(held) // PER_GROUP) - 1).bit_length())
    counts = np.bincount((held >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return (counts if counts.max() < 255 else np.full(1 << bits, 255)).astype(np.uint8)


class Points:
    """Count vectors of several widths, each a power of two."""

    def __init__(self, counts: pa.Array) -> None:
        data, offsets = buffers(counts)
        self.width = np.diff(offsets)
        self.place = np.zeros(len(self.width), np.int64)
        self.of_width: dict[int, np.ndarray] = {}
        self.full = np.zeros(len(self.width), bool)
        for width in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == width)
            self.place[rows] = np.arange(len(rows))
            matrix = data[(offsets[rows][:, None] + np.arange(width)).ravel()].reshape(len(rows), width) \
                if len(rows) < len(self.width) else data[offsets[0]:offsets[-1]].reshape(-1, width)
            self.of_width[width] = matrix
            self.full[rows] = matrix.min(1) == 255

    def at(self, rows: np.ndarray, width: int) -> np.ndarray:
        """The points of ``rows`` brought to ``width`` groups."""
        out = np.zeros((len(rows), width), np.uint16)
        for wide in np.unique(self.width[rows]).tolist():
            here = np.flatnonzero(self.width[rows] == wide)
            part = self.of_width[wide][self.place[rows[here]]]
            out[here] = part if wide == width else part.reshape(len(here), width, wide // width).sum(2, dtype=np.uint16)
        return out

    def room(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The most that the sets of each pair of rows can share; beyond any size if the counters of one are full."""
        room = np.zeros(len(x), np.int64)
        width = np.minimum(self.width[x], self.width[y])
        for w in np.unique(width).tolist():
            of = np.flatnonzero(width == w)
            step = max(1, COUNTERS // w)
            for k in range(0, len(of), step):
                some = of[k:k + step]
                room[some] = np.minimum(self.at(x[some], w), self.at(y[some], w)).sum(1, dtype=np.int64)
        room[self.full[x] | self.full[y]] = 1 << 62
        return room


def _needed(n: int, least: Fraction) -> int:
    """Fewest shingles that a set of ``n`` shares with any set it links to."""
    return -(-n * least.numerator // least.denominator)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, size, counts = [], [], []
        for _, held in _sets(batch.column(1)):
            size.append(len(held))
            node.append(_node(held) if len(held) else None)
            counts.append(_counts(held).tobytes() if len(held) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(counts, pa.binary())],
            ["row_id", "node", "n", "counts"])


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _in_batches(([held] for _, held in _sets(batch.column(0))), ["token"])


def _in_batches(parts: Iterator[list[np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Parts of columns of 64-bit numbers, joined to batches of about ``BATCH_ROWS`` rows."""
    some, rows = [], 0
    for part in parts:
        some.append(part)
        rows += len(part[0])
        if rows >= BATCH_ROWS:
            yield _joined(some, names)
            some, rows = [], 0
    if rows:
        yield _joined(some, names)


def _joined(parts: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(column))) for column in zip(*parts)], names)


def _first_parts(frequent: np.ndarray, least: Fraction):
    """Rows (token, node, n) of the first part of each set, once per node and task."""

    def parts(texts: pa.Array, seen: set[int]) -> Iterator[list[np.ndarray]]:
        for _, held in _sets(texts):
            if not len(held) or (node := _node(held)) in seen:
                continue
            seen.add(node)
            rank = held >> np.uint64(1)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, held), len(frequent) - 1)
                rank[frequent[at] == held] |= TOP
            first = held[np.argsort(rank)[:len(held) - _needed(len(held), least) + 1]]
            yield [first, np.full(len(first), node, np.int64), np.full(len(first), len(held), np.int64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            yield from _in_batches(parts(batch.column(0), seen), ["token", "node", "n"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by token and node: those of blocks of more than one node, each once.

    Tasks that read equal sets send the same rows.  The last row waits for the next ones.
    """

    def kept(cols: list[np.ndarray], before, ends: bool) -> pa.RecordBatch:
        token = cols[0]
        same = np.zeros(len(token) + 1, bool)
        same[1:-1] = token[1:] == token[:-1]
        same[0] = before is not None and before == token[0]
        keep = same[:-1] | same[1:]
        if not ends:
            keep[-1] = False
        return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols], ["token", "node", "n"])

    held, before = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in range(3)]
        if held is not None:
            cols = [np.concatenate(c) for c in zip(held, cols)]
        new = np.ones(len(cols[0]), bool)
        new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        cols = [c[new] for c in cols]
        yield kept(cols, before, False)
        before = cols[0][-2] if len(cols[0]) > 1 else before
        held = [c[-1:] for c in cols]
    if held is not None:
        yield kept(held, before, True)


def tree_pairs(points: Points, n: np.ndarray, group: np.ndarray, side: np.ndarray, least: Fraction,
               earlier: np.ndarray | None = None) -> np.ndarray:
    """Pairs of places, of different ``group``, whose counts allow a link.

    ``side`` is 0 for rows that meet all others, 1 and 2 for rows that meet the other side only.
    ``earlier`` holds blocks before this one by row; rows that share one of them have met there.  Every width has a tree of its own rows and those of twice the width; pairs of the latter
    are left to their own tree.
    """
    found = [np.zeros((0, 2), np.int64)]
    for width in points.of_width:
        rows = np.flatnonzero((points.width == width) | (points.width == 2 * width))
        pairs = _one_tree(points, rows, width, n, group, side, least, earlier)
        found.append(pairs[(points.width[pairs] == width).any(1)])
    return np.concatenate(found)


def _one_tree(points: Points, rows: np.ndarray, width: int, n, group, side, least: Fraction, earlier) -> np.ndarray:
    """Rows are sorted by size and packed into leaves; a leaf pair is opened only if the minima
    of the upper corners leave room for a link between its smallest sets, their sizes fit, and
    not all rows are of one group.
    """
    num, den = least.numerator, least.denominator
    rows = rows[np.argsort(n[rows], kind="stable")]
    m = len(rows)
    edges = np.arange(0, m, LEAF)
    corner = np.stack([points.at(rows[e:e + LEAF], width).max(0) for e in edges])
    full = np.logical_or.reduceat(points.full[rows], edges)
    small, large = np.minimum.reduceat(n[rows], edges), np.maximum.reduceat(n[rows], edges)
    g_low, g_high = np.minimum.reduceat(group[rows], edges), np.maximum.reduceat(group[rows], edges)
    found = [np.zeros((0, 2), np.int64)]
    for a in range(len(edges)):
        b = np.arange(a, len(edges))
        b = b[large[a] * den >= small[b] * num]
        b = b[~((g_low[a] == g_high[a]) & (g_low[b] == g_high[b]) & (g_low[a] == g_low[b]))]
        opens = np.minimum(corner[a], corner[b]).sum(1, dtype=np.int64) * (num + den) >= num * (small[a] + small[b])
        for leaf in b[opens | full[a] | full[b]]:
            of_a, of_b = np.arange(edges[a], min(edges[a] + LEAF, m)), np.arange(edges[leaf], min(edges[leaf] + LEAF, m))
            x, y = np.repeat(of_a, len(of_b)), np.tile(of_b, len(of_a))
            apart = x < y
            found.append(np.stack(_allowed(points, n, group, side, rows[x[apart]], rows[y[apart]], least, earlier), 1))
    return np.concatenate(found)


def _met(earlier: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """True for the pairs whose rows share an earlier block."""
    met = np.zeros(len(x), bool)
    step = max(1, COUNTERS // earlier.shape[1] ** 2)
    for k in range(0, len(x), step):
        some = slice(k, k + step)
        met[some] = (earlier[x[some]][:, :, None] == earlier[y[some]][:, None, :]).any((1, 2))
    return met


def _allowed(points: Points, n, group, side, x, y, least: Fraction, earlier=None) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (x, y), those of different groups and sides whose sizes and counts allow a link and that have not met."""
    num, den = least.numerator, least.denominator
    small, large = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
    ok = (group[x] != group[y]) & ((side[x] == 0) | (side[x] != side[y])) & (small * den >= large * num)
    x, y = x[ok], y[ok]
    if earlier is not None:
        new = ~_met(earlier, x, y)
        x, y = x[new], y[new]
    # shared >= least / (1 + least) * (|x| + |y|)
    keep = points.room(x, y) >= -(-num * (n[x] + n[y]) // (num + den))
    return x[keep], y[keep]


def _tree_join(least: Fraction):
    """Candidate pairs from rows sorted by cell (token, i, j): node, n, component, side, counts, earlier.

    A pair that shares many blocks is looked at in the first of them, and in a later one only if
    none of the ``EARLIER`` blocks of each row just before it is shared.  The pairs of small cells are formed for many cells at once; a larger cell has a tree.
    What is kept back for the next rows is one cell, of at most two parts.
    """

    def before(lists: pa.Array, node: np.ndarray) -> np.ndarray:
        """The earlier blocks by row; free places hold the row's own node, which no other row of the block has."""
        offsets = lists.offsets.to_numpy()
        size = np.diff(offsets)
        out = np.repeat(node[:, None], EARLIER, 1)
        out[np.arange(EARLIER) < size[:, None]] = lists.values.to_numpy()[offsets[0]:offsets[-1]]
        return out

    def of_cells(cols: list[np.ndarray], counts: pa.Array, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        token, i, j, node, n, group, side = cols
        points, earlier = Points(counts), before(lists, node)
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(token)))
        xs, ys = [], []
        for m in range(2, LEAF + 1):  # all cells of one size together
            of = first[size == m]
            p, q = np.triu_indices(m, 1)
            x, y = (of[:, None] + p).ravel(), (of[:, None] + q).ravel()
            x, y = _allowed(points, n, group, side, x, y, least, earlier)
            xs.append(node[x])
            ys.append(node[y])
        for f, m in zip(first[size > LEAF], size[size > LEAF]):
            at = slice(f, f + m)
            pairs = tree_pairs(Points(counts.slice(f, m)), n[at], group[at], side[at], least, earlier[at]) + f
            xs.append(node[pairs[:, 0]])
            ys.append(node[pairs[:, 1]])
        x, y = np.concatenate(xs), np.concatenate(ys)
        pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, kept_lists = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
            lists = [batch.column(7), batch.column(8)]
            if kept is not None:
                cols, lists = [np.concatenate(c) for c in zip(kept, cols)], [pa.concat_arrays(c) for c in zip(kept_lists, lists)]
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            kept, kept_lists = [c[cut:] for c in cols], [c.slice(cut) for c in lists]
            if cut:
                x, y = of_cells([c[:cut] for c in cols], *(c.slice(0, cut) for c in lists))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])
        if kept is not None:
            x, y = of_cells(kept, *kept_lists)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])

    return run


def _verify(least: Fraction):
    """Of rows (x, y, text of x, text of y): the pairs that link."""

    def held(texts: pa.Array, k: int) -> np.ndarray:
        return next(_sets(texts.slice(k, 1)))[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, None
        for batch in batches:
            x, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ok = np.zeros(len(x), bool)
            for k, other in _sets(batch.column(2)):
                if last != y[k]:
                    last, one = y[k], held(batch.column(3), k)
                at = np.minimum(np.searchsorted(one, other), len(one) - 1)
                shared = int((one[at] == other).sum())
                ok[k] = shared * least.denominator >= least.numerator * (len(one) + len(other) - shared)
            yield pa.RecordBatch.from_arrays([pa.array(x[ok]), pa.array(y[ok])], ["x", "y"])

    return run


def _linked(pairs: DataFrame, documents: DataFrame, described: DataFrame, least: Fraction) -> DataFrame:
    """The (x, y) of ``pairs`` that link, by the whole sets of both."""
    pairs = written(pairs, "possible")
    texts = _texts(documents, pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct(), described)
    first = pairs.join(texts.select(F.col("node").alias("x"), F.col("text").alias("text_x")), "x")
    both = first.join(texts.select(F.col("node").alias("y"), F.col("text").alias("text_y")), "y")
    return both.select("x", "y", "text_x", "text_y").mapInArrow(_verify(least), "x long, y long")


def _texts(documents: DataFrame, nodes: DataFrame, described: DataFrame) -> DataFrame:
    """One text of each node in ``nodes``."""
    wanted = written(described.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("row_id").alias("row_id")), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    return documents.join(F.broadcast(wanted) if few else wanted, "row_id").select("node", "text")


def jaccard_components(documents: DataFrame, least: Fraction = Fraction(3, 4), id_column: str = "doc_id") -> DataFrame:
    """Size of the shingle set and component of every row of ``documents`` (id, text).

    Returns the id as doc_id, n_shingles, component_id (smallest id reachable by links) and
    n_copies (rows with the same set).  A text of one to four words has its whole sequence as
    its one shingle.  Null and empty texts have the empty set and link with nothing.  Rows
    with a null id are given back with the size of their set and a null component, and link
    with nothing.  Rows that repeat an id are documents of their own with the same id.  Other
    columns are not read; an empty table gives no rows.  Sets are told apart by 64-bit hashes.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("row_id"), "text")
    with configured(documents.sparkSession, spark__sql__execution__arrow__maxBytesPerBatch=BATCH_BYTES):
        described = written(rows.mapInArrow(_describe, "row_id long, node long, n long, counts binary"), "described")
        keyed = described.where("row_id IS NOT NULL AND node IS NOT NULL")
        links = node_links(rows.where("row_id IS NOT NULL"), keyed, least)
        found = components(links)
    placed = keyed.select("row_id", "node", "n").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("row_id").alias("component_id"))
    sizes = placed.groupBy("node").agg(F.count(F.lit(1)).alias("n_copies"))
    linked = placed.join(smallest, "component").join(sizes, "node").select(
        F.col("row_id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "n_copies")
    rest = described.where("row_id IS NULL OR node IS NULL").select(
        F.col("row_id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("row_id").alias("component_id"),
        F.lit(1).cast("long").alias("n_copies"))
    return linked.unionByName(rest)


def keep_one_of_each(documents: DataFrame, least: Fraction = Fraction(3, 4)) -> DataFrame:
    """The rows of ``documents`` (any columns, with doc_id and text) without those whose component has a smaller id.

    Rows without words and rows with a null id stay.  Of rows that repeat an id and are linked
    one stays; if ids repeat, rows are numbered first, by id and text.
    """
    odd = documents.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count()
    # The row is packed, so no name of its columns meets one of these.
    rows = documents.select(F.struct(*documents.columns).alias("row"))
    if odd:
        rows = running_number(rows, F.col("row")["doc_id"].asc_nulls_last(), F.col("row")["text"], out="key")
        given = rows.where(F.col("row")["doc_id"].isNotNull()).select("key", F.col("row")["text"].alias("text"))
    else:
        rows = rows.withColumn("key", F.col("row")["doc_id"].cast("long"))
        given = documents.select(F.col("doc_id").alias("key"), "text")
    gone = written(jaccard_components(given, least, "key").where("doc_id <> component_id").select(
        F.col("doc_id").alias("gone")), "gone")
    few = gone.count() <= BROADCAST_IDS
    kept = rows.join(F.broadcast(gone) if few else gone, F.col("key") == F.col("gone"), "left_anti")
    return kept.select(*(F.col("row")[c].alias(c) for c in documents.columns))


def _frequent(documents: DataFrame) -> np.ndarray:
    """Shingles that are frequent among one in ``SAMPLED`` documents, sorted.

    There are at most ``FREQUENT`` times as many as a document has on average, whatever the
    size of the corpus.
    """
    sample = documents.where(F.pmod(F.xxhash64("row_id"), F.lit(SAMPLED)) == 0).select("text")
    least = max(2, sample.count() // FREQUENT)
    counts = sample.mapInArrow(_values, "token long").groupBy("token").count()
    return np.sort(counts.where(F.col("count") >= least).select("token").toArrow().column("token").to_numpy().view(np.uint64))


def node_links(documents: DataFrame, described: DataFrame, least: Fraction) -> DataFrame:
    """Links (x, y) that connect every component of nodes; not all links inside a component."""
    counts = written(described.dropDuplicates(["node"]).select("node", "n", "counts"), "counts")
    tokens = documents.select("text").mapInArrow(_first_parts(_frequent(documents), least), "token long, node long, n long")
    shared = written(tokens.repartition("token").sortWithinPartitions("token", "node").mapInArrow(
        _shared, "token long, node long, n long"), "shared")
    part = F.col("n") - F.ceil(F.col("n") * least.numerator / least.denominator) + 1
    score = shared.groupBy("node").agg((F.count(F.lit(1)) / F.first(part)).alias("score"))
    shared = written(_unlike_blocks(shared), "blocks")
    pairs = written(_leader_pairs(shared, score, least), "pairs")
    first = written(_linked(_possible(pairs, counts, least), documents, described, least), "links")
    near = written(_tree_candidates(shared, counts, components(first), least).join(pairs, ["x", "y"], "left_anti"), "near")
    second = written(_linked(near, documents, described, least), "links")
    return first.unionByName(second)


def _unlike_blocks(shared: DataFrame) -> DataFrame:
    """The rows of one of all blocks that hold the same nodes: a passage makes many such blocks."""
    blocks = shared.groupBy("token").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"))
    tokens = written(blocks.groupBy("size", "one", "two").agg(F.min("token").alias("token")).select("token"), "tokens")
    few = tokens.count() <= BROADCAST_IDS
    return shared.join(F.broadcast(tokens) if few else tokens, "token", "left_semi")


def _leader_pairs(shared: DataFrame, score: DataFrame, least: Fraction) -> DataFrame:
    """Every node with the leader of each of its blocks.

    A block's leader is the node with the highest ``score``, the share of its own first part that
    others hold too: what copies were made from shares all of it, a copy's changes are its own.
    """
    score = written(score, "score")
    few = score.count() <= BROADCAST_IDS
    rows = shared.join(F.broadcast(score) if few else score, "node")
    leaders = rows.groupBy("token").agg(F.max_by(F.struct(F.col("node").alias("leader"), F.col("n").alias("size")),
                                                 F.struct("score", "node")).alias("l"))
    num, den = least.numerator, least.denominator
    fits = (F.least("n", "l.size") * den >= F.greatest("n", "l.size") * num) & (F.col("node") != F.col("l.leader"))
    return shared.join(leaders, "token").where(fits).select(
        F.least("node", "l.leader").alias("x"), F.greatest("node", "l.leader").alias("y")).distinct()


def _possible(pairs: DataFrame, counts: DataFrame, least: Fraction) -> DataFrame:
    """The (x, y) of ``pairs`` whose counts allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            both = Points(pa.concat_arrays([batch.column(4), batch.column(5)]))
            n = np.concatenate([batch.column(2).to_numpy(), batch.column(3).to_numpy()])
            at, _ = _allowed(both, n, np.arange(2 * m), np.zeros(2 * m, np.int64), np.arange(m), np.arange(m, 2 * m), least)
            yield batch.select([0, 1]).take(pa.array(at))

    side = [counts.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("counts").alias(f"counts_{k}")) for k in "xy"]
    return pairs.join(side[0], "x").join(side[1], "y").select("x", "y", "n_x", "n_y", "counts_x", "counts_y").mapInArrow(
        run, "x long, y long")


def _tree_candidates(shared: DataFrame, counts: DataFrame, found: DataFrame, least: Fraction) -> DataFrame:
    """Pairs of different components that share a block and whose counts allow a link."""
    rows = shared.select("token", "node", "n").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed_blocks = rows.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")
    ).where("low <> high").select("token", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    before = Window.partitionBy("node").orderBy("token").rowsBetween(-EARLIER, -1)
    rows = written(rows.join(mixed_blocks, "token"), "mixed").withColumn("earlier", F.collect_list("token").over(before))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    # A row of part p meets part q in the cell (p, q) or (q, p), the smaller first.
    cells = rows.withColumn("p", part).withColumn("q", F.explode(every)).select(
        "token", "node", "n", "component", "earlier", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"),
        F.when(F.col("p") == F.col("q"), 0).when(F.col("p") < F.col("q"), 1).otherwise(2).alias("side"))
    dealt = cells.join(counts.select("node", "counts"), "node").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return dealt.select("token", "i", "j", "node", "n", "component", "side", "counts", "earlier").mapInArrow(
        _tree_join(least), "x long, y long").distinct()
