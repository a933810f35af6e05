"""Secret scans with corpus-wide ownership frequency, in built-in functions only.

Fixed patterns find assignments of secrets, access keys and long hexadecimal runs; these
spans always count.  Wider patterns propose candidates; those that look live count: no
placeholder, no run, no sequence, enough different characters.  Values are hashed and counted over the whole
corpus by the repositories and the owners that hold them: a value that more than
``max_owners`` owners or ``max_repos`` repositories share is a copied example, one that few
hold is a credential of theirs and its span is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.llm.frames import written

KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The base patterns.
ASSIGN = ("(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|"
          + _either_case("api") + "_?" + _either_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
LEAST_VALUE = 12
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
#: Candidates of known shape, and long mixed runs (checked by ``_mixed``).
KNOWN = "|".join((
    "gh[opsur]_[A-Za-z0-9]{30,}", "xox[abprs]-[A-Za-z0-9-]{10,}", "sk[-_][A-Za-z0-9_-]{20,}",
    r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}", "AIza[A-Za-z0-9_-]{30,}"))
MIXED = "[A-Za-z0-9+/_-]{20,}"
#: Words of examples, in lower case.
PLACEHOLDERS = ("example", "sample", "dummy", "placeholder", "changeme", "change_me", "your", "test", "fake")
_DIGITS, _LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: What no live value holds, in lower case: placeholders, a character four times, four in sequence.
NOT_LIVE = "|".join((*PLACEHOLDERS, *(f"{c}{{4}}" for c in _DIGITS + _LETTERS),
                     *(row[i:i + 4] for row in (_DIGITS, _LETTERS) for i in range(len(row) - 3))))
LEAST_DISTINCT = 10
KINDS = ("assign", "access", "hex", "known", "mixed")
SPAN = "struct<start:int,rank:int,end:int,value:bigint,live:boolean>"


def _most(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _least(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(items: Column) -> Column:
    """An array in pieces of 64."""
    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(items) - 1, 6)),
                       lambda b: F.slice(items, b * 64 + 1, F.lit(64)))


def _scan(items: Column, zero: Column, gain, best, make, kind: str) -> Column:
    """``make(state, x)`` of every item, where the state folds the gains of all items before it by ``best``.

    The fold runs inside blocks of 64 that start from the folds of the blocks before, so no
    array of all items is copied item by item.  ``kind`` is the type that ``make`` gives.
    """
    def inside(blocks, totals):
        return F.flatten(F.transform(blocks, lambda q, i: F.aggregate(
            q, F.struct(F.aggregate(F.slice(totals, F.lit(1), i), zero, best).alias("at"),
                        F.array().cast(f"array<{kind}>").alias("out")),
            lambda a, x: F.struct(best(a["at"], gain(x)).alias("at"), F.array_append(a["out"], make(a["at"], x)).alias("out")),
            lambda a: a["out"])))

    return _let(items, lambda all_: _let(_blocks(all_), lambda blocks: _let(
        F.transform(blocks, lambda q: F.aggregate(q, zero, lambda a, x: best(a, gain(x)))),
        lambda totals: inside(blocks, totals))))


PLACED = "array<struct<start:int,end:int,found:string>>"


def _gaps(text: Column, pattern: str, may: Column | None = None) -> Column:
    """Whole matches of ``pattern``, each with the text between it and the one before; none unless ``may``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The gap after the last match has none.
    pairs = F.filter(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("found")),
                     lambda x: x["found"].isNotNull())
    some = text.rlike(pattern) if may is None else may & text.rlike(pattern)
    return F.when(some, pairs).otherwise(F.array().cast("array<struct<gap:string,found:string>>"))


def _placed(gaps: Column) -> Column:
    """Of an array of results of ``_gaps``, the matches with their places, in code points: running sums of lengths."""
    def place(at, x):
        start = at + F.length(x["gap"])
        return F.struct(start.alias("start"), (start + F.length(x["found"])).alias("end"), x["found"].alias("found"))

    return F.transform(gaps, lambda pairs: _scan(
        pairs, F.lit(0), lambda x: F.length(x["gap"]) + F.length(x["found"]), lambda a, b: a + b, place, PLACED[6:-1]))


def names(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined in their order."""
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kind, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span of the sorted ``spans`` replaced by ``mark``; spans that overlap become one."""
    def inside(blocks, ends):
        def pieces(q, low, part):
            return F.aggregate(
                q, F.struct(low.alias("at"), F.array().cast("array<string>").alias("out")),
                lambda a, s: F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(
                    s["start"] >= a["at"], F.concat(a["out"], F.array(
                        F.substring(part, a["at"] - low + 1, s["start"] - a["at"]), F.lit(mark)))
                ).otherwise(a["out"]).alias("out")),
                lambda a: a["out"])

        # Only a block's own part of the text is searched for its places.
        return F.flatten(F.transform(blocks, lambda q, i: _let(
            F.aggregate(F.slice(ends, F.lit(1), i), F.lit(0), _most), lambda low: _let(
                F.substring(text, low + 1, F.greatest(F.element_at(ends, i + 1) - low, F.lit(0))),
                lambda part: pieces(q, low, part)))))

    done = _let(_blocks(spans), lambda blocks: _let(
        F.transform(blocks, lambda q: F.aggregate(q, F.lit(0), lambda a, s: F.greatest(a, s["end"]))),
        lambda ends: F.array_join(F.concat(inside(blocks, ends), F.array(F.substring(
            text, F.aggregate(ends, F.lit(0), _most) + 1, F.length(text)))), "")))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def _spans(found: Column, kind: str, value=lambda m: m["found"], keep=None, live=lambda m: F.lit(True)) -> Column:
    kept = F.filter(found, keep) if keep else found
    return F.transform(kept, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"),
        F.xxhash64(value(m)).alias("value"), live(m).alias("live")))


def _assigned(m: Column) -> Column:
    return F.regexp_extract(m["found"], ASSIGN, 2)


def _mixed(m: Column) -> Column:
    text = m["found"]
    return text.rlike("[0-9]") & text.rlike("[a-z]") & text.rlike("[A-Z]")


def _live(m: Column) -> Column:
    return ~F.lower(m["found"]).rlike(NOT_LIVE) & (
        F.size(F.array_distinct(F.regexp_extract_all(m["found"], F.lit("."), F.lit(0)))) >= LEAST_DISTINCT)


def _free(base: Column, known: Column, mixed: Column) -> Column:
    """Known shapes that touch no base span, and mixed runs that touch neither those nor any known shape.

    In the order of starts a span touches one before it if the farthest end reaches over its
    start, and one after it if the nearest start lies before its end.
    """
    shape, run = KINDS.index("known"), KINDS.index("mixed")
    fields = ("start", "rank", "end", "value", "live")
    far = 2**31 - 1

    def scan(items, zero, side, best, hit):
        def gain(x):
            return F.struct(F.when(x["rank"] < shape, x[side]).otherwise(zero).alias("base"),
                            F.when(x["rank"] == shape, x[side]).otherwise(zero).alias("known"))

        def fold(a, b):
            return F.struct(best(a["base"], b["base"]).alias("base"), best(a["known"], b["known"]).alias("known"))

        def make(at, x):
            edge = F.when(x["rank"] == run, best(at["base"], at["known"])).otherwise(at["base"])
            return F.struct(*(x[f].alias(f) for f in fields), hit(edge, x).alias("hit"))

        return _scan(items, F.struct(F.lit(zero).alias("base"), F.lit(zero).alias("known")), gain, fold, make,
                     SPAN[:-1] + ",hit:boolean>")

    before = scan(F.sort_array(F.concat(base, known, mixed)), -1, "end", _most, lambda edge, x: edge > x["start"])
    after = scan(F.reverse(before), far, "start", _least, lambda edge, x: x["hit"] | (edge < x["end"]))
    kept = F.transform(F.filter(after, lambda x: (x["rank"] >= shape) & ~x["hit"]),
                       lambda x: F.struct(*(x[f].alias(f) for f in fields)))
    return F.when(F.size(known) + F.size(mixed) > 0, kept).otherwise(F.array().cast(f"array<{SPAN}>"))


def scanned(documents: DataFrame) -> DataFrame:
    """``base`` and ``more``: spans of ``documents`` (doc_id, owner, repo, text) by fixed and wider patterns.

    A null text is empty.  Candidates that touch a base span, or a known shape, are left out;
    those that do not look live are marked.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    small = F.lower(text)
    named = F.lit(False)
    for word in KEYWORDS:
        named = named | F.contains(small, F.lit(word))
    gaps = F.array(_gaps(text, ASSIGN, named), *(_gaps(text, p) for p in (ACCESS, HEX, KNOWN, MIXED)))
    placed = documents.select("doc_id", "owner", "repo", _placed(gaps).alias("placed"))
    assign, access, hexes, known, mixed = (F.col("placed")[k] for k in range(len(KINDS)))
    base = F.concat(
        _spans(assign, "assign", _assigned, lambda m: F.length(_assigned(m)) >= LEAST_VALUE),
        _spans(access, "access"), _spans(hexes, "hex"))
    found = placed.select("doc_id", "owner", "repo", base.alias("base"),
                          _spans(known, "known", live=_live).alias("known"),
                          _spans(mixed, "mixed", keep=_mixed, live=_live).alias("mixed"))
    return found.select("doc_id", "owner", "repo", "base", _free(F.col("base"), F.col("known"), F.col("mixed")).alias("more"))


def ownership(found: DataFrame) -> DataFrame:
    """Value, number of repositories, of owners and of spans: every (value, owner, repo) counts once."""
    held = found.select("owner", "repo", F.explode(F.concat("base", "more")).alias("s")).groupBy(
        F.col("s.value").alias("value"), "owner", "repo").agg(F.count(F.lit(1)).alias("spans"))
    by_owner = held.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("spans").alias("spans"))
    return by_owner.groupBy("value").agg(
        F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"), F.sum("spans").alias("n_spans"))


#: A value of more spans than this, and than one in ``MOST_HOT`` of all, is hot: at most ``MOST_HOT`` values are.
HOT_SPANS = 1 << 16
MOST_HOT = 100_000


def _with_ownership(held: DataFrame, owned: DataFrame) -> DataFrame:
    """``held`` with the ownership of its values; the spans of hot values stay where they are."""
    total = owned.agg(F.sum("n_spans")).head()[0] or 0
    hot = F.col("n_spans") > max(HOT_SPANS, total // MOST_HOT)
    hottest = owned.where(hot)
    if hottest.isEmpty():
        return held.join(owned, "value")
    few = F.broadcast(hottest)
    return held.join(few, "value").unionByName(
        held.join(few, "value", "left_anti").join(owned.where(~hot), "value"))


def scan_secrets(documents: DataFrame, max_owners: int = 2, max_repos: int = 3) -> DataFrame:
    """Spans of secrets of ``documents`` (doc_id, owner, repo, text).

    One row per input row: doc_id, base and added (arrays of start, rank, end, value, live; code
    points, end exclusive, sorted by start and rank; rank is the place in ``KINDS``; live), n_shared
    (spans of either sort whose value more than ``max_owners`` owners or ``max_repos``
    repositories hold), most_owners and most_repos (of any value in the text, 0 without spans)
    and row_id.  Null and empty texts have no spans; the work for a text grows in proportion to it.
    A null owner or repository counts as one of its own.  Repeated rows are scanned each; they
    do not raise an ownership count.  Other columns are not read, and an empty table gives no rows.
    """
    # The number of a row is fixed once the rows are written.
    found = written(scanned(documents).withColumn("row_id", F.monotonically_increasing_id()), "spans")
    held = found.select("row_id", F.explode(F.concat("base", "more")).alias("s")).withColumn("value", F.col("s.value"))
    judged = _with_ownership(held, written(ownership(found), "ownership"))
    wide = (F.col("n_owners") > max_owners) | (F.col("n_repos") > max_repos)
    first_candidate = KINDS.index("known")
    per_row = judged.groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.when(~wide & F.col("s.live") & (F.col("s.rank") >= first_candidate), F.col("s")))).alias("added"),
        F.count(F.when(wide, 1)).alias("n_shared"),
        F.max("n_owners").alias("most_owners"), F.max("n_repos").alias("most_repos"))
    none = F.array().cast(f"array<{SPAN}>")
    return found.join(per_row, "row_id", "left").select(
        "doc_id", F.sort_array("base").alias("base"), F.coalesce("added", none).alias("added"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_shared", "most_owners", "most_repos")), "row_id")


#: Documents with spans that may be sent to all tasks (a few hundred bytes each); more are joined.
BROADCAST_ROWS = 1 << 17


def redact_secrets(documents: DataFrame, owner: Column, repo: Column, max_owners: int = 2,
                   max_repos: int = 3, mark: str = "[secret]") -> DataFrame:
    """``documents`` (any columns, with doc_id and text) with every secret replaced by ``mark``.

    Spans are those of ``scan_secrets``.  Rows without one are unchanged, a null text stays
    null, and n_chars, if there, becomes the length of a changed text.  Equal rows have equal
    spans, so id and a hash of the text bring the spans back to their rows.
    """
    key = F.xxhash64("text")
    rows = documents.select(F.struct("doc_id", key.alias("hash")).alias("doc_id"), owner.alias("owner"), repo.alias("repo"), "text")
    found = scan_secrets(rows, max_owners, max_repos).withColumn("spans", F.sort_array(F.concat("base", "added"))).where("size(spans) > 0")
    found = written(found.groupBy("doc_id").agg(F.first("spans").alias("spans")).select(
        F.col("doc_id.doc_id").alias("id"), F.col("doc_id.hash").alias("hash"), "spans"), "secrets")
    few = found.count() <= BROADCAST_ROWS
    # The row is packed, so no name of its columns meets one of these.
    packed = documents.select(F.struct(*documents.columns).alias("row"))
    text = F.col("row")["text"]
    same = F.col("row")["doc_id"].eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("hash"))
    joined = packed.join(F.broadcast(found) if few else found, same, "left")
    clean = joined.withColumn("clean", F.when(F.col("spans").isNull(), text).otherwise(redacted(text, F.col("spans"), mark)))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("clean")
        if name == "n_chars":
            kept = F.when(F.col("spans").isNull(), F.col("row")[name]).otherwise(F.length("clean"))
            return kept.cast(documents.schema[name].dataType)
        return F.col("row")[name]

    return clean.select(*(column(c).alias(c) for c in documents.columns))
