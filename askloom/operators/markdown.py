"""Markdown text to typed blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askloom.functions.text import WHITESPACE, as_column, bind, char_count, strip_space, word_count

# The prefixes and the bound that decide a line's kind.
HEADINGS = (("### ", "h3"), ("## ", "h2"), ("# ", "h1"))
BULLETS = ("- ", "* ", "• ")
NOTES = ("note:", "tip:", "important:", "warning:")
NUMBERED = r"^\p{Nd}+\.[%s]" % WHITESPACE
NUMBERED_MAX_CHARS = 300
FENCE = "```"

_INLINE_SPACE = WHITESPACE.replace("\n", "")
# A whole fence line together with the newline before it.
FENCE_LINE = f"\n[{_INLINE_SPACE}]*{FENCE}[^\n]*"


def line_kind(line: Column) -> Column:
    """Kind of a stripped line outside fences; the first rule that holds decides."""
    kind = F.when(line == "", "blank")
    for prefix, name in HEADINGS:
        kind = kind.when(line.startswith(prefix), name)
    for prefix in BULLETS:
        kind = kind.when(line.startswith(prefix), "bullet")
    kind = kind.when(line.rlike(NUMBERED) & (F.char_length(line) < NUMBERED_MAX_CHARS), "numbered")
    lowered = F.lower(line)
    for prefix in NOTES:
        kind = kind.when(lowered.startswith(prefix), "note")
    return kind.otherwise("body")


def line_text(line: Column) -> Column:
    """A stripped line without its heading or bullet mark."""
    text = F.when(F.lit(False), line)
    for prefix in [p for p, _ in HEADINGS] + list(BULLETS):
        text = text.when(line.startswith(prefix), F.substr(line, F.lit(len(prefix) + 1)))
    return text.otherwise(line)


def _block(kind: Column, text: Column) -> Column:
    return F.struct(kind.alias("kind"), text.alias("text"))


def blocks(text: Column | str) -> Column:
    """``ARRAY<STRUCT<kind, text>>`` of one document, in order.

    Cutting at the fence lines makes every second segment the inside of a fence, so the
    inside/outside state needs no ordered scan and no shuffle of the lines.  The text
    after a fence that is never closed gives no block.
    """

    def lines(segment: Column) -> Column:
        stripped = F.transform(F.split(F.substr(segment, F.lit(2)), "\n"), strip_space)
        return F.transform(stripped, lambda s: _block(line_kind(s), line_text(s)))

    def build(segments: Column) -> Column:
        nothing = F.array().cast("array<struct<kind:string,text:string>>")

        def segment_blocks(segment: Column, at: Column) -> Column:
            closed = at + 1 < F.size(segments)
            code = F.array(_block(F.lit("code"), F.substr(segment, F.lit(2))))
            inside = F.when(closed, code).otherwise(nothing)
            outside = F.when(segment == "", nothing).otherwise(lines(segment))
            return F.when(at % 2 == 1, inside).otherwise(outside)

        return F.flatten(F.transform(segments, segment_blocks))

    return bind(F.split(F.concat(F.lit("\n"), as_column(text)), FENCE_LINE), build)


def markdown_blocks(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row per block: the document's other columns, ``block_no``, ``kind``, ``text``."""
    kept = [c for c in documents.columns if c != text]
    numbered = documents.select(*kept, F.posexplode(blocks(text)).alias("block_no", "_block"))
    return numbered.select(*kept, "block_no", "_block.kind", F.col("_block.text").alias("text"))


def fence_state(documents: DataFrame, text: str = "text") -> DataFrame:
    """Lines with ``in_code``; fence lines themselves are left out."""
    kept = [c for c in documents.columns if c != text]
    segments = F.split(F.concat(F.lit("\n"), F.col(text)), FENCE_LINE)
    parts = documents.select(*kept, F.posexplode(segments).alias("segment_no", "_segment"))
    cut = F.split(F.substr("_segment", F.lit(2)), "\n")
    return parts.where("_segment <> ''").select(
        *kept, "segment_no", (F.col("segment_no") % 2 == 1).alias("in_code"),
        F.posexplode(cut).alias("line_no", "line"),
    )


def length_report(documents: DataFrame, text: str = "text") -> DataFrame:
    """Characters and words per document."""
    return documents.withColumns({"n_chars": char_count(text), "n_words": word_count(text)}).drop(text)
