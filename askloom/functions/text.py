"""String expressions.  All are built-in column functions that stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from askloom.config import EXCERPT_CHARS, PLACEHOLDERS

# Every character that str.isspace() calls white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
TOKEN = r"[\p{L}\p{N}]+"
SENTENCE_BREAK = r"[.!?]+[ \t\n]+|\n+"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once per row.

    Inside the lambda of a higher-order function an expression that does not depend on
    the element is evaluated for each element; binding it here avoids that.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_space(text: Column | str) -> Column:
    """Drop surrounding white space of any kind (``trim`` only drops blanks)."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def strip_quotes(text: Column | str) -> Column:
    """Drop surrounding white space, then double quotes, then single quotes."""
    return F.btrim(F.btrim(strip_space(text), F.lit('"')), F.lit("'"))


def excerpt(text: Column | str, limit: int = EXCERPT_CHARS) -> Column:
    """Stripped beginning; the ellipsis depends on the length before stripping."""
    text = as_column(text)
    tail = F.when(F.char_length(text) > limit, "...").otherwise("")
    return F.concat(strip_space(F.substring(text, 1, limit)), tail)


def preview(text: Column | str, limit: int = 60) -> Column:
    """First characters, always followed by an ellipsis."""
    return F.concat(F.substring(as_column(text), 1, limit), F.lit("..."))


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(as_column(path), "/"), -1)


def file_extension(path: Column | str) -> Column:
    """Suffix with its dot; empty for names that only start with a dot."""
    return F.regexp_extract(base_name(path), r"^.+(\.[^.]+)$", 1)


def char_count(text: Column | str) -> Column:
    return F.char_length(as_column(text))


def word_count(text: Column | str) -> Column:
    # Blanks first: splitting at one plain character is several times faster than matching
    # a character class.
    blanks = F.translate(as_column(text), WHITESPACE, " " * len(WHITESPACE))
    return F.size(F.array_remove(F.split(blanks, " "), ""))


def title_from_file(name: Column | str) -> Column:
    bare = F.replace(as_column(name), F.lit(".pdf"), F.lit(""))
    return F.initcap(F.replace(F.regexp_replace(bare, r"^\d+_", ""), F.lit("_"), F.lit(" ")))


def percent(share: Column | str) -> Column:
    return F.format_string("%.2f%%", as_column(share) * 100)


def round2(value: Column | str) -> Column:
    return F.round(as_column(value), 2)


def unix_newlines(text: Column | str) -> Column:
    return F.regexp_replace(as_column(text), "\r\n?", "\n")


def session_id() -> Column:
    """A new ``session_<date>_<time>_<8 hex digits>`` per row."""
    stamp = F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
    return F.concat(F.lit("session_"), stamp, F.lit("_"), F.substring(F.uuid(), 1, 8))


def is_session_id(value: Column | str) -> Column:
    return as_column(value).rlike(r"^session_\d{8}_\d{6}_[0-9a-f]{8}$")


def tokens(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(TOKEN), F.lit(0))


def distinct_tokens(text: Column | str) -> Column:
    return F.array_distinct(tokens(text))


def sentences(text: Column | str) -> Column:
    """Non-empty stripped statements in order."""
    parts = F.transform(F.split(as_column(text), SENTENCE_BREAK), strip_space)
    return F.filter(parts, lambda part: part != "")


def fill_template(template: str, **values: Column) -> Column:
    """Put columns into ``{name}`` placeholders.

    The template is cut once here, so a placeholder that occurs inside a document
    or a question is left as it is.
    """
    known = "|".join(map(re.escape, values or PLACEHOLDERS))
    parts = re.split(r"\{(%s)\}" % known, template)
    columns = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)]
    return F.concat(*columns)


def render_history(history: Column | str) -> Column:
    """``role: text`` lines of an ordered array of messages."""
    lines = F.transform(as_column(history), lambda m: F.concat(m["role"], F.lit(": "), m["text"]))
    return F.array_join(lines, "\n")
