"""Text primitives shared by all field rules. All are native Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a Unicode-aware strip removes (zero-width space is not one of them).
UNICODE_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Control characters and space: what a byte-oriented trim removes.
CONTROL_BLANKS = "".join(map(chr, range(0x00, 0x21)))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_of(c: Column | str) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Trim all Unicode whitespace; null becomes the empty string (F1)."""
    return F.btrim(text_of(c), F.lit(UNICODE_BLANKS))


def trim_controls(c: Column | str) -> Column:
    """Trim space and control characters only."""
    return F.btrim(col(c), F.lit(CONTROL_BLANKS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, also when the body is a lambda that
    uses it for every element of an array."""
    return F.get(F.transform(F.array(value), body), 0)


def once(value: Column) -> Column:
    """The value as the only row of a generator, to be selected. A filter on the result stays above it: pushed below a
    projection, it would work the value out a second time."""
    return F.explode(F.array(value))


def words_of(words: list[str]) -> Column:
    """A word list as a constant array (one literal, folded when the query is planned)."""
    return F.split(F.lit("\x00".join(words)), "\x00")


def capture(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, null when there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def capture_number(c: Column, pattern: str, group: int = 1) -> Column:
    """First match as bigint; null when there is none or it does not fit.

    No match has to be null *before* the cast: a failing cast costs an exception per row.
    """
    return capture(c, pattern, group).try_cast("bigint")


def is_listed(c: Column, words: list[str]) -> Column:
    return F.array_contains(words_of(words), c)


def contains_any(c: Column, words: list[str]) -> Column:
    """Whether the text contains one of the words."""
    if len(words) < 4:
        found = c.contains(words[0])
        for word in words[1:]:
            found = found | c.contains(word)
        return found
    return let(c, lambda t: F.exists(words_of(words), lambda w: F.contains(t, w)))


HAN = "[\u4e00-\u9fff]"


def _searched(text: Column, words: list[str]) -> Column:
    """The words worth a search: those with Chinese characters are not looked for in a text without any.

    One pass for the characters replaces one for each such word.
    """
    plain = [w for w in words if not re.search(HAN, w)]
    if len(words) - len(plain) < 6:
        return words_of(words)
    return F.when(text.rlike(HAN), words_of(words)).otherwise(words_of(plain) if plain else F.array().cast("array<string>"))


def present(c: Column, words: list[str]) -> Column:
    """The words the text contains, in list order."""
    return let(c, lambda t: F.filter(_searched(t, words), lambda w: F.contains(t, w)))


def first_listed(c: Column, words: list[str]) -> Column:
    """The first word *in list order* that the text contains, else null.

    Substring tests over a constant array: a long WHEN chain is not faster, makes
    generated code too long to be compiled well, and a regex alternation is slower.
    """
    return F.get(present(c, words), 0)


def first_group(c: Column, groups: dict[str, list[str]]) -> Column:
    """The first group, in order, with a word in the text, ignoring case.

    All words are looked for at once, in the order of their groups; the first one found tells the group.
    """
    named = [(name, word.upper()) for name, words in groups.items() for word in words]
    words = [word for _, word in named]
    first = first_listed(F.upper(c), words)
    place = F.array_position(words_of(words), first).cast("int")
    return F.get(words_of([name for name, _ in named]), place - 1)


def split_tags(c: Column | str) -> Column:
    """Comma-separated tags as an array: trimmed, blanks dropped, duplicates kept."""
    parts = F.transform(F.split(text_of(c), ","), trim_controls)
    return F.filter(parts, lambda t: t != F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))
