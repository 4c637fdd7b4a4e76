"""Helpers for Column expressions: Unicode classes that Java and RE2 read alike, and local bindings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What Python's str.isspace() and \s take for white space, as the inside of a class. Java keeps single characters
#: below U+0100 in one table, but asks for each range in turn, which is slow from the third on.
WS = "\\t\\n\\x0b\\f\\r\\x1c\\x1d\\x1e\\x1f\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACE, NOT_SPACE = f"[{WS}]", f"[^{WS}]"
#: The same as characters, for trimming.
WS_CHARS = "".join(chr(c) for a, b in ((0x9, 0xD), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)) for c in range(a, b + 1))
#: Runs of white space that are not one plain space: most are, and each match costs as much as many characters that
#: do not match. What stands first turns down most characters by one or two comparisons.
ODD_SPACE = f"(?![!-~]| [!-~])(?:{SPACE}{{2,}}|(?! ){SPACE})"
#: A word character, and the edges of words; Java's own \w and \b are ASCII in some releases.
WORD = "[\\p{L}\\p{N}_]"
EDGE = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
#: Where str.splitlines() breaks.
LINE_BREAK = "(?![ -~])(?:\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029])"


def listed(*ranges: str) -> str:
    """The characters from each first to each last, one by one."""
    return "".join(chr(x) for a, b in ranges for x in range(ord(a), ord(b) + 1))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body with value evaluated once: what a lambda takes from outside it is evaluated for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(c: Column) -> Column:
    """Null as empty."""
    return F.coalesce(c, F.lit(""))


def sub(c: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(to))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WS_CHARS))


def squeeze(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return strip(sub(c, ODD_SPACE, " "))


def hits(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def chars_in(c: Column, inside: str) -> Column:
    """How many characters are of a class (the inside of a bracket): the rest is taken out and what stays is
    measured, which makes one string where counting matches makes one for each character."""
    return n_chars(sub(c, f"[^{inside}]+"))


def chars_not_in(c: Column, inside: str) -> Column:
    return n_chars(sub(c, f"[{inside}]+"))


def pieces(c: Column, inside: str) -> Column:
    """The runs of characters of a class (the inside of a bracket). Splitting at the rest is several times as fast
    as collecting matches."""
    return F.array_remove(F.split(c, f"[^{inside}]+", -1), "")


def words(c: Column) -> Column:
    """Squeezed first, because splitting at one plain character needs no pattern, which would be compiled for each value."""
    return F.array_remove(F.split(squeeze(c), " ", -1), "")


def word_count(c: Column) -> Column:
    return let(squeeze(c), lambda s: F.when(s == "", F.lit(0)).when(s.isNotNull(), n_chars(s) - n_chars(F.replace(s, F.lit(" "), F.lit(""))) + 1)).cast("long")


def n_chars(c: Column) -> Column:
    return F.char_length(c).cast("long")


def split_lines(c: Column) -> Column:
    """str.splitlines(): no last empty line, no line for an empty text."""
    parts = F.split(c, LINE_BREAK, -1)
    return let(parts, lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))


def ratio(a: Column, b: Column) -> Column:
    """a / b as double, with 1 for a b of 0."""
    return a.cast("double") / F.greatest(b, F.lit(1)).cast("double")


def unfold(df: DataFrame, keep: list[str], array: Column, pos: str, value: str) -> DataFrame:
    """A row for each element: keep, its position from 0, the element. The outer form is filtered afterwards,
    because the optimizer puts a test of the array's size before the plain one, which evaluates it again."""
    return df.select(*keep, F.posexplode_outer(array).alias(pos, value)).where(F.col(pos).isNotNull())


def spread(df: DataFrame) -> DataFrame:
    """df on all cores, where its files make fewer partitions than there are; as it is otherwise."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df
