r"""Character classes of Unicode string predicates, for Java regular expressions.

Every pattern of the engine is built from these. The classes \w, \s, \d and \b of Java regular expressions and Spark's
trim mean other characters and are not used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, for use inside a character class.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same characters one by one.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters of a word.
WORD = r"\p{L}\p{N}_"
#: Digits: decimal ones and the other numeric characters that count as digits (superscripts, circled ones and so on).
DIGIT = (
    r"\p{Nd}\u00b2\u00b3\u00b9\u1369-\u1371\u19da\u2070\u2074-\u2079\u2080-\u2089\u2460-\u2468\u2474-\u247c\u2488-\u2490\u24ea\u24f5-\u24fd\u24ff\u2776-\u277e\u2780-\u2788\u278a-\u2792"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
#: Line breaks.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
#: Word boundaries: no word character before, none after.
NOT_AFTER, NOT_BEFORE = f"(?<![{WORD}])", f"(?![{WORD}])"


def strip(s: Column) -> Column:
    """Without white space at either end. (A pattern for the end is tried from each place inside every run of white space.)"""
    return F.btrim(s, F.lit(SPACES))


def squeeze(s: Column) -> Column:
    """Runs of white space as one space."""
    return F.regexp_replace(s, f"[{SPACE}]+", " ")


def count(s: Column, inside: str, others: str = "") -> Column:
    """How many characters are in a class. `others`: a simple class outside it that most characters are in, to pass over them fast."""
    pattern = f"[{others}]+|[^{inside}{others}]+" if others else f"[^{inside}]+"
    return F.length(F.regexp_replace(s, pattern, ""))


def count_outside(s: Column, outside: str) -> Column:
    """How many characters aren't in a class."""
    return F.length(F.regexp_replace(s, f"[{outside}]+", ""))


def words(s: Column) -> Column:
    """Pieces between white space."""
    return F.filter(F.split(s, f"[{SPACE}]+"), lambda w: w != "")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole to six digits, half to even; 0 of nothing."""
    return F.when(whole > 0, F.bround(part / whole, 6)).otherwise(0.0)


def unmoved(column: Column) -> Column:
    """A column below which no filter is pushed: there, the expensive columns it is made of would be computed twice."""
    return F.when(F.spark_partition_id() >= 0, column)


def let(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.transform(F.array(value), use)[0]
