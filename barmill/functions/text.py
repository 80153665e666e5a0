"""Column expressions over delimited text lines.

All of them stay inside Spark's generated code: no UDF, and no regular expression where a plain
string function says the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Java's String.trim strips (U+0000 to U+0020).
_BLANKS = "".join(map(chr, range(0x21)))


def strip_blanks(text: Column) -> Column:
    """Trim as Java does: every character up to the space, at both ends."""
    return F.trim(text, F.lit(_BLANKS))


def drop_trailing_commas(line: Column) -> Column:
    """The line without its trailing empty fields.

    Java's split forgets trailing empties, so this is also the line that results from joining the
    split fields again (P2): splitting and joining on the same comma cancel out. Most lines end
    in none, and the test is cheaper than the trim.
    """
    return F.when(line.endswith(","), F.rtrim(line, F.lit(","))).otherwise(line)


def fields_of(line: Column) -> Column:
    """Comma split without trailing empties.

    One difference from Java's split is left: a line of commas only gives one empty field, not
    none. No caller can tell, since both are below the least arity asked for.
    """
    return F.split(drop_trailing_commas(line), ",")


def first_field(line: Column) -> Column:
    return F.substring_index(line, ",", 1)


def parse_float32(text: Column) -> Column:
    """Text to 32-bit float, NULL where Java's Float.parseFloat would throw.

    Spark's cast trims and accepts all that Java does, and also the spellings ``inf``,
    ``infinity`` and ``nan`` in any case. Java knows only ``Infinity`` and ``NaN``, but a number
    too large gives an infinity in both, so only such results need a look at the text.
    """
    number = text.try_cast("float")
    special = F.isnan(number) | (F.abs(number) == float("inf"))
    bare = F.lower(F.ltrim(strip_blanks(text), F.lit("+-")))
    java_spelling = text.contains("Infinity") | text.contains("NaN")
    return F.when(~special | ~bare.isin("inf", "infinity", "nan") | java_spelling, number)
