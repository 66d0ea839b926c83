"""Text rules of the source tables, as Spark column expressions.

In the tables this library maintains an empty string *is* NULL, concatenation
treats NULL as empty, and fixed-width codes are padded with blanks. Spark
differs on all three, so every operator goes through these helpers.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

CODE_WIDTH = 8


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """``c`` without leading and trailing blanks; NULL when nothing is left."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def code(c: Column | str) -> Column:
    """Comparable form of a blank-padded code; a blank code becomes NULL."""
    return F.nullif(F.rtrim(_col(c)), F.lit(""))


def padded(c: Column | str, width: int = CODE_WIDTH) -> Column:
    """``c`` padded with blanks (or cut) to ``width`` characters."""
    return F.rpad(_col(c), width, " ")


def has_text(c: Column | str) -> Column:
    """True when ``c`` holds something other than blanks; never NULL."""
    return trimmed(c).isNotNull()


def yes_no(condition: Column) -> Column:
    """'Y' when the condition is true, otherwise (also for NULL) 'N'."""
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def decode(c: Column | str, cases: Sequence[tuple[Any, Any]], default: Any = None) -> Column:
    """Value of the first case equal to ``c`` (NULL equals NULL), else ``default``."""
    subject = _col(c)
    out = None
    for key, value in cases:
        hit = subject.eqNullSafe(F.lit(key))
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if out is None else out.otherwise(default)


def joined(*parts: Column | str) -> Column:
    """Concatenation that reads NULL as empty text; an empty result is NULL.

    Strings among ``parts`` are literals, not column names.
    """
    cells = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.nullif(F.concat(*cells), F.lit(""))


def piped(*parts: Column) -> Column:
    """``a|b|c`` with empty slots for NULLs."""
    cells: list[Column | str] = []
    for i, part in enumerate(parts):
        if i:
            cells.append("|")
        cells.append(part)
    return joined(*cells)


def like_pattern(*parts: Column | str) -> Column:
    """A LIKE pattern put together at run time.

    Strings are literals (normally the ``%`` signs). ``_`` and ``%`` coming from
    column values stay wildcards; a backslash is an ordinary character, so it
    is doubled for Spark.
    """
    cells = [
        F.lit(p) if isinstance(p, str)
        else F.replace(F.coalesce(p.cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\"))
        for p in parts
    ]
    return F.concat(*cells)


def matches(text: Column | str, pattern: Column | str) -> Column:
    """``text LIKE pattern`` with the pattern taken from a column."""
    return F.like(_col(text), _col(pattern))


def full_name(race: Column | str, surname: Column | str, given: Column | str) -> Column:
    """Display name: surname first for race code CHI, otherwise given name first."""
    last, first = trimmed(surname), trimmed(given)
    return F.when(_col(race) == "CHI", joined(last, " ", first)).otherwise(joined(first, " ", last))


def segments(c: Column | str, width: int, count: int | None = None) -> Column:
    """``c`` cut into pieces of ``width`` characters, as an array.

    ``count`` fixes the number of slots (slots past the end are NULL); without
    it the whole text is cut.
    """
    text = _col(c)
    if count is None:
        # one pass over the text; a substring per piece would start from the front each time
        pieces = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % width), F.lit(0))
        return F.when(F.length(text) > 0, pieces).otherwise(F.array(F.lit(None).cast("string")))
    return F.transform(
        F.sequence(F.lit(1), F.lit(count)),
        lambda i: F.nullif(F.substring(text, (i - 1) * width + 1, F.lit(width)), F.lit("")),
    )
