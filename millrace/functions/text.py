"""Names, searches, keys and query text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_name(value: Column, default: str = "user", length: int | None = None) -> Column:
    """An identifier of lower-case letters, digits and single underscores."""
    name = F.regexp_replace(F.lower(F.trim(value)), "[^a-z0-9_]", "_")
    name = F.regexp_replace(F.regexp_replace(name, "_+", "_"), "^_|_$", "")
    name = F.coalesce(F.nullif(name, F.lit("")), F.lit(default))
    return F.substring(name, 1, length) if length else name


def contains_text(value: Column, text: str) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` in ``text`` are literal."""
    escaped = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return value.ilike(f"%{escaped}%")


def strip_nul(value: Column) -> Column:
    """Remove 0x00, which a relational text column refuses."""
    return F.replace(value, F.lit("\x00"), F.lit(""))


def surrogate_key(columns: Sequence[Column], null_safe: bool = False) -> Column:
    """SHA-1 over the columns as text.

    A null in any part makes the key null.  ``null_safe`` tells nulls and
    neighbouring parts apart instead.
    """
    texts = [column.cast("string") for column in columns]
    if not null_safe:
        return F.sha1(F.concat(*texts))
    marked = [
        F.when(text.isNull(), F.lit("-")).otherwise(
            F.concat(F.length(text).cast("string"), F.lit(":"), text)
        )
        for text in texts
    ]
    return F.sha1(F.concat(*marked))


_NUMBER = r"(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?(?![\p{L}\p{N}_$])"
# One token of query text: quoted text, a name in quotes, a comment, a word, a
# number (its sign belongs to it where no operand stands before), any other sign.
_TOKEN = (
    r"(?s)'[^']*+(?:''[^']*+)*+'|\"[^\"]*+(?:\"\"[^\"]*+)*+\"|--[^\n]*|/\*.*?\*/|[\p{L}_][\p{L}\p{N}_$]*"
    r"|(?<=[=(,<>+*/-][ \t\n]{0,16})[+-]" + _NUMBER + "|" + _NUMBER + r"|[\p{L}\p{N}_$]+|."
)


def query_pattern(query: Column) -> Column:
    """Query text with every literal replaced by ``?`` and blanks squeezed.

    One pass from left to right, so a quote in a comment or a number in a text
    is what it is there.  Comments count as blanks, names in double quotes stay.
    A quote without end is left as it is.
    """

    def plain(token: Column) -> Column:
        comment = F.startswith(token, F.lit("--")) | F.startswith(token, F.lit("/*"))
        literal = (F.length(token) > 1) & F.startswith(token, F.lit("'"))
        number = token.rlike(rf"^[+-]?{_NUMBER}$")
        return F.when(literal | number, "?").when(comment, " ").otherwise(token)

    text = F.array_join(F.transform(F.regexp_extract_all(query, F.lit(_TOKEN), 0), plain), "")
    text = F.regexp_replace(text, "\\(\\?( *, *\\?)*\\)", "(?)")
    return F.trim(F.regexp_replace(text, "\\s+", " "))
