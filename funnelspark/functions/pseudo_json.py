"""Repairing single-quoted pseudo-JSON and parsing it, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is text outside strings, a closed string, or an unclosed tail. A quote
# closes its string when only blanks separate it from , } ] : or the end.
_TOKEN = r"[^']+|'(?s:.*?)'(?=[ \t\n\r]*(?:[,}\]:]|\z))|'(?s:.*)"
# The same for a text with a quote put behind it, which closes an unclosed tail and nothing else.
_CLOSED = r"'((?s:.*?))'(?=[ \t\n\r]*(?:[,}\]:]|'?\z))"
_MARK = "#"


def repair_quotes(text: Column) -> Column:
    """Turn single-quoted strings into JSON strings; apostrophes inside stay.

    Only a text that holds a double quote, which may have to be escaped, is taken apart into tokens.
    """
    closed = F.regexp_replace(F.concat(text, F.lit("'")), _CLOSED, '"$1"')
    return F.when(text.contains('"'), _rewritten(text)).otherwise(F.left(closed, F.length(text)))


def _rewritten(text: Column) -> Column:
    def rewrite(token: Column) -> Column:
        closed = token.endswith("'") & (F.length(token) > 1)
        inner = F.when(closed, token.substr(F.lit(2), F.length(token) - 2)).otherwise(
            token.substr(F.lit(2), F.length(token))
        )
        quoted = F.concat(
            F.lit('"'),
            F.replace(inner, F.lit('"'), F.lit('\\"')),
            F.when(closed, '"').otherwise(""),
        )
        return F.when(token.startswith("'"), quoted).otherwise(token)

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, rewrite), "")


def wrapped_document(text: Column) -> Column:
    """Parse ``text`` as the first of two array items; see ``whole_document``."""
    wrapped = F.concat(F.lit("["), text, F.lit(f',"{_MARK}"]'))
    return F.try_parse_json(wrapped).try_cast("array<variant>")


def whole_document(wrapped: Column) -> Column:
    """The document, or NULL when the text held anything but one JSON document.

    The parser alone accepts text after the document; with the mark behind it,
    only a single complete document leaves exactly two items.
    """
    single = (F.size(wrapped) == 2) & (F.get(wrapped, F.lit(1)).try_cast("string") == _MARK)
    return F.when(single, F.get(wrapped, F.lit(0)))
