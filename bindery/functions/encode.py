"""Percent encoding with one byte per character."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values. ASCII and Latin-1 characters become one escaped byte. A character outside both
# printable ranges becomes an escaped question mark; the no-break space counts as outside.
OUT_OF_RANGE = "%3F"
KEPT_THOUGH_ESCAPED = {"%21": "!", "%27": "'", "%28": "(", "%29": ")", "%7E": "~"}

# UTF-8 escapes of characters outside: control characters, and everything above Latin-1.
_NEXT = "%[89AB][0-9A-F]"
OUTSIDE = (
    "%(?:[01][0-9A-F]|7F|C2%(?:[89][0-9A-F]|A0)"
    f"|C[4-9A-F]{_NEXT}|D[0-9A-F]{_NEXT}|E[0-9A-F]{_NEXT}{_NEXT}|F[0-9A-F]{_NEXT}{_NEXT}{_NEXT})"
)
# Two-byte Latin-1 escapes and the start of their single byte. The C2 ones come last: the bytes they
# leave could follow an escape that is already single and be taken for its second byte.
TWO_BYTES = {"%C3%8": "%C", "%C3%9": "%D", "%C3%A": "%E", "%C3%B": "%F", "%C2%A": "%A", "%C2%B": "%B"}


def url_encode_latin1(text: Column) -> Column:
    """Percent-encode ``text`` byte-wise in Latin-1.

    Spark's ``url_encode`` walks over the characters, in UTF-8. What follows folds its escapes to
    one byte with literal replacements, after one pattern for what has no single byte.
    """
    out = F.regexp_replace(F.url_encode(text), OUTSIDE, OUT_OF_RANGE)
    for found, wanted in {"+": "%20", **KEPT_THOUGH_ESCAPED, **TWO_BYTES}.items():
        out = F.replace(out, F.lit(found), F.lit(wanted))
    return out
