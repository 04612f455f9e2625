"""Personal names split into the subfields of a bibliographic name entry.

A name may hold a fuller form in parentheses and a date range at its end. Each part is one regular
expression over the whole name, so the name is referred to once per part and plans stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the splitting rules. A range in the name is cut off with the six characters before
# its dash, a comma, a space and a year; the dates start four characters before that dash. The later
# of the first two dashes is the one in the range, unless a digit stands before the first.
HEAD = "(?s)^[^-]*"
DIGIT_BEFORE_DASH = HEAD + "[0-9]-"
TWO_DASHES = HEAD + "-[^-]*-"
CUT_AT_FIRST = "(?s)^([^-]*)[^-]{6}-"
CUT_AT_SECOND = "(?s)^([^-]*-(?:[^-]*(?=[^-]{6}-))?)"
YEAR_START = "(?:[^-]*(?=[^-]{4}-)|(?=[^-]{0,3}-))"
DATES_AT_FIRST = f"(?s)^{YEAR_START}([0-9].*)"
DATES_AT_SECOND = f"{HEAD}-{YEAR_START}([0-9].*)"
BEFORE_PAREN = r"(?s)^([^(]*)\("
IN_PAREN = r"(?s)^[^(]*\(([^)]*)\)"


def name_part(name: Column) -> Column:
    """Subfield a: the name without a parenthesised form and without a trailing date range.

    Only a name with neither parenthesis nor dash gets a closing comma.
    """
    return (
        F.when(F.contains(name, F.lit("(")), F.regexp_extract(name, BEFORE_PAREN, 1))
        .when(~F.contains(name, F.lit("-")), F.concat(name, F.lit(",")))
        .when(name.rlike(DIGIT_BEFORE_DASH), F.regexp_extract(name, CUT_AT_FIRST, 1))
        .when(name.rlike(TWO_DASHES), F.regexp_extract(name, CUT_AT_SECOND, 1))
        .otherwise(name)
    )


def fuller_form(name: Column) -> Column:
    """Subfield q: the parenthesised form; null when there is no parenthesis."""
    inside = F.regexp_extract(name, IN_PAREN, 1)
    return F.when(F.contains(name, F.lit("(")), F.concat(F.lit("("), inside, F.lit(")")))


def dates_part(name: Column) -> Column:
    """Subfield d: the dates, if what stands four characters before the dash is a digit; else null."""
    found = F.when(name.rlike(TWO_DASHES), F.regexp_extract(name, DATES_AT_SECOND, 1)).otherwise(
        F.regexp_extract(name, DATES_AT_FIRST, 1)
    )
    return F.concat(F.nullif(found, F.lit("")), F.lit(". "))


def role_part(role: Column) -> Column:
    """Subfield e."""
    return F.concat(role, F.lit(". "))


def orcid_part(orcid: Column) -> Column:
    """Subfield 0: the identifier, prefixed unless it is a link. Null without an identifier."""
    prefix = F.when(F.contains(orcid, F.lit("http")), "").otherwise("(orcid)")
    return F.concat(prefix, orcid)


def person_subfields(name: Column, role: Column, orcid: Column | None = None) -> Column:
    """All subfields of one person, in order, absent ones left out."""
    parts = [("a", name_part(name)), ("q", fuller_form(name)), ("d", dates_part(name)), ("e", role_part(role))]
    if orcid is not None:
        parts.append(("0", orcid_part(orcid)))
    made = F.array(*[F.struct(F.lit(code).alias("code"), value.alias("value")) for code, value in parts])
    return F.filter(made, lambda part: part["value"].isNotNull())
