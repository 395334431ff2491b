"""Column expressions that turn raw n-gram fields into clean values.

Everything here is a plain Catalyst expression, so it runs inside whole-stage
codegen next to the scan.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The letters a word may keep, the characters trimmed from a text
# (U+0000 to U+0020) and the signs a token is made of, all but white space.
LETTERS = r"a-z\x{0590}-\x{05FF}"
PADDING = "".join(map(chr, range(0x21)))
TOKEN = r"[^ \t\n\x0B\f\r]++"

# The decimal digits of other scripts (of the first plane) and what they stand for.
OTHER_DIGITS = {
    sign: str(unicodedata.decimal(sign))
    for sign in map(chr, range(0x80, 0x10000))
    if unicodedata.category(sign) == "Nd"
}

# A token is good when its lower-cased form holds exactly one run of letters and
# that run has two letters or more. The quantifiers are possessive: a long run
# of digits or dashes is read once, never backtracked into.
ONE_WORD = rf"^[^{LETTERS}]*+([{LETTERS}]{{2,}}+)[^{LETTERS}]*+$"


def trimmed(text: Column) -> Column:
    """``text`` without the control characters and blanks at its ends.

    Trimming by a set of characters is slow, and most texts need none.
    """
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    return F.when((first <= " ") | (last <= " "), F.trim(text, F.lit(PADDING))).otherwise(text)


def whole_number(text: Column, type_name: str) -> Column:
    """``text`` as an ``int`` or ``bigint``; NULL where it is not one.

    Decimals, blanks and numbers too large for the type all give NULL. The
    digits may be of any script; that is tried only if the plain cast fails. The
    cast ignores the same characters at the ends as :func:`trimmed`, and U+007F,
    which is no blank.
    """
    plain = F.translate(text, "".join(OTHER_DIGITS), "".join(OTHER_DIGITS.values()))
    number = F.coalesce(text.try_cast(type_name), plain.try_cast(type_name))
    return F.when(~F.contains(text, F.lit("\x7f")), number)


def decade_of(year: Column) -> Column:
    """The first year of the decade, rounding towards zero (-5 gives 0)."""
    return (year - year % 10).cast("int")


def clean_token(raw: Column) -> Column:
    """The lower-cased word inside ``raw``, or NULL when there is not just one.

    ``19th`` gives ``th``, ``"Hello,`` gives ``hello``; ``don't``, ``x1y`` and
    ``I`` give NULL.
    """
    return F.get(F.regexp_extract_all(F.lower(raw), F.lit(ONE_WORD), F.lit(1)), F.lit(0))


def token_list(text: Column) -> Column:
    """The pieces of ``text`` between white space."""
    return F.regexp_extract_all(trimmed(text), F.lit(TOKEN), F.lit(0))


def computed(df: DataFrame, *columns: Column, kept: tuple[str, ...] = ()) -> DataFrame:
    """``df.select(*kept, *columns)`` whose ``columns`` are computed only once.

    Catalyst moves a filter below a plain projection and repeats the projected
    expression for every use the filter makes of it, here regular expressions on
    every line read. A generator of one row holds the values in place.
    """
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))
