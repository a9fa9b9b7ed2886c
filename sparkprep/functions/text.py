"""Scalar text and number expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII punctuation; equals POSIX [[:punct:]] in the C locale.
PUNCT = r"\p{Punct}"
WORD_SPLIT = r"[^\p{L}\p{N}']+"      # word tokens keep inner apostrophes
CLEAN_SPLIT = r"[^\p{L}\p{N}]+"      # tokens after punctuation removal
WS_CHARS = " \t\r\n"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


UNICODE_PUNCT = r"[\p{P}\p{S}]"


def strip_punct(col, unicode: bool = False) -> Column:
    """Drop ASCII punctuation, or every Unicode punctuation/symbol
    character with ``unicode=True``."""
    return F.regexp_replace(_c(col), UNICODE_PUNCT if unicode else PUNCT, "")


def squash_ws(col) -> Column:
    return F.regexp_replace(_c(col), r"\s+", " ")


def trim_ws(col) -> Column:
    """Trim blanks, tabs and line breaks at both ends (plain trim only strips
    spaces)."""
    return F.trim(_c(col), F.lit(WS_CHARS))


def parse_number(col, strip: str = "[$,%]") -> Column:
    """Currency / percent text to double; bad text becomes null (try_cast)."""
    return F.regexp_replace(_c(col), strip, "").try_cast("double")


def before(col, sep: str = ",") -> Column:
    """Text before the first ``sep`` (whole text when absent)."""
    return F.substring_index(_c(col), sep, 1)


def has(col, pattern: str) -> Column:
    """Case-insensitive pattern test where null text counts as no match."""
    return F.coalesce(_c(col).rlike("(?iu)" + pattern), F.lit(False))


def detect(col, pattern: str) -> Column:
    """Pattern test that keeps null for null text."""
    return _c(col).rlike(pattern)


def normalize_label(col, missing: str = "Missing") -> Column:
    """lower -> trim -> drop punctuation -> squash blanks -> null to ``missing``."""
    c = trim_ws(F.lower(_c(col)))
    c = squash_ws(strip_punct(c))
    return F.coalesce(c, F.lit(missing))


def word_tokens(col) -> Column:
    """Lower-cased word tokens (letters, digits, inner apostrophes)."""
    return F.filter(F.split(F.lower(_c(col)), WORD_SPLIT), lambda t: t != "")


def clean_tokens(col, stop_words: list[str]) -> Column:
    """lower -> drop ASCII digits -> drop punctuation -> split to words ->
    drop stop words (duplicates kept)."""
    c = F.regexp_replace(F.lower(_c(col)), "[0-9]", "")
    c = strip_punct(c)
    toks = F.filter(F.split(c, CLEAN_SPLIT), lambda t: t != "")
    # IN over many literals is planned as a hash-set lookup (InSet)
    return F.filter(toks, lambda t: (t != "") & ~t.isin(*stop_words))


def list_tokens(col, sep: str = ",") -> Column:
    """Split a delimited list, then per element: drop punctuation, lower,
    trim. Null text gives a null array."""
    return F.transform(F.split(_c(col), sep),
                       lambda x: trim_ws(F.lower(strip_punct(x))))
