"""Ordered first-match rule chains, folded into one CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.functions.text import has


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _is_plain(p: str) -> bool:
    return not any(ch in p for ch in ".^$*+?()[]{}|\\")


def _one(lowered: Column, p: str) -> Column:
    """A regex; alternations of plain words become OR-ed substring tests
    (same matches, and indexOf is far cheaper than regex backtracking)."""
    alts = p.split("|")
    if all(a and _is_plain(a) for a in alts):
        cond = None
        for a in alts:
            c = lowered.contains(a.lower())
            cond = c if cond is None else (cond | c)
        return cond
    return lowered.rlike("(?iu)" + p)  # the pattern's own case may matter (\\D, \\W)


def _match(lowered: Column, pattern) -> Column:
    pats = pattern if isinstance(pattern, (list, tuple)) else [pattern]
    cond = None
    for p in pats:
        c = _one(lowered, p)
        cond = c if cond is None else (cond & c)
    return cond


def first_match(col, rules: Sequence, default: str | None,
                lowered: bool = False) -> Column:
    """``rules`` is an ordered list of ``(pattern, label)``; ``pattern`` is a
    regex (or list of regexes that must all match) tested on the lower-cased
    text. Null text matches nothing and falls through to ``default``, as a
    SQL searched CASE does. Pass ``lowered=True`` for a column that is
    already lower-cased (compute it once in its own projection: conditional
    CASE branches are not shared by subexpression elimination)."""
    lowered = _c(col) if lowered else F.lower(_c(col))
    expr = None
    for pattern, label in rules:
        cond = _match(lowered, pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def keyword_category(col, keywords: Sequence[str],
                     default: str = fv.KEYWORD_DEFAULT, lowered: bool = False) -> Column:
    """Label = first keyword the text contains (case-insensitive)."""
    return first_match(col, [(k, k) for k in keywords], default, lowered)


def access_flags(col, lowered: bool = False) -> Column:
    """Struct of seven 0/1 flags; null text gives null flags."""
    lowered = _c(col) if lowered else F.lower(_c(col))
    return F.struct(*[_match(lowered, p).cast("int").alias(name)
                      for name, p in fv.ACCESS_FLAGS])


def region(col, lowered: bool = False) -> Column:
    return first_match(col, fv.REGION_RULES, fv.REGION_DEFAULT, lowered)


def jurisdiction_state(col, lowered: bool = False) -> Column:
    return first_match(col, fv.JURISDICTION_RULES, fv.JURISDICTION_DEFAULT, lowered)


def host_mentions(col, lowered: bool = False) -> Column:
    return first_match(col, fv.HOST_MENTION_RULES, fv.HOST_MENTION_DEFAULT, lowered)


def license_status(col) -> Column:
    c = _c(col)
    return (F.when(c.isNull(), F.lit("No"))
            .when(has(c, fv.LICENSE_PENDING), F.lit("Pending"))
            .otherwise(F.lit("Yes")))


def property_category(col) -> Column:
    c = _c(col)
    expr = None
    for values, label in fv.PROPERTY_CATEGORIES:
        cond = F.coalesce(c.isin(*values), F.lit(False))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(fv.PROPERTY_DEFAULT))


def merge_policy(col) -> Column:
    """strict-like policies -> "strict"; others unchanged; null stays null."""
    c = _c(col)
    return F.when(c.isin(*fv.STRICT_POLICIES), F.lit("strict")).otherwise(c)


def merge_neighborhood(col) -> Column:
    c = _c(col)
    src, dst = fv.NEIGHBORHOOD_MERGE
    return F.when(c == src, F.lit(dst)).otherwise(c)


def bed_category(col) -> Column:
    """Real Bed -> bed, other -> other, null -> null."""
    c = _c(col)
    return F.when(c == fv.REAL_BED, F.lit("bed")).when(c != fv.REAL_BED, F.lit("other"))


def yes_no_positive(col) -> Column:
    """>0 -> YES, <=0 -> NO, null -> null (ifelse semantics)."""
    c = _c(col)
    return F.when(c > 0, F.lit("YES")).when(c <= 0, F.lit("NO"))


def rate_level(col) -> Column:
    """100 -> ALL, <100 -> SOME, null -> MISSING, above 100 -> null."""
    c = _c(col)
    return (F.when(c == 100, F.lit("ALL")).when(c < 100, F.lit("SOME"))
            .when(c.isNull(), F.lit("MISSING")))


def has_rules(col, lowered: bool = False, word_boundary: bool = False) -> Column:
    """Yes when a topic word co-occurs with a permission/prohibition word
    (substring tests on lower-cased text, so "not" and "now" count as "no",
    as in the original); ``word_boundary=True`` matches whole words instead.
    Null text -> No."""
    lowered = _c(col) if lowered else F.lower(_c(col))

    def test(w):
        return lowered.rlike(rf"\b{w}\b") if word_boundary else lowered.contains(w)
    cond = None
    for topic in fv.RULE_TOPICS:
        for word in fv.RULE_WORDS:
            c = test(topic) & test(word)
            cond = c if cond is None else (cond | c)
    return F.when(F.coalesce(cond, F.lit(False)), F.lit("Yes")).otherwise(F.lit("No"))
