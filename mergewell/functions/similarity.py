"""Similarities of strings and of token sets. Empty inputs have defined results; see each function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Edit distances look at so many characters of each side, unless whole texts are asked for, as all features and queries do.
EDIT_CHARS = 100


def edit_distance(a: Column, b: Column, most: int | None = EDIT_CHARS) -> Column:
    """Of the first `most` characters of each side; None: of whole texts."""
    return F.levenshtein(a, b) if most is None else F.levenshtein(F.left(a, F.lit(most)), F.left(b, F.lit(most)))


def edit_similarity(a: Column, b: Column, both_empty: float, most: int | None = EDIT_CHARS) -> Column:
    """1 less the edit distance's share of the longer length."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(both_empty)).otherwise(1.0 - edit_distance(a, b, most) / F.greatest(longest, F.lit(1)))


def jaro_winkler_value(a: str, b: str) -> float:
    """Jaro similarity with a bonus for up to four equal first characters, at any similarity."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    free = [True] * len(b)
    mine = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == ch:
                free[j] = False
                mine.append(ch)
                break
    m = len(mine)
    if not m:
        return 0.0
    theirs = [ch for ch, unused in zip(b, free, strict=True) if not unused]
    swaps = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


@F.pandas_udf(DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(a, b, strict=True):
        if pair[0] is None or pair[1] is None:
            out.append(None)
            continue
        if pair not in known:
            known[pair] = jaro_winkler_value(*pair)
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


def jaro_winkler(a: Column, b: Column) -> Column:
    """Arrow-batched; equal and empty sides are answered in the JVM, and repeated pairs of a batch are computed once."""
    trivial = F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0))
    return F.coalesce(trivial, _jaro_winkler(F.when(trivial.isNull(), a), F.when(trivial.isNull(), b)), F.lit(0.0))


def char_ngrams(c: Column, n: int = 3) -> Column:
    """Distinct runs of n characters of the text with n - 1 spaces before and after; none of an empty text."""
    padded = F.concat(F.lit(" " * (n - 1)), c, F.lit(" " * (n - 1)))
    # By lists of characters side by side: places of a long text's characters would each be counted from its start.
    chars, size = F.split(padded, ""), F.length(padded) - (n - 1)
    grams = F.slice(chars, F.lit(1), size)
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice(chars, F.lit(k + 1), size), lambda a, b: F.concat(a, b))
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


#: Bits of a character in a coded trigram.
CODE_BITS = 21


def _coded(chars: Column, size: Column) -> Column:
    """Each three neighbouring characters' code points as one whole number."""
    codes = F.transform(chars, lambda c: F.ascii(c).cast("long"))
    join = lambda a, b: F.shiftleft(a, CODE_BITS) + b
    two = F.zip_with(F.slice(codes, F.lit(1), size), F.slice(codes, F.lit(2), size), join)
    return F.zip_with(two, F.slice(codes, F.lit(3), size), join)


def gram_codes(c: Column) -> Column:
    """char_ngrams of three characters as whole numbers, in which they take less room and are compared faster. Codes and
    trigrams have the same order."""
    padded = F.concat(F.lit("  "), c, F.lit("  "))
    return F.when(c == "", F.array().cast("array<bigint>")).otherwise(F.array_distinct(_coded(F.split(padded, ""), F.length(padded) - 2)))


def gram_code(term: Column) -> Column:
    """The code of a trigram."""
    return F.element_at(_coded(F.split(term, ""), F.lit(1)), 1)


def coded_gram(code: Column) -> Column:
    """The trigram of a code."""
    part = lambda k: F.lpad(F.hex(F.shiftright(code, k * CODE_BITS).bitwiseAND(F.lit((1 << CODE_BITS) - 1))), 8, "0")
    return F.decode(F.unhex(F.concat(part(2), part(1), part(0))), "UTF-32")


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def _sets(a: Column, b: Column, both: float, one: float, value: Column) -> Column:
    none = (F.size(a) == 0).cast("int") + (F.size(b) == 0).cast("int")
    return F.when(none == 2, F.lit(both)).when(none == 1, F.lit(one)).otherwise(value)


def jaccard(a: Column, b: Column, both: float = 1.0, one: float = 0.0) -> Column:
    """Shared elements of distinct ones; both and one: the results where so many sides are empty."""
    return _sets(a, b, both, one, overlap(a, b) / F.greatest(F.size(F.array_union(a, b)), F.lit(1)))


def set_jaccard(a: Column, b: Column, both: float = 1.0, one: float = 0.0) -> Column:
    """jaccard of lists without repeats, which needs no union of them."""
    common, sizes = overlap(a, b), F.size(a) + F.size(b)
    value = F.coalesce(common / F.nullif(sizes - common, F.lit(0)), F.lit(both))
    return value if one == 0.0 else F.when((F.size(a) > 0) & (F.size(b) > 0), value).when(sizes > 0, F.lit(one)).otherwise(F.lit(both))


def containment(a: Column, b: Column, both: float = 1.0, one: float = 0.0) -> Column:
    """Shared elements of the smaller side's distinct ones."""
    return set_containment(F.array_distinct(a), F.array_distinct(b), both, one)


def set_containment(a: Column, b: Column, both: float = 1.0, one: float = 0.0) -> Column:
    """containment of lists without repeats."""
    return _sets(a, b, both, one, overlap(a, b) / F.greatest(F.least(F.size(a), F.size(b)), F.lit(1)))


def tri_state(a: Column, b: Column) -> Column:
    """1 for equal, -1 for different, 0 if a side is empty."""
    return F.when((a == "") | (b == ""), F.lit(0.0)).when(a == b, F.lit(1.0)).otherwise(F.lit(-1.0))
