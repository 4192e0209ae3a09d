"""Text expressions. All are built-in Spark SQL functions, evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
#: Unicode letters, digits and underscore, two or more: the same class in Java and RE2.
WORD = r"[\p{L}\p{N}_]{2,}"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """trim every kind of white space at both ends."""
    return F.trim(c, F.lit(WHITE_SPACE))


def has_script(c: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """does the text hold a character of one of the code-point ranges?"""
    return c.rlike("[" + "".join(rf"\x{{{lo:04X}}}-\x{{{hi:04X}}}" for lo, hi in ranges) + "]")


def words(c: Column) -> Column:
    """Lower-cased word tokens of at least two characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), 0)


def without(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Drop stop words, keep duplicates and order."""
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words)))


def word_ngrams(tokens: Column, max_n: int = 2) -> Column:
    """All word n-grams of 1..``max_n`` tokens."""
    def grams(t: Column) -> Column:
        def of_size(n: int) -> Column:
            last = F.size(t) - n
            starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(t, i + k) for k in range(n)]))

        return F.concat(t, *[of_size(n) for n in range(2, max_n + 1)])

    return let(tokens, grams)


def char_ngrams(c: Column, min_n: int = 2, max_n: int = 4) -> Column:
    """Character n-grams inside each word padded by one space on both sides.

    A padded word shorter than ``min_n`` is emitted once, whole.
    """
    padded = F.transform(
        F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda w: w != ""),
        lambda w: F.concat(F.lit(" "), w, F.lit(" ")),
    )

    def of_word(w: Column) -> Column:
        size = F.length(w)
        windows = F.flatten(
            F.transform(
                F.sequence(F.lit(min_n), F.least(F.lit(max_n), size)),
                lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: w.substr(i, n)),
            )
        )
        return F.when(size < min_n, F.array(w)).otherwise(windows)

    return F.flatten(F.transform(padded, of_word))


def term_counts(terms: Column) -> Column:
    """Distinct terms of a list with their counts, in the row: array<struct<term, tf>>."""
    def runs(s: Column) -> Column:
        size = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda p, k: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(at, k + 1), size) - p).cast("long").alias("tf"),
                ),
            ),
        )

    return F.when(F.size(terms) > 0, let(F.sort_array(terms), runs)).otherwise(
        F.array().cast("array<struct<term:string,tf:bigint>>")
    )


def truncate(c: Column, n: int = 140) -> Column:
    """null becomes "", longer texts are cut at ``n``, right-stripped and marked."""
    text = F.coalesce(c, F.lit(""))
    cut = F.rtrim(F.substring(text, 1, n), F.lit(WHITE_SPACE))
    return F.when(F.length(text) > n, F.concat(cut, F.lit("…"))).otherwise(text)


def percent(c: Column, digits: int = 0) -> Column:
    """F8: a share as percent text; halves go to even, as in the source reports."""
    return F.concat(number(c * 100, digits), F.lit("%"))


def number(c: Column, digits: int = 2) -> Column:
    """F8: fixed-point text of a number, halves to even; null stays null."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f", F.bround(c, digits)))


def plural(n: Column, word: str) -> Column:
    """"1 step", "2 steps"."""
    return F.concat(n.cast("string"), F.lit(f" {word}"), F.when(n != 1, "s").otherwise(""))


def fill(template: str, **values: Column) -> Column:
    """a template whose ``{name}`` fields are column values; values are not re-read."""
    out: list[Column] = []
    rest = template
    while rest:
        hits = [(rest.index("{" + k + "}"), k) for k in values if "{" + k + "}" in rest]
        if not hits:
            out.append(F.lit(rest))
            break
        at, key = min(hits)
        if at:
            out.append(F.lit(rest[:at]))
        out.append(F.coalesce(values[key], F.lit("")))
        rest = rest[at + len(key) + 2 :]
    return F.concat(*out)
