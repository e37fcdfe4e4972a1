"""Tokenizing as column expressions.

Every function takes and returns a ``Column`` made of JVM built-ins, so a corpus is analysed inside the scan
stage: no Python worker, and no shuffle, because all words of a document sit in one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a separator is a run of characters outside the Unicode category "letter".
SEPARATOR = r"[^\p{L}]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def tokens(text: Column, drop_empty: bool = False) -> Column:
    """Lower-cased words of a text, in order.

    A text that starts with a separator has an empty first token, trailing empty tokens are dropped, the empty
    text is one empty token and a text of separators only has none. Separators become single blanks first, so
    lower-casing sees each word on its own: a letter whose lower case holds a separator stays one token.
    """
    words = F.rtrim(F.lower(F.regexp_replace(text, SEPARATOR, " ")))
    none = F.array().cast("array<string>")
    result = bind(words, lambda w: F.when((w == "") & (text != ""), none).otherwise(F.split(w, " ")))
    return F.array_remove(result, "") if drop_empty else result


def doc_length(token_array: Column) -> Column:
    """Number of tokens, repeated and empty ones included."""
    return F.size(token_array).cast("long")


def term_bag(token_array: Column) -> Column:
    """Distinct terms of one document with their counts: ``array<struct<term, tf>>`` in term order.

    Sorting the row's own tokens and measuring the runs of equal ones counts them without an ``explode``, so
    term frequencies need no exchange.
    """

    def runs(words: Column) -> Column:
        positions = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(positions, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
        return bind(
            starts,
            lambda first: F.transform(
                first,
                lambda start, j: F.struct(
                    F.get(words, start).alias("term"),
                    (F.coalesce(F.get(first, j + 1), F.size(words)) - start).cast("long").alias("tf"),
                ),
            ),
        )

    return bind(F.sort_array(token_array), runs)


def term_places(token_array: Column) -> Column:
    """Distinct terms of one document with their places: ``array<struct<term, places>>``, places count from 0 and rise."""

    def runs(words: Column) -> Column:
        numbered = F.sort_array(F.transform(words, lambda word, at: F.struct(word.alias("term"), at.alias("at"))))

        def gather(sorted_words: Column) -> Column:
            indexes = F.when(F.size(sorted_words) > 0, F.sequence(F.lit(0), F.size(sorted_words) - 1)).otherwise(
                F.array().cast("array<int>")
            )
            starts = F.filter(
                indexes,
                lambda i: (i == 0) | (F.get(sorted_words, i)["term"] != F.get(sorted_words, i - 1)["term"]),
            )

            def term_at(first: Column) -> Column:
                def one(start: Column, j: Column) -> Column:
                    run = F.slice(sorted_words, start + 1, F.coalesce(F.get(first, j + 1), F.size(sorted_words)) - start)
                    term = F.get(sorted_words, start)["term"].alias("term")
                    return F.struct(term, F.transform(run, lambda e: e["at"]).alias("places"))

                return F.transform(first, one)

            return bind(starts, term_at)

        return bind(numbered, gather)

    return bind(token_array, runs)


def analysis(text: Column, drop_empty: bool = False, only: list[str] | None = None) -> Column:
    """``struct<doc_length, terms>`` of a text; ``only`` keeps these terms, the length still counts all."""

    def describe(words: Column) -> Column:
        kept = words if only is None else F.filter(words, lambda w: w.isin(only))
        return F.struct(doc_length(words).alias("doc_length"), term_bag(kept).alias("terms"))

    return bind(tokens(text, drop_empty), describe)


def entries(text: Column, drop_empty: bool = False) -> Column:
    """``array<struct<term, tf, doc_length>>`` of a text, to ``inline``.

    Give the expression to the generator as it is: the optimizer filters on a generator's input when that is a
    column, and would compute the array again for it.
    """

    def describe(words: Column) -> Column:
        length = doc_length(words)
        return F.transform(
            term_bag(words), lambda e: F.struct(e["term"].alias("term"), e["tf"].alias("tf"), length.alias("doc_length"))
        )

    return bind(tokens(text, drop_empty), describe)
