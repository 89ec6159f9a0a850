"""Text to tokens, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

TOKEN_BREAK = "[^a-z0-9]+"
# Letters outside ASCII whose lower case is an ASCII letter. They separate tokens like all others outside
# ASCII, so they must go before lower().
LOWERS_INTO_ASCII = ("\u0130", "\u212a")  # dotted capital I, Kelvin sign


@dataclass(frozen=True)
class TokenRules:
    """Optional limits; a token that breaks one is dropped."""

    max_length: int | None = None
    max_digits: int | None = None
    max_repeats: int | None = None  # equal characters in a row

    def accept(self, token: Column) -> list[Column]:
        tests = []
        if self.max_length is not None:
            tests.append(F.length(token) <= self.max_length)
        if self.max_digits is not None:
            tests.append(~token.rlike(f"([0-9][^0-9]*){{{self.max_digits + 1}}}"))
        if self.max_repeats is not None:
            tests.append(~token.rlike(rf"(.)\1{{{self.max_repeats}}}"))
        return tests


def tokenize(text: Column, rules: TokenRules = TokenRules(), stopwords: Iterable[str] = ()) -> Column:
    """Lower-cased runs of ASCII letters and digits, in order. Null gives an empty array.

    Empty pieces, stopwords and tokens that break ``rules`` are left out in the same walk over the array.
    """
    plain = F.coalesce(text, F.lit(""))
    for letter in LOWERS_INTO_ASCII:
        plain = F.replace(plain, F.lit(letter), F.lit(" "))
    pieces = F.split(F.lower(plain), TOKEN_BREAK)
    # More than ten literals become one hash-set lookup in the optimizer.
    dropped = ["", *sorted(set(stopwords))]

    def keep(token: Column) -> Column:
        test = ~token.isin(dropped)
        for rule in rules.accept(token):
            test = test & rule
        return test

    return F.filter(pieces, keep)


def remove_stopwords(tokens: Column, stopwords: Iterable[str]) -> Column:
    words = sorted(set(stopwords))
    return F.filter(tokens, lambda token: ~token.isin(words)) if words else tokens
