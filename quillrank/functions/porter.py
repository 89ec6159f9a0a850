"""Porter's suffix stripper (M. F. Porter, "An algorithm for suffix stripping", 1980).

Follows the paper, with the two changes its author made in his own later program: ``bli`` for ``abli`` and
the added ``logi`` in step 2, and words of one or two letters left alone. All of it is built-in expressions. Run it
over a vocabulary, never over running text.

A letter is a vowel if it is one of a, e, i, o, u, or a y after a consonant. So a run of consonants is one letter that is
not of the five and then letters that are neither of them nor y; a run of vowels begins with any of the six and goes on
with the five. Read from the start of a word there is one way to do that, which the patterns below spell out.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillrank.functions.binding import let

# Fixed values of the published algorithm: suffix and replacement by step.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
)


_TO_VOWELS = "^(?:[^aeiou][^aeiouy]*[aeiouy]|[aeiou])[aeiou]*"  # up to the end of the first run of vowels
_HAS_VOWEL = "^(?:[^aeiou][^aeiouy]*[aeiouy]|[aeiou])"
_ONE = _TO_VOWELS + "[^aeiou]"  # measure of one or more
_TWO = _ONE + "[^aeiouy]*[aeiouy][aeiou]*[^aeiou]"
_SHORT = "^[^aeiou][^aeiouy]*[aeiouy][^aeiouwxy]$"  # of measure one, and ends consonant, vowel, consonant

# Ends in two equal consonants other than l, s and z. A y counts if it is a consonant, as every other one in a row is.
_DOUBLE = r"([^aeiouylsz])\1$|(?:^|[aeiou])y(?:yy)+$|[^aeiouy](?:yy)+$"


def _without(word: Column, count: Column | int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - count)


def _suffix(word: Column, suffixes) -> Column:
    """The longest of the suffixes that the word has; empty if none. The leftmost match is the longest."""
    return F.regexp_extract(word, f"({'|'.join(sorted(suffixes, key=len, reverse=True))})$", 1)


def _replaced(word: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    new = F.create_map(*[F.lit(x) for rule in rules for x in rule])

    def apply(suffix: Column) -> Column:
        stem = _without(word, F.length(suffix))
        return F.when((suffix != "") & stem.rlike(_ONE), F.concat(stem, F.try_element_at(new, suffix))).otherwise(word)

    return let(_suffix(word, [old for old, _ in rules]), apply)


def _plural(word: Column) -> Column:
    return (
        F.when(word.endswith("sses") | word.endswith("ies"), _without(word, 2))
        .when(word.endswith("s") & ~word.endswith("ss"), _without(word, 1))
        .otherwise(word)
    )


def _past_and_progressive(word: Column) -> Column:
    def tidied(stem: Column) -> Column:
        return (
            F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
            .when(stem.rlike(_DOUBLE), _without(stem, 1))
            .when(stem.rlike(_SHORT), F.concat(stem, F.lit("e")))
            .otherwise(stem)
        )

    def cut(count: int) -> Column:
        stem = _without(word, count)
        return F.when(stem.rlike(_HAS_VOWEL), let(stem, tidied)).otherwise(word)

    return (
        F.when(word.endswith("eed"), F.when(_without(word, 3).rlike(_ONE), _without(word, 1)).otherwise(word))
        .when(word.endswith("ed"), cut(2))
        .when(word.endswith("ing"), cut(3))
        .otherwise(word)
    )


def _final_y(word: Column) -> Column:
    stem = _without(word, 1)
    return F.when(word.endswith("y") & stem.rlike(_HAS_VOWEL), F.concat(stem, F.lit("i"))).otherwise(word)


def _residual(word: Column) -> Column:
    def apply(suffix: Column) -> Column:
        stem = _without(word, F.length(suffix))
        fits = (suffix != "ion") | stem.rlike("[st]$")
        return F.when((suffix != "") & fits & stem.rlike(_TWO), stem).otherwise(word)

    return let(_suffix(word, STEP_4), apply)


def _final_e(word: Column) -> Column:
    stem = _without(word, 1)
    gone = stem.rlike(_TWO) | (stem.rlike(_ONE) & ~stem.rlike(_SHORT))
    return F.when(word.endswith("e") & gone, stem).otherwise(word)


def _final_ll(word: Column) -> Column:
    return F.when(word.endswith("ll") & word.rlike(_TWO), _without(word, 1)).otherwise(word)


def stem(word: Column | str) -> Column:
    """The stem of a lower-case word; null for null."""
    word = F.col(word) if isinstance(word, str) else word

    def steps(word: Column) -> Column:
        out = word
        for step in (
            _plural, _past_and_progressive, _final_y, lambda w: _replaced(w, STEP_2), lambda w: _replaced(w, STEP_3), _residual,
            _final_e, _final_ll,
        ):
            out = let(out, step)
        return F.when(F.length(word) <= 2, word).otherwise(out)

    return let(word, steps)
