"""Distance between two titles."""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def edits(text: str, others: list[str]) -> list[int]:
    """Edit distances in code points from ``text`` to each of ``others``, in one round per code point of ``text``.

    A round makes a column of every table of distances. The steps down the columns, one more or one less, are the bits of two
    numbers (Myers 1999, Hyyro 2003), in which the others lie side by side with a bit between that stops carries.
    """
    codes = np.frombuffer("".join(other + "\0" for other in others).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(other) for other in others], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    inside, first = np.ones(len(codes), bool), np.zeros(len(codes), bool)
    inside[ends], first[ends - sizes] = False, True

    def number(bits: np.ndarray) -> int:
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")

    def ones(number: int) -> np.ndarray:
        bits = np.frombuffer(number.to_bytes(len(codes) // 8 + 1, "little"), np.uint8)
        below = np.concatenate([[0], np.cumsum(np.unpackbits(bits, bitorder="little"), dtype=np.int64)])
        return below[ends] - below[ends - sizes]

    places = {c: number((codes == ord(c)) & inside) for c in {*text}}
    every, lowest = number(inside), number(first)
    up, down = every, 0
    for at in map(places.__getitem__, text):
        level = (((at & up) + up) ^ up) | at | down
        right_up = (down | ((level | up) ^ every)) << 1 | lowest
        up, down = ((level & up) << 1 | ((level | right_up) ^ every)) & every, right_up & level
    return (len(text) + ones(up) - ones(down & every)).tolist()


@F.pandas_udf(T.IntegerType())
def _edits(a: pd.Series, b: pd.Series) -> pd.Series:
    """Rows of one text that follow each other, as the items of an article do, are done together."""
    out = []
    for text, rows in groupby(zip(a, b), lambda row: row[0]):
        others = [other for _, other in rows]
        found = [other for other in others if other is not None]
        if text is None:
            distances = iter([None] * len(found))
        elif len(text) > sum(map(len, found)):  # fewer rounds over the others
            distances = (edits(other, [text])[0] for other in found)
        else:
            distances = iter(edits(text, found))
        out += [None if other is None else next(distances) for other in others]
    return pd.Series(out, dtype="Int32")


def title_distance(a: Column, b: Column) -> Column:
    """Edit distance over the longer length, in code points: 0 same, 1 nothing shared.

    Null where a title is null or both are empty.
    """
    return F.try_divide(_edits(a, b), F.greatest(F.char_length(a), F.char_length(b)))


def _at_most(a: Column, b: Column, longer: Column, min_distance: float) -> Column:
    enough = F.ceil(F.lit(min_distance) * longer).cast("int")
    edits = F.call_function("levenshtein", a, b, enough)  # -1 beyond that
    return (edits >= 0) & (edits / longer < min_distance)


def titles_alike(a: Column, b: Column, min_distance: float) -> Column:
    """True where the distance is below ``min_distance``; a missing title is never alike.

    Equal titles and titles whose lengths alone keep them apart are settled without an edit distance; for others it is
    worked out only as far as it may matter.
    """
    longer = F.greatest(F.char_length(a), F.char_length(b))
    shorter = F.least(F.char_length(a), F.char_length(b))
    at_least = F.try_divide(longer - shorter, longer)
    return F.coalesce(
        F.when(a == b, (longer > 0) & F.lit(min_distance > 0))
        .when(at_least >= min_distance, F.lit(False))
        .otherwise(_at_most(a, b, longer, min_distance)),
        F.lit(False),
    )
