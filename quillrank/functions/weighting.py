"""The DPH weighting model (Amati, 2006) for one term in one document."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def _log2(x: Column) -> Column:
    # Spark's log2 is null at zero.
    return F.when(x > 0, F.log2(x)).otherwise(F.lit(float("-inf")))


def dph(tf: Column, cf: Column, doc_len: Column, avg_len: Column, n_docs: Column, ratio: str = "real") -> Column:
    """DPH score of a term that occurs ``tf`` > 0 times in a document of ``doc_len`` tokens.

    ``ratio="integer"`` truncates n_docs / cf, which sends terms more frequent than documents to minus
    infinity. A document that holds nothing but the term scores 0.0, the limit of the formula.
    """
    f = tf / doc_len
    norm = (1 - f) * (1 - f) / (tf + 1)
    rarity = n_docs / cf
    if ratio == "integer":
        rarity = F.floor(rarity)
    score = norm * (
        tf * _log2(tf * avg_len / doc_len * rarity) + 0.5 * _log2(2 * math.pi * tf * (1 - f))
    )
    return F.when(tf >= doc_len, F.lit(0.0)).otherwise(score)
