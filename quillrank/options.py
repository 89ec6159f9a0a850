"""What a caller may set about a ranking."""

from __future__ import annotations

from dataclasses import dataclass

from quillrank.functions.stopwords import ENGLISH
from quillrank.functions.text import TokenRules


@dataclass(frozen=True)
class RankOptions:
    # Text analysis
    stopwords: tuple[str, ...] = ENGLISH
    stopword_table: str | None = None  # text path with a word per line, of any number; takes the place of stopwords
    stem: bool = True
    rules: TokenRules = TokenRules()
    max_paragraphs: int = 5
    body_passes: int = 1  # 2 runs the body through stopwords and stemming again before counting

    # Scoring
    ratio: str = "real"  # "integer" truncates documents / collection frequency
    score_digits: int = 12  # scores are compared after rounding, so equal sums tie on every run
    include_unmatched: bool = False  # documents without any query term rank with score 0.0

    # Selection
    k: int = 10
    min_title_distance: float = 0.5
    depth: int = 100  # candidates looked at per query and round, at most 1000; does not change the result

    # Physical choices; none of them changes the result
    broadcast_bytes: int = 64 << 20  # a lookup side larger than this is joined by shuffle
    stem_table: str | None = None  # folder in which stems are kept over runs, so that only new words are stemmed

    def __post_init__(self):
        if self.ratio not in ("real", "integer"):
            raise ValueError(f"ratio must be 'real' or 'integer', not {self.ratio!r}")
        if self.body_passes not in (1, 2):
            raise ValueError("body_passes must be 1 or 2")
        if self.k < 1 or self.max_paragraphs < 0:
            raise ValueError("k must be positive, max_paragraphs not negative")
        if not 1 <= self.depth <= 1000:
            # Above that Spark no longer cuts partitions down before the shuffle.
            raise ValueError("depth must be between 1 and 1000")
