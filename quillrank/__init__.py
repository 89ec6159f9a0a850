"""Ranked text retrieval as Spark DataFrame jobs."""

from quillrank.options import RankOptions
from quillrank.plans.ranking import rank_articles, rank_files
from quillrank.workspace import Workspace

__all__ = ["RankOptions", "Workspace", "rank_articles", "rank_files"]
