"""The folder in which registered queries keep their work tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

from quillrank.workspace import Workspace

_workspaces: dict[str, Workspace] = {}


def session_workspace(spark: SparkSession) -> Workspace:
    """One workspace per session, as results are read from it until the session ends.

    It lies in spark.checkpoint.dir. Only a local master without that setting, as in tests, gets a temporary folder, which
    goes when the process ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _workspaces:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root and spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
            root = tempfile.mkdtemp(prefix="quillrank-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
        _workspaces[app] = Workspace(spark, root)
    return _workspaces[app]
