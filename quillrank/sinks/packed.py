"""Reports of many queries in few large files, with an index of where each lies.

A folder per query, as ``report`` writes, costs the store a file for every query. Here a query's report is a byte range of
one of ``total bytes / file_bytes`` files; the file of a query follows from a hash of its id, and reports lie there in the
order of their ids. The index holds ``(query_id, query, file_name, file, offset, length)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quillrank.sinks.report import file_name, report_lines
from quillrank.workspace import Workspace

FILE_BYTES = 64 << 20  # what a file has on average; a reader of many reports holds one file per task
LONGEST = 1 << 30  # offsets are cut out of one file's bytes, which an array of the JVM must hold


def report_texts(ranking: DataFrame) -> DataFrame:
    """``(query_id, query, report)``: the lines of a query's report, at most k + 1, with line feeds between."""
    lines = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    grouped = report_lines(ranking).groupBy("query_id", "query").agg(lines.alias("lines"))
    return grouped.select("query_id", "query", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("report"))


def write_packed_report(ranking: DataFrame, path: str, workspace: Workspace, file_bytes: int = FILE_BYTES) -> None:
    """``reports/file=N/``, one text file each, and ``index``, which is written when all of them are there.

    Reports are written once to ``workspace`` and measured there, so that the number of files follows from their bytes. An
    empty ranking makes an empty index.
    """
    if not 0 < file_bytes <= LONGEST:
        raise ValueError(f"file_bytes must be between 1 and {LONGEST}")
    sized = report_texts(ranking).withColumn("length", F.octet_length("report") + 1)  # with the line feed that ends it
    saved = workspace.save_measured(sized, "reports", total=F.sum("length"))
    files = max(1, -(-(saved.observed["total"] or 0) // file_bytes))
    # Not the hash that deals rows out, or files would meet in few tasks.
    placed = saved.frame.withColumn("file", F.pmod(F.xxhash64("query_id"), F.lit(files)).cast("int"))
    (
        placed.select("file", "query_id", "report")
        .repartition(files, "file")
        .sortWithinPartitions("file", "query_id")
        .select("file", "report")
        .write.option("maxRecordsPerFile", 0)
        .partitionBy("file")
        .text(f"{path}/reports")
    )
    before = Window.partitionBy("file").orderBy("query_id").rowsBetween(Window.unboundedPreceding, -1)
    index = placed.select("query_id", "query", "file", "length").withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    index.select("query_id", "query", file_name(F.col("query")).alias("file_name"), "file", "offset", "length").write.parquet(f"{path}/index")


def read_packed_report(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """``(query_id, file_name, report)`` of the queries in ``wanted`` (``query_id``), or of all, each cut out of its file by the index.

    A file is one row with the places that are wanted in it, so a task holds one file's bytes.
    """
    index = spark.read.parquet(f"{path}/index")
    if wanted is not None:
        index = index.join(wanted.select("query_id"), "query_id", "left_semi")
    places = index.groupBy("file").agg(F.collect_list(F.struct("query_id", "file_name", "offset", "length")).alias("places"))
    if not index.take(1):  # nothing was written, or nothing is wanted
        return index.select("query_id", "file_name", F.lit("").alias("report"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{path}/reports")
    both = files.select(F.col("file").cast("int").alias("file"), "content").join(places, "file")

    def cut(place):
        text = F.col("content").substr((place["offset"] + 1).cast("int"), (place["length"] - 1).cast("int"))
        return F.struct(place["query_id"].alias("query_id"), place["file_name"].alias("file_name"), text.cast("string").alias("report"))

    return both.select(F.explode(F.transform("places", cut)).alias("r")).select("r.*")


def read_one_report(spark: SparkSession, path: str, query_id) -> str | None:
    """The report of one query, its byte range alone read from any store that Spark reads; None if there is no such query."""
    place = spark.read.parquet(f"{path}/index").where(F.col("query_id") == F.lit(query_id)).select("file", "offset", "length").first()
    if place is None:
        return None
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/reports/file={place['file']}")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    (file,) = [status.getPath() for status in store.listStatus(folder) if status.getPath().getName().endswith(".txt")]
    stream = store.open(file)
    try:
        stream.seek(place["offset"])
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, place["length"] - 1)).decode("utf-8")
    finally:
        stream.close()
