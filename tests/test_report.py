import re
from pathlib import Path

import pytest

from quillrank import Workspace
from quillrank.sinks.packed import read_one_report, read_packed_report, write_packed_report
from quillrank.sinks.report import nested, read_report, report_lines, write_ranking, write_report

RANKING = [
    (1, "james bond", 1, "11b0-0af5", 3.7824629519609267, None),
    (1, "james bond", 2, "7e9c-981a", 3.513622915235988, "A cinematographer, dies at 84"),
    (1, "james bond", 3, "1cd4-d7ba", -0.25, "Book: In ‘Girl’ by E. D., a woman takes on high finance"),
    (2, "on a/b test", 1, "ceced", 6.5, "Report: to file next Wednesday"),
    (3, "on_a/b_test", 1, "ceced", 6.5, ""),
]
SCHEMA = "query_id bigint, query string, rank int, doc_id string, score double, title string"
EXPECTED = """james bond
  1:11b0-0af5 3.7824629519609267 null
  2:7e9c-981a 3.513622915235988 A cinematographer, dies at 84
  3:1cd4-d7ba -0.25 Book: In ‘Girl’ by E. D., a woman takes on high finance
"""


def test_lines(spark):
    rows = report_lines(spark.createDataFrame(RANKING, SCHEMA)).where("query_id = 1").orderBy("line_no").collect()
    assert "".join(r["line"] + "\n" for r in rows) == EXPECTED


def test_lines_read_back_as_rows(spark):
    """A report holds everything a ranking does."""
    lines = report_lines(spark.createDataFrame(RANKING, SCHEMA)).where("line_no > 0").collect()
    found = []
    for row in lines:
        rank, doc_id, score, title = re.fullmatch(r"  (\d+):(\S+) (\S+) (.*)", row["line"]).groups()
        found.append((row["query_id"], row["query"], int(rank), doc_id, float(score), None if title == "null" else title))
    assert sorted(found, key=str) == sorted(RANKING, key=str)


def test_files(spark, tmp_path):
    ranking = spark.createDataFrame(RANKING, SCHEMA)
    write_report(ranking, str(tmp_path / "out"))
    reports = tmp_path / "out" / "reports"
    assert sorted(p.name for p in reports.iterdir() if p.is_dir()) == ["query_id=1", "query_id=2", "query_id=3"]
    assert (reports / "_SUCCESS").exists()
    (file,) = (reports / "query_id=1").glob("*.txt")
    assert file.read_text(encoding="utf8") == EXPECTED
    manifest = spark.read.parquet(str(tmp_path / "out" / "manifest")).orderBy("query_id").collect()
    assert [tuple(r) for r in manifest] == [
        (1, "james_bond", "james bond"), (2, "on_a/b_test", "on a/b test"), (3, "on_a/b_test", "on_a/b_test")
    ]
    back = read_report(spark, str(tmp_path / "out")).orderBy("query_id", "line_no").collect()
    lines = report_lines(ranking).select("query_id", "line_no", "line").orderBy("query_id", "line_no").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in lines]
    write_ranking(ranking, str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == len(RANKING)


def test_files_of_a_long_query(spark, tmp_path):
    query = "so long a query / " * 25
    write_report(spark.createDataFrame([("q", query, 1, "d", 1.0, None)], SCHEMA.replace("query_id bigint", "query_id string")), str(tmp_path))
    assert [r["line"] for r in read_report(spark, str(tmp_path)).orderBy("line_no").collect()] == [query, "  1:d 1.0 null"]


def test_packed_files(spark, tmp_path):
    """Few files whatever the number of queries, every report read back by its byte range."""
    titles = ["A cinematographer, dies at 84", None, "", "In ‘Girl’ by E. D.", "東京 😀", "two\nlines", "x" * 500]
    rows = [(q, f"query {q} é/ß", r, f"d{q}-{r}", r / 4, titles[(q + r) % 7]) for q in range(400) for r in range(1, 1 + q % 5 + 1)]
    ranking = spark.createDataFrame(rows, SCHEMA).repartition(7)
    expected = {}
    for q, query, r, doc, score, title in sorted(rows):
        expected[q] = expected.get(q, query) + f"\n  {r}:{doc} {score} {'null' if title is None else title}"
    for name, size in (("one", 1 << 20), ("some", 1 << 14), ("least", 1)):
        path = str(tmp_path / name)
        with Workspace(spark) as workspace:
            write_packed_report(ranking.where("query_id < 20") if name == "least" else ranking, path, workspace, size)
        held = {q: text for q, text in expected.items() if q < 20 or name != "least"}
        files = sorted((tmp_path / name / "reports").glob("file=*/*.txt"))
        total = sum(f.stat().st_size for f in files)
        assert (len(files) == 1) if name == "one" else 1 < len(files) <= -(-total // size)
        index = spark.read.parquet(f"{path}/index").collect()
        assert len(index) == len(held) and sum(r["length"] for r in index) == total
        back = read_packed_report(spark, path).collect()
        assert {r["query_id"]: r["report"] for r in back} == held and len(back) == len(held)
        assert {r["file_name"] for r in back} == {f"query_{q}_é/ß" for q in held}
        few = read_packed_report(spark, path, spark.createDataFrame([(3,), (3,), (11,), (9999,)], "query_id bigint"))
        assert sorted((r["query_id"], r["report"]) for r in few.collect()) == [(3, held[3]), (11, held[11])]
        assert [read_one_report(spark, path, q) for q in (0, 17, 9999)] == [held[0], held[17], None]


def test_packed_files_of_odd_rankings(spark, tmp_path):
    with Workspace(spark) as workspace:
        write_packed_report(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), workspace)
        assert read_packed_report(spark, str(tmp_path / "none")).collect() == []
        long = "so long a query / " * 25000
        ranking = spark.createDataFrame([("q'1", long, 1, "d", 1.0, None)], SCHEMA.replace("query_id bigint", "query_id string"))
        write_packed_report(ranking, str(tmp_path / "long"), workspace, 100)
        assert read_one_report(spark, str(tmp_path / "long"), "q'1") == long + "\n  1:d 1.0 null"
        with pytest.raises(ValueError):
            write_packed_report(ranking, str(tmp_path / "no"), workspace, 1 << 31)


def test_nested(spark):
    row = nested(spark.createDataFrame(RANKING, SCHEMA)).where("query_id = 1").first()
    assert [(r["rank"], r["doc_id"]) for r in row["results"]] == [(1, "11b0-0af5"), (2, "7e9c-981a"), (3, "1cd4-d7ba")]


def test_workspace_deletes_only_itself(spark, tmp_path):
    with Workspace(spark, str(tmp_path)) as workspace, Workspace(spark, str(tmp_path)) as other:
        saved = workspace.save_measured(spark.createDataFrame([("ab", 1), (None, 2)], "s string, n int"), "t")
        assert (saved.rows, saved.nbytes) == (2, 2 * 32 + 2) and saved.fits(66) and not saved.fits(65)
        kept = other.save(saved.frame, "kept")
        workspace.close()
        assert not Path(workspace.path).exists() and kept.count() == 2
