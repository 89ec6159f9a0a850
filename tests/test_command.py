import json

import pytest
from pyspark.sql import SparkSession

from quillrank import __main__ as command
from quillrank.sinks.packed import read_packed_report


def test_command(spark, tmp_path, monkeypatch):
    (tmp_path / "queries.list").write_text("bond market\n", encoding="utf8")
    articles = [
        {"id": f"a{i}", "title": f"{'abc'[i % 3] * 9} {i}", "contents": [{"subtype": "paragraph", "content": "bonds " * (i + 1) + "in the markets today"}]}
        for i in range(5)
    ]
    (tmp_path / "articles.json").write_text("\n".join([*map(json.dumps, articles), "{broken"]), encoding="utf8")
    (tmp_path / "stopwords").write_text("in\nthe\n", encoding="utf8")
    monkeypatch.setenv("BIGDATA_NEWS", str(tmp_path / "articles.json"))
    monkeypatch.delenv("SPARK_MASTER", raising=False)
    places = {name: str(tmp_path / name) for name in ("out", "rejects", "rows", "work", "stopwords")}
    command.main(
        ["--queries", str(tmp_path / "queries.list"), "--output", places["out"], "--rejects", places["rejects"], "--rows", places["rows"],
         "--work", places["work"], "--stopwords", places["stopwords"], "--max-token-length", "30"]
    )
    (file,) = (tmp_path / "out" / "reports").glob("query_id=*/*.txt")
    lines = file.read_text(encoding="utf8").splitlines()
    assert [tuple(r) for r in spark.read.json(places["rejects"]).select("value", "reason").collect()] == [("{broken", "not an article")]
    assert spark.read.parquet(places["rows"]).count() == 3
    with pytest.raises(Exception):
        command.main(["--queries", str(tmp_path / "queries.list"), "--output", str(tmp_path / "out2"), "--work", places["work"]])
    packed = ["--queries", str(tmp_path / "queries.list"), "--output", str(tmp_path / "packed"), "--work", places["work"], "--packed"]
    command.main([*packed, "--rejects", str(tmp_path / "rejects2"), "--stopwords", places["stopwords"]])
    assert [r["report"].splitlines() for r in read_packed_report(spark, str(tmp_path / "packed")).collect()] == [lines]
    assert lines[0] == "bond market" and len(lines) == 4  # three of five titles are far apart
    assert SparkSession.getActiveSession() is not None
