import json

import pytest
from pyspark.sql import functions as F

from quillrank.options import RankOptions
from quillrank.operators.documents import analyze_contents, analyze_documents, first_paragraphs
from quillrank.sources.articles import ARTICLE, RANKED_FIELDS, decode_articles, published_at, read_articles, read_with_rejects
from quillrank.sources.queries import distinct_queries, read_queries

ARTICLES = [
    {"id": "a1", "title": "T", "published_date": 1326000000000, "unknown": 1,
     "contents": [{"content": 123, "subtype": "paragraph", "more": []}, None]},
    {"id": "a2", "title": None, "contents": None},
    {"id": "a3", "contents": []},
]


@pytest.fixture
def article_file(tmp_path):
    path = tmp_path / "articles.json"
    path.write_text("\n".join(json.dumps(a) for a in ARTICLES) + "\n", encoding="utf8")
    return str(path)


@pytest.mark.parametrize("schema", [ARTICLE, RANKED_FIELDS])
def test_read_articles(spark, article_file, schema):
    rows = {r["id"]: r for r in read_articles(spark, article_file, schema).collect()}
    assert set(rows) == {"a1", "a2", "a3"}
    assert rows["a1"]["contents"][0]["content"] == "123" and rows["a1"]["contents"][1] is None
    assert rows["a2"]["title"] is None and rows["a2"]["contents"] is None
    assert rows["a3"]["title"] is None and rows["a3"]["contents"] == []


def test_decode_and_date(spark):
    line = spark.createDataFrame([(json.dumps(ARTICLES[0]),)], "value string")
    row = line.select(decode_articles(F.col("value")).alias("a")).select("a.*").first()
    assert row.asDict().keys() == set(ARTICLE.names) and row["published_date"] == 1326000000000
    when = line.select(published_at(F.lit(1326000000000)).cast("string")).first()[0]
    assert when.startswith("2012-01-08")


def test_broken_lines(spark, tmp_path):
    path = tmp_path / "mixed.json"
    good = json.dumps(ARTICLES[0])
    path.write_text(f"{good}\n{{broken\nplain text\n\n[1]\n{good}\n", encoding="utf8")
    articles, rejects = read_with_rejects(spark, str(path))
    assert articles.columns == ARTICLE.names and [r["id"] for r in articles.collect()] == ["a1", "a1"]
    assert sorted(r["value"] for r in rejects.collect()) == ["", "[1]", "plain text", "{broken"]
    with pytest.raises(Exception):
        read_articles(spark, str(path)).collect()


def test_read_queries(spark, tmp_path):
    lines = ["finance", "james bond", "finance", "on Facebook IPO", ""]
    (tmp_path / "one").mkdir(), (tmp_path / "two").mkdir()
    (tmp_path / "one" / "a").write_text("\n".join(lines) + "\n", encoding="utf8")
    (tmp_path / "two" / "b").write_text("\n".join(lines[:1]) + "\n", encoding="utf8")
    (tmp_path / "two" / "a").write_text("\n".join(lines[:0:-1]) + "\n", encoding="utf8")
    one, two = (read_queries(spark, str(tmp_path / name)).collect() for name in ("one", "two"))
    assert sorted(r["query"] for r in one) == sorted(lines)
    assert sorted(one) == sorted(two) and len({r["query_id"] for r in one}) == 4
    assert sorted(r["query"] for r in distinct_queries(read_queries(spark, str(tmp_path / "two"))).collect()) == sorted(set(lines))


CONTENTS = [
    ("Kicker", None), ("one", "paragraph"), (None, "PARAGRAPH"), ("x", "Author"), ("two", "Paragraph"),
    ("the", "paragraph"), ("three 3", "paragraph"), ("four", "paragraph"),
]


def article(spark, contents, title="Head line"):
    return spark.createDataFrame(
        [("a", title, contents)], "id string, title string, contents array<struct<content:string,subtype:string>>"
    )


def test_first_paragraphs(spark):
    row = article(spark, CONTENTS).select(first_paragraphs(F.col("contents"), 5).alias("p")).first()
    assert [p["content"] for p in row["p"]] == ["one", None, "two", "the", "three 3"]


def test_analyze(spark):
    options = RankOptions()
    row = analyze_documents(article(spark, CONTENTS), options).first()
    assert row["title_tokens"] == ["head", "line"] and row["body_tokens"] == ["one", "two", "three", "3"]
    assert row["doc_len"] == 6
    contents = analyze_contents(article(spark, CONTENTS), options).first()["contents"]
    assert [c["tokens"] for c in contents] == [["one"], [], ["two"], [], ["three", "3"]]
    for empty in (None, [], [None], [(None, None)]):
        row = analyze_documents(article(spark, empty, None), options).first()
        assert (row["title_tokens"], row["body_tokens"], row["doc_len"]) == ([], [], 0)


def test_rejects_have_a_reason(spark, tmp_path):
    lines = {
        '{"id":"a","title":"t","published_date":5,"contents":[{"content":"x","subtype":"paragraph"},null]}': None,
        '{"id":7,"title":null,"contents":null,"other":{"z":[1]}}': None,
        '{"id":"h","title":true,"published_date":null}': None,
        "{}": None,
        '{"id":"b","title":{"x":1}}': "title",
        '{"id":["b"]}': "id",
        '{"id":"c","published_date":"soon"}': "published_date",
        '{"id":"c","published_date":1.5}': "published_date",
        '{"id":"d","contents":{"a":1}}': "contents",
        '{"id":"e","contents":[3]}': "contents",
        '{"id":"f","contents":[{"content":"x"},{"content":{"q":1}}]}': "contents.content",
        '{"id":"f","contents":[{"kicker":[]}]}': "contents.kicker",
        "[1]": "not an article",
        "null": "not an article",
        "{broken": "not an article",
        "": "not an article",
    }
    path = tmp_path / "lines"
    path.write_text("\n".join(lines) + "\n")
    articles, rejects = read_with_rejects(spark, str(path))
    assert {r["value"]: r["reason"] for r in rejects.collect()} == {k: v for k, v in lines.items() if v}
    assert sorted(r["id"] or "" for r in articles.collect()) == ["", "7", "a", "h"]
    assert read_with_rejects(spark, str(path), RANKED_FIELDS)[1].where("reason = 'contents.kicker'").count() == 0


def test_a_line_is_parsed_once(spark, tmp_path):
    """Once by the schema and once as a variant, whatever is asked of it afterwards."""
    (tmp_path / "lines").write_text('{"id":"1","contents":[{"content":"a"}]}\n{"id":{}}\n')
    for frame, rows in zip(read_with_rejects(spark, str(tmp_path / "lines")), (1, 1)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1 and plan.count("parseJson(") == 1
        assert frame.count() == rows
