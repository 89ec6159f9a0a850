"""What the physical plans must and must not contain."""

import random
import re
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillrank import Workspace
from quillrank.operators import scoring
from quillrank.operators.documents import analyze_documents
from quillrank.operators.matching import match_terms
from quillrank.operators.lookup import hot_keys, lookup_join
from quillrank.operators.ranking import rank_all, top_per_query
from quillrank.operators.terms import kept_stem_vocabulary, plain_dictionary, query_terms, stem_vocabulary
from quillrank.plans.ranking import match_corpus, unmatched
from quillrank.sources.tables import sample_articles, sample_queries
from registry.queries import PLAIN, QUERIES, STEMMED
from tests.conftest import SF


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def found(spark):
    with Workspace(spark) as workspace:
        yield match_corpus(sample_articles(spark, SF), sample_queries(spark, SF), PLAIN, workspace)


def test_match_is_one_narrow_pass(spark):
    documents = analyze_documents(sample_articles(spark, SF), PLAIN)
    text = plan(match_terms(documents, plain_dictionary(query_terms(sample_queries(spark, SF), PLAIN)), PLAIN))
    assert text.count("documents.parquet") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    corpus_side = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in corpus_side and "Exchange" not in corpus_side
    assert len(re.findall(r"split\(", corpus_side)) <= 4  # lines, title, body: nothing is tokenized twice
    assert "Generate explode(concat(array(" in corpus_side  # of counts: tokens are counted before there are rows
    assert "Python" not in text


def test_scoring_shuffles_hits_once(found):
    text = plan(found.scores)
    assert text.count("Exchange hashpartitioning(doc_key") == 1
    assert not re.search(r"Exchange hashpartitioning\(query_id#\d+L?, doc_key", text)
    for name in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin", "Python"):
        assert name not in text
    assert "PartitionFilters: [isnotnull(is_document" in text
    assert text.index("sum(tf") < text.index("Exchange hashpartitioning(doc_key")


def test_scoring_tasks_make_few_rows(found, monkeypatch):
    monkeypatch.setattr(scoring, "TASK_ROWS", 200)
    scored = found.term_scores
    held = [row["count"] for row in scored.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) > 20 * scoring.TASK_ROWS and max(held) < 4 * scoring.TASK_ROWS


def test_small_partitions_are_cut(spark):
    """Each of 60 partitions has two rows of every query, and sends one."""
    rows = spark.range(0, 600, 1, 60).select((F.col("id") % 5).alias("query_id"), F.col("id").alias("doc_key"), F.lit(0.5).alias("score"))
    best = top_per_query(rows.withColumn("doc_id", F.col("doc_key")), 1)
    assert [tuple(row) for row in best.orderBy("query_id").select("query_id", "doc_id").collect()] == [(i, i) for i in range(5)]
    assert "Exchange hashpartitioning(query_id" in plan(best) and "SPARK_PARTITION_ID()" in plan(best)


def test_top_is_cut_before_the_shuffle(found):
    text = plan(top_per_query(found.scores, PLAIN.depth))
    assert text.count("WindowGroupLimit") == 4


def test_unmatched_numbers_come_from_gaps(spark):
    """Against plain sets, for queries with none, few, nearly all and all documents, from any place on."""
    rng = random.Random(2)
    n = 5000
    has = {1: [], 2: [7, 1, 2500], 3: rng.sample(range(1, n + 1), 4800), 4: list(range(1, n + 1)), 5: list(range(1, 3000)), 6: [n], 9: [1, 2]}
    taken = spark.createDataFrame([(q, x) for q, numbers in has.items() for x in numbers], "query_id long, number long")
    short = spark.createDataFrame([(q,) for q in range(1, 7)], "query_id long")
    for low, high in ((0, 100), (100, 1100), (1100, n), (0, 1), (4, 5)):
        frame = unmatched(taken, short, n, low, high)
        text = plan(frame)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "LeftAnti" not in text
        got = {q: [] for q in range(1, 7)}
        for r in frame.collect():
            got[r["query_id"]].append(r["number"])
        free = {q: sorted(set(range(1, n + 1)) - set(has[q]))[low:high] for q in got}
        assert {q: sorted(v) for q, v in got.items()} == free


@pytest.mark.parametrize("on", [["term"], ["term", "in_body"]])
def test_hot_keys_are_not_shuffled(spark, on):
    """One key in a third of the rows: no task of the join has more than twice the median rows."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id") % 500))
    facts = spark.range(60_000).select(key.alias("term"), (F.col("id") % 2 == 0).alias("in_body"), "id")
    lookup = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))  # an aggregate, as in the joins of the library
    settings = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        with Workspace(spark) as workspace:
            saved = workspace.save(facts.repartition(8), "facts")
            assert [r["term"] for r in hot_keys(saved, "term").collect()] == ["hot"]
            joined = lookup_join(saved, lookup, on, False, workspace, 4096)
            sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
            everything = lookup_join(saved, lookup, on, False, workspace, 0)
            expected = sorted(map(tuple, saved.join(lookup, on).select("id", "n").collect()))
            assert sorted(map(tuple, joined.select("id", "n").collect())) == expected
            assert sorted(map(tuple, everything.select("id", "n").collect())) == expected
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert len(sizes) >= 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_no_python(spark):
    for key in ("stem_vocabulary", "query_terms_stemmed", "ranked_top10_stemmed"):
        assert "Python" not in plan(QUERIES[key](spark, SF))


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_full_order_is_written_once(spark, limit, monkeypatch, request):
    """A query with most of the rows lies in several range partitions; others share one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    rng = random.Random(3)
    rows = [(1 if i % 3 else 2 + i % 40, f"d{i % 700}", i, float(rng.randrange(20))) for i in range(9000)]
    written = []
    save = Workspace.save
    monkeypatch.setattr(Workspace, "save", lambda self, frame, name, by=None: written.append(name) or save(self, frame, name, by))
    with Workspace(spark) as workspace:
        scores = save(workspace, spark.createDataFrame(rows, "query_id long, doc_id string, doc_key long, score double"), "scores")
        ranked = rank_all(scores, replace(PLAIN, broadcast_bytes=limit), workspace)
        got = {(r["query_id"], r["doc_key"]): r["position"] for r in ranked.collect()}
        ordered = workspace.spark.read.parquet(*[str(p) for p in Path(workspace.path).glob("ordered-*")])
        parts = ordered.where("query_id = 1").select(F.shiftright("row", 33)).distinct().count()
    expected = {}
    for query in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == query), key=lambda r: (-r[3], r[1], r[2]))
        expected.update({(query, r[2]): place for place, r in enumerate(mine, 1)})
    assert got == expected
    assert written == ["ordered", "starts"] and parts > 1


def test_full_order_of_nothing(spark):
    with Workspace(spark) as workspace:
        scores = workspace.save(spark.createDataFrame([], "query_id long, doc_id string, doc_key long, score double"), "scores")
        assert rank_all(scores, PLAIN, workspace).collect() == []


def test_known_words_are_not_stemmed_again(spark, tmp_path):
    """A second run adds no file; a third one with a further word adds that word alone. Options do not change the table."""
    path, words = str(tmp_path / "stems"), ["relational", "being", "on", "skies", "conditionally", "", "x9"]

    def run(tokens, options=STEMMED):
        frame = spark.createDataFrame([(w,) for w in tokens], "token string")
        with Workspace(spark) as workspace:
            found = sorted(map(tuple, kept_stem_vocabulary(frame, path, options, workspace).collect()))
        return found, sorted(map(tuple, stem_vocabulary(frame, options).collect()))

    files = lambda: sorted(p.name for p in Path(path).glob("*.parquet"))
    assert run([]) == ([], []) and files() == []
    found, expected = run(words)
    assert found == expected and len(found) == len(words) and len(files()) == 1
    first = files()
    found, expected = run(words[2:])
    assert found == expected and len(found) == 5 and files() == first
    found, expected = run(words, replace(STEMMED, stopwords=("relat", "ski")))
    assert found == expected and files() == first and ("skies", "ski", None) in found
    found, expected = run([*words, "hopefulness"])
    assert found == expected and len(files()) == 2
    rows = spark.read.parquet(path).collect()
    assert sorted(r["token"] for r in rows) == sorted([*words, "hopefulness"])
    spark.read.parquet(path).limit(3).write.mode("append").parquet(path)  # two runs at once have added the same words
    assert run(words)[0] == run(words)[1]
