import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quillrank import RankOptions, Workspace, rank_articles
from quillrank.operators.ranking import rank_all
from quillrank.operators.stopwords import without_words
from quillrank.plans.ranking import match_corpus
from tests import plain

SCHEMA = "id string, title string, contents array<struct<subtype:string,content:string>>"
WORDS = "bond bonds james finance financial universities university doing engine market markets ipo the of a1".split()
QUERIES = [
    (1, "finance"), (2, "James Bond"), (3, "the of"), (4, "universities doing markets"), (5, "market market ipo"),
    (6, "nowhere"), (7, "engine"), (8, "common"),
]


def corpus(seed, size=60, hot=0.35):
    """Random articles, ``hot`` of them under one title with small changes, some without title or body."""
    rng = random.Random(seed)

    def words(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))

    articles = []
    for i in range(size):
        title = rng.choice([None, "", words(rng.randint(1, 5)), f"{words(2)} {i}"])
        if rng.random() < hot:
            title = "the one title that everybody copies " + rng.choice(["", "!", "again", str(i % 7)])
        contents = [
            rng.choice([None, (rng.choice(["paragraph", "PARAGRAPH", None, "kicker"]), rng.choice([None, "common " + words(rng.randint(0, 9))]))])
            for _ in range(rng.randint(0, 8))
        ]
        articles.append((f"d{rng.randint(0, size * 2):03d}", title, rng.choice([contents] * 9 + [None])))
    articles.append(("alone", None, [("paragraph", "engine")]))
    return articles


def ranked(spark, articles, queries, options):
    # Two partitions in order, so that row keys follow the order of the list as in the plain version.
    frame = spark.createDataFrame(spark.sparkContext.parallelize(articles, 2), SCHEMA)
    asked = spark.createDataFrame(queries, "query_id bigint, query string")
    with Workspace(spark) as workspace:
        rows = rank_articles(frame, asked, options, workspace).orderBy("query_id", "rank").collect()
    found = {}
    for row in rows:
        found.setdefault(row["query_id"], []).append((row["doc_id"], row["score"], row["title"]))
        assert row["rank"] == len(found[row["query_id"]]) and row["query"] == dict(queries)[row["query_id"]]
    return found


BASE = RankOptions(score_digits=9)
VARIANTS = {
    "default": BASE,
    "plain": replace(BASE, stem=False),
    "shallow": replace(BASE, depth=1, k=3),
    "shallow 3": replace(BASE, depth=3, stem=False),
    "integer": replace(BASE, ratio="integer", stem=False),
    "unmatched": replace(BASE, include_unmatched=True, stem=False),
    "unmatched shallow": replace(BASE, include_unmatched=True, depth=2, k=4, stem=False),
    "unmatched integer, all words": replace(BASE, include_unmatched=True, ratio="integer", stopwords=(), stem=False, k=20),
    "two passes": replace(BASE, body_passes=2),
    "two passes, shuffled": replace(BASE, body_passes=2, broadcast_bytes=0),
    "shuffled": replace(BASE, broadcast_bytes=0, depth=4, k=6, stem=False),
    "shuffled, hot terms broadcast": replace(BASE, broadcast_bytes=400, stem=False),
    "shuffled, hot stems broadcast": replace(BASE, broadcast_bytes=400),
    "strict distance": replace(BASE, min_title_distance=0.9, k=5),
    "k 1": replace(BASE, k=1, depth=1),
}


@pytest.mark.parametrize("seed, name", enumerate(VARIANTS))
def test_same_as_plain_version(spark, name, seed):
    options = VARIANTS[name]
    articles = corpus(seed)
    assert ranked(spark, articles, QUERIES, options) == plain.rank(articles, QUERIES, options)


def test_most_rows_are_copies(spark):
    """Far more copies than a round looks at, on top of the ranking, hide nothing below them."""
    articles = [(f"c{i:03d}", "one title for all", [("paragraph", "bond bond bond market")]) for i in range(150)]
    articles += [(f"x{i:03d}", f"{i} {'xyz'[i % 3] * 20}", [("paragraph", "bond " + "market " * (i + 3))]) for i in range(9)]
    options = replace(BASE, depth=5, k=4)
    found = ranked(spark, articles, [(1, "bond")], options)
    assert found == plain.rank(articles, [(1, "bond")], options)
    assert len(found[1]) == 4 and [t for _, _, t in found[1]].count("one title for all") == 1


def test_edge_inputs(spark):
    assert ranked(spark, corpus(1), [(1, ""), (2, "the")], BASE) == {}
    assert ranked(spark, [("a", None, None), ("b", "the", [])], QUERIES, BASE) == {}
    one = [("a", "bond", [])]
    assert ranked(spark, one, [(1, "bond")], BASE) == {1: [("a", 0.0, "bond")]}
    empty_query = replace(BASE, include_unmatched=True)
    assert ranked(spark, one, [(1, "")], empty_query) == {1: [("a", 0.0, "bond")]}


def test_repeated_queries_count_once(spark):
    articles = corpus(3)
    asked = spark.createDataFrame([(4, "bond"), (2, "bond"), (9, "Bond")], "query_id bigint, query string")
    frame = spark.createDataFrame(articles, SCHEMA)
    with Workspace(spark) as workspace:
        ids = {r[0] for r in rank_articles(frame, asked, BASE, workspace).select("query_id").collect()}
    assert ids == {2, 9}


def test_full_ranking(spark):
    options = replace(BASE, stem=False, stopwords=())
    frame = spark.createDataFrame(corpus(5, size=300), SCHEMA)
    asked = spark.createDataFrame(QUERIES, "query_id bigint, query string")
    with Workspace(spark) as workspace:
        scores = workspace.save(match_corpus(frame, asked, options, workspace).scores, "scores")
        for limit in (0, 64 << 20):
            rows = rank_all(scores, replace(options, broadcast_bytes=limit), workspace).collect()
            for query_id in {r["query_id"] for r in rows}:
                mine = sorted((r for r in rows if r["query_id"] == query_id), key=lambda r: r["position"])
                assert [r["position"] for r in mine] == list(range(1, len(mine) + 1))
                order = [(-r["score"], r["doc_id"], r["doc_key"]) for r in mine]
                assert order == sorted(order)
        assert len(rows) == scores.count()


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_string_query_ids(spark, limit):
    """Any type of id, with queries that only unmatched documents can fill."""
    options = replace(BASE, include_unmatched=True, stem=False, k=15, depth=4, broadcast_bytes=limit)
    articles = corpus(6)
    frame = spark.createDataFrame(spark.sparkContext.parallelize(articles, 2), SCHEMA)
    asked = spark.createDataFrame([(f"q{i}", q) for i, q in QUERIES], "query_id string, query string")
    with Workspace(spark) as workspace:
        rows = rank_articles(frame, asked, options, workspace).orderBy("query_id", "rank").collect()
    expected = plain.rank(articles, [(f"q{i}", q) for i, q in QUERIES], options)
    assert {q: [(r["doc_id"], r["score"], r["title"]) for r in rows if r["query_id"] == q] for q in expected} == expected


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_a_term_in_every_document(spark, limit):
    articles = [(f"d{i:03d}", f"{'xyz'[i % 3] * 9} {i}", [("paragraph", "common " * (1 + i % 5) + f"w{i % 11} " * (i % 7))]) for i in range(400)]
    options = replace(BASE, stem=False, stopwords=(), broadcast_bytes=limit, depth=20)
    assert ranked(spark, articles, [(1, "common"), (2, "w3")], options) == plain.rank(articles, [(1, "common"), (2, "w3")], options)


def test_options_are_checked():
    for wrong in ({"ratio": "x"}, {"body_passes": 3}, {"k": 0}, {"depth": 0}, {"depth": 1001}):
        with pytest.raises(ValueError):
            RankOptions(**wrong)


@pytest.mark.parametrize("limit", [0, 64 << 20])
@pytest.mark.parametrize("variant", [{"stem": False}, {"body_passes": 2}])
def test_stopwords_from_a_table(spark, tmp_path, limit, variant):
    """As with the same words in the options; documents and queries of such words alone included, among a great many others."""
    words = ["the", "of", "james", "doing", "market", "common", "financ"]
    spark.range(200_000).select(F.concat(F.lit("w"), "id").alias("value")).union(spark.createDataFrame([(w,) for w in ["", *words, "the"]], "value string")).write.text(
        str(tmp_path / "words")
    )
    articles = [*corpus(8), ("only", "the of", [("paragraph", "the the")])]
    options = replace(BASE, broadcast_bytes=limit, **variant)
    expected = ranked(spark, articles, QUERIES, replace(options, stopwords=tuple(words)))
    assert ranked(spark, articles, QUERIES, replace(options, stopword_table=str(tmp_path / "words"))) == expected and expected
    if limit == 0 and not variant.get("stem", True):
        assert expected == plain.rank(articles, QUERIES, replace(options, stopwords=tuple(words)))


def test_stopwords_in_any_place(spark):
    """Order and repeats of what stays; empty rows; a list that nothing meets leaves the rows as they are."""
    rows = [(1, ["a", "b", "a", "c"], ["b"]), (2, [], ["a"]), (3, ["b", "b"], []), (4, [], []), (5, ["c", "c", "d"], ["d", "a", "c"])]
    with Workspace(spark) as workspace:
        saved = workspace.save(spark.createDataFrame(rows, "k long, x array<string>, y array<string>"), "rows")
        for listed in ({"a", "b"}, {"c"}, {"zzz"}, set()):
            words = spark.createDataFrame([(w,) for w in listed], "token string")
            expected = [(k, [t for t in x if t not in listed], [t for t in y if t not in listed]) for k, x, y in rows]
            for limit in (0, 64 << 20):
                kept = without_words(saved, "k", ["x", "y"], words, replace(BASE, broadcast_bytes=limit), workspace)
                assert sorted(map(tuple, kept.collect())) == expected
