"""Every stage against a plain version, on what the stage before has kept."""

import pytest

import corpus_pipeline
from quillrank import Workspace
from quillrank.llm.quality import THRESHOLD, scored, train
from quillrank.sources.tables import read_table
from tests.llm import plain
from tests.llm.test_decontamination import plain as contaminated

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    with Workspace(spark) as workspace:
        frames = [read_table(spark, FOLDER, "documents")]
        for name, stage in corpus_pipeline.STAGES:
            frames.append(workspace.save(stage(spark, frames[-1], FOLDER), name))
        yield frames


def texts(frame):
    return [tuple(r) for r in frame.select("doc_id", "text").collect()]


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "hilbert_sharding"
    ]


def test_quality(spark, steps):
    with Workspace(spark) as workspace:
        model = train(steps[0], read_table(spark, FOLDER, "labels"), workspace)
    good = {r["doc_id"] for r in scored(steps[0], model).where(f"score >= {THRESHOLD}").collect()}
    assert sorted(r for r in texts(steps[0]) if r[0] in good) == sorted(texts(steps[1]))
    bad = {r["doc_id"] for r in read_table(spark, FOLDER, "labels").where("quality = 0").collect()}
    assert len(bad & good) <= 2


def test_near_duplicates(steps):
    firsts = {c for _, _, c in plain.near_duplicates(texts(steps[1]))}
    assert sorted(texts(steps[2])) == sorted(r for r in texts(steps[1]) if r[0] in firsts)


def test_decontamination(spark, steps):
    items = [tuple(r) for r in read_table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    clean = {d for d, _, hit, _ in contaminated(texts(steps[2]), items) if not hit}
    assert sorted(texts(steps[3])) == sorted(r for r in texts(steps[2]) if r[0] in clean)
    assert 0 < len(clean) < steps[2].count()


def test_mix(steps):
    whole = {d: plain.words(t) for d, t in texts(steps[3])}
    size, taken, sources = {}, {}, {r["doc_id"]: r["source"] for r in steps[3].collect()}
    for d, words in whole.items():
        size[sources[d]] = size.get(sources[d], 0) + len(words)
    rows = steps[4].collect()
    for r in rows:
        words = plain.words(r["text"])
        taken[r["source"]] = taken.get(r["source"], 0) + len(words)
        assert r["source"] == sources[r["doc_id"]] and r["n_chars"] == len(r["text"])
        assert len(words) <= len(whole[r["doc_id"]]) and set(words) <= set(whole[r["doc_id"]])
    assert max(sum(x["doc_id"] == d for x in rows) for d in whole) <= 2
    for source, target in plain.targets(size).items():
        assert abs(taken.get(source, 0) - target) <= max(128, 0.02 * target)
    assert steps[4].columns == steps[0].columns == steps[3].columns


def test_shards(steps):
    rows = steps[5].collect()
    assert sorted(texts(steps[4])) == sorted((r["doc_id"], r["text"]) for r in rows)
    counts = [sum(r["shard"] == s for r in rows) for s in range(24)]
    assert max(counts) - min(counts) <= 1


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "some words here", None, None, 15), (2, "some words here", None, None, 15)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, shard int, size string")
    with Workspace(spark) as workspace:
        for frame in (docs, docs.limit(0)):
            for name, stage in corpus_pipeline.STAGES:
                frame = workspace.save(stage(spark, frame, FOLDER), name)
            assert {"doc_id", "shard", "slot"} <= set(frame.columns) and frame.count() <= 4
