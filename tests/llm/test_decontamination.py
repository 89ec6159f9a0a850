import hashlib
import random
import re

import pytest

from quillrank.llm.decontamination import decontaminated, find_items, n_hit
from quillrank.llm.queries import LLM_QUERIES
from quillrank.sources.tables import read_table

DOCS = "doc_id long, text string, spans string, n_words int"
ITEMS = "item_id long, text string, longest int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain(docs, items, size=10):
    """doc_id -> (words, hit words, items)"""
    windows = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - size + 1)) if words else ():
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                owners = windows.get(tuple(words[i : i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        out.append((doc, len(words), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return sorted(out, key=repr)


def found(frame):
    rows = frame.select("doc_id", "n_words", n_hit().alias("n_hit"), "item_ids").collect()
    return sorted([(r[0], r[1], r[2], tuple(r[3])) for r in rows], key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_like_brute_force(spark, block_bytes):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("ab") + rng.choice(["", "C"]) + rng.choice([" ", ", ", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([2, 5, 12, 14]))) for i in range(12)]
    items += [(None, text(11)), (3, text(12)), (90, None), (91, ""), (92, "!!"), (93, "zulu"), (94, "ß é"), items[0]]
    docs = [(i, text(rng.choice([0, 1, 8, 30, 60]))) for i in range(40)]
    docs += [(None, "Zulu time"), (50, None), (51, ""), (52, "x ß, É é ß é"), (7, items[2][1]), (7, items[2][1])]
    docs += [(60, " ".join([items[2][1]] * 30) + " tail")]
    got = find_items(
        spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([(*i, 1) for i in items], ITEMS), block_bytes=block_bytes
    )
    assert found(got) == plain(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "", 1)], DOCS), spark.createDataFrame([(1, "a", 1)], ITEMS)
    assert found(find_items(docs, items.limit(0))) == [(1, 2, 0, ())]
    assert found(find_items(docs.limit(0), items)) == []


def test_removal(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, f"Fée, {item.upper()}; end of it " + "more " * 20), (2, item), (3, "clean\ttext "), (4, None), (5, "x " * 30 + item)]
    frame = find_items(spark.createDataFrame([(*d, "", 0) for d in docs], DOCS), spark.createDataFrame([(1, item, 1)], ITEMS))
    kept = dict(decontaminated(frame).collect())
    assert kept == {1: "Fée, end of it " + "more " * 20, 3: "clean\ttext ", 4: None, 5: "x " * 30}
    assert dict(decontaminated(frame, max_coverage=0.0).collect()) == {3: "clean\ttext ", 4: None}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (read_table(spark, folder, t) for t in ("documents", "benchmark"))
    expected = plain(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    rows = LLM_QUERIES["op8_benchmark_decontamination"](spark, folder).collect()
    digest = lambda names: hashlib.sha256(",".join(names).encode()).hexdigest()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows], key=repr) == [
        (d, n, h, len(i), digest(i), h > 0) for d, n, h, i in expected
    ]
    assert any(r.contaminated for r in rows)
