import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from quillrank.llm.queries import LLM_QUERIES
from quillrank.llm.secrets import CHANCE, KINDS, LETTERS, RUN, log_ratios, redacted, scan, with_base_spans
from quillrank.sources.tables import read_table
from tests.llm import plain

SCHEMA = "doc_id long, text string, base string, runs int, spans string"


def found(spark, docs):
    return with_base_spans(spark.createDataFrame([(*d, "x", 1, None) for d in docs], SCHEMA))


def spans(row, column):
    return [(s["start"], s["kind"], s["end"]) for s in row[column]]


def corpus():
    rng = random.Random(2)
    bits = ["token", "Secret", "API_KEY", "apikey", "passwd", "password", "=", ":", " = ", '"', "'", " ", "\n", "AKIA", "é𝒳", "abcdef", "0a1b2c", "Z9", "ſecret", "."]
    docs = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(60)))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "AKIA" + "A" * 15), (503, "AKIA" + "A" * 16 + "AKIA" + "B" * 30), (504, "f" * 23), (505, "f" * 24)]
    docs += [(506, "token: token = abcdef"), (507, "x token=abcdef " * 3000), docs[0], docs[0], (None, "secret=hunter22")]
    return docs


def test_base_spans(spark):
    docs = corpus()
    rows = found(spark, docs).collect()
    got = sorted([(r["doc_id"], spans(r, "base")) for r in rows], key=repr)
    assert got == sorted([(d, plain.secrets(t)) for d, t in docs], key=repr)
    assert any(len(s) > 1000 for _, s in got)


def test_added_spans(spark):
    rng = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda: "".join(rng.choice(letters) for _ in range(32))
    syllables = ["tion", "ing", "the", "er", "re", "con", "al", "ness"]
    case = lambda word: rng.choice([word, word, word.title(), word.upper()])
    name = lambda: case("".join(rng.choice(syllables) for _ in range(6))) + rng.choice(["", "_12", "7"])
    docs = [(i, f"some text token={key()} and {name()} or {name()}_{name()} 4111111111111111") for i in range(200)]
    hidden = [(1000 + i, f"the é{key()}, {name()}") for i in range(50)]
    frame = found(spark, docs + hidden)
    rows = {r["doc_id"]: r for r in scan(frame, log_ratios(frame)).collect()}
    added = {i: [s for s in spans(r, "spans") if s[1] == KINDS.index("random")] for i, r in rows.items()}
    assert not any(added[i] for i, _ in docs)
    assert sum(added[i] == [(5, KINDS.index("random"), 37)] for i, _ in hidden) >= 40
    assert all(spans(r, "spans")[: len(r["base"])] == spans(r, "base") for i, r in rows.items() if i < 1000)


def test_runs_beside_base_spans(spark):
    key = "Zq8Xw2Lk9Vb4Nm7Tp1Rs"
    docs = [(1, f"é {key}/token=abcdef"), (2, "0" * 24 + key), (3, f"{key}/token={'a' * 30}"), (4, f"{key} token=abcdef")]
    runs = {r["doc_id"]: [(s["start"], s["end"], s["value"]) for s in r["runs"]] for r in found(spark, docs).collect()}
    assert runs == {1: [(2, 23, key + "/")], 2: [(24, 44, key)], 3: [(0, 21, key + "/")], 4: [(0, 20, key)]}


def test_keys_among_words(spark):
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda n, of=letters: "".join(rng.choice(of) for _ in range(n))
    syllables = ["tion", "ing", "the", "er", "re", "con", "al", "ness"]
    name = lambda n=6: "".join(rng.choice(syllables) for _ in range(n))
    case = lambda word: rng.choice([word, word.upper()])
    docs = [(i, f"text token={key(32)} " + " ".join(case(f"{name(3)}/{name(3)}") for _ in range(40))) for i in range(200)]
    keys = {1000 + i: key(24) for i in range(40)}
    paths = {i: "/".join([*(name(2) for _ in range(60)), k, *(name(2) for _ in range(30)), k[::-1], name(2)]) for i, k in keys.items()}
    bare = [(2000 + i, f"the {key(20, letters[:26] + letters[52:])} key") for i in range(40)]
    frame = found(spark, docs + list(paths.items()) + bare)
    ratios = log_ratios(frame)
    rows = {r["doc_id"]: r for r in scan(frame, ratios).collect()}
    added = {i: [s for s in spans(r, "spans") if s[1] == KINDS.index("random")] for i, r in rows.items()}
    assert not any(added[i] for i, _ in docs)
    assert sum({paths[i][a:b] for a, _, b in added[i]} == {k, k[::-1]} for i, k in keys.items()) >= 38
    assert sum(added[i] == [(4, KINDS.index("random"), 24)] for i, _ in bare) >= 38


def plain_stretches(value, ratios):
    """Spans in ``value``, walked over character by character."""
    limit, found = math.log(len(value) / CHANCE), []
    gains = [ratios[LETTERS.index(a) * len(LETTERS) + LETTERS.index(b)] for a, b in zip(value, value[1:])]
    start = 0
    while start < len(gains):
        total = peak = 0.0
        last = at = start
        while at < len(gains):
            total += gains[at]
            if total > peak:
                peak, last = total, at + 2
            if total <= 0 or peak - total >= limit:
                break
            at += 1
        if peak >= limit:
            inside = value[start:last]
            first = start + len(inside) - len(inside.lstrip("/_=-"))
            end = start + len(inside.rstrip("/_-"))
            low = first - len(re.search("[A-Za-z0-9+]*$", value[:first])[0])
            high = end + len(re.match("[A-Za-z0-9+]*=*", value[end:])[0])
            if high - low >= RUN and re.search("[A-Za-z]", value[low:high]) and (low, high) not in found:
                found.append((low, high))
        start = at + 1
    return found


WORDS = "user account service request handler manager config update status value index table batch window cluster reader".split()


def identifiers(rng, n):
    """Ordinary names of the usual kinds, of two to eight words."""
    join = [
        "_".join, "/".join, "-".join, lambda w: "_".join(w).upper(), lambda w: w[0] + "".join(x.title() for x in w[1:]),
        lambda w: "/".join(w) + "/2024-11-03", lambda w: "".join(w) + "_12",
    ]
    return [rng.choice(join)([rng.choice(WORDS) for _ in range(rng.randint(2, 8))]) for _ in range(n)]


def test_spans_against_plain_version_and_by_share(spark):
    """Every added span; most keys are cut out of paths exactly, and few ordinary names are reported. A text has the same
    spans alone as among others."""
    rng = random.Random(6)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda n: "".join(rng.choice(letters) for _ in range(n))
    train = [(i, f"token={key(32)} " + " ".join(identifiers(rng, 20))) for i in range(150)]
    keys = {1000 + i: key(24) for i in range(200)}
    paths = {i: "/".join([*rng.choices(WORDS, k=(1, 2, 4, 6, 10)[i % 5]), k]) for i, k in keys.items()}
    names = {5000 + i: name for i, name in enumerate(identifiers(rng, 500))}
    frame = found(spark, train)
    ratios = log_ratios(frame)
    asked = found(spark, [*paths.items(), *names.items()])
    got = {r["doc_id"]: [(a, b) for a, k, b in spans(r, "spans") if k == KINDS.index("random")] for r in scan(asked, ratios).collect()}
    expected = {i: plain_stretches(t, ratios) if len(t) >= RUN else [] for i, t in {**paths, **names}.items()}
    based = {i for i, t in {**paths, **names}.items() if plain.secrets(t)}
    assert {i: s for i, s in got.items() if i not in based} == {i: s for i, s in expected.items() if i not in based} and len(based) < 5
    assert sum([paths[i][a:b] for a, b in got[i]] == [k] for i, k in keys.items()) >= 0.9 * len(keys)
    assert sum(bool(got[i]) for i in names) <= 0.02 * len(names)
    alone = scan(found(spark, [(1000, paths[1000])]), ratios).first()
    assert [(a, b) for a, _, b in spans(alone, "spans")] == got[1000]


def test_without_samples(spark):
    frame = found(spark, [(1, "nothing of that kind, internationalization"), (2, None)])
    assert log_ratios(frame) is None and [r["spans"] for r in scan(frame, None).collect()] == [[], []]
    assert log_ratios(found(spark, [])) is None


def test_redacted(spark):
    frame = spark.createDataFrame([(1, "é token=abcdef0123 x")], "doc_id long, text string")
    kept = frame.join(with_base_spans(frame), "doc_id").select(redacted(F.col("text"), F.col("base")).alias("t"))
    assert kept.first()["t"] == "é * x"


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = dict(read_table(spark, folder, "documents").select("doc_id", "text").collect())
    for row in LLM_QUERIES["op3_secret_scans"](spark, folder).collect():
        base = plain.secrets(texts[row["doc_id"]])
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(k == x for _, k, _ in base) for x in range(3)]
        listed = ",".join(f"{plain.PATTERNS[k][0]}:{a}:{b}" for a, k, b in base)
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(row["spans"].split(","))
