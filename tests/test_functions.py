import math
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from quillrank.functions.porter import stem
from quillrank.functions.stopwords import ENGLISH
from quillrank.functions.text import TokenRules, remove_stopwords, tokenize
from quillrank.functions.titles import edits, title_distance, titles_alike
from quillrank.functions.weighting import dph
from tests import plain


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, []),
        ("", []),
        (" -- ", []),
        ("Don't PANIC, 42 times!", ["don", "t", "panic", "42", "times"]),
        ("naïve café", ["na", "ve", "caf"]),
        ("300 K and İstanbul", ["300", "and", "stanbul"]),
        ("<p>a_b</p>", ["p", "a", "b", "p"]),
    ],
)
def test_tokenize(spark, text, expected):
    assert one(spark, tokenize(F.lit(text).cast("string"))) == expected


def test_token_rules(spark):
    rules = TokenRules(max_length=5, max_digits=2, max_repeats=3)
    text = F.lit("short longer 12 123 1a2b3 aaa aaaa 111")
    assert one(spark, tokenize(text, rules)) == ["short", "12", "aaa"]


def test_stopwords(spark):
    assert list(ENGLISH) == sorted(w for w in StopWordsRemover.loadDefaultStopWords("english") if "'" not in w)
    text = F.lit("The bond and THE girl")
    assert one(spark, tokenize(text, stopwords=ENGLISH)) == ["bond", "girl"]
    assert one(spark, remove_stopwords(tokenize(text), ENGLISH)) == ["bond", "girl"]
    assert one(spark, remove_stopwords(tokenize(text), ())) == ["the", "bond", "and", "the", "girl"]


# Examples of the published description, step by step.
STEMS = """
caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall
hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit
rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic
differentli differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper
feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr
hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend
adoption adopt homologou homolog communism commun activate activ angulariti angular homologous homolog
effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
generalizations gener oscillators oscil is is by by yoga yoga
""".split()


def stems(spark, words):
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", stem("w").alias("s")).collect()
    return {r["w"]: r["s"] for r in rows}


def test_porter(spark):
    assert stems(spark, STEMS[::2]) == dict(zip(STEMS[::2], STEMS[1::2]))


def test_porter_takes_any_token_and_repeats(spark):
    odd = {"": "", "a": "a", "12": "12", "1990s": "1990", "x" * 500: "x" * 500, "universities": "univers", "univers": "univ", None: None}
    assert stems(spark, odd) == odd
    same = ("financ", "jame", "bond", "facebook", "ipo")
    assert stems(spark, same) == {w: w for w in same}


def test_porter_like_the_plain_version(spark):
    rng = random.Random(7)
    endings = ["", "s", "es", "ies", "ed", "ing", "eed", "y", "ying", "yyed", "ational", "izer", "fulness", "ement", "e", "ll", "sion", "iviti"]
    words = {"".join(rng.choices("aeiouyyybcdlstxzw09", k=rng.randint(0, 6))) + rng.choice(endings) for _ in range(20000)}
    assert stems(spark, words) == {w: plain.porter_stem(w) for w in words}


TITLES = [
    ("same", "same", True),
    ("", "", False),
    ("", "a", False),
    (None, "a", False),
    (None, None, False),
    ("abcd", "abxy", False),  # exactly 0.5
    ("abc", "abx", True),
    ("ab", "abcd", False),  # lengths alone give 0.5
    ("abc", "abcde", True),
    ("für", "fur", True),
    ("France loses AAA credit rating", "France loses its AAA credit rating", True),
]


def test_titles(spark):
    frame = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(TITLES)], "i int, a string, b string")
    rows = frame.select("i", titles_alike(F.col("a"), F.col("b"), 0.5)).collect()
    assert {r[0]: r[1] for r in rows} == {i: expected for i, (_, _, expected) in enumerate(TITLES)}
    assert one(spark, title_distance(F.lit("kitten"), F.lit("sitting"))) == pytest.approx(3 / 7)
    assert one(spark, title_distance(F.lit(""), F.lit(""))) is None


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.tuples(st.text("abé", max_size=8), st.text("abé", max_size=8)), min_size=1, max_size=40),
    st.sampled_from([0.0, 0.25, 0.3, 0.5, 1.0, 1.5]),
)
def test_titles_random(spark, pairs, limit):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    rows = frame.select("i", titles_alike(F.col("a"), F.col("b"), limit)).collect()
    assert {r[0]: r[1] for r in rows} == {i: plain.alike(a, b, limit) for i, (a, b) in enumerate(pairs)}


def score(spark, tf, cf, length, average, n, ratio="real"):
    return one(spark, dph(*[F.lit(v) for v in (tf, cf, length, average, n)], ratio))


def test_dph_by_hand(spark):
    # tf 2, cf 4, length 10, average 20, 16 documents: f = 0.2, norm = 0.64 / 3
    expected = 0.64 / 3 * (2 * math.log2(2 * 20 / 10 * 4) + 0.5 * math.log2(2 * math.pi * 2 * 0.8))
    assert score(spark, 2, 4, 10, 20.0, 16) == pytest.approx(expected, rel=1e-12)
    assert score(spark, 2, 5, 10, 20.0, 16, "integer") == pytest.approx(
        0.64 / 3 * (2 * math.log2(4 * 3) + 0.5 * math.log2(2 * math.pi * 2 * 0.8)), rel=1e-12
    )


def test_dph_limits(spark):
    assert score(spark, 3, 3, 3, 5.0, 10) == 0.0
    assert score(spark, 1, 100, 10, 10.0, 10) < 0
    assert score(spark, 1, 20, 10, 10.0, 10, "integer") == float("-inf")
    assert score(spark, 3, 20, 3, 10.0, 10, "integer") == 0.0


def test_edit_distances_of_many_texts_at_once(spark):
    """Texts side by side do not disturb each other, and a column gives what Spark's own function does."""
    rng = random.Random(7)
    rows = []
    for n in range(60):
        letters = "ab" if n % 2 else "aß中\U0001f600. \0"
        text = None if n == 9 else "".join(rng.choices(letters, k=rng.randrange(50)))
        rows += [(text, "".join(rng.choices(letters, k=rng.randrange(80)))) for _ in range(rng.randrange(6))]
        rows += [(text, other) for other in (text, "", None)]
    assert edits("kitten", ["sitting", "", "kitten", "mitten"]) == [3, 6, 0, 1] and edits("", ["ab", ""]) == [2, 0]
    longer = F.greatest(F.char_length("a"), F.char_length("b"))
    both = spark.createDataFrame(rows, "a string, b string").select(
        title_distance(F.col("a"), F.col("b")).alias("got"), F.try_divide(F.levenshtein("a", "b"), longer).alias("want")
    )
    assert len(rows) > 200 and all(row["got"] == row["want"] for row in both.collect())
