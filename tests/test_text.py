import random

import pytest
from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.functions import text as T


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"s {typ}")
    return df.select(expr(F.col("s")).alias("r")).first()["r"]


@pytest.mark.parametrize("s,expected", [
    ("", [""]), ("   ", []), ("a b  ", ["a", "b"]), (" a", ["", "a"]), ("a  b", ["a", "", "b"]), ("a", ["a"]),
])
def test_java_split_space(spark, s, expected):
    assert one(spark, T.java_split, s) == expected


@pytest.mark.parametrize("s,sep,expected", [
    ("a|", "|", ["a"]), ("a|b|", "|", ["a", "b"]), ("|a", "|", ["", "a"]), ("x; y; z", "; ", ["x", "y", "z"]),
    ("x; y; ", "; ", ["x", "y"]), ("a.b", ".", ["a", "b"]),
])
def test_java_split_other(spark, s, sep, expected):
    assert one(spark, lambda c: T.java_split(c, sep), s) == expected


def test_java_trim(spark):
    assert one(spark, T.java_trim, "\t\x01 a b \n\x0b") == "a b"


@pytest.mark.parametrize("s,expected", [
    ("a -- b", "a  b"), ("Câmera", "cmera"), ("", ""), ("Hello, World!", "hello world"),
    ("a\tb", "ab"), ("  x   y ", "x y"), ("\n", ""), ("-- a", " a"), ("a --", "a "),
])
def test_words_only(spark, s, expected):
    assert one(spark, T.words_only, s) == expected


@pytest.mark.parametrize("s,expected", [
    ("<a href=x>y</a><b>z</b>", "<a href=x>y</a>z"), ("<abbr>x</abbr>", "x"), ("<>", ""), ("<a>k</a>", "<a>k</a>"),
    ("<a\thref=1>", "<a\thref=1>"), ("<b\n>", "<b\n>"), ("a < b > c", "a  c"), ("<//x>", ""), ("</>", ""),
    ("<a <b>", "<a "), ("<ab>", ""), ("<p>1</p><a>2", "1<a>2"),
])
def test_strip_markup(spark, s, expected):
    assert one(spark, T.strip_markup, s) == expected
    assert one(spark, lambda c: T.strip_markup(c, java_pattern=True), s) == expected


def test_strip_markup_rewrite_equals_fixed_pattern(spark):
    rnd = random.Random(7)
    alphabet = ["<", ">", "/", "a", "b", " ", "\t", "\n", "\r", "x", "=", " ", "\x0b"]
    rows = [("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 24))),) for _ in range(5000)]
    df = spark.createDataFrame(rows, "s string")
    diff = df.where(T.strip_markup("s") != T.strip_markup("s", java_pattern=True)).count()
    assert diff == 0


def test_clean_text_rules(spark):
    # stopwords are tested before lower-casing; lemma 'be' is too short; digits and symbols drop
    got = one(spark, lambda c: T.clean_text(c, {"was": "be", "cats": "cat"}), "The cats was #happy abc123 the to")
    assert got == "the cat happy"


def test_stopword_list_fixed_values():
    assert len(K.STOPWORDS) == 173
    assert "ours\tourselves" in K.STOPWORDS and "ours" not in K.STOPWORDS


def test_keyword_flags(spark):
    df = spark.createDataFrame([("hurricane weather",), ("nothing",)], "s string")
    rows = df.select(*T.keyword_flags("s")).collect()
    assert [tuple(r) for r in rows] == [(0.0, 1.0, 1.0), (0.0, 0.0, 0.0)]


def test_words_only_forms_agree(spark):
    rnd = random.Random(5)
    alpha = ["a", "B", " ", " ", "\t", "\n", "-", "\u00e9", "x", "\x01", ".", "_", "1", "\u212a", "\u00a0"]
    rows = [("".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 30))),) for _ in range(5000)]
    df = spark.createDataFrame(rows, "s string")
    assert df.where(T.words_only("s") != T.words_only_split("s")).count() == 0
