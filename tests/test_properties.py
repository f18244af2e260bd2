"""Property tests: the Java-semantics text expressions against plain statements of the rules."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.functions import text as T

ALPHABET = st.sampled_from(list("ab -|;\t\n\x01.#Aé_9") + ["; ", "--"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=1, max_size=60)


def py_java_split(s: str, sep: str) -> list[str]:
    """String.split(quote(sep)): '' -> [''], trailing empty parts dropped."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def py_words_only(s: str) -> str:
    toks = [t.strip("".join(chr(i) for i in range(33))).lower() for t in s.split(" ")]
    toks = [re.sub(r"[^A-Za-z0-9_]", "", t) for t in toks if t]
    return " ".join(toks)


def run(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r["r"] for r in df.select("i", expr(F.col("s")).alias("r")).orderBy("i").collect()]


@settings(max_examples=15, deadline=None, derandomize=True)
@given(TEXTS)
def test_java_split_property(spark, texts):
    for sep in (" ", "|", "; "):
        got = run(spark, texts, lambda c: T.java_split(c, sep))
        assert got == [py_java_split(t, sep) for t in texts]


@settings(max_examples=15, deadline=None, derandomize=True)
@given(TEXTS)
def test_words_only_property(spark, texts):
    got = run(spark, texts, T.words_only)
    assert got == [py_words_only(t) for t in texts]


CLEAN_ALPHABET = st.sampled_from(["The", "the", "cats", "was", "#tag", "abc123", "ÉTÉ", "año", "x", "ab", " ", " ",
                                  ",", ".", "-", "don't", "\t", "\n", "über", "naïve", "is", "a1b"])
CLEAN_TEXTS = st.lists(st.lists(CLEAN_ALPHABET, max_size=15).map("".join), min_size=1, max_size=40)


def py_clean_text(s: str, lemmas: dict[str, str]) -> str:
    import regex
    from wordloom.constants import STOPWORDS
    toks = regex.findall(r"[^\t\n\x0B\f\r \p{P}\p{S}]+", s.replace("#", ""))
    toks = [lemmas.get(t.lower(), t) for t in toks]
    keep = [t for t in toks if len(t) > 2 and t not in STOPWORDS and regex.fullmatch(r"\p{L}+", t)]
    return " ".join(t.lower() for t in keep)


@settings(max_examples=10, deadline=None, derandomize=True)
@given(CLEAN_TEXTS)
def test_clean_text_property(spark, texts):
    lemmas = {"cats": "cat", "was": "be", "is": "be"}
    got = run(spark, texts, lambda c: T.clean_text(c, lemmas))
    assert got == [py_clean_text(t, lemmas) for t in texts]


LINE_ALPHABET = st.sampled_from(["1", "2.5", "x", "|", "; ", ";", " ", "ab", "\t", "-", "7"])
LINES = st.lists(st.lists(LINE_ALPHABET, max_size=10).map("".join), min_size=1, max_size=40)


def _num(s):
    try:
        return float(s.strip()) if s.strip() not in ("", "nan", "inf") else None
    except ValueError:
        return None


@settings(max_examples=10, deadline=None, derandomize=True)
@given(LINES)
def test_delimited_parsers_property(spark, lines):
    from wordloom.sources import delimited as D
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "line_id int, line string")
    # Exactly two parts and a numeric label
    got = {r["id"]: (r["text"], r["label"]) for r in D.good(D.parse_label_text(df)).collect()}
    want = {}
    for i, t in enumerate(lines):
        p = py_java_split(t, "|")
        if len(p) == 2 and _num(p[0]) is not None:
            want[str(i)] = (p[1], _num(p[0]))
    assert got == want
    # S3: '; ' three parts first, else '|' two parts
    got3 = sorted((r["id"], r["raw_label"], r["text"], r["fmt"]) for r in D.good(D.parse_mixed(df)).collect())
    want3 = []
    for i, t in enumerate(lines):
        a, b = py_java_split(t, "; "), py_java_split(t, "|")
        if len(a) == 3:
            want3.append((a[1], a[0], a[2], "semi"))
        elif len(b) == 2:
            want3.append((str(i), b[0], b[1], "pipe"))
    assert got3 == sorted(want3)
    # Split at the first ';'
    got4 = sorted((r["key"], r["text"]) for r in D.good(D.parse_key_text(df)).collect())
    assert got4 == sorted(tuple(t.split(";", 1)) for t in lines if ";" in t)
    # Trim, split on ' ', distinct keeping first-seen order
    got5 = [r["items"] for r in df.orderBy("line_id").select(D.parse_transaction("line").alias("items")).collect()]
    want5 = [list(dict.fromkeys(py_java_split(t.strip("".join(chr(c) for c in range(33))), " "))) for t in lines]
    assert got5 == want5
