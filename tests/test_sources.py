import os

from wordloom.sources import delimited as D


def write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines))
    return path


def test_read_pipe2(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "a.txt"), ["1|hello world", "2|", "x|bad label", "3|a|b", "4.0| spaced"])
    df = D.read_label_text(spark, p)
    good = sorted((r["label"], r["text"]) for r in D.good(df).collect())
    assert good == [(1.0, "hello world"), (4.0, " spaced")]
    assert D.rejected(df).count() == 3
    ids = [r["id"] for r in df.collect()]
    assert len(set(ids)) == len(ids)


def test_read_pipe3_takes_third_part(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "b.txt"), ["1|id1|text|more", "2|id2", "2.0|id3|t"])
    rows = sorted(tuple(r) for r in D.good(D.read_label_id_text(spark, p)).select("id", "text", "label").collect())
    assert rows == [("id1", "text", 1.0), ("id3", "t", 2.0)]


def test_read_mixed_exclusive_and_overlap(spark, tmp_dir):
    lines = ["A; 7; some text", "B|other text", "C; 8; a|b", "bad line", "D; 9; x; y"]
    p = write(os.path.join(tmp_dir, "c.txt"), lines)
    ex = D.read_mixed(spark, p)
    got = sorted((r["raw_label"], r["text"], r["fmt"]) for r in D.good(ex).collect())
    assert got == [("A", "some text", "semi"), ("B", "other text", "pipe"), ("C", "a|b", "semi")]
    assert D.rejected(ex).count() == 2          # 'bad line' and the 4-part row
    ov = D.good(D.read_mixed(spark, p, overlap=True))
    assert ov.count() == 4                      # 'C; 8; a|b' is read twice, as the original does


def test_read_key_text_first_separator(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "d.txt"), ["k1;a;b", "k2;", "nokey"])
    rows = sorted(tuple(r) for r in D.good(D.read_key_text(spark, p)).collect())
    assert rows == [("k1", "a;b"), ("k2", "")]


def test_transactions_distinct_first_seen(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "e.txt"), ["  b a b c a  ", "x"])
    rows = [r["items"] for r in D.read_transactions(spark, p).orderBy("line_id").collect()]
    assert rows == [["b", "a", "c"], ["x"]]


def test_write_key_lines_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("k1", "a b"), ("k2", "")], "key string, clean string")
    out = os.path.join(tmp_dir, "out")
    D.write_key_lines(df, out)
    back = sorted(r["value"] for r in spark.read.text(out).collect())
    assert back == ["k1;a b", "k2;"]


def test_read_stopwords_keeps_lines_verbatim(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "stop.txt"), ["the", "ours\tourselves", "a"])
    got = sorted(r["word"] for r in D.read_stopwords(spark, p).collect())
    assert got == ["a", "ours\tourselves", "the"]
