"""Alignment, importance resampling and token files against brute force and the tokenizers' own libraries."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wordloom.llm import alignment, importance, token_store
from wordloom.session import scratch_path

DOCS = "doc_id long, text string, lang string, start long, n_tokens long, chunk string, pair string, bucket long, rest string"


def frame(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, None, 5, 6, "c", "p", 7, None) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, tied, repeated and very long texts, special tokens' strings and odd characters."""
    rng = random.Random(11)
    long = " ".join(rng.choice(["alpha", "beta", "gamma.", "Delta", "épsilon"]) + str(rng.randint(0, 999)) for _ in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, long), (8, "日本語 😀 ñandú İstanbul ὈΔΥΣΣΕΎΣ " * 20),
            (8, "日本語 😀 ñandú İstanbul ὈΔΥΣΣΕΎΣ " * 20), (9, "a<|endoftext|>b <|startoftext|> c"), (10, "x▁y  two  gaps"), (11, "é \x02 \x1c \x85 ﬁ K ²½"),
            (None, "no id here"), (12, "Don't stop, it's 12:30!'s we'LL'd"), (13, "W" * 30_000), (14, " " * 3000 + "x" + "\n" * 50), (-7, "one two three ")]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def naive_alignment(rows):
    """Every pair of tokens compared by byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    letters = {c: i for i, c in enumerate(alignment.byte_letters())}
    b_side = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    docs, links = [], collections.Counter()
    for doc_id, text in rows:
        found = {"doc_id": doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "links": [], "groups_sha256": ""}
        docs.append(found)
        if not text:
            continue
        a = [(i, bytes(letters[c] for c in a_side.id_to_token(i))) for i in a_side.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in b_side.encode(text):
            p = b_side.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()))
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
            continue
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
        i = j = 0
        while i < len(a) and j < len(b):  # both in step: each overlap once
            found["links"].append((a[i][0], b[j][0]))
            x, y = ends[0][i], ends[1][j]
            i, j = i + (x <= y), j + (y <= x)
        groups, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
            groups.append(",".join(str(t) for t, _ in a[i:x]) + "|" + ",".join(str(t) for t, _ in b[j:y]))
            i, j = x, y
        found |= {"n_a": len(a), "n_b": len(b), "n_groups": len(groups), "n_links": len(found["links"]), "groups_sha256": hashlib.sha256(";".join(groups).encode()).hexdigest()}
        links.update(found["links"])
    best = collections.Counter()
    for (_, y), n in links.items():
        best[y] = max(best[y], n)
    for d in docs:
        pairs = d.pop("links")
        d |= {"n_best": sum(links[p] == best[p[1]] for p in pairs), "count_sum": sum(links[p] for p in pairs)}
    return docs


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted(map(key, got)) == sorted(map(key, want))


def test_alignment_equals_brute_force(spark, small, odd, monkeypatch):
    files = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 20_000)
    monkeypatch.setattr(alignment, "RUN_BYTES", 30_000)
    for df in (small, odd):
        got = [r.asDict() for r in alignment.align(df, *files).collect()]
        want = naive_alignment(rows_of(df))
        names = sorted(want[0])
        assert same([[r[c] for c in names] for r in got], [[r[c] for c in names] for r in want])
    assert alignment.align(odd.limit(0), *files).count() == 0
    assert sum(r["n_links"] for r in got) > 0 and any(r["n_links"] == 0 for r in got)


def test_both_encoders_of_the_first_side_agree(small):
    bpe, rng = alignment.ByteBpe(P.path("byte_bpe_50k.json")), random.Random(3)
    texts = [" " + t for _, t in rows_of(small)]
    alphabet = [c for c in map(chr, range(9, 0x250)) if bpe.PLAIN.fullmatch(c)]
    texts += ["".join(rng.choices(alphabet, k=400)) for _ in range(100)] + ["".join(rng.choices("ab' \t\n.1é", k=300)) for _ in range(100)]
    for t in texts:
        if bpe.PLAIN.fullmatch(t):
            assert bpe.fast.encode_ordinary(t) == bpe.whole.encode(t, add_special_tokens=False).ids


def naive_resample(docs, target, longest, buckets, seed, least, percent):
    def buckets_of(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    s, t = collections.Counter(), collections.Counter()
    for _, x in docs:
        s.update(buckets_of(x)[1])
    for x in target:
        t.update(buckets_of(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    out = []
    for i, x in docs:
        n, which = buckets_of(x)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, which))
        out.append([i, n, len(which), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = k + 1
    return out


def test_resample_equals_brute_force(spark, small, odd):
    target = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    goal = [r["text"] for r in target.collect()]
    for df, args in ((small, (1, 10_000, 2024, 20, 10)), (small, (3, 700, 5, 40, 33)), (odd, (2, 50, 2024, 2, 50))):
        got = [list(r) for r in importance.resample(df, target, *args).select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]
        want = naive_resample(rows_of(df), goal, *args)
        if df is odd:  # rows that repeat an id share score and may swap ranks
            assert same([r[:5] for r in got], [r[:5] for r in want]) and sorted(r[5] or 0 for r in got) == sorted(r[5] or 0 for r in want)
        else:
            assert same(got, want)
    assert importance.resample(small.limit(0), target).count() == 0
    none = importance.resample(small, target.limit(0)).collect()
    assert len(none) == small.count()


def test_offsets_are_those_of_the_words():
    text = "Ünï-Ab 12 the\tEND"
    w = importance.Windows(1, 100).words(text.encode())
    assert [x for x, _ in w] == ["Ünï", "ab", "12", "the", "end"] and all(text[a:b].lower() == x.lower() for x, (a, b) in w)


def test_codes_give_any_token_back():
    rng = np.random.default_rng(4)
    for n in (0, 1, 63, 64, 512, 513, 5000):
        for top in (0, 1, 15, 16, 300, 49_407, 2 ** 32 - 1):
            ids = np.minimum(rng.integers(0, top + 1, n), rng.integers(0, top + 1, n)).astype(np.uint32)
            ends = np.sort(rng.integers(0, n + 1, 4))
            ends[-1] = n
            codes = token_store.Codes(token_store.write_codes(ids, [3, None, -1, 2 ** 62], ends), check=True)
            assert codes.doc_ids == [3, None, -1, 2 ** 62] and codes.n == n
            at = rng.integers(0, n, 200) if n else np.zeros(0, int)
            assert (codes.at(at) == ids[at]).all() and (codes.range(0, n) == ids).all()
            assert (codes.document(2) == ids[ends[1]:ends[2]]).all()
            for i, j in ((n // 3, n // 2), (n, n), (n // 7, n)):
                assert (codes.range(i, j) == ids[i:j]).all()
    with pytest.raises(IndexError):
        codes.at([n])
    data = bytearray(token_store.write_codes(ids, [1], np.array([n])))
    data[-9] ^= 1
    with pytest.raises(ValueError):
        token_store.Codes(bytes(data), check=True)


def test_widths_are_the_best():
    rng = np.random.default_rng(5)

    def cost(ids, widths):
        total, shift = 0, 0
        for k, w in enumerate(widths):
            there = len(ids) if not shift else int((ids >> np.uint32(shift) != 0).sum())
            total, shift = total + there * (w + (k + 1 < len(widths))), shift + w
        return total

    splits = lambda n: [[n]] + [[4 * k, *rest] for k in range(1, n // 4) for rest in splits(n - 4 * k)]
    for top in (200, 5000, 49_000):
        ids = (rng.pareto(0.7, 2000) * 20).clip(0, top).astype(np.uint32)
        bits = -(-int(ids.max()).bit_length() // 4) * 4
        assert cost(ids, token_store.best_widths(ids)) == min(cost(ids, w) for w in splits(bits))


def test_files_equal_the_library(spark, small, odd, monkeypatch):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for df, tokens in ((small, 50_000), (odd, 1000)):
        folder = scratch_path(spark, "token-test")
        token_store.write(df, P.path("word_bpe_49k.json"), folder, file_tokens=tokens)
        token_store.put(f"{folder}/ids", "000000-000000-lost.dac", b"of a task that failed")
        got = [tuple(r) for r in token_store.documents(token_store.read(spark, folder)).collect()]
        rows, at, want = [(i is not None, i or 0, whole.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows_of(df)], 0, []
        for known, i, ids in sorted(rows):
            want.append((i if known else None, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        assert same(got, want)
        assert spark.read.parquet(f"{folder}/index").agg(F.sum("tokens")).first()[0] == at
    folder = scratch_path(spark, "token-test")
    token_store.write(odd.limit(0), P.path("word_bpe_49k.json"), folder)
    assert token_store.documents(token_store.read(spark, folder)).count() == 0


def test_word_ids_equal_the_library_on_random_text(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_store, "CACHE_PIECES", 300)
    whole, words, rng = Tokenizer.from_file(P.path("word_bpe_49k.json")), token_store.PieceIds(P.path("word_bpe_49k.json")), random.Random(6)
    for alphabet in ("abAB '.,!s1 \t\n", "aA éÉßÿŸŉǅǆ×'s1.ªºŁ", [chr(c) for c in range(1, 0x250)], "aé'́İßΣσς  日\x02|<>"):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 120))) for _ in range(150)] + [None, ""]
        ids, sizes = words.encode(pa.array(texts))
        for t, x in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
            assert x.tolist() == whole.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_ascii_pieces_are_spelt_as_they_are():
    """The alphabet of bytes maps printable ASCII to itself, so only other pieces are translated."""
    pieces = token_store.PieceIds(P.path("word_bpe_49k.json"))
    marks = "".join(map(chr, range(33, 127)))
    assert marks.translate(pieces.alphabet) == marks
    want = pieces.whole.encode("hello 7 ... z}", add_special_tokens=False).ids
    pieces.alphabet = None
    some = ["hello", "7", "...", "z", "}"]
    pieces.learn(some)
    assert [i for p in some for i in memoryview(pieces[p]).cast("I")] == want


def test_known_pieces_of_a_slice_are_not_learned_again(monkeypatch):
    """A full cache forgets what the slice at hand does not have, and no more."""
    import pyarrow as pa

    monkeypatch.setattr(token_store, "CACHE_PIECES", 5)
    pieces, learned = token_store.PieceIds(P.path("word_bpe_49k.json")), []
    learn = pieces.learn
    monkeypatch.setattr(pieces, "learn", lambda some: (learned.append(sorted(some)), learn(some)))
    for text in ("one two three four", "two four five six", "two four five six"):
        ids, _ = pieces.encode(pa.array([text, None]))
        assert ids.tolist() == pieces.whole.encode(text, add_special_tokens=False).ids
    assert learned == [["four", "one", "three", "two"], ["five", "six"]]
    assert sorted(pieces) == ["five", "four", "six", "two"]
