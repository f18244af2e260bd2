"""Documents drawn to look like a target: importance resampling on hashed word features.

**Words.** ASCII letters are lowered; the words are the matches of ``WORD`` in the whole text. An untrained Regex Split of
the tokenizers library cuts them out, with their offsets. Features are the windows of one to ``LONGEST`` words (pairs of
offsets that follow one another), the words joined by one space; a feature's bucket is the CRC-32 of its UTF-8 bytes
modulo ``BUCKETS``.

**Gains.** The source (all documents) and the target have a histogram of buckets each. A bucket's gain is
floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))), with s and t the features in it, S and T all features and B buckets. A document's
weight is the sum of the gains of its features.

**Draw.** Each weight gets Gumbel noise from a hash of the seed and the id, so the highest scores are a sample without
replacement in proportion to exp(weight / 1000). Of the N documents of ``LEAST_WORDS`` words or more, the floor(``PERCENT`` N / 100)
highest are drawn; ties go to the smaller id.

Texts are read once: each document's buckets and counts are written to the shared folder, the histogram is summed from
them, with one partial histogram a task, and only the gains (one number a bucket) reach the driver and the tasks.
Ranks come from a range partitioning by score.

Null, empty and wordless texts have no features and weight 0, and are never drawn. A null id hashes as the empty string and
comes after others in ties. Rows that repeat an id are documents of their own, with the same noise. With an empty target
the gains come from the source alone; with no documents the result is empty. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.base import map_slices, register, table, utf8
from wordloom.operators.labels import global_row_number
from wordloom.session import scratch_path

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Words whose CRC a worker remembers before it starts afresh.
CACHE_WORDS = 500_000


class Crc(dict):
    """word -> CRC-32 of its UTF-8 bytes."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        c = self[word] = zlib.crc32(word.encode())
        return c


class Windows:
    """Cuts words out of texts and hashes their windows."""

    def __init__(self, longest: int, buckets: int):
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True).pre_tokenize_str
        self.longest, self.buckets, self.crc = longest, buckets, Crc()

    def words(self, data: bytes) -> list[tuple[str, tuple[int, int]]]:
        """(word, its offsets in characters) for each word of a UTF-8 text; ``lower`` of bytes lowers A to Z alone."""
        return self.split(data.lower().decode()) if data else []

    def hashes(self, words: list[tuple[str, tuple[int, int]]]) -> np.ndarray:
        """The buckets of all windows: of one word, then of two, and so on. The CRC of a longer window goes on from that
        of its beginning."""
        ones = np.fromiter(map(self.crc.__getitem__, (w for w, _ in words)), np.int64, len(words))
        out, last = [ones], ones.tolist()
        for n in range(2, self.longest + 1):
            last = [zlib.crc32(b" " + w.encode(), c) for (w, _), c in zip(words[n - 1:], last, strict=False)]
            out.append(np.array(last, np.int64))
        return np.concatenate(out) % self.buckets


FEATURES = "doc_id long, n_words long, n_features long, buckets binary, counts binary"


def features(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """Each document's distinct buckets and how many of its features fall in each, as 32-bit integers."""

    def setup():
        windows = Windows(longest, buckets)

        def rows(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in ("n_words", "n_features", "buckets", "counts")}
            for data in utf8(batch.column("text")):
                words = windows.words(data)
                which = windows.hashes(words)
                kinds, n = np.unique(which, return_counts=True)
                for c, v in zip(out, (len(words), len(which), kinds.astype("<u4").tobytes(), n.astype("<u4").tobytes()), strict=True):
                    out[c].append(v)
            return {"doc_id": batch.column("doc_id"), **out}
        return rows

    return map_slices(docs.select("doc_id", "text"), setup, FEATURES)


def joined(column: pa.Array) -> np.ndarray:
    """The 32-bit integers of all rows in a row."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u4")


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, of all documents."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(joined(batch.column("buckets")), joined(batch.column("counts")), buckets).astype(np.int64)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    sums = found.select("buckets", "counts").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)  # a row for each bucket at most
    for bucket, n in sums:
        out[bucket] = n
    return out


@dataclass
class Gains:
    """The gain of each bucket, and the windows they are for."""

    gains: list[int]
    longest: int = LONGEST


def fit(source: np.ndarray, target: np.ndarray, longest: int = LONGEST) -> Gains:
    s, t, n = source.tolist(), target.tolist(), len(source)
    all_s, all_t = sum(s), sum(t)
    return Gains([math.floor(1000 * math.log((b + 1) * (all_s + n) / ((a + 1) * (all_t + n)))) for a, b in zip(s, t, strict=True)], longest)


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise of an id, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(found: DataFrame, model: Gains, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of documents given by :func:`features`."""

    def setup():
        gains = np.array(model.gains, np.int64)

        def rows(batch: pa.RecordBatch) -> dict:
            ids, kinds = batch.column("doc_id").to_pylist(), batch.column("buckets").to_pylist()
            sizes = np.array([len(x) // 4 for x in kinds])
            worth = gains[joined(batch.column("buckets"))] * joined(batch.column("counts"))
            upto = np.concatenate(([0], np.cumsum(worth)))
            end = np.cumsum(sizes)
            weight = upto[end] - upto[end - sizes]
            return {"doc_id": ids, "n_words": batch.column("n_words"), "n_features": batch.column("n_features"), "weight": weight,
                    "score": weight + np.array([noise(seed, i) for i in ids], np.int64)}
        return rows

    return map_slices(found, setup, "doc_id long, n_words long, n_features long, weight long, score long")


def draw(rows: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``rows`` of :func:`scored` with rank: 1, 2, 3 ... for the drawn ones, from the highest score; null for others."""
    able = F.col("n_words") >= least_words
    rows = rows.withColumn("_last", (~able).cast("int")).withColumn("_down", -F.col("score")).withColumn("_no_id", F.col("doc_id").isNull()).checkpoint()
    most = percent * rows.where(able).count() // 100
    place = global_row_number(rows.sparkSession, rows, ["_last", "_down", "_no_id", "doc_id", "n_words", "weight"], "_place")
    rank = F.when(able & (F.col("_place") <= most), F.col("_place")).cast("long")
    return place.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED,
             least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Weights, scores and ranks of ``docs`` for a target given as rows with a text."""
    path = scratch_path(docs.sparkSession, "word-features")
    features(docs, longest, buckets).write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    goal = features(target.select(F.lit(0).cast("long").alias("doc_id"), "text"), longest, buckets)
    model = fit(histogram(found, buckets), histogram(goal, buckets), longest)
    return draw(scored(found, model, seed), least_words, percent)


SQL = r"""
WITH lowered AS (
  SELECT 0 AS kind, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents
  UNION ALL
  SELECT 1, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS (SELECT kind, doc_id, unnest(regexp_extract_all(x, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM lowered WHERE x IS NOT NULL),
crc_table AS (SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
              FROM (SELECT unnest(range(256)) AS i)),
spelt AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)),
buckets AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
              lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS b FROM spelt, crc_table),
counted AS (SELECT kind, doc_id, b, count(*) AS n FROM words JOIN buckets USING (w) GROUP BY ALL),
sums AS (SELECT b, sum(CASE WHEN kind = 0 THEN n ELSE 0 END) AS s, sum(CASE WHEN kind = 1 THEN n ELSE 0 END) AS t FROM counted GROUP BY b),
gains AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM sums) + 10000)::DOUBLE
              / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sums) + 10000)::DOUBLE)))::BIGINT AS g FROM sums),
weights AS (SELECT doc_id, sum(n) AS n_features, sum(n * g) AS weight FROM counted JOIN gains USING (b) WHERE kind = 0 GROUP BY doc_id),
scores AS (SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
              coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM documents d LEFT JOIN weights USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scores)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * (SELECT count(*) FROM scores WHERE n_features >= 20) // 100 THEN place END AS rank
FROM placed"""


@register("op12_importance", SQL)
def q_importance(spark, sf_dir):
    docs, target = table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
