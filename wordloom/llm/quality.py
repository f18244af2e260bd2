"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every text is reduced to the statistics named in ``STATS`` (whole text). The trees are grown level by level on
histograms of quantile-binned statistics with logistic loss, then flattened into arrays: a tree of depth D
is 2^D - 1 tests and 2^D leaves, and numpy walks all rows of a slice through a tree in D steps.

Labels come only from rows whose crc32(doc_id) mod 4 is not 2, and the trees are fitted on at most
``MAX_TRAIN`` of them, those first in hash order of the id; that bound is the only sample. A document with
several labels counts once for each.

Null and empty texts have statistics too (all zero) and get a score. With no labels the score is 0.5 for all; with
one class only it is that class's share, smoothed. A very long text is read whole, in one task, with a few times its bytes
in memory. Splits of equal gain go to the first statistic in the order of ``STATS``, then the lowest limit; sampled rows of
equal hash are ordered by id and label. Repeated rows give repeated rows, an empty table an empty one; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.base import WordHash, fold, map_slices, register, repeated_windows, table, utf8

STATS = ("log_bytes", "log_words", "word_len", "long_words", "distinct_words", "letters", "upper", "digits", "symbols",
         "marks", "pipes", "spaces", "non_ascii", "entropy", "lines", "dup_lines", "line_words", "ends_in_mark",
         "repeat_windows", "zstd_ratio", "all_caps", "word_tails", "distinct_bytes", "top_word")
HELD_OUT = (4, 2)
THRESHOLD = 0.7
MAX_TRAIN = 20_000
BINS, DEPTH, TREES, RATE, L2, LEAF = 64, 4, 80, 0.15, 1.0, 20
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def _kinds() -> np.ndarray:
    """Rows: letters, upper, digits, symbols, marks, pipes, spaces, non-ASCII; columns: byte values."""
    k = np.zeros((8, 256))
    for row, chars in enumerate((b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                                 b"#*$%&<>@^~_=+\\/{}[]", b".,;:!?\"'()-", b"|", b" \t\n\v\f\r")):
        k[row, list(chars)] = 1
    k[7, 128:] = 1
    return k


KINDS = _kinds()


def statistics(data: bytes, hashes: WordHash, pack: zstandard.ZstdCompressor) -> list[float]:
    words, n = data.split(), len(data)
    if not words:
        return [0.0] * len(STATS)
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = hist[hist > 0] / n
    letters, upper, digits, symbols, marks, pipes, spaces, high = (KINDS @ hist) / n
    ids = hashes.hashes(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    each = np.unique(ids, return_counts=True)[1]
    lines = [x for x in data.split(b"\n") if x.strip()]
    twice = repeated_windows(ids, 3)
    return [np.log1p(n), np.log1p(len(words)), lengths.mean(), (lengths > 12).mean(), len(each) / len(words), letters, upper, digits, symbols,
            marks, pipes, spaces, high, -(share * np.log2(share)).sum(), np.log1p(len(lines)), 1 - len(set(lines)) / len(lines),
            len(words) / len(lines), sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines), twice.mean() if len(twice) else 0.0,
            len(pack.compress(data)) / n, sum(map(bytes.isupper, words)) / len(words),
            sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / len(words), len(share) / 256, each.max() / len(words)]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text, as an array in the order of ``STATS``."""

    def setup():
        hashes, pack = WordHash(), zstandard.ZstdCompressor(level=1)

        def rows(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column("doc_id"), "stats": [statistics(t, hashes, pack) for t in utf8(batch.column("text"))]}
        return rows

    return map_slices(docs.select("doc_id", "text"), setup, "doc_id long, stats array<float>")


class Trees:
    """Flattened trees: for tree t and test i, ``feature[t, i]`` and ``limit[t, i]``; the children of i are
    2i + 1 (value <= limit) and 2i + 2; ``leaf[t]`` has the values of the 2^depth ends."""

    def __init__(self, base: float, feature: np.ndarray, limit: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.limit, self.leaf = base, feature, limit, leaf

    def raw(self, x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.full(len(x), self.base)
        tests = self.feature.shape[1]
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < tests:
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            out += leaf[at - tests]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Fit by boosting. Gradients g and curvatures h of the logistic loss are summed in histograms of
    (node, feature, bin) by one bincount a level; a node's split is the bin edge of largest gain."""
    n, d = x.shape
    share = (y.sum() + 1) / (n + 2)
    base, tests = float(np.log(share / (1 - share))), 2 ** depth - 1
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(1) for f in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1) if n else np.zeros((0, d), int)
    feature, limit = np.zeros((trees, tests), np.int64), np.full((trees, tests), np.inf)
    leaf, raw, cell = np.zeros((trees, tests + 1)), np.full(n, base), np.arange(d) * BINS
    for t in range(trees if n and 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-raw))
        g, h, at = p - y, p * (1 - p), np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2 ** level - 1, 2 ** level
            flat = ((at - first)[:, None] * (d * BINS) + cell + binned).ravel()
            sums = [np.bincount(flat, np.repeat(v, d), nodes * d * BINS).reshape(nodes, d, BINS).cumsum(axis=2) for v in (g, h, np.ones(n))]
            (gl, hl, nl), (ga, ha, na) = sums, (s[:, :, -1:] for s in sums)
            gain = gl ** 2 / (hl + L2) + (ga - gl) ** 2 / (ha - hl + L2) - ga ** 2 / (ha + L2)
            gain[(nl < LEAF) | (na - nl < LEAF)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for node in np.flatnonzero(gain.reshape(nodes, -1).max(axis=1) > 1e-6):
                f, b = divmod(int(best[node]), BINS)
                if b < len(edges[f]):
                    feature[t, first + node], limit[t, first + node] = f, edges[f][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > limit[t, at])
        ends = at - tests
        leaf[t] = -RATE * np.bincount(ends, g, tests + 1) / (np.bincount(ends, h, tests + 1) + L2)
        raw += leaf[t][ends]
    return Trees(base, feature, limit, leaf)


def fit(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Trees:
    """Trees from the statistics of at most ``max_train`` labelled rows that are not held out."""
    train = labels.where((fold("doc_id", HELD_OUT[0]) != HELD_OUT[1]) & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("y"))
    sample = train.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_train)
    got = stats.join(F.broadcast(sample), "doc_id").select("stats", "y").toArrow()
    x = np.array(got.column("stats").to_pylist(), np.float32).reshape(-1, len(STATS))
    y = np.array(got.column("y").to_pylist(), float)
    order = np.lexsort((*x.T, y))  # the same trees whatever order the rows came in
    return grow(x[order], y[order])


def score(stats: DataFrame, model: Trees) -> DataFrame:
    sent = stats.sparkSession.sparkContext.broadcast(model)

    def setup():
        def rows(batch: pa.RecordBatch) -> dict:
            x = np.array(batch.column("stats").to_pylist(), np.float32).reshape(-1, len(STATS))
            s = sent.value.score(x)
            return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": s, "predicted": (s >= THRESHOLD).astype(np.int32)}
        return rows

    src = stats.select("doc_id", (fold("doc_id", HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), "stats")
    return map_slices(src, setup, SCHEMA, rows=4096)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted. The statistics (a hundred bytes a row) are written once to the shared
    checkpoint folder and serve both the fit and the scoring."""
    stats = document_statistics(docs).checkpoint()
    return score(stats, fit(stats, labels))


@register("op8_quality")
def q_quality(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
