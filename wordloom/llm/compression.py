"""Quality rules by compression bands.

A document's bytes are compressed with zstandard as a whole and in fixed chunks. A ratio (compressed / raw
size) below its band says that the text repeats itself, above it that the text is noise. The limits depend
on the length: short texts hardly compress, so their bands lie higher and are wider. A text is rejected if
its whole ratio leaves its band, or if more than half of its full chunks leave theirs.

Before the bands come plain rules on the words (runs without ASCII white space): fewer than ``MIN_WORDS``
words, or more than ``MAX_REPEAT_PCT`` percent of the words in 5-word windows that occur twice or more.

Null and empty texts have no word, fail the base rules, and have a null ratio. A very long text is judged whole, in one
task, with a few times its bytes in memory. A ratio equal to a limit lies inside its band, and half of the chunks is not
more than half. Repeated rows give repeated rows, an empty table an empty one; other columns of the input are ignored,
whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from wordloom.llm.base import WordHash, map_slices, register, repeated_windows, table, utf8

LEVEL = 3
CHUNK = 2048
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
#: (bytes from, lowest ratio, highest ratio): the limits for a text of at least so many bytes.
BANDS = ((0, 0.30, 1.80), (128, 0.25, 1.20), (512, 0.22, 0.90), (2048, 0.18, 0.72), (8192, 0.15, 0.70), (65536, 0.12, 0.70))
SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, zstd_ratio double, n_chunks long, n_bad_chunks long")


def limits(n_bytes: int) -> tuple[float, float]:
    low, high = next((lo, hi) for start, lo, hi in reversed(BANDS) if n_bytes >= start)
    return low, high


def bands(data: bytes, pack: zstandard.ZstdCompressor) -> tuple[float | None, int, int]:
    """(whole ratio, full chunks, full chunks outside their band)."""
    if not data:
        return None, 0, 0
    low, high = limits(CHUNK)
    chunks = [len(pack.compress(data[i:i + CHUNK])) / CHUNK for i in range(0, len(data) - CHUNK + 1, CHUNK)]
    return len(pack.compress(data)) / len(data), len(chunks), sum(not low <= r <= high for r in chunks)


def word_counts(data: bytes, words: list[bytes], hashes: WordHash) -> tuple[int, int, int, int]:
    """(code points in words, symbols, repeated lines, words in repeated 5-word windows)."""
    bare = data.translate(None, SPACE)
    points = len(bare) - np.count_nonzero((np.frombuffer(bare, np.uint8) & 0xC0) == 0x80)
    symbols = len(bare) - len(bare.translate(None, SYMBOLS))
    lines = Counter(x for x in data.split(b"\n") if x.strip(SPACE))
    repeat = 0
    if len(words) > 5:
        twice = repeated_windows(hashes.hashes(words), 5)
        if twice.any():
            covered = np.zeros(len(words) + 1, np.int32)
            at = np.flatnonzero(twice)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + 5, -1)
            repeat = int(np.count_nonzero(np.cumsum(covered[:-1]) > 0))
    return int(points), symbols, sum(lines.values()) - len(lines), repeat


def compression_bands(docs: DataFrame) -> DataFrame:
    """One row per document: its word statistics, the base verdict and the verdict of the bands."""

    def setup():
        pack, hashes = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False), WordHash()

        def one(data: bytes) -> tuple:
            words = data.split()
            n = len(words)
            points, symbols, dup, repeat = word_counts(data, words, hashes)
            failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PCT * n
            ratio, chunks, bad = bands(data, pack)
            low, high = limits(len(data))
            kept = not failed and low <= ratio <= high and 2 * bad <= chunks
            return n, points, symbols, dup, repeat, failed, kept, ratio, chunks, bad

        def rows(batch: pa.RecordBatch) -> dict:
            cols = list(zip(*map(one, utf8(batch.column("text"))), strict=True))
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                     "zstd_ratio", "n_chunks", "n_bad_chunks")
            return {"doc_id": batch.column("doc_id")} | dict(zip(names, map(list, cols), strict=True))

        return rows

    return map_slices(docs.select("doc_id", "text"), setup, SCHEMA)


@register("op2_compression_bands")
def q_compression_bands(spark, sf_dir):
    return compression_bands(table(spark, sf_dir, "documents"))
