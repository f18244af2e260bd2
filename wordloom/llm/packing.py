"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

**Pieces.** A document is its token ids and an end mark. Documents longer than a sequence are cut into full
pieces and a rest; shorter ones stay whole.

**Packing.** Pieces are dealt by hash into shards of about ``SHARD`` pieces, so no task sees more. Each shard is
evolved on ``ISLANDS`` islands, one row each. An individual is a grouping of the shard's pieces into sequences.
Crossover injects whole well-filled sequences of one parent into the other, drops the sequences that
now hold a piece twice, and best-fits the displaced pieces; mutation dissolves the emptiest sequences. Between
the epochs an island's best individual migrates to the next island (a window over the islands of a
shard). The first individual is best-fit decreasing, and an island rests as soon as it uses no more sequences than
the sum of lengths needs, so easy shards cost little.

**Second level.** What lies in sequences filled below ``GOOD_FILL`` is dealt again, whole sequences together, into
as few shards as it needs and evolved once more from what it had, so it never gets worse.

A null or empty text is one piece with the end mark alone. Documents without an id are packed like others. Repeated rows give repeated pieces, packed on their
own. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import os
import unicodedata
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.base import map_slices, register, table, utf8

LENGTH = 4096
END = 1
SHARD = 4096
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 12
GOOD_FILL = 0.99
#: Words whose ids a worker remembers: the first ones it meets.
CACHE_WORDS = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Words(dict):
    """White-space-separated piece of a text (UTF-8, ASCII letters lowered) -> its ids, little-endian 32-bit.

    The tokenizer drops white space, so the ids of a text are those of its words in order. A mark at the end of
    a word is a token run of its own, and a word of letters alone goes straight to the merges."""

    MARKS = b".,!?;:"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.merges = self.whole.model
        self.specials = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        self.bytewise = str.maketrans({i: c for i, c in enumerate(byte_letters())})

    def __missing__(self, word: bytes) -> bytes:
        if len(word) > 1 and word[-1] in self.MARKS and word[-2:-1].isalnum():
            return self[word[:-1]] + self[word[-1:]]
        if word.isalpha():  # bytes: ASCII letters only
            ids = [t.id for t in self.merges.tokenize(word.decode())]
        else:
            text = word.decode()
            low = text.lower()
            if low.isalpha() and "σ" not in low and "ς" not in low and "̇" not in low and unicodedata.is_normalized("NFC", text):
                ids = [t.id for t in self.merges.tokenize(low.encode().decode("latin-1").translate(self.bytewise))]
            else:
                ids = self.whole.encode(text, add_special_tokens=False).ids
        out = np.array(ids, "<u4").tobytes()
        if len(self) < CACHE_WORDS:
            self[word] = out
        return out

    def encode(self, data: bytes) -> bytes:
        if b"<|" in data:  # may hold a special token, whose case matters
            return np.array(self.whole.encode(data.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, data.lower().split()))


def byte_letters() -> list[str]:
    """The characters that stand for bytes in byte-level vocabularies: visible Latin-1 characters for themselves,
    the others counted up from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@functools.lru_cache(maxsize=1)
def load_words(path: str) -> Words:
    return Words(path)


def token_pieces(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """The pieces of every document. ``path`` is a tokenizer file that every executor can read."""

    def setup():
        words = load_words(path)
        end = np.array([END], "<u4").tobytes()

        def rows(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text")), strict=True):
                ids = words.encode(data) + end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, length)):
                    part = ids[4 * start:4 * (start + length)]
                    for c, v in zip(out, (doc_id, piece, start, len(part) // 4, zlib.crc32(part)), strict=True):
                        out[c].append(v)
            return out
        return rows

    return map_slices(docs.select("doc_id", "text"), setup, PIECES)


def best_fit(lengths: np.ndarray, items, bins: list[list[int]], room: list[int], size: int) -> None:
    """Put the items, in the order given, into the sequence with the least room that takes each."""
    free = sorted((r, b) for b, r in enumerate(room) if r > 0)
    for i in items:
        need = int(lengths[i])
        at = bisect_left(free, (need, -1))
        if at < len(free):
            r, b = free.pop(at)
        else:
            r, b = size, len(bins)
            bins.append([])
            room.append(size)
        bins[b].append(i)
        room[b] = r - need
        if room[b]:
            insort(free, (room[b], b))


def longest_first(lengths: np.ndarray, items) -> list[int]:
    return sorted(items, key=lambda i: (-lengths[i], i))


def grouped(which: np.ndarray) -> list[list[int]]:
    """Sequences as lists of items, from the number of each item's sequence."""
    order = np.argsort(which, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(which[order])) + 1)] if len(which) else []


def numbered(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for b, items in enumerate(bins):
        out[items] = b
    return out


def fitness(which: np.ndarray, lengths: np.ndarray, size: int) -> tuple[int, float]:
    """(minus the number of sequences, mean squared fill): more is better."""
    fill = np.bincount(which, lengths) / size
    fill = fill[fill > 0]
    return -len(fill), float((fill ** 2).mean()) if len(fill) else 0.0


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, size: int, rng) -> np.ndarray:
    """Child of ``a`` with a run of well-filled sequences of ``b``."""
    bins_b = grouped(b)
    fill_b = np.array([lengths[x].sum() for x in bins_b])
    good = np.flatnonzero(fill_b >= np.quantile(fill_b, 0.5))
    take = rng.choice(good, max(1, int(len(good) * rng.uniform(0.1, 0.5))), replace=False)
    injected = [bins_b[t] for t in take]
    inside = np.zeros(len(a), bool)
    for x in injected:
        inside[x] = True
    whole, displaced = [], []
    for x in grouped(a):
        if inside[x].any():
            displaced += [i for i in x if not inside[i]]
        else:
            whole.append(x)
    bins = whole + injected
    best_fit(lengths, longest_first(lengths, displaced), bins, [size - int(lengths[x].sum()) for x in bins], size)
    return numbered(bins, len(a))


def mutate(a: np.ndarray, lengths: np.ndarray, size: int, rng) -> np.ndarray:
    """Dissolve the emptiest sequence and a few others at random, and best-fit their pieces in random order."""
    bins = grouped(a)
    fill = np.array([lengths[x].sum() for x in bins])
    out = {int(fill.argmin()), *rng.choice(len(bins), min(len(bins), 3), replace=False).tolist()}
    loose = [i for b in out for i in bins[b]]
    bins = [x for b, x in enumerate(bins) if b not in out]
    rng.shuffle(loose)
    best_fit(lengths, loose, bins, [size - int(lengths[x].sum()) for x in bins], size)
    return numbered(bins, len(a))


def evolve(lengths: np.ndarray, start: list[np.ndarray], size: int, seed: int, generations: int = GENERATIONS) -> np.ndarray:
    """The best individual after some generations, the given ones among the first."""
    least, rng, n = -(-int(lengths.sum()) // size), np.random.default_rng(seed), len(lengths)
    first: list[list[int]] = []
    best_fit(lengths, longest_first(lengths, range(n)), first, [], size)
    people = sorted([*start, numbered(first, n)], key=lambda x: fitness(x, lengths, size), reverse=True)
    for g in range(generations):
        if -fitness(people[0], lengths, size)[0] <= least:
            break
        while len(people) < 3:
            people.append(mutate(people[0], lengths, size, rng))
        child = crossover(people[g % 3], people[(g + 1) % 3], lengths, size, rng)
        people += [child, mutate(people[0], lengths, size, rng)]
        people = sorted(people, key=lambda x: fitness(x, lengths, size), reverse=True)[:4]
    return people[0]


def _pack_shards(items: DataFrame, shard, size: int, islands: int, epochs: int) -> DataFrame:
    """Pack each shard of ``items`` (pieces, with ``before``: the sequence they are in so far, or null)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "before"]

    def gather(t: pa.Table) -> pa.Table:
        t = t.sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32", "before")])
        cols = {c: [t.column(c).to_pylist()] for c in names}
        return pa.table({"shard": t.column("shard").slice(0, 1), **cols}, schema=pa.schema(
            [("shard", pa.int64()), *[(c, pa.list_(pa.int64())) for c in names]]))

    rows = items.select(shard.alias("shard"), *[F.col(c).cast("long").alias(c) for c in names])
    base = rows.groupBy("shard").applyInArrow(gather, "shard long, " + ", ".join(f"{c} array<long>" for c in names)).checkpoint()

    def epoch(state: DataFrame, number: int) -> DataFrame:
        def setup():
            def one(shard, island, length, best, guest):
                lengths = np.array(length, np.int64)
                start = [np.array(x, np.int64) for x in (best, guest) if x is not None]
                return evolve(lengths, start, size, hash((shard % 2**31, island, number)) % 2**32).tolist()

            def run(batch: pa.RecordBatch) -> dict:
                cols = [batch.column(c).to_pylist() for c in ("shard", "island", "length", "best", "guest")]
                return {"shard": cols[0], "island": cols[1], "length": cols[2], "best": [one(*x) for x in zip(*cols, strict=True)]}
            return run

        return map_slices(state.select("shard", "island", "length", "best", "guest"), setup,
                          "shard long, island int, length array<long>, best array<int>", rows=8)

    def numbers(before: pa.Array) -> list:
        return [None if not b or b[0] is None else np.unique(b, return_inverse=True)[1].tolist() for b in before.to_pylist()]

    state = map_slices(base.select("shard", "length", "before"), lambda: lambda batch: {
        "shard": batch.column("shard"), "length": batch.column("length"), "best": numbers(batch.column("before"))},
        "shard long, length array<long>, best array<int>", rows=8)
    state = state.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    state = state.repartition(F.col("shard"), F.col("island")).withColumn("guest", F.lit(None).cast("array<int>"))
    ring = Window.partitionBy("shard").orderBy("island")
    for e in range(epochs):
        state = epoch(state, e)
        if e + 1 < epochs:  # elites move on by one island
            last = F.last("best").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            state = state.withColumn("guest", F.coalesce(F.lag("best").over(ring), last))

    def spell(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in (*names[:-1], "sequence_id", "offset", "fill")}
        for row in batch.to_pylist():
            lengths, choices = np.array(row["length"], np.int64), [np.array(x, np.int64) for x in row["bests"]]
            which = max(choices, key=lambda x: fitness(x, lengths, size))
            order = np.argsort(which, kind="stable")
            ends = np.cumsum(lengths[order])
            first = np.concatenate(([0], np.flatnonzero(np.diff(which[order])) + 1))
            begin = np.repeat((ends - lengths[order])[first], np.diff(np.append(first, len(order))))
            fill = np.bincount(which, lengths)
            for c in names[:-1]:  # ids may be null
                out[c] += np.array(row[c], object)[order].tolist()
            out["sequence_id"] += (row["shard"] * SHARD * 64 + which[order]).tolist()
            out["offset"] += (ends - lengths[order] - begin).tolist()
            out["fill"] += (fill[which[order]] / size).tolist()
        return out

    won = state.groupBy("shard").agg(F.collect_list("best").alias("bests"))
    return map_slices(base.drop("before").join(won, "shard"), lambda: spell, PIECES + ", sequence_id long, offset long, fill double", rows=8)


def pack(pieces: DataFrame, size: int = LENGTH, shard_size: int = SHARD, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Pieces with sequence_id and offset."""
    pieces = pieces.checkpoint()
    shards = max(1, -(-pieces.count() // shard_size))
    items = pieces.withColumn("before", F.lit(None).cast("long"))
    first = _pack_shards(items, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)), size, islands, epochs).checkpoint()
    full = first.where(F.col("fill") >= GOOD_FILL)
    rest = first.where(F.col("fill") < GOOD_FILL).withColumn("before", F.col("sequence_id"))
    again = max(1, -(-rest.count() // shard_size))
    if shards > 1:
        second = _pack_shards(rest, F.pmod(F.xxhash64("before"), F.lit(again)) + shards, size, islands, epochs)
        first = full.unionByName(second)
    return first.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op7_packing")
def q_packing(spark, sf_dir):
    import public_tokenizers

    return pack(token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
