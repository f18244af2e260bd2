"""Toxicity by class-conditional Kneser-Ney models.

For each class c (toxic, ordinary) an interpolated Kneser-Ney bigram model over lower-cased words:

    P_c(w | u) = (max(n_c(u,w) - D_c, 0) + D_c t_c(u) P_c(w)) / n_c(u)
    P_c(w)     = (max(k_c(w) - E_c, 0) + E_c V_c P(w)) / K_c
    P(w)       = the share of w in the counts that the discount E took from both classes, and one for each word

n counts bigrams, t_c(u) the distinct words after u, k_c(w) the distinct words before w (K_c in all, of V_c words). The
discounts are absolute, n1 / (n1 + 2 n2) from the numbers of bigrams (D) and of words by k (E) that occur once and
twice; 1/2 where either is missing. P is shared by the classes, and the pooled model of both classes has the weight ``SHARED``
in either, so that a passage copied within one class cannot outweigh a whole text.

All words and bigrams of all training rows are counted, exactly, and stay tables, in parts by the hash of the (first) word. Words
have numbers there, 64-bit hashes stand for words, pairs of numbers for bigrams. Nothing that grows with the corpus reaches the driver or a broadcast.
Texts are read once, into blocks of about ``BLOCK_BYTES`` whose words are numbers too. A block asks each part once for the words
that it has, and then for its distinct bigrams of known words, as sorted numbers; parts answer with their counts, 0 for
what was never seen. The blocks' tasks read the answers from the shared folder and price each bigram of each text. So neither
texts nor what is known of a single text are shuffled, and a common word is asked for once a block.

A document's evidence is its mean log-likelihood ratio per word (length-normalised): of P_c(w), and what P_c(w | u) adds
to it. Either has three parts: what single words have beyond ``STRONG`` for toxic, beyond it for ordinary, and the rest,
which mostly tells languages and topics apart. A logistic curve on the six, fitted on training rows that the counts did
not see, makes the score.

Labels come only from rows whose crc32(doc_id) mod 5 is not 0. Remainders 1 to 3 give the counts (exact copies once), 4 the curve,
of at most ``MAX_CURVE`` rows, those first in hash order. Null and wordless texts have no evidence: they score the
toxic share of the curve's rows. With no labels, or one class, everything scores the smoothed toxic share.
Repeated rows give repeated rows; a document with several labels counts for each; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wordloom.llm.base import SLICE, WordHash, fold, register, release, table, utf8
from wordloom.session import scratch_path

HELD_OUT = (5, 0)
CURVE = 4
MAX_CURVE = 20_000
SHARED = 0.05
STRONG = 1.0
THRESHOLD = 0.5
START = 0x5EED
#: Text that a block holds.
BLOCK_BYTES = 16 << 20
#: Training words for which there is one part, words of texts that one task answers for, and words priced at a time.
PART_WORDS = 2_000_000
ASKED_WORDS = 32_000_000
PRICED_WORDS = 500_000
#: Partitions take turns, if there are enough of them, so that blocks, what they ask and what they are answered lie on disk for
#: one turn at a time.
TURNS = 4
TURN_PARTITIONS = 3
TO_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(data: bytes) -> list[bytes]:
    """The lower-cased words."""
    return data.decode().lower().encode().translate(TO_SPACE).split()


def word_ids(data: bytes, hashes: WordHash) -> np.ndarray:
    """Hashes of the lower-cased words, after a start mark."""
    return np.concatenate((np.array([START], np.uint64), hashes.hashes(words_of(data))))


# ---- whole numbers as bytes ------------------------------------------------------------------

def pack(x: np.ndarray) -> bytes:
    """Whole numbers from 0, the lowest bytes of all first, compressed."""
    x = np.ascontiguousarray(x, np.uint64)
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + (pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(x) else b"")


def unpack(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :data[0]] = np.frombuffer(pa.decompress(data[1:], n * data[0], codec="zstd", asbytes=True), np.uint8).reshape(data[0], n).T
    return out.view(np.uint64).ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    """The same for differences, which wrap where numbers fall."""
    return pack(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n), dtype=np.uint64)


# ---- texts in blocks -------------------------------------------------------------------------

BLOCK = "block long, size long, keys binary, lengths binary, kinds long, words binary, tokens long, stream binary"


class Index(dict):
    """word -> its number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def of_turn(docs: DataFrame, turn: int, turns: int) -> DataFrame:
    """The rows of the partitions whose turn it is."""
    return docs.where(F.spark_partition_id() % turns == turn) if turns > 1 else docs


def blocks(docs: DataFrame, key: str, turn: int = 0, turns: int = 1) -> tuple[DataFrame, str]:
    """The words of the texts with the numbers of ``key``, a row for about ``BLOCK_BYTES`` of text (or one longer text):
    hashes of the block's words, most frequent first (equally frequent ones in order), and the texts as numbers of them. ``turn`` only sets their numbers apart. The second
    result is the folder that holds them."""
    struct = StructType.fromDDL(BLOCK)

    def row(number: int, keys: list, texts: list[np.ndarray], index: Index) -> pa.RecordBatch:
        stream = np.concatenate(texts)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, index), np.uint64, len(index))
        order = np.lexsort((hashes, -np.bincount(stream, minlength=len(index))))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        values = (number, len(keys), pack(np.array(keys, np.int64).view(np.uint64)), pack(np.array([len(t) for t in texts])),
                  len(index), pack_sorted(hashes[order]), len(stream), pack(place[stream]))
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, to_arrow_schema(struct), strict=True)], schema=to_arrow_schema(struct))

    def run(batches):
        number = TaskContext.get().partitionId() * turns + turn << 32
        keys, texts, index, size = [], [], Index(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                for k, text in zip(some.column(0).to_pylist(), utf8(some.column(1)), strict=True):
                    words = words_of(text)
                    keys.append(k)
                    texts.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
                    size += len(text)
                    if size >= BLOCK_BYTES:
                        yield row(number, keys, texts, index)
                        keys, texts, index, size, number = [], [], Index(), 0, number + 1
        if keys:
            yield row(number, keys, texts, index)

    folder = scratch_path(docs.sparkSession, "toxicity")
    docs.select(F.col(key).cast("long").alias("key"), "text").mapInArrow(run, struct).write.parquet(folder)
    return docs.sparkSession.read.schema(struct).parquet(folder), folder


@dataclass
class Block:
    """``words``: the hashes, the start mark's last; ``u`` and ``w``: for each word of the texts the one before it and its own, as
    places in ``words``."""

    keys: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    u: np.ndarray
    w: np.ndarray


def read_block(r: dict) -> Block:
    words = np.append(unpack_sorted(r["words"], r["kinds"]), np.uint64(START))
    lengths, w = unpack(r["lengths"], r["size"]).astype(np.int64), unpack(r["stream"], r["tokens"]).astype(np.int64)
    u = np.concatenate((w[:0], w[-1:], w[:-1]))
    u[(np.cumsum(lengths) - lengths)[lengths > 0]] = r["kinds"]
    return Block(unpack(r["keys"], r["size"]).view(np.int64), lengths, words, u, w)


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """``fn`` makes the columns of the rows that one row gives."""
    struct = StructType.fromDDL(schema)

    def run(batches):
        arrow = to_arrow_schema(struct)
        for batch in batches:
            for i in range(batch.num_rows):
                got = fn(batch.slice(i, 1).to_pylist()[0])
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


# ---- sorted keys in parts, asked by blocks -----------------------------------------------------

#: A part of a table, or what one block asks of it: ``n`` sorted keys, and numbers for each.
CELL = "part long, block long, n long, keys binary, values array<binary>"
ANSWER = "block long, part long, n long, found binary, hits long, places binary, values array<binary>"


def cells(block: int, keys: np.ndarray, starts: np.ndarray, values=()) -> dict:
    """Sorted keys cut at the ``starts`` of the parts, each less its part's start."""
    cuts = np.append(np.searchsorted(keys, starts), len(keys))
    some = [(p, a, b) for p, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
    return {"part": [p for p, _, _ in some], "block": [block] * len(some), "n": [b - a for _, a, b in some],
            "keys": [pack_sorted(keys[a:b] - starts[p]) for p, a, b in some], "values": [[pack(v[a:b]) for v in values] for _, a, b in some]}


def of_group(schema: str, fn: Callable[..., dict], two: bool = False) -> Callable[..., pa.Table]:
    """``fn`` makes the columns that a group gives, or the groups of ``two`` tables."""
    struct = StructType.fromDDL(schema)

    def made(got: dict) -> pa.Table:
        arrow = to_arrow_schema(struct)
        return pa.Table.from_arrays([pa.array(got[f.name], f.type) for f in arrow], schema=arrow)

    return (lambda left, right: made(fn(left, right))) if two else (lambda rows: made(fn(rows)))


def answer(asked: pa.Table, held: pa.Table, numbers: int) -> dict:
    """For each row of ``asked`` which of its keys are held, where, and their ``numbers`` numbers."""
    out = {c: [] for c in ("block", "part", "n", "found", "hits", "places", "values")}
    mine = held.to_pylist()
    keys = unpack_sorted(mine[0]["keys"], mine[0]["n"]) if mine else np.zeros(0, np.uint64)
    values = [unpack(v, len(keys)) for v in mine[0]["values"]] if mine else [keys] * numbers
    for i in range(asked.num_rows):
        r = asked.slice(i, 1).to_pylist()[0]
        want = unpack_sorted(r["keys"], r["n"])
        at = np.searchsorted(keys, want)
        found = at < len(keys)
        found[found] = keys[at[found]] == want[found]
        at = at[found]
        for c, v in (("block", r["block"]), ("part", r["part"]), ("n", r["n"]), ("found", np.packbits(found).tobytes()), ("hits", len(at)),
                     ("places", pack_sorted(at.astype(np.uint64))), ("values", [pack(v[at]) for v in values])):
            out[c].append(v)
    return out


def answered(asked: DataFrame, held: DataFrame, numbers: int, salts: int = 1) -> str:
    """The answers in the shared folder, ``block=<b>/``. A part that many ask is held by ``salts`` tasks."""
    folder = scratch_path(asked.sparkSession, "toxicity")
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)))
    held = held.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    got = asked.groupBy("part", "salt").cogroup(held.groupBy("part", "salt")).applyInArrow(of_group(ANSWER, lambda asks, has: answer(asks, has, numbers), two=True), ANSWER)
    got.repartition("block").write.partitionBy("block").parquet(folder)
    release(asked.sparkSession)
    return folder


def forget(spark: SparkSession, *folders: str) -> None:
    """Removes answers that have been used."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_answers(folder: str, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of all keys that the block asked, in order: which are held; of these the part, the place there and their numbers."""
    where, root = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", f"{folder}/block={block}"))
    files = sorted(f.path for f in where.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.path.endswith(".parquet"))
    rows = sorted((r for f in files for r in pq.read_table(f, filesystem=where, partitioning=None).to_pylist()), key=lambda r: r["part"])
    join = lambda xs, of: np.concatenate(xs) if xs else np.zeros(0, of)
    found = join([np.unpackbits(np.frombuffer(r["found"], np.uint8), count=r["n"]).astype(bool) for r in rows], bool)
    part = np.repeat(np.array([r["part"] for r in rows], np.int64), [r["hits"] for r in rows])
    place = join([unpack_sorted(r["places"], r["hits"]).astype(np.int64) for r in rows], np.int64)
    return found, part, place, [join(list(v), np.uint64) for v in zip(*[[unpack(v, r["hits"]) for v in r["values"]] for r in rows], strict=True)]


# ---- the counts --------------------------------------------------------------------------------

@dataclass
class Model:
    """Tables in parts, each starting at a hash (``starts``) and at a word's number (``offsets``, the number of all words last).
    ``word_parts``: the words with k0, k1, s0, s1 (occurrences as a context), t0, t1; ``pair_parts``: the bigrams, first number x all +
    second number, with n0, n1. By class: the discounts D and E, K and V; ``kinds``: the words of both; ``toxic``: the toxic share
    of the training words."""

    word_parts: DataFrame
    pair_parts: DataFrame
    starts: np.ndarray
    offsets: np.ndarray
    d: list[float]
    e: list[float]
    k: list[int]
    v: list[int]
    kinds: int
    toxic: float
    curve: tuple = ([0.0] * 6, 0.0, 0.5)

    def _numbered(self) -> DataFrame:
        starts, offsets = self.starts, self.offsets

        def rows(r: dict) -> dict:
            k0, k1 = (unpack(v, r["n"]).view(np.int64) for v in r["values"][:2])
            words = (unpack_sorted(r["keys"], r["n"]) + starts[r["part"]]).view(np.int64)
            return {"id": np.arange(r["n"]) + int(offsets[r["part"]]), "w": words, "k0": k0, "k1": k1}

        return map_rows(self.word_parts, rows, "id long, w long, k0 long, k1 long")

    @property
    def words(self) -> DataFrame:
        """w, k0, k1."""
        return self._numbered().where("k0 + k1 > 0").drop("id")

    @property
    def pairs(self) -> DataFrame:
        """u, w, n0, n1."""
        offsets, all_ = self.offsets, int(self.offsets[-1])

        def rows(r: dict) -> dict:
            keys = unpack_sorted(r["keys"], r["n"]).view(np.int64)
            n0, n1 = (unpack(v, r["n"]).view(np.int64) for v in r["values"])
            return {"a": keys // all_ + int(offsets[r["part"]]), "b": keys % all_, "n0": n0, "n1": n1}

        word = lambda place, name: self._numbered().select(F.col("id").alias(place), F.col("w").alias(name))
        found = map_rows(self.pair_parts, rows, "a long, b long, n0 long, n1 long")
        return found.join(word("a", "u"), "a").join(word("b", "w"), "b").select("u", "w", "n0", "n1")


def ask_words(texts: DataFrame, starts: np.ndarray) -> DataFrame:
    def rows(r: dict) -> dict:
        return cells(r["block"], np.unique(np.append(unpack_sorted(r["words"], r["kinds"]), np.uint64(START))), starts)
    return map_rows(texts.select("block", "kinds", "words").where("tokens > 0"), rows, CELL)


def numbered(block: Block, number: int, folder: str, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each of the block's words its number in the model, -1 if it has none, and its counts."""
    found, part, place, values = read_answers(folder, number)
    back = np.unique(block.words, return_inverse=True)[1]

    def spread(x: np.ndarray, other: int) -> np.ndarray:
        out = np.full(len(found), other, np.int64)
        out[found] = x
        return out[back]

    return spread(offsets.astype(np.int64)[part] + place, -1), [spread(v.view(np.int64), 0) for v in values]


def codes(ids: np.ndarray, u: np.ndarray, w: np.ndarray, all_: int) -> tuple[np.ndarray, np.ndarray]:
    """Which bigrams have two known words, and their numbers."""
    a, b = ids[u], ids[w]
    both = (a >= 0) & (b >= 0)
    return both, a[both].astype(np.uint64) * np.uint64(all_) + b[both].astype(np.uint64)


def merged_words(cells_: pa.Table) -> dict:
    rows = cells_.to_pylist()
    keys = np.unique(np.concatenate([unpack_sorted(r["keys"], r["n"]) for r in rows]))
    return {"part": [rows[0]["part"]], "block": [0], "n": [len(keys)], "keys": [pack_sorted(keys)], "values": [[]]}


def merged_pairs(cells_: pa.Table, offsets: np.ndarray) -> dict:
    """Of a part: its bigrams (kind 0), the contexts' counts by place (kind 1), and for the parts of the second words what their k
    has from here (kind 2)."""
    rows, all_ = cells_.to_pylist(), offsets[-1]
    part = rows[0]["part"]
    keys = np.concatenate([unpack_sorted(r["keys"], r["n"]) for r in rows])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    keys, n = keys[first], [np.add.reduceat(np.concatenate([unpack(r["values"][c], r["n"]) for r in rows])[order], first) for c in (0, 1)]
    size, u = int(offsets[part + 1] - offsets[part]), (keys // all_).astype(np.int64)
    s = [np.bincount(u, x, size) for x in n]
    t = [np.bincount(u[x > 0], minlength=size) for x in n]
    seconds, at = np.unique(keys % all_, return_inverse=True)
    k = cells(0, seconds, offsets[:-1], [np.bincount(at, x > 0) for x in n])
    own = {"part": [part] * 2, "block": [0] * 2, "n": [len(keys), size], "keys": [pack_sorted(keys), b""], "values": [[pack(x) for x in n], [pack(x) for x in s + t]]}
    return {"kind": [0, 1] + [2] * len(k["part"])} | {c: own[c] + k[c] for c in own}


def with_counts(words: pa.Table, counts: pa.Table) -> dict:
    word, rows = words.to_pylist()[0], counts.to_pylist()
    k = np.zeros((2, word["n"]), np.uint64)
    context = [np.zeros(word["n"], np.uint64)] * 4
    for r in rows:
        if r["kind"] == 1:
            context = [unpack(v, r["n"]) for v in r["values"]]
        else:
            k[:, unpack_sorted(r["keys"], r["n"]).astype(np.int64)] += np.array([unpack(v, r["n"]) for v in r["values"]])
    return {c: [word[c]] for c in ("part", "block", "n", "keys")} | {"values": [[pack(x) for x in (*k, *context)]]}


def discounts(held: DataFrame) -> tuple[list[float], list[int], list[int], int]:
    """Of the first two numbers, one for each class: n1 / (n1 + 2 n2), the sum of the counts, and how many are not 0; and how many
    are not 0 in either class."""
    names = [f"{x}{c}" for c in (0, 1) for x in ("once", "twice", "sum", "some")] + ["either"]

    def rows(r: dict) -> dict:
        n = [unpack(v, r["n"]) for v in r["values"][:2]]
        got = [int(x) for a in n for x in ((a == 1).sum(), (a == 2).sum(), a.sum(), (a > 0).sum())] + [int((n[0] + n[1] > 0).sum())]
        return {k: [v] for k, v in zip(names, got, strict=True)}

    got = map_rows(held.select("n", "values"), rows, ", ".join(f"{x} long" for x in names)).agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in names]).first()
    by = [got[0:4], got[4:8]]
    return [once / (once + 2 * twice) if once and twice else 0.5 for once, twice, _, _ in by], [x[2] for x in by], [x[3] for x in by], got[8]


def n_words(texts: DataFrame) -> int:
    return texts.agg(F.sum("tokens")).first()[0] or 0


def fit_counts(*train: DataFrame) -> Model:
    """Of the rows (text, y) of all tables."""
    spark, written = train[0].sparkSession, []
    for turn, rows in enumerate(train):
        written.append(blocks(rows, "y", turn, len(train))[1])
        release(spark)
    texts = spark.read.schema(BLOCK).parquet(*written)
    n_parts = 1 + n_words(texts) // PART_WORDS
    starts = np.array([p * 2**64 // n_parts for p in range(n_parts)], np.uint64)
    asked = ask_words(texts, starts)
    words = asked.groupBy("part").applyInArrow(of_group(CELL, merged_words), CELL).checkpoint()
    sizes = dict(words.select("part", "n").collect())
    offsets = np.cumsum([0] + [sizes.get(p, 0) for p in range(n_parts)]).astype(np.uint64)
    folder = answered(asked, words, 0)

    def pair_cells(r: dict) -> dict:
        block = read_block(r)
        ids, _ = numbered(block, r["block"], folder, offsets)
        pairs, at = np.unique(codes(ids, block.u, block.w, int(offsets[-1]))[1], return_inverse=True)
        toxic = np.repeat(block.keys, block.lengths)
        return cells(r["block"], pairs, offsets[:-1] * offsets[-1], [np.bincount(at[toxic == c], minlength=len(pairs)) for c in (0, 1)])

    counted = map_rows(texts.where("tokens > 0"), pair_cells, CELL).groupBy("part")
    counted = counted.applyInArrow(of_group(f"kind int, {CELL}", lambda t: merged_pairs(t, offsets)), f"kind int, {CELL}").checkpoint()
    pairs = counted.where("kind = 0").drop("kind")
    words = words.groupBy("part").cogroup(counted.where("kind > 0").groupBy("part")).applyInArrow(of_group(CELL, with_counts, two=True), CELL).checkpoint()
    forget(spark, folder, *written)
    release(spark)
    d, n, _, _ = discounts(pairs)
    e, k, v, kinds = discounts(words)
    return Model(words, pairs, starts, offsets, d, e, k, v, kinds, (n[1] + 1) / (sum(n) + 2))


# ---- the evidence ------------------------------------------------------------------------------

SIDES = ("toxic_part", "ordinary_part", "weak_part")
PARTS = (*SIDES, *(f"pair_{x}" for x in SIDES))


@dataclass
class Prices:
    """The numbers of a model that a task needs."""

    d: list[float]
    e: list[float]
    k: list[int]
    v: list[int]
    kinds: int
    toxic: float

    def log_ratio(self, ordinary: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        both = SHARED / (1 - SHARED) * ((1 - self.toxic) * ordinary + self.toxic * toxic)
        return np.log((toxic + both) / (ordinary + both))

    def words(self, k: list[np.ndarray]) -> list[np.ndarray]:
        """P_c(w), by class."""
        taken = 1.0 + sum(np.where(k[c] > 0, self.e[c], 0.0) for c in (0, 1))
        base = taken / (sum(e * v for e, v in zip(self.e, self.v, strict=True)) + self.kinds + 1)
        return [(np.maximum(k[c] - self.e[c], 0) + self.e[c] * self.v[c] * base) / self.k[c] if self.k[c] else base for c in (0, 1)]

    def pairs(self, n: list[np.ndarray], s: list[np.ndarray], t: list[np.ndarray], low: list[np.ndarray]) -> list[np.ndarray]:
        """P_c(w | u), by class."""
        return [np.where(s[c] > 0, (np.maximum(n[c] - self.d[c], 0) + self.d[c] * t[c] * low[c]) / np.maximum(s[c], 1), low[c]) for c in (0, 1)]


def parts_of(block: Block, counts: list[np.ndarray], seen: np.ndarray, prices: Prices) -> dict:
    """The parts of the evidence of the block's texts that have a word. ``counts``: of its words; ``seen``: of its bigrams."""
    low = prices.words(counts[:2])
    single = prices.log_ratio(*low)
    ends, out, at = np.cumsum(block.lengths), [], 0
    while at < len(ends):
        begin = ends[at] - block.lengths[at]
        to = max(at + 1, int(np.searchsorted(ends, begin + PRICED_WORDS, "right")))
        u, w = block.u[begin:ends[to - 1]], block.w[begin:ends[to - 1]]
        high = prices.pairs(seen[:, begin:ends[to - 1]], [x[u] for x in counts[2:4]], [x[u] for x in counts[4:6]], [x[w] for x in low])
        lengths = block.lengths[at:to]
        some = lengths > 0
        first = (np.cumsum(lengths) - lengths)[some]
        means = [block.keys[at:to][some]]
        for r in (single[w], prices.log_ratio(*high) - single[w]):
            r = r.astype(np.float32).astype(np.float64)
            weak = np.clip(r, -STRONG, STRONG)
            mean = lambda x: (np.add.reduceat(x, first) if len(first) else x[:0]) / lengths[some]  # noqa: B023, E731
            means += [np.sqrt(mean(np.maximum(r - weak, 0.0))), np.sqrt(mean(np.maximum(weak - r, 0.0))), mean(weak)]
        out.append(means)
        at = to
    return {c: np.concatenate([m[i] for m in out]) for i, c in enumerate(("_key", *PARTS))}


def priced(docs: DataFrame, model: Model, turn: int, turns: int) -> DataFrame:
    """_key and the parts of the evidence of the texts that have a word, of the partitions whose turn it is, checkpointed."""
    texts, written = blocks(of_turn(docs, turn, turns), "_key")
    salts = 1 + n_words(texts) // (ASKED_WORDS * len(model.starts))
    texts = texts.where("tokens > 0")
    starts, offsets, all_ = model.starts, model.offsets, int(model.offsets[-1])
    prices = Prices(model.d, model.e, model.k, model.v, model.kinds, model.toxic)
    words = answered(ask_words(texts, starts), model.word_parts, 6, salts)

    def ask_pairs(r: dict) -> dict:
        block = read_block(r)
        ids, _ = numbered(block, r["block"], words, offsets)
        return cells(r["block"], np.unique(codes(ids, block.u, block.w, all_)[1]), offsets[:-1] * offsets[-1])

    pairs = answered(map_rows(texts, ask_pairs, CELL), model.pair_parts, 2, salts)

    def rows(r: dict) -> dict:
        block = read_block(r)
        ids, counts = numbered(block, r["block"], words, offsets)
        held, _, _, n = read_answers(pairs, r["block"])
        both, code = codes(ids, block.u, block.w, all_)
        at = np.unique(code, return_inverse=True)[1]
        seen = np.zeros((2, len(block.w)), np.int64)
        for c, x in enumerate(n):
            of_pair = np.zeros(len(held), np.int64)
            of_pair[held] = x
            seen[c, both] = of_pair[at]
        return parts_of(block, counts, seen, prices)

    got = map_rows(texts, rows, f"_key long, {', '.join(f'{c} double' for c in PARTS)}").checkpoint()
    forget(texts.sparkSession, words, pairs, written)
    return got


def evidence(docs: DataFrame, model: Model, turns: int = 1) -> DataFrame:
    """The columns of ``docs`` beside the text, and the parts of the evidence of each row, strong ones as square roots; nan
    without words. With several ``turns`` the partitions of ``docs`` are worked off in as many jobs; it must have the same ones whenever it
    is read, as a table has."""
    docs = docs.withColumn("_key", F.xxhash64("doc_id", "text"))  # rows that repeat id and text have the same evidence
    got = [priced(docs, model, turn, turns) for turn in range(turns)]
    got = functools.reduce(DataFrame.unionByName, got).dropDuplicates(["_key"])
    nan = [F.coalesce(c, F.lit(float("nan"))).alias(c) for c in PARTS]
    return docs.drop("text").join(got, "_key", "left").select(*[c for c in docs.columns if c not in ("_key", "text")], *nan)


def fit_curve(e: np.ndarray, y: np.ndarray) -> tuple[list[float], float, float]:
    """Logistic curve on the parts of the evidence by Newton steps, lightly held towards zero weights: (weights,
    constant, toxic share)."""
    share = float((y.sum() + 1) / (len(y) + 2))
    keep = ~np.isnan(e[:, 0])
    e, y = e[keep], y[keep]
    if not len(y) or y.min() == y.max():
        return [0.0] * e.shape[1], float(np.log(share / (1 - share))), share
    spread = np.where(e.std(axis=0) > 1e-9, e.std(axis=0), 1.0)
    x = np.concatenate((e / spread, np.ones((len(e), 1))), axis=1)
    w, hold = np.zeros(x.shape[1]), np.array([0.05] * e.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = np.clip(w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (p - y) + hold * w), -50, 50)
    return (w[:-1] / spread).tolist(), float(w[-1]), share


def training(docs: DataFrame, marked: DataFrame, turns: int) -> list[DataFrame]:
    """(text, y) of the marked rows, texts that a class has several times once, for each turn. Which rows these are is settled
    without the texts, so that those of one turn at most are shuffled at a time."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("same"))
    own = (F.spark_partition_id() % turns).alias("turn")
    first = docs.select("doc_id", "same", own).join(marked, "doc_id").groupBy("y", "same").agg(F.min(F.struct("turn", "doc_id")).alias("row"))
    first = first.select("y", "same", "row.*").checkpoint()
    rest = fold("doc_id", HELD_OUT[0])
    docs = docs.where((rest != HELD_OUT[1]) & (rest != CURVE))
    return [of_turn(docs, i, turns).join(first.where(F.col("turn") == i), ["doc_id", "same"]).dropDuplicates(["y", "same"]).select("text", "y") for i in range(turns)]


def fit(docs: DataFrame, labels: DataFrame, max_curve: int = MAX_CURVE, turns: int = 1) -> Model:
    rest = fold("doc_id", HELD_OUT[0])
    marked = labels.where((rest != HELD_OUT[1]) & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("y"))
    docs = docs.select("doc_id", "text")
    model = fit_counts(*training(docs, marked.where(rest != CURVE), turns))
    sample = marked.where(rest == CURVE).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_curve)
    got = evidence(docs.join(F.broadcast(sample), "doc_id"), model).select("y", *PARTS).toArrow()
    e = np.array([got.column(c).to_pylist() for c in PARTS], float).reshape(len(PARTS), -1).T
    model.curve = fit_curve(e, np.array(got.column("y").to_pylist(), float))
    return model


def classify(docs: DataFrame, model: Model, turns: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted and the parts of the evidence; ``turns`` as in :func:`evidence`."""
    weights, constant, share = model.curve
    src = docs.select("doc_id", (fold("doc_id", HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), "text")
    e = evidence(src, model, turns)
    total = sum((F.lit(w) * F.col(c) for w, c in zip(weights, PARTS, strict=True)), F.lit(constant))
    score = F.when(F.isnan(PARTS[0]), F.lit(share)).otherwise(1 / (1 + F.exp(-total)))
    return e.withColumn("score", score).select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), *PARTS)


@register("op4_toxicity")
def q_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    turns = max(1, min(TURNS, docs.rdd.getNumPartitions() // TURN_PARTITIONS))
    return classify(docs, fit(docs, table(spark, sf_dir, "labels"), turns=turns), turns)
