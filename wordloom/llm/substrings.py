"""Removal of long repeated substrings by longest-previous-factor arrays.

Texts are UTF-8 bytes. A byte is repeated if it lies in a ``LENGTH``-byte string that starts anywhere else too, in
the same document or another. ``keep="none"`` finds all such bytes; ``keep="first"`` leaves alone each string's first
occurrence, in the order of ids and positions.

**Anchors.** Each ``LENGTH``-byte window has an anchor: of the ``GRAM``-byte strings in it, the one with the smallest
hash. It depends on the window's content alone, so equal windows have equal anchors at equal distances, and an
anchor answers for a run of neighbouring windows. Only anchors that occur twice go on.

**Equal surroundings.** Anchors whose whole surroundings (all bytes of any window around them) are equal are counted
in an aggregation; all their windows are repeated. One of them stands for the rest below.

**Suffix order.** For anchors with different surroundings, the bytes to the left and right are brought together
by anchor and laid out in document order. A suffix array of that text (prefix doubling), the nearest
smaller and larger positions before and after in suffix order, and the common prefixes with them give for
each window the longest previous factor, and likewise the longest next one; a window is repeated if either spans
it. All suffixes are ranked, but only those at which a window starts are compared with their neighbours. The anchor's
own bytes are equal throughout a group and count as one symbol.

**Common anchors.** A group of more than ``GROUP`` different surroundings (2 MB at most) is not brought into one task: its windows are
hashed one by one and counted in an aggregation, which combines before it shuffles.

Null texts are empty; texts shorter than ``LENGTH`` have no window and lose nothing. Rows that repeat id and text are
copies of one another for ``keep="none"``; ``keep="first"`` treats them as one. An empty table gives an empty result.
Columns beside doc_id and text are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.base import join_hot, map_slices, mix, register, table, utf8

LENGTH = 400
GRAM = 200
GROUP = 4096
#: Bytes of surroundings that a task puts in suffix order at a time.
CHUNK = 1_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
POSITION_BITS = 28
#: Windows whose anchors are found at a time; longer texts go in stretches, so memory has a bound too.
STRETCH = 1 << 24


class Powers:
    """BASE^i and BASE^-i modulo 2^64, as far as they have been needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, BASE))), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, INVERSE))), dtype=np.uint64)
        return self.up[:n], self.down[:n]


def anchors(data: bytes, powers: Powers, length: int = LENGTH, gram: int = GRAM):
    """(position, hash of the gram there, hash of the text around it, least and largest distance from the start
    of a window to it) of the anchors of all ``length``-byte windows."""
    n, reach, parts = len(data), length - gram, []
    for s in range(0, n - length + 1, STRETCH):
        e, begin = min(s + STRETCH, n - length + 1), max(s - reach, 0)
        pos, a, u, lo, hi = _anchors_of(data[begin:e + reach + length], powers, length, gram, s - begin, e - begin)
        parts.append((pos + begin, a, u, lo, hi))
    if not parts:
        return (np.zeros(0, np.int64),) * 5
    pos, a, u, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
    first = np.concatenate(([True], pos[1:] != pos[:-1]))  # a stretch may begin at the anchor with which the last one ends
    return pos[first], a[first], u[first], np.minimum.reduceat(lo, np.flatnonzero(first)), np.maximum.reduceat(hi, np.flatnonzero(first))


def _anchors_of(data: bytes, powers: Powers, length: int, gram: int, begin: int, stop: int):
    """The same for the windows that start at ``begin`` up to ``stop``; ``data`` holds all that lies around their anchors."""
    n, reach = len(data), length - gram
    up, down = powers.get(n + 1)
    b = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(b * up[:n], dtype=np.uint64)))
    grams = mix((sums[gram:] - sums[:n - gram + 1]) * down[:n - gram + 1])
    w = reach + 1
    keys = (grams >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)) | np.arange(len(grams), dtype=np.uint64)
    pad = -len(keys) % w
    block = np.concatenate((keys, np.full(pad, np.uint64(2**64 - 1)))).reshape(-1, w)
    left = np.minimum.accumulate(block, axis=1).reshape(-1)
    right = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    at = (np.minimum(right[begin:stop], left[reach + begin:reach + stop]) & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    last = np.concatenate((first[1:] - 1, [stop - begin - 1]))
    pos = at[first]
    first, last = first + begin, last + begin
    begins, ends = np.maximum(pos - reach, 0), np.minimum(pos + length, n)
    around = mix((sums[ends] - sums[begins]) * down[begins] + ((pos - begins) << 20 | (ends - pos)).astype(np.uint64) * BASE)
    return pos, grams[pos].view(np.int64), around.view(np.int64), pos - last, pos - first


def suffix_ranks(symbols: np.ndarray, depth: int) -> tuple[list[np.ndarray], int]:
    """Prefix doubling, from as many symbols as fit 63 bits: (ranks, m), where the k-th array ranks all suffixes by their first
    m * 2^k symbols, the last by ``depth``. A rank is the number of smaller suffixes; one that no other suffix shares is final,
    so only the rest is sorted again. Past the end lie symbols smaller than all others."""
    n, bits = len(symbols), max(int(symbols.max(initial=0)) + 1, 1).bit_length()
    m = min(1 << (63 // bits).bit_length() - 1, 1 << depth.bit_length() - 1)
    padded = np.concatenate((symbols + 1, np.zeros(m - 1, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(m):
        key = key << bits | padded[k:k + n]
    rank, todo, ranks, have = np.zeros(n, np.int32), np.arange(n), [], m
    while True:
        order = np.argsort(key)
        todo, key = todo[order], key[order]
        new = np.ones(len(todo), bool)
        new[1:] = key[1:] != key[:-1]
        old = rank[todo]
        parted = np.ones(len(todo), bool)
        parted[1:] = old[1:] != old[:-1]
        at = np.arange(len(todo))
        rank = rank.copy()
        rank[todo] = old + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(parted, at, 0))
        ranks.append(rank)
        if have >= depth:
            return ranks, m
        shared = ~new
        shared[:-1] |= ~new[1:]
        todo = todo[shared]
        step = min(have, depth - have)
        then = np.where(todo + step < n, rank[np.minimum(todo + step, n - 1)] + 1, 0)
        key = rank[todo].astype(np.int64) * (n + 1) + then
        have += step


def common_prefix(symbols: np.ndarray, ranks: list[np.ndarray], m: int, i: np.ndarray, j: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at i and j, up to ``depth``."""
    n = len(symbols)
    got = np.where(ranks[-1][i] == ranks[-1][j], depth, 0)
    x, y, open_ = i, j, got < depth
    for k in range(len(ranks) - 2, -1, -1):
        inside = open_ & (np.maximum(x, y) + (m << k) <= n)
        same = inside & (ranks[k][np.minimum(x, n - 1)] == ranks[k][np.minimum(y, n - 1)])
        got, x, y = (v + np.where(same, m << k, 0) for v in (got, x, y))
    same = open_
    for _ in range(m - 1):
        same = same & (np.maximum(x, y) < n)
        same = same & (symbols[np.minimum(x, n - 1)] == symbols[np.minimum(y, n - 1)])
        got, x, y = (v + same for v in (got, x, y))
    return np.minimum(got, depth)


def nearest_smaller(p: np.ndarray, adjacent: np.ndarray) -> np.ndarray:
    """For each place of the suffix order the length of what its suffix has in common with the one at the nearest place before
    it with a smaller value of ``p``, 0 without such a place. ``adjacent`` has these lengths for the places right before. Jumps
    along the answers so far; what two suffixes have in common is the least of what lies between them."""
    at, common = np.arange(-1, len(p) - 1), adjacent.copy()
    todo = np.arange(len(p))
    while len(todo):
        todo = todo[at[todo] >= 0]
        todo = todo[p[at[todo]] > p[todo]]
        via = at[todo]
        common[todo] = np.minimum(common[todo], common[via])
        at[todo] = at[via]
    return common


def factors(symbols: np.ndarray, depth: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(longest previous factor, longest next factor) at every position, up to ``depth``; with ``at`` (ascending) at these
    positions alone, of the strings that start at them: a sparse suffix array has no others."""
    ranks, m = suffix_ranks(symbols, depth)
    at = np.arange(len(symbols)) if at is None else at
    order = np.argsort(ranks[-1][at], kind="stable")  # the suffix array
    sorted_ = at[order]
    before = np.zeros(len(order), np.int32)
    before[1:] = common_prefix(symbols, ranks, m, sorted_[1:], sorted_[:-1], depth)
    after = np.zeros(len(order), np.int32)
    after[1:] = before[:0:-1]

    def longest(p: np.ndarray) -> np.ndarray:
        return np.maximum(nearest_smaller(p, before), nearest_smaller(p[::-1], after)[::-1])

    lpf, lnf = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    lpf[order], lnf[order] = longest(order), longest(-order)
    return lpf, lnf


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true values, as (first, last)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


ANCHORS = "key long, doc_id long, pos int, a long, u long, lo int, hi int"
STARTS = "key long, first long, last long"


def _anchors(keyed: DataFrame, only_hash: bool, length: int, gram: int) -> DataFrame:
    def setup():
        powers = Powers()

        def rows(batch: pa.RecordBatch) -> dict:
            got = [anchors(t, powers, length, gram) for t in utf8(batch.column("text"))]
            pos, a, u, lo, hi = (np.concatenate([g[i] for g in got]) for i in range(5))
            if only_hash:
                return {"a": a}
            n = [len(g[0]) for g in got]
            return {"key": np.repeat(batch.column("key").to_numpy(), n), "doc_id": np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), n),
                    "pos": pos, "a": a, "u": u, "lo": lo, "hi": hi}
        return rows

    src = keyed.select("key", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text")
    return map_slices(src, setup, "a long" if only_hash else ANCHORS)


def _surroundings(keyed: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """For each wanted anchor the bytes of its windows before and after the gram."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("a", "doc_id", "pos", "lo", "hi", "alone")).alias("at"))

    def rows(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("key", "a", "doc_id", "pos", "lo", "hi", "alone", "left", "right")}
        for key, data, at in zip(batch.column("key").to_pylist(), utf8(batch.column("text")), batch.column("at").to_pylist(), strict=True):
            for x in at:
                p = x["pos"]
                for c, v in {"key": key, "left": data[p - x["hi"]:p], "right": data[p + gram:p - x["lo"] + length], **x}.items():
                    out[c].append(v)
        return out

    return map_slices(keyed.select("key", "text").join(lists, "key"), lambda: rows, "key long, a long, doc_id long, pos int, lo int, hi int, alone boolean, left binary, right binary")


def _by_suffix_order(around: DataFrame, first_only: bool, width: int) -> DataFrame:
    """Runs of repeated window starts, from the surroundings of groups that fit a task."""
    depth = width + 1  # the bytes of a window beside the gram, which counts as one

    def solve(rows: list[dict]) -> list[tuple[int, int, int]]:
        rows.sort(key=lambda r: (r["doc_id"], r["key"], r["pos"]))
        name = {a: 256 + i for i, a in enumerate(dict.fromkeys(r["a"] for r in rows))}
        parts, starts, at = [], [], 0
        for i, r in enumerate(rows):
            left, right = np.frombuffer(r["left"], np.uint8), np.frombuffer(r["right"], np.uint8)
            parts += [left, [name[r["a"]]], right, [256 + len(rows) + i]]
            starts.append(at)
            at += len(left) + len(right) + 2
        # Only where a window starts can one recur: its anchor is named at the same distance from its start.
        n = np.array([r["hi"] - r["lo"] + 1 for r in rows])
        first = np.cumsum(n) - n
        lpf, lnf = factors(np.concatenate(parts).astype(np.int64), depth, np.arange(n.sum()) + np.repeat(np.array(starts) - first, n))
        hit = lpf >= depth if first_only else (lpf >= depth) | (lnf >= depth)
        out = []
        for at, size, r in zip(first.tolist(), n.tolist(), rows, strict=True):
            begin = r["pos"] - r["hi"]
            if r["alone"] or first_only:
                out += [(r["key"], begin + x, begin + y) for x, y in runs(hit[at:at + size])]
        return out

    def run(batches):
        held, size, last, place = [], 0, None, None

        def flush():
            got = solve(held)
            return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.int64()) for i in range(3)], names=["key", "first", "last"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for r in batch.slice(at, 1024).to_pylist():
                    if place == (r["a"], r["key"], r["pos"]):  # the same place in a row that repeats id and text
                        continue
                    place = r["a"], r["key"], r["pos"]
                    if size >= CHUNK and r["a"] != last:  # groups stay whole
                        yield flush()
                        held.clear()
                        size = 0
                    held.append(r)
                    size += len(r["left"]) + len(r["right"]) + 2
                    last = r["a"]
        if held:
            yield flush()

    together = around.repartition("a").sortWithinPartitions("a", "key", "pos")
    return together.select("key", "a", "doc_id", "pos", "lo", "hi", "alone", "left", "right").mapInArrow(run, STARTS)


def _by_counting(around: DataFrame, first_only: bool, width: int) -> DataFrame:
    """The same for the groups of common anchors: each window is hashed and counted."""
    def setup():
        powers = Powers()

        def rows(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in ("key", "doc_id", "start", "w", "alone")}
            for r in batch.to_pylist():
                b = np.frombuffer(r["left"] + r["right"], np.uint8).astype(np.uint64) + np.uint64(1)
                up, down = powers.get(len(b) + 1)
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(b * up[:len(b)], dtype=np.uint64)))
                n = r["hi"] - r["lo"] + 1
                distance = np.arange(r["hi"], r["lo"] - 1, -1).astype(np.uint64)
                w = mix(mix((sums[width:width + n] - sums[:n]) * down[:n] + distance * BASE) ^ np.uint64(r["a"] % 2**64))
                out["w"].append(w.view(np.int64))
                out["start"].append(np.arange(n) + r["pos"] - r["hi"])
                for c in ("key", "doc_id", "alone"):
                    out[c].append(np.full(n, r[c]))
            return {c: np.concatenate(v) for c, v in out.items()}
        return rows

    windows = map_slices(around, setup, "key long, doc_id long, start long, w long, alone boolean")
    counts = windows.groupBy("w").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "start")).alias("one")).where("n > 1")
    hit = windows.join(counts, "w")
    hit = hit.where(F.struct("doc_id", "key", "start") != F.col("one")) if first_only else hit.where("alone")
    return hit.select("key", F.col("start").alias("first"), F.col("start").alias("last"))


def repeated_spans(docs: DataFrame, keep: str = "none", length: int = LENGTH, gram: int | None = None) -> DataFrame:
    """doc_id, text, spans (array of begin, end: the maximal runs of bytes in repeated strings of ``length`` bytes) and rest (a
    struct of all other columns) for each row. ``gram`` (half the length) is the length of the anchors: a shorter one leaves
    fewer of them, but more that recur by chance."""
    gram = gram or length // 2
    first_only = {"none": False, "first": True}[keep]
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text", (F.struct(*rest) if rest else F.lit(None)).alias("rest"))

    twice = _anchors(keyed, True, length, gram).groupBy("a").agg(F.count("*").alias("n")).where("n > 1").checkpoint()
    found = join_hot(_anchors(keyed, False, length, gram), twice, "a", "left_semi").checkpoint()
    kinds = found.groupBy("a", "u").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "pos", "lo", "hi")).alias("one"))
    kinds = kinds.checkpoint()
    equal = found.join(kinds.where("n > 1").select("a", "u", "one"), ["a", "u"])
    if first_only:
        equal = equal.where((F.col("key") != F.col("one.key")) | (F.col("pos") != F.col("one.pos")))
    equal = equal.select("key", (F.col("pos") - F.col("hi")).cast("long").alias("first"), (F.col("pos") - F.col("lo")).cast("long").alias("last"))

    groups = kinds.groupBy("a").agg(F.count("*").alias("n"), F.count("*").alias("kinds")).where("n > 1").checkpoint()
    wanted = join_hot(kinds, groups, "a").select("a", "one.*", (F.col("n") == 1).alias("alone"), "kinds").checkpoint()
    spans = equal
    for some, solve in ((wanted.where(F.col("kinds") <= GROUP), _by_suffix_order), (wanted.where(F.col("kinds") > GROUP), _by_counting)):
        spans = spans.unionByName(solve(_surroundings(keyed, some.drop("kinds"), length, gram), first_only, length - gram))
    lists = spans.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("starts"))

    def merge(batch: pa.RecordBatch) -> dict:
        out = []
        for starts in batch.column("starts").to_pylist():
            merged = []
            for x, y in sorted((s["first"], s["last"] + length) for s in starts):
                if merged and x <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], y)
                else:
                    merged.append({"begin": x, "end": y})
            out.append(merged)
        return {"key": batch.column("key"), "spans": out}

    merged = map_slices(lists, lambda: merge, "key long, spans array<struct<begin long, end long>>")
    return keyed.join(merged, "key", "left").select("doc_id", "text", F.coalesce("spans", F.expr("array()")).alias("spans"), "rest")


def without(data: bytes, spans: list[dict]) -> bytes:
    at, out = 0, []
    for s in spans:
        out.append(data[at:s["begin"]])
        at = s["end"]
    return b"".join([*out, data[at:]])


def cut(docs: DataFrame, keep: str = "first", length: int = LENGTH, gram: int | None = None) -> DataFrame:
    """The rows of ``docs`` with the repeated bytes taken out of their texts; what is left of a character that loses
    some of its bytes goes too. ``n_chars``, if there is such a column, is counted anew."""
    found = repeated_spans(docs, keep, length, gram)

    def rows(batch: pa.RecordBatch) -> dict:
        left = [without(t, x).decode("utf-8", "ignore") if x else t.decode() for t, x in zip(utf8(batch.column("text")), batch.column("spans").to_pylist(), strict=True)]
        return {"doc_id": batch.column("doc_id"), "left": [t if given else None for t, given in zip(left, batch.column("text").is_valid().to_pylist(), strict=True)],
                "rest": batch.column("rest")}

    kind = dict(found.dtypes)
    out = map_slices(found, lambda: rows, f"doc_id {kind['doc_id']}, left string, rest {kind['rest']}")
    column = {"doc_id": F.col("doc_id"), "text": F.col("left"), "n_chars": F.length("left").cast("long")}
    return out.select(*[column.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


@register("op10_suffix_dedup")
def q_suffix_dedup(spark, sf_dir):
    def rows(batch: pa.RecordBatch) -> dict:
        texts, spans = utf8(batch.column("text")), batch.column("spans").to_pylist()
        return {"doc_id": batch.column("doc_id"), "n_bytes": list(map(len, texts)), "n_removed": [sum(s["end"] - s["begin"] for s in x) for x in spans],
                "n_spans": list(map(len, spans)), "kept_sha256": [hashlib.sha256(without(t, x)).hexdigest() for t, x in zip(texts, spans, strict=True)]}

    found = repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return map_slices(found.select("doc_id", "text", "spans"), lambda: rows,
                      "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
