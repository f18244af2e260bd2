"""Alignment of two tokenizers' tokens by the bytes they cover.

**Tokens.** A byte-level BPE (A) encodes a space and the text, a SentencePiece model (B) the text, to which it adds the space
itself; both without special tokens. Texts whose joined token bytes differ from space and text on either side (null and empty
ones too) have no tokens.

**In a task**, everything after the tokenizers is Arrow. Runs of documents become two list arrays; flattened, with each
token's parent index, token lengths are taken from a table and summed up along the run, less the sum before the parent:
the byte offset in its document where a token ends. Parent and end make a key. A full outer hash join (Acero) on the keys
gives, in key order, every place where a token of either side ends; the token of a side that does not end there is the next
one that does (nulls filled backward). Each such place is one link, since between neighbouring ends lies a piece of exactly
one A and one B token, and each pair of overlapping tokens has exactly one such piece. Places where both sides end close a group.

**Counts.** Links are coded as pairs of ids. About ``CHUNK_LINKS`` links make a chunk: one row with its documents, its distinct pairs and
their partial counts (``Table.group_by``), and the links as compressed places among the pairs. Chunks are written to the shared folder.
Spark merges the partial counts; each B id's highest count is a row per id of the vocabulary and is broadcast. The merged
counts return to the chunks by a join on the pairs, once a chunk however often it has a pair, and meet them in a cogroup.

Ties: all A ids that share a B id's highest count are best. Repeated rows are documents of their own. Very long texts are
encoded whole and make a run and a chunk of their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wordloom.llm.base import register, table
from wordloom.llm.packing import byte_letters
from wordloom.session import scratch_path

#: Text bytes that a task encodes and joins at a time (one document at least).
RUN_BYTES = 1_000_000
#: Links after which a chunk is closed, and documents.
CHUNK_LINKS = 4_000_000
CHUNK_DOCS = 65_536
SPACE = "▁"


class ByteBpe:
    """The first tokenizer. Texts of common Latin characters without very long gaps go through a faster encoder with the same
    vocabulary, others through the tokenizer's own library; both give the same ids."""

    #: Here all pattern libraries agree what letters, numbers and white space are.
    PLAIN = re.compile("[\t-\r -~ -ɏ]*")
    LONG = re.compile(r"\s{400}")

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        back = {c: b for b, c in enumerate(byte_letters())}
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        ranks = {bytes(back[c] for c in token): i for token, i in vocabulary.items()}
        self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * self.whole.get_vocab_size(with_added_tokens=True)
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, text: str) -> list[int]:
        if self.PLAIN.fullmatch(text) and not self.LONG.search(text):
            return self.fast.encode_ordinary(text)
        return self.whole.encode(text, add_special_tokens=False).ids


class Pieces:
    """The second tokenizer."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.bytes = [b"" if self.model.is_control(i) or self.model.is_unknown(i) else bytes([int(p[3:5], 16)]) if self.model.is_byte(i)
                      else p.replace(SPACE, " ").encode() for i, p in enumerate(self.model.id_to_piece(list(range(n))))]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Side:
    """A tokenizer with its tables: bytes and lengths by id, and the decimal ids with the marks that may follow."""

    def __init__(self, tokenizer, last: str):
        self.encode, self.size = tokenizer.encode, len(tokenizer.bytes)
        self.bytes = pa.array(tokenizer.bytes, pa.large_binary())
        self.lengths = pc.cast(pc.binary_length(self.bytes), pa.int64())
        self.spelt = [f"{i}{mark}" for i in range(self.size) for mark in (",", last)]

    def tokens(self, texts: list[str], expected: list[bytes]) -> list[list[int]]:
        """Ids of each text, None where their bytes are not the expected ones."""
        ids = [self.encode(t) for t in texts]
        lists = pa.array(ids, pa.large_list(pa.int32()))
        joined = self.bytes.take(lists.flatten())
        ends = np.frombuffer(joined.buffers()[1], "<i8", len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
        raw = memoryview(joined.buffers()[2] or b"").cast("B") if len(joined) else memoryview(b"")
        at = ends[np.frombuffer(lists.buffers()[1], "<i8", len(lists) + 1)].tolist()
        return [x if raw[a:b] == want else None for x, a, b, want in zip(ids, at, at[1:], expected, strict=False)]

    def ends(self, lists: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
        """(ids, parents, byte offset in its document where each token ends)."""
        ids, parents = pc.list_flatten(lists), pc.cast(pc.list_parent_indices(lists), pa.int64())
        upto = pc.cumulative_sum(self.lengths.take(ids))
        first = np.frombuffer(lists.buffers()[1], "<i8", len(lists) + 1)[:-1]
        before = np.concatenate(([0], upto.to_numpy()))[first]  # the sum before each document
        return ids, parents, pc.subtract(upto, pa.array(before).take(parents))


class Aligner:
    def __init__(self, a, b):
        self.a, self.b = Side(a, "|"), Side(b, ";")
        self.spelt = pa.array(self.a.spelt + self.b.spelt, pa.large_string())

    def align(self, texts: list[str | None]) -> dict:
        """For each text n_a, n_b, n_groups, n_links and groups_sha256; ``pairs``: a * size of B + b for each link, texts in a row."""
        given = [k for k, t in enumerate(texts) if t]
        whole = [f" {texts[k]}" for k in given]
        expected = [t.encode() for t in whole]
        got_a = self.a.tokens(whole, expected)
        got_b = self.b.tokens([texts[k] for k in given], expected)
        ids = {k: (x, y) for k, x, y in zip(given, got_a, got_b, strict=True) if x is not None and y is not None}
        none = ([], [])
        a, b = (pa.array([ids.get(k, none)[s] for k in range(len(texts))], pa.large_list(pa.int32())) for s in (0, 1))
        n = len(texts)
        sides = []
        for side, lists, name in ((self.a, a, "a"), (self.b, b, "b")):
            flat, parents, ends = side.ends(lists)
            sides.append(pa.table({"key": pc.add(pc.shift_left(parents, 40), ends), name: flat}))
        both = sides[0].join(sides[1], "key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
        has_a, has_b = (pc.is_valid(both[c]).to_numpy() for c in ("a", "b"))
        key = both["key"].to_numpy()
        doc, closes = key >> 40, has_a & has_b
        pairs = pc.add(pc.multiply(pc.cast(pc.fill_null_backward(both["a"]), pa.int64()), self.b.size), pc.cast(pc.fill_null_backward(both["b"]), pa.int64()))
        group = np.cumsum(closes) - closes
        return {"n_a": pc.list_value_length(a).to_numpy(), "n_b": pc.list_value_length(b).to_numpy(), "n_groups": np.bincount(doc[closes], minlength=n),
                "n_links": np.bincount(doc, minlength=n), "pairs": pairs.to_numpy(),
                "groups_sha256": self.digests(a, b, group[has_a], group[has_b])}

    def digests(self, a: pa.Array, b: pa.Array, group_a: np.ndarray, group_b: np.ndarray) -> list[str]:
        """The digest of each document's groups, spelt out. Tokens of a group stand together, A before B."""
        groups = int(group_a[-1]) + 1 if len(group_a) else 0
        a_upto, b_upto = (np.cumsum(np.bincount(g, minlength=groups)) for g in (group_a, group_b))
        out = np.empty(len(group_a) + len(group_b), np.int64)
        for ids, g, at, first in ((a, group_a, b_upto[group_a - 1] * (group_a > 0) if groups else group_a, 0), (b, group_b, a_upto[group_b] if groups else group_b, len(self.a.spelt))):
            last = np.append(g[1:] != g[:-1], True)[:len(g)]
            out[np.arange(len(g)) + at] = first + 2 * ids.flatten().to_numpy() + last
        spelt = self.spelt.take(pa.array(out))
        sizes = pc.list_value_length(a).to_numpy() + pc.list_value_length(b).to_numpy()
        at = np.concatenate(([0], np.cumsum(sizes)))
        if not len(spelt):
            return [""] * len(sizes)
        ends, raw = np.frombuffer(spelt.buffers()[1], "<i8", len(spelt) + 1)[at].tolist(), memoryview(spelt.buffers()[2])
        return [hashlib.sha256(raw[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:], strict=False)]


@functools.lru_cache(maxsize=1)
def load_aligner(a: str, b: str) -> Aligner:
    return Aligner(ByteBpe(a), Pieces(b))


STATS = {"n_a": "array<int>", "n_b": "array<int>", "n_groups": "array<int>", "n_links": "array<int>", "groups_sha256": "array<string>"}
CHUNKS = ("chunk long, doc_id array<long>, " + ", ".join(f"{c} {t}" for c, t in STATS.items())
          + ", pairs array<long>, counts array<long>, links binary")


def runs_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in stretches of about ``RUN_BYTES`` of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + RUN_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def chunks(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Rows of ``CHUNKS``. ``a`` and ``b`` are tokenizer files that every executor can read."""
    struct = StructType.fromDDL(CHUNKS)

    def run(batches):
        aligner, part, number, arrow = load_aligner(a, b), TaskContext.get().partitionId(), 0, to_arrow_schema(struct)
        ids: list[int | None] = []
        held: list[dict] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            codes = pa.array(np.concatenate([h["pairs"] for h in held])).dictionary_encode()
            counted = pa.table({"place": codes.indices}).group_by("place", use_threads=False).aggregate([([], "count_all")])
            place, counts = counted["place"].to_numpy(), np.zeros(len(codes.dictionary), np.int64)
            counts[place] = counted["count_all"].to_numpy()
            order = np.argsort(codes.dictionary.to_numpy())
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            links = pa.compress(rank[codes.indices.to_numpy()].tobytes(), "zstd", asbytes=True)
            row = {"chunk": (part << 32) + number, "doc_id": ids, "pairs": codes.dictionary.to_numpy()[order], "counts": counts[order], "links": links,
                   **{c: np.concatenate([h[c] for h in held]) for c in STATS}}
            number += 1
            out = pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in arrow], schema=arrow)
            ids.clear()
            held.clear()
            return out

        links = 0
        for batch in batches:
            for some in runs_of(batch):
                ids += some.column("doc_id").to_pylist()
                held.append(aligner.align(some.column("text").to_pylist()))
                links += len(held[-1]["pairs"])
                if links >= CHUNK_LINKS or len(ids) >= CHUNK_DOCS:
                    yield flush()
                    links = 0
        if held:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, struct)


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """(pair, count, best) over the corpus: best if no pair with the same B id has a higher count."""
    each = found.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("x.pairs", "x.counts")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count")).withColumn("b", F.col("pair") % size_b).checkpoint()
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))  # a row for each id of B at most
    return counts.join(F.broadcast(highest), "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def measured(found: DataFrame, counts: DataFrame) -> DataFrame:
    """A row of ``OUT`` for each document of the chunks."""
    arrow = to_arrow_schema(StructType.fromDDL(OUT))

    def solve(chunk: pa.Table, prices: pa.Table) -> pa.Table:
        row = chunk.select(["doc_id", *STATS, "links"]).to_pylist()[0] if chunk.num_rows else None
        if row is None:
            return arrow.empty_table()
        prices = prices.sort_by("pair")
        n = np.array(row["n_links"], np.int64)
        links = np.frombuffer(pa.decompress(row["links"], 4 * int(n.sum()), "zstd"), "<u4") if n.sum() else np.zeros(0, np.uint32)
        end = np.cumsum(n)

        def sums(of: np.ndarray) -> np.ndarray:
            upto = np.concatenate(([0], np.cumsum(of[links]))) if len(links) else np.zeros(1, np.int64)
            return upto[end] - upto[end - n]

        return pa.table({**{c: row[c] for c in ("doc_id", *STATS)}, "n_best": sums(prices["best"].to_numpy().astype(np.int64)), "count_sum": sums(prices["count"].to_numpy())}
                        ).select(arrow.names).cast(arrow)

    asked = found.select(F.col("chunk").alias("of"), F.explode("pairs").alias("pair")).join(counts, "pair").select("of", "pair", "count", "best")
    return found.groupBy("chunk").cogroup(asked.groupBy("of")).applyInArrow(solve, OUT)


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Per document the tokens of both sides, groups, links, how many links are best, and the sum of the links' counts."""
    path = scratch_path(docs.sparkSession, "alignment")
    chunks(docs, a, b).write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    return measured(found, pair_counts(found, load_aligner(a, b).b.size))


@register("op11_alignment")
def q_alignment(spark, sf_dir):
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
