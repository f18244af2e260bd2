"""Token ids in binary files of directly addressable codes.

**Codes.** An id is cut into chunks, lowest bits first, of the widths of the file's levels. Level 0 has a chunk of every id;
a bit per chunk says whether the id goes on, and level k + 1 has the chunks of those that do, in the same order. A rank
directory over each bitmap (ones before every 512 bits, and within these before every 64) gives the place of an id's next
chunk, so any token is read from one place per level, without decoding others. The widths, multiples of four bits, are
those that make the file smallest, found from the counts of ids by their number of bits.

**Files.** Documents are range-partitioned and sorted by id; each task encodes its range and writes files of about
``FILE_TOKENS`` tokens (a document is never split). A file holds a header, the table of its documents (id, end) and the
levels. Its name holds a random part; what counts is the index, a Parquet table written by Spark that names
the files of the tasks that were committed, with the number of tokens before each file. So retried and speculative tasks
leave files that no index names. Files are written through ``pyarrow.fs`` (local, hdfs, s3, gs paths) to the shared
folder and read back by Spark's ``binaryFile`` source.

**Tokens.** Texts of common Latin characters are cut into the pieces that the tokenizer merges within (words, digits, runs of
marks); the pieces of a slice of documents are dictionary-encoded, each distinct one is encoded by the library once, and the
ids are gathered back. Other texts, and those with a special token's string, go to the library whole.

A null or empty text has only the end id. Rows without an id come first; rows that repeat an id are documents of their own,
in the order of a hash of the text. An empty table gives no files and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wordloom.llm.base import map_slices, register, table
from wordloom.llm.packing import byte_letters
from wordloom.operators.labels import running_total
from wordloom.session import scratch_path

END = 2
#: Tokens after which a task begins another file.
FILE_TOKENS = 2_000_000
#: Documents that a task encodes at a time.
DOCS = 1024
#: Distinct pieces whose ids a worker remembers before it forgets those that the slice at hand does not have.
CACHE_PIECES = 200_000
MAGIC = b"WLDAC001"
BLOCK, WORD = 512, 64


class Bits:
    """A bitmap with a rank directory."""

    def __init__(self, words: np.ndarray, blocks: np.ndarray, inside: np.ndarray):
        self.words, self.blocks, self.inside = words, blocks, inside

    @classmethod
    def of(cls, flags: np.ndarray) -> Bits:
        packed = np.packbits(flags, bitorder="little")
        words = np.concatenate((packed, np.zeros(-len(packed) % 64 + 64, np.uint8))).view("<u8")  # whole blocks, and one more for rank(n)
        before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1]
        blocks = before[::BLOCK // WORD]
        return cls(words, blocks.astype("<u4"), (before - np.repeat(blocks, BLOCK // WORD)).astype("<u2"))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def range(self, i: int, j: int) -> np.ndarray:
        begin = i // 8
        return np.unpackbits(self.words.view(np.uint8)[begin:-(-j // 8)], bitorder="little")[i - 8 * begin:j - 8 * begin].astype(bool)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        below = self.words[i >> 6] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.blocks[i >> 9].astype(np.int64) + self.inside[i >> 6] + np.bitwise_count(below)


def split_chunks(chunks: np.ndarray, width: int) -> list[np.ndarray]:
    """Chunks of ``width`` bits as whole bytes, one plane each, and the last four bits two to a byte."""
    planes = [(chunks >> np.uint32(8 * k)).astype(np.uint8) for k in range(width // 8)]
    if width % 8:
        half = (chunks >> np.uint32(width - 4)).astype(np.uint8)
        half = np.concatenate((half, np.zeros(len(half) % 2, np.uint8)))
        planes.append(half[::2] | half[1::2] << np.uint8(4))
    return planes


def read_chunks(planes: list[np.ndarray], width: int, i: np.ndarray) -> np.ndarray:
    out = np.zeros(len(i), np.uint32)
    for k in range(width // 8):
        out |= planes[k][i].astype(np.uint32) << np.uint32(8 * k)
    if width % 8:
        half = planes[-1][i >> 1] >> ((i & 1) * 4).astype(np.uint8) & np.uint8(15)
        out |= half.astype(np.uint32) << np.uint32(width - 4)
    return out


def best_widths(ids: np.ndarray) -> list[int]:
    """Widths of the levels, multiples of four, with the fewest bits in all; every level but the last costs a bit a chunk more."""
    steps = max(1, -(-int(ids.max(initial=0)).bit_length() // 4))
    above = [int((ids >> np.uint32(4 * k) != 0).sum()) if k else len(ids) for k in range(steps)]  # ids with chunks from step k on
    best: list[tuple[int, list[int]]] = [(0, [])] * (steps + 1)
    for k in range(steps - 1, -1, -1):
        best[k] = min((above[k] * (4 * (m - k) + (m < steps)) + best[m][0], [4 * (m - k), *best[m][1]]) for m in range(k + 1, steps + 1))
    return best[0][1]


def write_codes(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> bytes:
    """The bytes of a file: documents with their ends, and the ids of all of them in a row."""
    widths, sections = best_widths(ids), {}
    sections["doc_ids"] = np.array([i or 0 for i in doc_ids], "<i8")
    sections["no_id"] = np.packbits(np.array([i is None for i in doc_ids], bool), bitorder="little")
    sections["ends"] = ends.astype("<i8")
    rest = ids.astype(np.uint32)
    for level, width in enumerate(widths):
        for k, plane in enumerate(split_chunks(rest & np.uint32((1 << width) - 1) if width < 32 else rest, width)):
            sections[f"chunks{level}.{k}"] = plane
        if level + 1 < len(widths):
            rest = rest >> np.uint32(width)
            bits = Bits.of(rest != 0)
            sections |= {f"words{level}": bits.words, f"blocks{level}": bits.blocks, f"inside{level}": bits.inside}
            rest = rest[rest != 0]
    places, parts, at = {}, [], 0
    for name, x in sections.items():
        raw = x.tobytes()
        places[name] = [at, x.dtype.str, len(x)]
        parts += [raw, bytes(-len(raw) % 8)]
        at += len(raw) + -len(raw) % 8
    body = b"".join(parts)
    head = json.dumps({"tokens": len(ids), "documents": len(doc_ids), "widths": widths, "crc32": zlib.crc32(body), "sections": places}).encode()
    head += b" " * (-len(head) % 8)
    return MAGIC + struct.pack("<q", len(head)) + head + body


class Codes:
    """A file, read. ``data`` may be a memory map: only what is asked for is touched."""

    def __init__(self, data, check: bool = False):
        data = memoryview(data)
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        size = struct.unpack("<q", data[8:16])[0]
        head = json.loads(bytes(data[16:16 + size]))
        body = data[16 + size:]
        if check and zlib.crc32(body) != head["crc32"]:
            raise ValueError("the file is damaged")
        part = {name: np.frombuffer(body, kind, n, at) for name, (at, kind, n) in head["sections"].items()}
        self.n, self.widths, self.ends = head["tokens"], head["widths"], part["ends"]
        none = np.unpackbits(part["no_id"], bitorder="little")[:head["documents"]]
        self.doc_ids = [None if x else int(i) for i, x in zip(part["doc_ids"], none, strict=True)]
        self.chunks = [[part[f"chunks{k}.{j}"] for j in range(-(-w // 8))] for k, w in enumerate(self.widths)]
        self.bits = [Bits(*[part[f"{x}{k}"] for x in ("words", "blocks", "inside")]) for k in range(len(self.widths) - 1)]

    def at(self, i) -> np.ndarray:
        """The ids at the given places, in any order."""
        i = np.asarray(i, np.int64)
        if len(i) and (i.min() < 0 or i.max() >= self.n):
            raise IndexError("no such token")
        out, mine, shift = np.zeros(len(i), np.uint32), np.arange(len(i)), 0
        for level, width in enumerate(self.widths):
            out[mine] |= read_chunks(self.chunks[level], width, i) << np.uint32(shift)
            if level < len(self.bits):
                on = self.bits[level].get(i)
                i, mine, shift = self.bits[level].rank(i[on]), mine[on], shift + width
        return out

    def range(self, i: int, j: int) -> np.ndarray:
        """The ids from place i up to j: their chunks lie together on every level."""
        def level(k: int, i: int, j: int) -> np.ndarray:
            out = read_chunks(self.chunks[k], self.widths[k], np.arange(i, j))
            if k < len(self.bits):
                on = self.bits[k].range(i, j)
                if on.any():
                    x, y = self.bits[k].rank(np.array([i, j])).tolist()
                    out[on] |= level(k + 1, x, y) << np.uint32(self.widths[k])
            return out

        return level(0, i, j)

    def document(self, k: int) -> np.ndarray:
        return self.range(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


class PieceIds(dict):
    """piece (a run of letters, a digit, a run of marks, lower case) -> its ids as little-endian 32-bit integers."""

    LETTERS = "a-zß-öø-įı-ɏ"
    #: Texts of these characters alone are cut here: their case, order and classes are the same in all libraries.
    PLAIN = re.compile("[\\t-\\r -~À-ÖØ-öø-įı-ɏ]*")
    PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[!-&(-/:-@\[-`{{-~']+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.specials = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        #: The same merges over pieces that are cut already and spelt in its alphabet of bytes.
        self.merges = Tokenizer(self.whole.model)
        self.alphabet = str.maketrans(dict(enumerate(byte_letters())))
        self.ends = np.array([(self.whole.id_to_token(i) or "").endswith("</w>") for i in range(self.whole.get_vocab_size())])

    def learn(self, pieces: list[str]) -> None:
        """Every piece's last id, and no other, is one that ends a word. Pieces hold no blanks, so those of ASCII are spelt as they are."""
        spelt = [p if p.isascii() else p.encode().decode("latin-1").translate(self.alphabet) for p in pieces]
        ids = np.array(self.merges.encode_batch_fast([spelt], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        end = np.flatnonzero(self.ends[ids]) + 1
        if len(end) != len(pieces):
            raise ValueError("the tokenizer has no ids that end words")
        raw = ids.tobytes()
        self.update(zip(pieces, [raw[4 * a:4 * b] for a, b in zip([0, *end[:-1].tolist()], end.tolist(), strict=True)], strict=True))

    def is_plain(self, text: str) -> bool:
        return self.PLAIN.fullmatch(text) is not None and not any(x in text for x in self.specials)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, how many each text has)."""
        texts = [t or "" for t in texts.to_pylist()]
        plain = [self.is_plain(t) for t in texts]
        cut = [self.PIECES.findall(t.lower()) if p else [] for t, p in zip(texts, plain, strict=True)]
        flat = pa.array(list(itertools.chain.from_iterable(cut)), pa.large_string()).dictionary_encode()
        distinct = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        unknown = [w for w in distinct if w not in self]
        if len(self) + len(unknown) > CACHE_PIECES:
            known = {w: self[w] for w in distinct if w in self}
            self.clear()
            self.update(known)
        if unknown:
            self.learn(unknown)
        spelt = pa.array(list(map(self.__getitem__, distinct)), pa.large_binary()).take(flat.indices)
        ends = np.frombuffer(spelt.buffers()[1], "<i8", len(spelt) + 1) if len(spelt) else np.zeros(1, np.int64)
        ids = np.frombuffer(spelt.buffers()[2], "<u4", int(ends[-1]) // 4) if len(spelt) else np.zeros(0, "<u4")
        sizes = np.diff(ends[np.concatenate(([0], np.cumsum([len(c) for c in cut], dtype=np.int64)))] // 4)
        other = [k for k, p in enumerate(plain) if not p]
        if other:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for k, e in zip(other, self.whole.encode_batch_fast([texts[k] for k in other], add_special_tokens=False), strict=True):
                parts[k] = np.array(e.ids, "<u4")
            ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, sizes


@functools.lru_cache(maxsize=1)
def load_pieces(path: str) -> PieceIds:
    return PieceIds(path)


def put(folder: str, name: str, data: bytes) -> None:
    """A new file in the shared folder."""
    where, root = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", folder))
    where.create_dir(root, recursive=True)
    with where.open_output_stream(f"{root.rstrip('/')}/{name}") as f:
        f.write(data)


INDEX = "part int, number int, file string, documents long, tokens long"


def write(docs: DataFrame, tokenizer: str, folder: str, end: int = END, file_tokens: int = FILE_TOKENS) -> None:
    """Encode all documents and write them under ``folder``: ``ids/`` and ``index/``. ``tokenizer`` is a file that every
    executor can read (it comes with an installed package)."""
    files, struct_ = f"{folder}/ids", StructType.fromDDL(INDEX)

    def run(batches):
        pieces, part, number = load_pieces(tokenizer), TaskContext.get().partitionId(), 0
        held, ids, sizes, size = [], [], [], 0
        arrow = to_arrow_schema(struct_)

        def flush():
            nonlocal number, held, ids, sizes, size
            name = f"{part:06d}-{number:06d}-{uuid.uuid4().hex}.dac"
            put(files, name, write_codes(np.concatenate(ids), held, np.cumsum(np.concatenate(sizes))))
            row = pa.RecordBatch.from_pylist([{"part": part, "number": number, "file": name, "documents": len(held), "tokens": size}], arrow)
            held, ids, sizes, size, number = [], [], [], 0, number + 1
            return row

        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                some = batch.slice(at, DOCS)
                got, n = pieces.encode(some.column("text"))
                got = np.insert(got, np.cumsum(n), end)
                held += some.column("doc_id").to_pylist()
                ids.append(got)
                sizes.append(n + 1)
                size += len(got)
                if size >= file_tokens:
                    yield flush()
        if held:
            yield flush()

    same = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first(), same).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), same)
    written = scratch_path(docs.sparkSession, "token-files")
    ordered.mapInArrow(run, struct_).write.parquet(written)
    index = docs.sparkSession.read.parquet(written)
    running_total(index, ["part", "number"], "tokens", "until").withColumn("start", F.col("until") - F.col("tokens")).drop("until").write.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(start: tokens before the file, content) of each file that the index names."""
    index = spark.read.parquet(f"{folder}/index")
    if index.isEmpty():
        return spark.createDataFrame([], "start long, content binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(f"{folder}/ids")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(index.select("file", "start"), "file").select("start", "content")


def documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, decoded from the files of :func:`read`."""

    def rows(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("doc_id", "start", "n_tokens", "ids_crc32")}
        for start, content in zip(batch.column("start").to_pylist(), batch.column("content"), strict=True):
            codes = Codes(content.as_buffer(), check=True)
            begin = np.concatenate(([0], codes.ends[:-1]))
            ids = memoryview(codes.range(0, codes.n).astype("<u4").tobytes())
            out["doc_id"] += codes.doc_ids
            out["start"] += (begin + start).tolist()
            out["n_tokens"] += (codes.ends - begin).tolist()
            out["ids_crc32"] += [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(begin.tolist(), codes.ends.tolist(), strict=True)]
        return out

    return map_slices(files, lambda: rows, "doc_id long, start long, n_tokens long, ids_crc32 long", rows=1)


@register("op13_token_files")
def q_token_files(spark, sf_dir):
    import public_tokenizers

    folder = scratch_path(spark, "token-store")
    write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return documents(read(spark, folder))
