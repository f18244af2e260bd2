"""Near-duplicate documents by ProbMinHash.

**Shingles.** Five-word windows (words are runs without ASCII white space), weighted by how often they occur in
the text; a text of one to four words is one shingle. Similarity is the probability Jaccard index J_P of the
weighted shingles, which for shingles that occur once each is the plain Jaccard index.

**Signatures.** Every shingle has a Poisson process of its own, seeded by its hash and sped up by its weight. Each
arrival falls on one of ``REGISTERS`` registers at random; a register keeps the shingle that came first. A
process ends as soon as its next arrival is later than all registers (early termination). Two texts agree in a
register with probability J_P.

**Bands.** Documents that agree in all ``ROWS`` registers of one of ``BANDS`` bands are candidates. At 0.8 a pair
is missed with probability (1 - 0.8^5)^32 = 3e-6.

**Verification** computes J_P exactly on the shingles of candidate pairs and keeps those of ``SIMILAR`` or more. Exact
copies are one representative from the start. First each document is held against one leader, of the buckets'
most connected documents the one that it shares most bands with; the links make components. Buckets that still
hold several components are joined into clusters, and in each cluster all documents outside its largest
component are held against all others, in blocks of ``BLOCK_SHINGLES`` shingles: a task gets two blocks and returns the links
that join components, never all pairs. So a large group of copies costs a row a member and bucket, and its
stragglers are sent once for each block of their cluster.

Null texts and texts without a word resemble nothing and are classes of their own. Ties go to the smaller id. Rows
that repeat an id are one document. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.base import WordHash, map_slices, mix, register, release, table, utf8
from wordloom.llm.components import components

WIDTH = 5
SIMILAR = 0.8
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
#: Shingles of a block of documents; two blocks meet in a task.
BLOCK_SHINGLES = 1_000_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: bytes, hashes: WordHash) -> np.ndarray:
    """Hashes of the five-word windows, in order; of all words if there are fewer."""
    h = hashes.hashes(data.split())
    if not len(h):
        return h
    n, width = max(len(h) - WIDTH + 1, 1), min(len(h), WIDTH)
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = mix(out * GOLDEN + h[i:i + n])
    return out


def weighted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles, their counts)."""
    return np.unique(h, return_counts=True)


def signatures(texts: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """A row of registers for each (shingles, weights); all texts of a slice run together."""
    sizes = np.array([len(h) for h, _ in texts])
    first = np.full((len(texts), registers), np.inf)
    kept = np.zeros((len(texts), registers), np.uint64)
    if not sizes.sum():
        return kept
    doc = np.repeat(np.arange(len(texts)), sizes)
    shingle = np.concatenate([h for h, _ in texts])
    weight = np.concatenate([w for _, w in texts]).astype(float)
    time, turn = np.zeros(len(doc)), np.uint64(0)
    flat_first, flat_kept = first.reshape(-1), kept.reshape(-1)
    with np.errstate(over="ignore"):
        while len(doc):
            turn += np.uint64(1)
            r = mix(shingle + turn * GOLDEN)
            time = time - np.log(((r >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / weight
            at = doc * registers + (mix(r ^ GOLDEN) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(flat_first, at, time)
            won = flat_first[at] == time
            flat_kept[at[won]] = shingle[won]
            alive = np.unique(doc)
            last = np.zeros(len(texts))
            last[alive] = first[alive].max(axis=1)
            go = time < last[doc]
            doc, shingle, weight, time = doc[go], shingle[go], weight[go], time[go]
    return kept


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash for each band of each signature."""
    parts = signature.reshape(len(signature), bands, -1)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(parts.shape[2]):
        out = mix(out * GOLDEN + parts[:, :, i])
    return out.view(np.int64)


def probability_jaccard(ha, ca, hb, cb) -> float:
    """J_P of two weighted sets: the sum over common x of 1 / sum over y of max(a(y)/a(x), b(y)/b(x)). With the
    elements sorted by a/b, the maximum is the first term from x on and the second before it."""
    common, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    a, b = ca[ia].astype(float), cb[ib].astype(float)
    only_a, only_b = ca.sum() - a.sum(), cb.sum() - b.sum()
    order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    from_here = np.cumsum(a[::-1])[::-1] + only_a
    before = np.cumsum(b) - b + only_b
    return float((1 / (from_here / a + before / b)).sum())


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, same: digest of the text, or of the id where there is no word, bands, size: distinct shingles)."""

    def setup():
        hashes = WordHash()

        def rows(batch: pa.RecordBatch) -> dict:
            ids, texts = batch.column("doc_id").to_pylist(), utf8(batch.column("text"))
            sets = [weighted(shingles(t, hashes)) for t in texts]
            keys = band_keys(signatures(sets))
            same = [xxhash.xxh3_128_digest(t if len(h) else b"no words %d" % (i or 0)) for i, t, (h, _) in zip(ids, texts, sets, strict=True)]
            return {"doc_id": ids, "same": same, "bands": [k if len(h) else [] for k, (h, _) in zip(keys, sets, strict=True)],
                    "size": [len(h) for h, _ in sets]}
        return rows

    return map_slices(docs.select("doc_id", "text"), setup, "doc_id long, same binary, bands array<long>, size long")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, h, c): the weighted shingles of the wanted documents, as bytes."""

    def setup():
        hashes = WordHash()

        def rows(batch: pa.RecordBatch) -> dict:
            sets = [weighted(shingles(t, hashes)) for t in utf8(batch.column("text"))]
            return {"doc_id": batch.column("doc_id"), "h": [h.tobytes() for h, _ in sets], "c": [c.astype(np.uint32).tobytes() for _, c in sets]}
        return rows

    return map_slices(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), setup, "doc_id long, h binary, c binary")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose texts have J_P >= SIMILAR, with it."""
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = shingle_sets(docs, wanted)
    both = pairs.join(sets.toDF("b", "hb", "cb"), "b").join(sets.toDF("a", "ha", "ca"), "a")

    def compare(batch: pa.RecordBatch) -> dict:
        cols = [[np.frombuffer(x, kind) for x in batch.column(c).to_pylist()] for c, kind in (("ha", np.uint64), ("ca", np.uint32), ("hb", np.uint64), ("cb", np.uint32))]
        return {"a": batch.column("a"), "b": batch.column("b"), "similarity": [probability_jaccard(*x) for x in zip(*cols, strict=True)]}

    found = map_slices(both.select("a", "b", "ha", "ca", "hb", "cb"), lambda: compare, "a long, b long, similarity double", rows=64)
    return found.where(F.col("similarity") >= SIMILAR - 1e-9)


def joining_links(nodes: list[int], roots: list[int], sets: list[tuple[np.ndarray, np.ndarray]], probes: list[int]) -> list[tuple[int, int]]:
    """Links of SIMILAR or more between each probe (a place in ``nodes``) and the other nodes, of other components
    (``roots``), as far as they join components that no earlier link has joined.

    With x and y the shares of two texts' weights that lie in common shingles, J_P is at most 1 / (1/x + 1/y - 1). So a
    probe is held only against texts that share one of its rarest shingles: if the first shared one comes after a share p of
    the probe's weight, x is at most 1 - p, and y at most the common weight over the text's own, its repeats counted at
    their most. Owners of a shingle are sorted by the latter, so those that cannot be near any more are never touched, and
    texts with many shingles of their own touch nothing. Pairs beyond the bound are passed over, others computed."""
    owner = np.repeat(np.arange(len(nodes)), [len(h) for h, _ in sets])
    weight = np.array([c.sum() for _, c in sets], float)
    least = weight / [c.max(initial=1) for _, c in sets]
    by_least = np.empty(len(nodes), np.int64)
    by_least[np.argsort(least, kind="stable")] = np.arange(len(nodes))
    least_sorted = np.sort(least)
    every, name = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True)
    counts = np.concatenate([c for _, c in sets]).astype(float)
    order = np.lexsort((by_least[owner], name))
    place = name[order] * len(nodes) + by_least[owner[order]]  # sorted: shingle, then owner by ``least``
    owners, held = owner[order], counts[order]
    often = np.bincount(name, minlength=len(every))
    first = np.concatenate(([0], np.cumsum([len(h) for h, _ in sets])))
    parent = {r: r for r in roots}
    group = np.unique(roots, return_inverse=True)[1]

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def owned(shingles: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places in ``owners`` of the shingles' first owners, up to the given places."""
        begin = np.searchsorted(place, shingles * len(nodes), "left")
        n = np.maximum(end - begin, 0)
        return np.repeat(begin - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())

    most = 1 / SIMILAR + 1 + 1e-6  # 1/x + 1/y of similar texts is not above this
    out = []
    for a in probes:
        mine, c = name[first[a]:first[a + 1]], counts[first[a]:first[a + 1]]
        rare = np.argsort(often[mine], kind="stable")
        left = 1 - (np.cumsum(c[rare]) - c[rare]) / weight[a]  # x, if this is the first shared shingle
        can = left > 1 / (most - 1) - 1e-9
        room = most - 1 / left[can]
        limit = np.searchsorted(least_sorted, left[can] * weight[a] * room * (1 + 1e-9), "right")
        some = mine[rare][can]
        near = np.unique(owners[owned(some, np.searchsorted(place, some * len(nodes) + limit, "left"))])
        near = near[group[near] != group[a]]
        if not len(near):
            continue
        at = owned(mine, np.searchsorted(place, (mine + 1) * len(nodes), "left"))
        n = np.searchsorted(place, (mine + 1) * len(nodes), "left") - np.searchsorted(place, mine * len(nodes), "left")
        x = np.bincount(owners[at], np.repeat(c, n), len(nodes))[near] / weight[a]
        y = np.bincount(owners[at], held[at], len(nodes))[near] / weight[near]
        good = 1 / x + 1 / y <= most
        near, x = near[good], x[good]
        for b in near[np.argsort(-x, kind="stable")].tolist():
            p, q = top(roots[a]), top(roots[b])
            if p != q and probability_jaccard(*sets[a], *sets[b]) >= SIMILAR - 1e-9:
                parent[max(p, q)] = min(p, q)
                out.append((nodes[a], nodes[b]))
    return out


def between_components(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that join components, among ``members(band, rep, size, root)`` of buckets with several of them."""
    lead = members.groupBy("band").agg(F.min("rep").alias("b"))
    clusters = components(members.join(lead, "band").select(F.col("rep").alias("a"), "b"))
    nodes = members.select("rep", "size", "root").distinct().join(clusters.toDF("rep", "cluster"), "rep").checkpoint()
    sizes = nodes.groupBy("cluster", "root").agg(F.sum("size").alias("size"))
    largest = sizes.groupBy("cluster").agg(F.max(F.struct("size", "root")).alias("x"), F.sum("size").alias("all"))
    blocks = lambda c: F.ceil(c / BLOCK_SHINGLES).cast("int")
    largest = largest.select("cluster", F.col("x.root").alias("main"), blocks(F.col("x.size")).alias("main_blocks"), blocks(F.col("all") - F.col("x.size")).alias("blocks"))
    nodes = nodes.join(largest, "cluster").withColumn("probe", F.col("root") != F.col("main"))
    block = F.pmod(F.xxhash64("rep"), F.when(F.col("probe"), F.col("blocks")).otherwise(F.col("main_blocks"))).cast("int")
    # Meetings (i, j): block i of probes with block j, which counts probes first, then the main component. A probe
    # block meets itself in (i, i); a main block is all ears.
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    nodes = nodes.withColumn("block", block).withColumn("meets", F.when(F.col("probe"), F.transform(
        upto(F.col("blocks") + F.col("main_blocks")), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))).otherwise(
        F.transform(upto(F.col("blocks")), lambda i: F.struct(i.alias("i"), (F.col("blocks") + F.col("block")).alias("j")))))
    sets = shingle_sets(docs, nodes.select(F.col("rep").alias("doc_id"))).withColumnRenamed("doc_id", "rep")
    dealt = nodes.select("cluster", "rep", "root", "probe", "block", F.explode("meets").alias("m"))
    dealt = dealt.select("cluster", "rep", "root", (F.col("probe") & (F.col("block") == F.col("m.i"))).alias("probe"), "m.i", "m.j").join(sets, "rep")

    def solve(t: pa.Table) -> pa.Table:
        t = t.sort_by("rep")
        c = {n: t.column(n).to_pylist() for n in ("rep", "root", "probe", "h", "c")}
        sets = [(np.frombuffer(h, np.uint64), np.frombuffer(w, np.uint32)) for h, w in zip(c["h"], c["c"], strict=True)]
        got = joining_links(c["rep"], c["root"], sets, [k for k, p in enumerate(c["probe"]) if p])
        return pa.table([pa.array([x[i] for x in got], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return dealt.groupBy("cluster", "i", "j").applyInArrow(solve, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, is_copy): class_id is the smallest id of the document's class."""
    sketches = sketch(docs).checkpoint()
    texts = sketches.groupBy("same").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"), F.max("size").alias("size"))
    rows = texts.select("rep", "size", F.explode("bands").alias("band")).checkpoint()
    shared = rows.groupBy("band").count().where("count > 1")
    rows = rows.join(shared, "band").checkpoint()  # only documents with company in a bucket are left
    release(docs.sparkSession)

    # A bucket's leader is its member with the most company in all its buckets.
    company = rows.groupBy("rep").agg(F.sum("count").alias("company"))
    leaders = rows.join(company, "rep").groupBy("band").agg(F.max(F.struct("company", (-F.col("rep")).alias("low"))).alias("x")).select("band", (-F.col("x.low")).alias("leader"))
    led = rows.join(leaders, "band").where(F.col("rep") != F.col("leader")).groupBy("rep", "leader").agg(F.count("*").alias("n"))
    best = led.groupBy("rep").agg(F.max(F.struct("n", (-F.col("leader")).alias("low"))).alias("x")).select((-F.col("x.low")).alias("a"), F.col("rep").alias("b"))
    links = verified(best.checkpoint(), docs).select("a", "b").checkpoint()
    release(docs.sparkSession)
    roots = components(links)

    members = rows.select("band", "rep", "size").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("band", "rep", "size", F.coalesce("root", "rep").alias("root"))
    mixed = members.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band")
    members = members.join(mixed, "band", "left_semi").checkpoint()
    roots = components(links.unionByName(between_components(members, docs)).checkpoint())

    reps = sketches.select("doc_id", "same").join(texts.select("same", "rep"), "same")
    out = reps.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("root", "rep").alias("class_id"))
    return out.select("doc_id", "class_id", (F.col("doc_id") != F.col("class_id")).alias("is_copy"))


@register("op1_near_dup")
def q_near_dup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
