"""Feature operators (F3-F10, F12-F13, A7, A10, O1) in long, relational form.

Long forms (``doc_id, bucket, tf``) keep every step a plain join or grouped aggregate, so they
are checkable in SQL and need no Python. The Spark ML forms (``HashingTF``, ``IDF``, vector
columns) used for model training live in :mod:`wordloom.plans.models`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom import constants as K
from wordloom.functions.hashing import md5_bucket, md5_unit
from wordloom.functions.text import tokens
from wordloom.functions.vectors import as_double_array, cosine, pad
from wordloom.operators.common import MAX_BROADCAST_ROWS, bounded_distinct, fits_broadcast, join_words, maybe_broadcast
from wordloom.operators.labels import global_row_number

MAX_CLASSES = 100_000
WORD_BYTES = 48  # estimated bytes of a word key and row overhead
QUERY_BLOCK_BYTES = 16 * 1024 * 1024  # query vectors that one pass over the rows of similar_topk takes
KNOWN_BYTES = 32 * 1024 * 1024  # a larger model's most frequent words, which texts meet by broadcast
WIDE_CLASSES = 256  # up to this many classes, per-class counts are columns of one aggregate


def hash_tf(df: DataFrame, id_col: str = "doc_id", text: str = "words",
            buckets: int = K.HASH_TF_BUCKETS) -> DataFrame:
    """term frequency per hash bucket ``(doc_id, bucket, tf)`` (one grouped pass)."""
    return (df.select(F.col(id_col).alias("doc_id"), F.explode(tokens(text)).alias("w"))
            .groupBy("doc_id", md5_bucket(F.col("w"), buckets).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("tf")))


def char_tf(df: DataFrame, id_col: str = "doc_id", text: str = "words",
            buckets: int = K.CHAR_TF_BUCKETS) -> DataFrame:
    """F8 re-aimed: character-level term frequency. Characters are counted per text first
    (partial aggregation shrinks the data to distinct characters), then hashed and summed."""
    chars = (df.select(F.col(id_col).alias("doc_id"), F.explode(F.split(F.col(text), "")).alias("ch"))
             .where(F.length("ch") == 1))
    per_char = chars.groupBy("doc_id", "ch").agg(F.count(F.lit(1)).alias("k"))
    return (per_char.groupBy("doc_id", md5_bucket(F.col("ch"), buckets).alias("bucket"))
            .agg(F.sum("k").cast("bigint").alias("tf")))


def idf_weights(tf: DataFrame, n_docs: int) -> DataFrame:
    """Document frequency per bucket and ``idf = ln((m + 1) / (df + 1))``
    (no minimum document frequency). ``tf`` rows are unique per (doc, bucket)."""
    # count_if(tf > 0) (= count, tf >= 1) keeps the tf column, so this branch reads the same
    # (doc, bucket) aggregate as the tf branch and its shuffle is reused, not recomputed.
    return (tf.groupBy("bucket").agg(F.count_if(F.col("tf") > 0).alias("df"))
            .withColumn("idf", F.log((F.lit(float(n_docs)) + 1.0) / (F.col("df") + 1.0))))


def tfidf(tf: DataFrame, idf: DataFrame, buckets: int) -> DataFrame:
    """``tf * idf`` per (doc, bucket); texts are never dropped. The IDF table has at most
    ``buckets`` rows, so broadcasting it is bounded by construction."""
    small = buckets <= MAX_BROADCAST_ROWS
    return (tf.join(maybe_broadcast(idf.select("bucket", "idf"), small), "bucket")
            .select("doc_id", "bucket", "tf", (F.col("tf") * F.col("idf")).alias("tfidf")))


def md5_word_vectors(df: DataFrame, text: str = "words", min_count: int = K.W2V_MIN_COUNT,
                     dims: int = 4) -> DataFrame:
    """Fixed word-vector table for F3 tests: words seen at least ``min_count`` times, vector
    components cut from ``md5(word)``."""
    counts = (df.select(F.explode(tokens(text)).alias("word")).groupBy("word")
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))
    return counts.select("word", F.array(*[md5_unit(F.col("word"), i) for i in range(dims)]).alias("vector"))


def doc_vector_mean(df: DataFrame, vectors: DataFrame, id_col: str = "doc_id", text: str = "words",
                    out: str = "features", n_vectors: int | None = None, dim: int | None = None,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """F3/A7 (+P5, P6): mean of the vectors of the *known* words of each text (repeats count);
    unknown words are skipped and a text without known words is dropped (inner join).

    With a vector table proven small (``n_vectors`` counted, e.g. by ``common.materialize``, times
    the vector width within ``common.MAX_BROADCAST_BYTES``) tokens meet it by broadcast; a larger one by
    ``common.join_words``, frequent words apart from the others. The per-dimension sums are
    partially aggregated per text before the shuffle.
    ``carry`` columns (fixed per text, e.g. its label) ride through the grouping, so nothing is
    joined back to the records afterwards.
    """
    if dim is None:
        dim = vectors.select(F.size("vector")).first()[0]
    v = vectors.select("word", as_double_array("vector").alias("_v"))
    keys = ["doc_id", *carry]
    toks = df.select(F.col(id_col).alias("doc_id"), *carry, F.explode(tokens(text)).alias("word"))
    joined = join_words(toks, v, keys, n_vectors, WORD_BYTES + 8 * dim, "k")
    sums = [F.sum(F.col("k") * F.col("_v")[i]).alias(f"_s{i}") for i in range(dim)]
    agg = joined.groupBy(*keys).agg(F.sum("k").alias("_n"), *sums)
    return agg.select(*keys, F.array(*[F.col(f"_s{i}") / F.col("_n") for i in range(dim)]).alias(out))


def join_features(features: DataFrame, records: DataFrame, id_col: str = "doc_id", label: str = "label") -> DataFrame:
    """J1 + F10: features joined to records on the id (inner, many-to-many: an id repeated on
    both sides multiplies rows, as a pair-RDD join does); rows without a label are filtered
    instead of failing. A shuffle join on the id; AQE may broadcast a small side at runtime."""
    return features.join(records.where(F.col(label).isNotNull()), id_col)


def pad_features(df: DataFrame, col: str, length: int = K.PAD_LENGTH, over: str = "error") -> DataFrame:
    """zero-padded double array of fixed length (see :func:`wordloom.functions.vectors.pad`)."""
    return df.withColumn(col, pad(as_double_array(col), length, over))


@dataclass
class WcpModel:
    """Class-word model: ``words`` is ``(word, lnv array<double>)`` with
    ``lnv[c] = ln(1 + n_cw)`` for the classes in ``classes`` order; ``classes`` holds
    ``(label, ln(V + T_c))``; ``n_words`` is the row count of ``words`` (for the broadcast bound)."""
    words: DataFrame
    classes: list[tuple]
    n_words: int | None = None


def fit_wcp(train: DataFrame, label: str = "label", text: str = "words",
            vocabulary_size: int = K.WCP_VOCABULARY_SIZE) -> WcpModel:
    """Fit the class-word model in one pass over the training texts.

    The class list comes from a one-column distinct (checked bounded); word counts per class
    become one row per word with a K-wide count vector, written once to the shared checkpoint
    folder; class totals are then summed from that (small) table."""
    labels = bounded_distinct(train, label, MAX_CLASSES)
    if labels is None:
        raise ValueError("too many classes for per-class scores")
    toks = (train.select(F.col(label).alias("label"), F.explode(tokens(text)).alias("w"))
            .where(F.col("label").isNotNull()).select("label", F.lower("w").alias("word")))
    if len(labels) <= WIDE_CLASSES:
        # One hash aggregate keyed by word, one count per class (partial before the shuffle).
        by_word = toks.groupBy("word").agg(*[F.count_if(F.col("label") == F.lit(c)).alias(f"_n{i}")
                                            for i, c in enumerate(labels)])
        nv = F.array(*[F.col(f"_n{i}").cast("bigint") for i in range(len(labels))])
    else:
        cw = toks.groupBy("label", "word").agg(F.count(F.lit(1)).alias("n"))
        by_word = cw.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("_m"))
        nv = F.array(*[F.coalesce(F.col("_m")[F.lit(c)], F.lit(0)).cast("bigint") for c in labels])
    words = (by_word.select("word", nv.alias("nv"))
             .withColumn("lnv", F.transform("nv", lambda n: F.log1p(n.cast("double"))))
             .checkpoint(eager=True))
    tot = words.agg(F.count(F.lit(1)).alias("n_words"),
                    *[F.sum(F.col("nv")[i]).alias(f"t{i}") for i in range(len(labels))]).first()
    classes = [(c, math.log(vocabulary_size + (tot[f"t{i}"] or 0))) for i, c in enumerate(labels)]
    return WcpModel(words.select("word", "lnv"), classes, tot["n_words"])


def _well_known(model: WcpModel, row_bytes: int) -> DataFrame | None:
    """The model's most frequent words, at most ``KNOWN_BYTES`` of it: whole classes of count (1, 2-3, 4-7, ...) from the top."""
    seen = F.aggregate(F.transform("lnv", lambda x: F.expm1(x)), F.lit(0.0), lambda s, x: s + x)
    level = F.floor(F.log2(F.greatest(seen, F.lit(1.0)))).cast("int")
    room, lowest = KNOWN_BYTES // row_bytes, None
    for r in sorted(model.words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        room -= r["n"]
        if room < 0:
            break
        lowest = r["level"]
    return None if lowest is None else model.words.where(level >= lowest).select("word")


def _wcp_sums(model: WcpModel, score: DataFrame, text: str, id_col: str) -> DataFrame:
    """Per text: token count ``L`` and, per class, ``sum over tokens of ln(1 + n_cw)``.

    With a model proven small, tokens meet it by broadcast (no shuffle of tokens) and the sums
    are partially aggregated per text before the only shuffle. A larger model meets them by ``common.join_words``, its most
    frequent words by broadcast."""
    k = len(model.classes)
    toks = score.select(F.col(id_col).alias("doc_id"), F.explode(tokens(text)).alias("w")) \
        .select("doc_id", F.lower("w").alias("word"))
    row = WORD_BYTES + 8 * k
    known = None if fits_broadcast(model.n_words, row) else _well_known(model, row)
    j = join_words(toks, model.words, ["doc_id"], model.n_words, row, "_k", "left", known)
    sums = [F.sum(F.col("_k") * F.coalesce(F.col("lnv")[i], F.lit(0.0))).alias(f"_s{i}") for i in range(k)]
    return j.groupBy("doc_id").agg(F.sum("_k").alias("L"), *sums)


def _class_scores(k_classes: list[tuple]) -> Column:
    """``score_c = s_c - L ln(V + T_c)`` as a K-wide array."""
    return F.array(*[F.col(f"_s{i}") - F.col("L") * F.lit(z) for i, (_, z) in enumerate(k_classes)])


def score_wcp(model: WcpModel, score: DataFrame, text: str = "words", id_col: str = "doc_id") -> DataFrame:
    """F13 built as intended: for each text and class, the sum over its tokens of
    ``ln(p_c(token))`` with ``p_c(w) = (1 + n_cw) / (V + T_c)`` (A3's smoothing; an unseen word
    has ``n_cw = 0``). Output ``(doc_id, label, score)``, K rows per text.

    Evaluated as ``sum_w ln(1 + n_cw) - L ln(V + T_c)`` per text (see :func:`_wcp_sums`); the K
    scores of a text are one array, exploded with the class list."""
    labels = F.array(*[F.lit(c) for c, _ in model.classes])
    per_doc = _wcp_sums(model, score, text, id_col)
    return (per_doc.select("doc_id", F.arrays_zip(labels.alias("label"), _class_scores(model.classes).alias("score"))
                           .alias("_z"))
            .select("doc_id", F.explode("_z").alias("_e"))
            .select("doc_id", F.col("_e.label").alias("label"), F.col("_e.score").alias("score")))


def predict_wcp(model: WcpModel, score: DataFrame, text: str = "words", id_col: str = "doc_id") -> DataFrame:
    """Best class per text ``(doc_id, prediction, best_score)`` computed in-row from the K
    scores; ties go to the lowest class (first maximum in class order)."""
    labels = F.array(*[F.lit(c) for c, _ in model.classes])
    per_doc = _wcp_sums(model, score, text, id_col).withColumn("_sc", _class_scores(model.classes))
    best = F.array_max("_sc")
    return per_doc.select("doc_id", F.element_at(labels, F.array_position("_sc", best).cast("int")).alias("prediction"),
                          best.alias("best_score"))


def class_log_scores(train: DataFrame, score: DataFrame, label: str = "label", text: str = "words",
                     vocabulary_size: int = K.WCP_VOCABULARY_SIZE) -> DataFrame:
    """fit on ``train`` and score ``score`` in one call."""
    return score_wcp(fit_wcp(train, label, text, vocabulary_size), score, text)


def argmax_label(scores: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Best class per text ``(doc_id, prediction, best_score)``; ties go to the lowest class
    (as a strict ``>`` scan in class order would pick)."""
    return (scores.groupBy(id_col)
            .agg(F.min_by("label", F.struct(F.negative("score"), F.col("label"))).alias("prediction"),
                 F.max("score").alias("best_score")))


def label_centroids(df: DataFrame, vec: str = "embedding", label: str = "label", dim: int | None = None) -> DataFrame:
    """Per-label mean vector ``(label, centroid array<double>)``: one grouped aggregate with an
    ``avg`` per vector position (code-generated, partial before the shuffle); ``dim`` is read
    from one row when not given."""
    if dim is None:
        dim = df.select(F.size(vec)).first()[0]
    aggs = [F.avg(F.try_element_at(vec, F.lit(i + 1)).cast("double")).alias(f"_c{i}") for i in range(dim)]
    return (df.groupBy(label).agg(*aggs)
            .select(label, F.array(*[F.col(f"_c{i}") for i in range(dim)]).alias("centroid")))


def similar_topk(df: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec: str = "embedding",
                 key: str = "label", skip_own: bool = False, block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """O1 (``findSynonyms`` in general form): per query vector, the ``k`` most cosine-similar of **all** rows of ``df``.

    ``queries`` is ``(key, query array<double>)``. Queries are numbered and taken in blocks of at most
    ``block_bytes``; a block is one pass over the rows. Each task keeps only the ``k`` best rows per query so far
    (states that merge: the best of the tasks' bests), so what leaves a task is ``k`` rows per query and no
    pair of row and query is ever emitted. Ties by id; ``skip_own`` leaves out the row whose id is the key.
    Null or zero vectors and those of another length take no part. Sums run in vector order, in doubles.
    Output ``(key, rank, id, cosine)``."""
    from pyspark.sql import Window

    spark = df.sparkSession
    numbered = global_row_number(spark, queries.select(key, as_double_array("query").alias("query")).where(F.col("query").isNotNull()), [key], "_n").checkpoint()
    n, dim = numbered.agg(F.count(F.lit(1)), F.max(F.size("query"))).first()
    rows = df.select(F.col(id_col), F.col(vec)).where(F.col(vec).isNotNull())
    schema = T.StructType([T.StructField(key, numbered.schema[key].dataType), T.StructField(id_col, rows.schema[id_col].dataType), T.StructField("cosine", T.DoubleType())])
    size = max(1, block_bytes // (8 * (dim or 1)))
    best = spark.createDataFrame([], schema)
    for first in range(0, n, size):
        block = numbered.where(F.col("_n").between(first + 1, first + size)).select(key, "query").collect()
        best = best.unionByName(rows.mapInArrow(_k_best([b[key] for b in block], [b["query"] for b in block], k, skip_own, schema), schema))
    w = Window.partitionBy(key).orderBy(F.col("cosine").desc(), F.col(id_col))
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(key, F.col("rank").cast("bigint").alias("rank"), id_col, "cosine"))


def _k_best(keys: list, queries: list, k: int, skip_own: bool, schema: T.StructType):
    """The part of :func:`similar_topk` that runs in a task: Arrow batches of (id, vector) -> the task's best rows."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    def run(batches):
        arrow, by_dim = to_arrow_schema(schema), {}
        for j, q in enumerate(queries):
            by_dim.setdefault(len(q), []).append(j)
        best: list[list[tuple]] = [[] for _ in keys]  # (-cosine, id), at most k

        def norms(m):
            total = np.zeros(len(m))
            for d in range(m.shape[1]):
                total += m[:, d] * m[:, d]
            return np.sqrt(total)

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids, vectors = (c for c in batch.slice(at, 1024).columns)
                lengths = np.array([len(v) if v is not None else -1 for v in vectors.to_pylist()])
                names = ids.to_pylist()
                for dim, which in by_dim.items():
                    mine = np.flatnonzero(lengths == dim)
                    if not len(mine) or not dim:
                        continue
                    x = np.array(vectors.take(pa.array(mine)).to_pylist(), float)
                    q = np.array([queries[j] for j in which], float)
                    scores = np.zeros((len(x), len(q)))
                    for d in range(dim):
                        scores += np.outer(x[:, d], q[:, d])
                    with np.errstate(all="ignore"):
                        scores /= np.outer(norms(x), norms(q))
                    for c, j in enumerate(which):
                        s = np.where(np.isfinite(scores[:, c]), scores[:, c], -np.inf)
                        bar = -best[j][-1][0] if len(best[j]) == k else -np.inf
                        some = [(-s[i], names[mine[i]]) for i in np.flatnonzero((s >= bar) & (s > -np.inf)) if not (skip_own and names[mine[i]] == keys[j])]
                        best[j] = sorted(best[j] + some)[:k]
        out = [(keys[j], i, -s) for j, b in enumerate(best) for s, i in b]
        yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], f.type) for c, f in enumerate(arrow)], schema=arrow)

    return run
