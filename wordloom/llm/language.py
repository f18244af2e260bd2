"""Language identification by hierarchical discrimination.

First a one-versus-one vote of linear support vector machines picks the language *family*; then the machines
between the languages of that family pick the language. Features are hashed counts of byte trigrams (of the
lower-cased letters, words parted by one space), damped and scaled to unit length, over the whole text, however
long it is.

The machines (squared hinge loss, L2 penalty) are fitted on at most ``PER_LANG`` training documents of each
language, those first in hash order of the id; that bound is the only sample. ``FAMILIES`` may name any
languages; one it doesn't list is a family of its own.

A text that is null or has no letter is ``und`` with score 0. With no training text every prediction is
``und``. With one language every other text gets it. A very long text is read whole, in one task, with a few times its
bytes in memory. Repeated rows give repeated rows, an empty table an empty one; other columns of the input are ignored,
whatever their names. Ties between classes go to the larger summed margin.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.base import fold, map_slices, register, table

DIM_BITS = 11
DIM = 1 << DIM_BITS
PER_LANG = 800
HELD_OUT = (4, 2)
FAMILIES = {"germanic": ("en", "de", "nl", "sv", "da", "no"), "romance": ("fr", "es", "it", "pt", "ro", "ca"),
            "slavic": ("ru", "pl", "cs", "uk", "bg", "sr")}
LETTER = regex.compile(r"\p{L}")
TO_SPACE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def family(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), f"only {lang}")


def features(text: str | None) -> np.ndarray | None:
    """The unit vector of a text; None if it has no letter."""
    if not text or not LETTER.search(text):
        return None
    b = np.frombuffer(b" %b " % b" ".join(text.lower().encode().translate(TO_SPACE).split()), np.uint8).astype(np.uint32)
    grams = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - DIM_BITS)
    v = np.sqrt(np.bincount(grams, minlength=DIM), dtype=np.float32)
    return v / np.linalg.norm(v)


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 150) -> np.ndarray:
    """Weights (bias last) of a linear machine with squared hinge loss, by accelerated gradient steps.
    ``x`` has unit rows, ``y`` is +1 or -1; the classes weigh the same."""
    x = np.concatenate((x, np.ones((len(x), 1), np.float32)), axis=1)
    c = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    step = 1.0 / (2 * 2.0 + penalty)  # rows have squared length 2
    w = v = np.zeros(x.shape[1], np.float32)
    for k in range(rounds):
        gap = np.maximum(0, 1 - y * (x @ v))
        new = v - step * (penalty * v - 2 * ((c * y * gap) @ x))
        v, w = new + (k / (k + 3)) * (new - w), new
    return w


def fit_pairs(x: np.ndarray, y: np.ndarray) -> tuple[list[str], list[tuple[int, int]], np.ndarray]:
    """One machine for each pair of classes: (classes, pairs of their numbers, weights as columns)."""
    names = sorted(set(y.tolist()))
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    cols = []
    for i, j in pairs:
        rows = (y == names[i]) | (y == names[j])
        cols.append(fit_svm(x[rows], np.where(y[rows] == names[i], 1, -1).astype(np.float32)))
    return names, pairs, np.array(cols, np.float32).reshape(len(pairs), DIM + 1).T


def vote(model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: the number of the class with the most won pairs (then the largest summed margin), and
    how sure its closest pair is (0.5 to 1; 1 if there is one class)."""
    names, pairs, w = model
    wins, margin = np.zeros((len(x), len(names))), np.zeros((len(x), len(names)))
    closest = np.full((len(x), len(names)), np.inf)
    out = x @ w[:-1] + w[-1] if pairs else np.zeros((len(x), 0))
    for col, (i, j) in enumerate(pairs):
        m = out[:, col]
        wins[:, i] += m > 0
        wins[:, j] += m <= 0
        margin[:, i] += m
        margin[:, j] -= m
        closest[:, i] = np.minimum(closest[:, i], m)
        closest[:, j] = np.minimum(closest[:, j], -m)
    best = np.argmax(wins + np.tanh(margin) / 4, axis=1)
    sure = 1 / (1 + np.exp(-4 * np.clip(closest[np.arange(len(x)), best], -20, 20)))
    return best, np.where(np.isinf(closest[np.arange(len(x)), best]), 1.0, sure)


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> dict | None:
    """The models: under "" the one of families, under a family's name the one of its languages."""
    train = docs.where((fold("doc_id", HELD_OUT[0]) != HELD_OUT[1]) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = train.select("doc_id", "lang").withColumn("at", rank).where(F.col("at") <= per_lang).select("doc_id").distinct()
    # At most per_lang ids of each language: small enough to send to every task.
    picked = train.join(F.broadcast(chosen), "doc_id", "left_semi")

    def setup():
        def rows(batch: pa.RecordBatch) -> dict:
            v = [features(t) for t in batch.column("text").to_pylist()]
            keep = [i for i, a in enumerate(v) if a is not None]
            return {"lang": batch.column("lang").take(pa.array(keep, pa.int64())), "v": [v[i].astype(np.float16).tobytes() for i in keep]}
        return rows

    got = map_slices(picked.select("text", "lang"), setup, "lang string, v binary").toArrow()
    if not got.num_rows:
        return None
    x = np.frombuffer(b"".join(got.column("v").to_pylist()), np.float16).reshape(-1, DIM).astype(np.float32)
    lang = np.array(got.column("lang").to_pylist(), object)
    fam = np.array([family(v) for v in lang], object)
    models = {"": fit_pairs(x, fam)}
    for f in models[""][0]:
        models[f] = fit_pairs(x[fam == f], lang[fam == f])
    return models


def predict(models: dict | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    names, scores = ["und"] * len(texts), [0.0] * len(texts)
    vectors = [features(t) for t in texts]
    have = [i for i, v in enumerate(vectors) if v is not None]
    if models is None or not have:
        return names, scores
    x = np.stack([vectors[i] for i in have])
    fam, sure = vote(models[""], x)
    for k, f in enumerate(models[""][0]):
        rows = np.flatnonzero(fam == k)
        if len(rows):
            lang, own = vote(models[f], x[rows])
            for r, which, s in zip(rows, lang, own, strict=True):
                names[have[r]], scores[have[r]] = models[f][0][which], float(s * sure[r])
    return names, scores


def identify(docs: DataFrame, models: dict | None) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(models)  # DIM floats for each pair of languages of a family

    def setup():
        def rows(batch: pa.RecordBatch) -> dict:
            names, scores = predict(sent.value, batch.column("text").to_pylist())
            return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": names, "score": scores}
        return rows

    src = docs.select("doc_id", (fold("doc_id", HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), "text")
    return map_slices(src, setup, SCHEMA)


@register("op9_language")
def q_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
