"""Secret scan: fixed patterns, and character Markov models of random strings and ordinary identifiers.

**Patterns** (per kind, leftmost and not overlapping): ``assign``, ``access`` and ``hex``, see ``PATTERNS``.

**Models.** Two first-order Markov models over the characters of ``ALPHABET``, one of random strings and one of ordinary
identifiers, are estimated from labelled samples: strings that the patterns caught (label 1) and long words of
letters (label 0), from at most ``MAX_SAMPLE`` documents, those first in hash order of the id; that bound is the only
sample. A transition backs off to how common its second character is, with the weight of ``BACKOFF`` draws; that is
smoothed by one draw of each character in random strings, half a one in identifiers. Tokens are runs of ``ALPHABET``; the
patterns' spans are cut out of them, and what is left on either side is a token by itself. One of ``MIN_TOKEN``
characters or more, with a letter, is a secret if its log-likelihood ratio is at least ``MIN_RATIO`` in all and
``MIN_EACH`` for each pair of characters; kind ``markov``.

Spans are counted in code points, end exclusive. Everything is DataFrame functions: the spans of a text come from its
split at the matches, and the models are a literal array of a fixed size.

A null text is empty and has no span. Texts without a match cost one pass for each pattern. Repeated rows give
repeated rows. With no samples both models are their smoothing alone. An empty table gives an empty result.
Columns beside doc_id and text are carried along by ``redact``, whatever their names. Spans of several kinds that start at the
same place are ordered by kind, as listed.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.base import register, table

#: kind, pattern, group whose length counts, least length. Fixed values.
PATTERNS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
MIN_TOKEN = 16
TOKEN = rf"[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}"
WORD = r"[A-Za-z]{8,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
MAX_SAMPLE = 20_000
MIN_RATIO = 20.0
MIN_EACH = 0.75
BACKOFF = 10.0
MASK = "[SECRET]"
#: Prefix sums run in blocks of so many matches.
BLOCK = 256
SPAN = "struct<start:int,kind:int,end:int>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def none() -> Column:
    return F.expr(f"cast(array() as array<{SPAN}>)")


def running(steps: Column, body) -> Column:
    """``body(f)`` where ``f(i)`` is the sum of the first i steps: sums of whole blocks and the rest of one."""
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(steps) / BLOCK).cast("int")),
                         lambda b: total(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
    def upto(sums):
        starts = F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda b: total(F.slice(sums, F.lit(1), b)))
        return let(starts, lambda s: body(lambda i: F.element_at(s, F.floor(i / BLOCK).cast("int") + 1)
                                          + total(F.slice(steps, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))))
    return let(blocks, upto)


def matches(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """Spans of the matches whose ``group`` has ``least`` characters or more: the text is split at the matches, and
    what lies between them says where they are."""
    p = F.lit(pattern)

    def found(gaps: Column) -> Column:
        def spans(both: Column) -> Column:
            whole, part = both["whole"], both["part"]
            steps = F.transform(gaps, lambda g, i: F.length(g) + F.coalesce(F.length(F.get(whole, i)), F.lit(0)))

            def spell(before) -> Column:
                return F.transform(whole, lambda m, i: F.when(F.length(F.get(part, i)) >= least, let(
                    before(i) + F.length(F.get(gaps, i)), lambda s: F.struct(s.alias("start"), F.lit(kind).alias("kind"), (s + F.length(m)).alias("end")))))
            return F.filter(let(steps, lambda x: running(x, spell)), lambda s: s.isNotNull()).cast(f"array<{SPAN}>")

        return F.when(F.size(gaps) < 2, none()).otherwise(let(
            F.struct(F.regexp_extract_all(text, p, F.lit(0)).alias("whole"), F.regexp_extract_all(text, p, F.lit(group)).alias("part")), spans))

    return let(F.split(text, pattern, -1), found)


def base_spans(text: Column) -> Column:
    return F.array_sort(F.concat(*[matches(text, p, group, least, kind) for kind, (_, p, group, least) in enumerate(PATTERNS)]))


def spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k, *_ in PATTERNS], F.lit("markov"))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def samples(docs: DataFrame, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """(token, label): 1 for strings that the patterns caught, 0 for long words."""
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample)
    text = F.coalesce("text", F.lit(""))
    some = docs.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi").select(text.alias("text"))
    caught = F.concat(*[F.filter(F.regexp_extract_all("text", F.lit(p), F.lit(g)), lambda x, n=least: F.length(x) >= n) for _, p, g, least in PATTERNS])
    both = F.concat(F.transform(caught, lambda t: F.struct(t.alias("token"), F.lit(1).alias("label"))),
                    F.transform(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lambda t: F.struct(t.alias("token"), F.lit(0).alias("label"))))
    return some.select(F.explode(both).alias("x")).select("x.token", "x.label")


def fit(labelled: DataFrame) -> list[float]:
    """log P_random(d | c) - log P_ordinary(d | c) for all pairs of characters, row by row. Only the counts of the
    pairs, a fixed number, reach the driver."""
    n = len(ALPHABET)
    pairs = labelled.groupBy("token", "label").count().select("label", "count", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("token") - 1, F.lit(1))), lambda i: F.substring("token", i, F.lit(2)))).alias("pair"))
    code = F.instr(F.lit(ALPHABET), F.substring("pair", 1, 1)) * (n + 1) + F.instr(F.lit(ALPHABET), F.substring("pair", 2, 1))
    counts = pairs.where(F.length("pair") == 2).groupBy("label", code.alias("code")).agg(F.sum("count").alias("n")).collect()
    seen = [[[0.0] * n for _ in range(n)] for _ in (0, 1)]
    for r in counts:
        c, d = divmod(r["code"], n + 1)
        if c and d:
            seen[r["label"]][c - 1][d - 1] += r["n"]
    logs = []
    for label, rows in enumerate(seen):
        start = 0.5 + 0.5 * label
        each = [sum(row[d] for row in rows) + start for d in range(n)]
        logs.append([[math.log((x + BACKOFF * each[d] / sum(each)) / (sum(row) + BACKOFF)) for d, x in enumerate(row)] for row in rows])
    return [logs[1][c][d] - logs[0][c][d] for c in range(n) for d in range(n)]


def ratio(token: Column, model: Column) -> Column:
    """Log-likelihood ratio of random to ordinary for a token over ALPHABET."""
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1)))
    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0),
                       lambda a, i: a + F.element_at(model, (place(i) - 1) * len(ALPHABET) + place(i + 1)))


def beside(token: Column, base: Column) -> Column:
    """The parts of a token's span that no base span covers."""
    def cut(near: Column) -> Column:
        starts = F.filter(F.array_distinct(F.concat(F.array(token["start"]), F.transform(near, lambda b: b["end"]))),
                          lambda p: (p < token["end"]) & ~F.exists(near, lambda b: (b["start"] <= p) & (p < b["end"])))
        later = lambda p: F.transform(F.filter(near, lambda b: b["start"] > p), lambda b: b["start"])
        return F.transform(starts, lambda p: F.struct(p.alias("start"), token["kind"].alias("kind"),
                                                      F.array_min(F.concat(F.array(token["end"]), later(p))).alias("end")))

    overlapping = F.filter(base, lambda b: (b["start"] < token["end"]) & (token["start"] < b["end"]))
    return let(overlapping, lambda near: F.when(F.size(near) == 0, F.array(token)).otherwise(cut(near)).cast(f"array<{SPAN}>"))


def all_spans(text: Column, base: Column, model: list[float]) -> Column:
    """The base spans and those of the tokens that the models take for secrets, by start, then kind."""
    weights = F.from_json(F.lit(json.dumps(model)), "array<double>")

    def secret(s: Column) -> Column:
        token = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        long = s["end"] - s["start"] >= MIN_TOKEN
        return long & token.rlike("[A-Za-z]") & let(ratio(token, weights), lambda r: (r >= MIN_RATIO) & (r >= MIN_EACH * (s["end"] - s["start"] - 1)))

    tokens = F.flatten(F.transform(matches(text, TOKEN, 0, MIN_TOKEN, len(PATTERNS)), lambda t: beside(t, base)))
    return F.array_sort(F.concat(base, F.filter(tokens, secret)))


def scan(docs: DataFrame, model: list[float]) -> DataFrame:
    """The rows with ``text`` (never null), ``base`` and ``spans``, and ``rest``: a struct of all other columns."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (F.struct(*rest) if rest else F.lit(None)).alias("rest"))
    src = src.withColumn("base", base_spans(F.col("text")))
    return src.withColumn("spans", all_spans(F.col("text"), F.col("base"), model))


def masked(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by ``MASK``."""
    def step(acc, s):  # a span opens a run unless an earlier one reaches beyond its start
        gap = F.concat(F.substring(text, acc["end"] + 1, s["start"] - acc["end"]), F.lit(MASK))
        return F.struct(F.concat(acc["out"], F.when(s["start"] >= acc["end"], gap).otherwise(F.lit(""))).alias("out"), F.greatest(acc["end"], s["end"]).alias("end"))

    done = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("end")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["end"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(done)


def redact(docs: DataFrame, model: list[float]) -> DataFrame:
    """The rows of ``docs`` with all secrets masked. ``n_chars``, if there is such a column, is counted anew."""
    found = scan(docs, model).select("doc_id", masked(F.col("text"), F.col("spans")).alias("text"), "rest")
    column = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[column.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


@register("op3_secrets")
def q_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, fit(samples(docs)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(PATTERNS)],
                        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))
