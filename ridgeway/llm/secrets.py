"""Secret scans by character Markov models; DataFrame functions only.

Base rules find assignments, access keys and hex runs.  The method scores every other
long token of ``TOKEN`` characters by the log-likelihood ratio of two first-order Markov
models over printable ASCII, one of random strings and one of ordinary identifiers, both
trained from labelled samples by one aggregate of character pairs.  A token whose ratio is
at least ``min_ratio`` in all and ``min_mean`` per character is a span of kind ``random``,
unless it overlaps a base span.

Positions are code points, end exclusive.  They come from splitting the text at the
matches: a match starts after all gaps and matches before it.

Defined cases: a null text is empty; ties in the start are ordered by kind as listed; repeated
rows are scanned one by one; an empty table gives no rows; ``redact`` keeps all columns, whatever
their names; empty training samples give ratios of 0, and so no ``random`` spans.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the base rules: kind, pattern, group whose length counts, least length.
RULES = (
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: A cheap necessary condition of each rule, checked before the text is split.
_HINTS = (r"(?i)(?:passw(?:or)?d|secret|token|api_?key)[\"']?\x20*[:=]", r"AKIA[A-Z0-9]{16}", r"[0-9a-f]{24}")
#: hex runs are looked for in their final length straight away: a run is one match either way.
_FAST = (RULES[0][1], r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}")
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
KINDS = ("assign", "access", "hex", "random")
ALPHABET = 94  # printable ASCII from "!"
MIN_RATIO, MIN_MEAN = 20.0, 1.5
#: Documents from which ``samples`` takes its labelled rows, as an expected number.
SAMPLE_DOCS = 1000


def samples(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled rows (token, is_random) from a hash sample of about ``n_docs`` rows (all of a smaller table), repeated
    ones once: a function of the rows alone, however they are split over files and tasks.

    Random strings are encoded digests of the ids; ordinary identifiers are the texts'
    words of letters, alone and joined as snake, dash, path and camel case names.
    """
    share = min(1.0, n_docs / max(1, docs.count()))
    few = (docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
           .where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct())
    digest = F.sha2(F.concat(F.col("id"), F.lit("/sample")), 256)
    forms = F.array(digest, F.base64(F.unhex(digest)), F.translate(F.base64(F.unhex(digest)), "+/=", "-_"),
                    F.upper(F.concat(F.conv(F.substring(digest, 1, 15), 16, 36), F.conv(F.substring(digest, 16, 15), 16, 36))))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z]{2,}"), F.lit(0))
    triples = F.transform(F.sequence(F.lit(0), F.floor((F.size("w") + 2) / 3).cast("int")), lambda i: F.slice("w", i * 3 + 1, 3))

    def names(p):
        lower = F.transform(p, lambda x: F.lower(x))
        return F.array(F.array_join(p, ""), F.array_join(lower, "_"), F.array_join(lower, "-"), F.array_join(lower, "/"),
                       F.array_join(F.transform(p, lambda x: F.initcap(x)), ""), F.upper(F.array_join(p, "_")),
                       F.concat(F.array_join(lower, "_"), F.lit("_"), F.pmod(F.xxhash64(p), F.lit(100)).cast("string")))

    told = lambda tokens, flag: F.transform(tokens, lambda t: F.struct(t.alias("token"), F.lit(flag).alias("is_random")))
    ordinary = F.flatten(F.transform(F.filter("p", lambda p: F.size(p) > 0), names))
    rows = few.select(forms.alias("forms"), words.alias("w")).select("forms", triples.alias("p"))
    return rows.select(F.explode(F.concat(told(F.col("forms"), True), told(ordinary, False))).alias("s")).select("s.token", "s.is_random")


def train(labelled: DataFrame, *, smoothing: float = 0.5) -> np.ndarray:
    """Log-likelihood ratios (ALPHABET + 1 rows: the last is the start; ALPHABET columns)."""
    code = F.array_compact(F.transform(F.split("token", ""), lambda c: F.when((F.ascii(c) > 32) & (F.ascii(c) < 127), F.ascii(c) - 33)))
    pairs = (labelled.where(F.length("token") > 0).select("is_random", code.alias("c")).where(F.size("c") > 0)
             .select("is_random", F.explode(F.arrays_zip(F.concat(F.array(F.lit(ALPHABET)), F.slice("c", 1, F.size("c") - 1)).alias("a"),
                                                         F.col("c").alias("b"))).alias("p")))
    counts = np.full((2, ALPHABET + 1, ALPHABET), smoothing)
    for r in pairs.groupBy("is_random", "p.a", "p.b").count().collect():  # at most 2 x 95 x 94 rows
        counts[int(r.is_random), r.a, r.b] += r["count"]
    share = counts / counts.sum(axis=2, keepdims=True)
    return np.log(share[1] / share[0])


def _table(ratios: np.ndarray) -> Column:
    """The ratios as one constant array (95 x 94 doubles)."""
    return F.split(F.lit(",".join(f"{x:.5f}" for x in ratios.ravel())), ",").cast("array<double>")


def ratio(token: Column, table: Column) -> Column:
    """Sum of the log-likelihood ratios of the token's character pairs."""
    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c) - 33)
    start = F.struct(F.lit(ALPHABET).alias("a"), F.lit(0.0).alias("s"))
    step = lambda acc, c: F.struct(c.alias("a"), (acc["s"] + F.get(table, acc["a"] * ALPHABET + c)).alias("s"))
    return F.aggregate(codes, start, step, lambda acc: acc["s"])


_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, hint: str, pattern: str, kind: int, group: int, keep) -> Column:
    """Spans of the matches whose counted group passes ``keep``; code points."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("match"), value.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc, x):
        lo = acc["at"] + F.char_length(x["gap"])
        hi = lo + F.coalesce(F.char_length(x["match"]), F.lit(0))
        span = F.array(F.struct(lo.alias("start"), F.lit(kind).alias("kind"), hi.alias("end")))
        good = x["match"].isNotNull() & keep(x["value"])
        return F.struct(hi.alias("at"), F.when(good, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(parts, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(hint), found).otherwise(F.array().cast(_SPAN))


def find(text: Column, ratios: np.ndarray, *, min_ratio: float = MIN_RATIO, min_mean: float = MIN_MEAN) -> tuple[Column, Column]:
    """(base spans, random spans not overlapping them as a function of the base spans)."""
    text = F.coalesce(text, F.lit(""))
    base = [_spans(text, _HINTS[k], _FAST[k], k, RULES[k][2], lambda v, n=RULES[k][3]: F.char_length(v) >= n) for k in range(3)]
    table = _table(ratios)

    def is_random(v):
        s = ratio(v, table)
        return (s >= min_ratio) & (s >= F.char_length(v) * min_mean)

    return F.array_sort(F.concat(*base)), _spans(text, TOKEN, TOKEN, 3, 0, is_random)


def scan(docs: DataFrame, ratios: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per row: id, base (spans of the rules), spans (all): arrays of start, kind (see KINDS), end."""
    base, more = find(F.col(f"`{text_col}`"), ratios, **limits)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), base.alias("base"), more.alias("more"))
    apart = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return rows.select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, ratios: np.ndarray, *, text_col: str = "text", mark: str = "[REDACTED]", **limits) -> DataFrame:
    """All rows and columns, with each secret (overlapping spans as one) replaced by ``mark``."""
    base, more = find(F.col(f"`{text_col}`"), ratios, **limits)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.array_sort(F.concat(base, more)).alias("spans"))
    text = F.col(f"row.`{text_col}`")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    end = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))
    new = F.when(F.size("spans") > 0, F.aggregate("spans", start, step, end)).otherwise(text)
    return rows.select(*[(new if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
