"""Quality rules by distribution divergence.

Base rules count symbols, repeated lines and repeated three-word windows.  The method
then compares two histograms of each document with the reference of its language, by
Jensen-Shannon distance (square root of the divergence in bits, 0 to 1):

* character classes (``CLASSES``), the reference being the median share of each class over
  all documents of the language (the median does not move with a minority of junk),
* common words: the ``common`` most frequent words of the language (lower case, edge
  punctuation stripped) and one bin for the rest.

References come from exact aggregates over all documents: class shares in bins of a
thousandth, and word counts whose ``common`` largest per language are kept.  The characters
are judged when the document has ``min_words`` words of any kind, its words when it has
``min_words`` of letters or digits (edge symbols stripped); each limit widens by ``slack /
sqrt(words)``, of the same words, because short texts scatter more.

Every language is judged by its own reference with a weight a = words / (words + ``prior``), words being
those of the language in the table: the character distance is a times the distance to its own medians plus
1 - a times the distance to the pooled medians of all languages, with the
letters beyond ASCII (class ``wide``) counted as lower-case letters there, because languages differ
in these; the word distance is a times the distance to its own words, as the words of other languages are
no reference.  There is no size at which the verdict jumps.  Where there are more than ``max_languages``
languages, they are dealt into slices of about so many, judged one slice after another, each by its own broadcast.

A very long text is one row, held by its task with its words.
Defined cases: null text: no words, base_failed; null language: a language of its own;
repeated rows count as often as they stand; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeway.llm.common import Shared, slices, texts_of
from ridgeway.llm.graph import store

CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other", "wide")
_STRIP = b".,;:!?\"'()[]{}#*$%&|<>-_"
#: Fixed defaults of the verdict.
COMMON, MIN_WORDS, PRIOR = 100, 50, 2000
MAX_LANGUAGES, BINS = 1000, 1000
#: Memory of a task's word counts, and of one of them beside its word.
TALLY_BYTES, ENTRY_BYTES = 40 << 20, 200
#: With 0.4, 98.4 % (sf0.1) and 99.3 % (check_s) of the good documents of 50 to 99 words are kept; rates by length: README.
CHAR_LIMIT, CHAR_SLACK, WORD_LIMIT, WORD_SLACK = 0.15, 0.4, 0.30, 2.0


def _class_table() -> np.ndarray:
    """Class of each byte; bytes that continue a UTF-8 character have none (8)."""
    out = np.full(256, 6, dtype=np.uint8)
    for b in range(128):
        c = chr(b)
        out[b] = (0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if b in b"\t\n\v\f\r "
                  else 4 if c in ".,;:!?'\"()-" else 5 if c in "#*$%&|<>" else 6)
    out[0x80:0xC0] = 8
    out[0xC0:] = 7
    return out


_CLASS = _class_table()


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=9)[:8]


def folded(counts: np.ndarray) -> np.ndarray:
    """The class counts with ``wide`` among ``lower``."""
    return np.concatenate(([counts[0] + counts[7]], counts[1:7]))


def bare_words(text: bytes) -> list[bytes]:
    return [w for w in (x.strip(_STRIP) for x in text.lower().split()) if w]


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = text.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode())
    symbols = len(joined) - len(joined.translate(None, b"#*$%&|<>"))
    lines = [x for x in text.split(b"\n") if x.split()]
    dup = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:]))
    repeat = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        hit = np.zeros(n + 3, dtype=bool)
        at = np.flatnonzero([times[w] > 1 for w in windows])
        for k in range(3):
            hit[at + k] = True
        repeat = int(hit.sum())
    return n, chars, symbols, dup, repeat


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms (any positive totals), 0 to 1."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0.0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


class References:
    """Histograms by language; built from bounded aggregates (languages x bins).  ``pooled``: the class
    shares (folded) of all languages together; without them a language's own are all there is."""

    def __init__(self, classes: dict, words: dict, totals: dict, prior: float = PRIOR, pooled: list | None = None):
        self.classes, self.words, self.totals, self.weights = {}, {}, totals, {}
        self.pooled = None if pooled is None else np.array(pooled, dtype=float) + 1e-6
        for lang, total in totals.items():
            self.weights[lang] = total / (total + prior)
            self.classes[lang] = np.array(classes[lang], dtype=float) + 1e-6
            top = words[lang]
            self.words[lang] = ({w: i for i, (w, _) in enumerate(top)},
                                np.array([c for _, c in top] + [max(0.5, total - sum(c for _, c in top))], dtype=float))

    def distances(self, lang, text: bytes) -> tuple[float, float | None, int] | None:
        """(class distance, word distance, bare words), both distances weighted as said above; None without a reference or
        characters, no word distance without bare words or words of the language."""
        counts = class_counts(text)
        if not counts.sum() or lang not in self.classes and self.pooled is None:
            return None
        words, own = bare_words(text), self.weights.get(lang, 0.0)
        far = None if self.pooled is None else js_distance(folded(counts), self.pooled)
        if lang not in self.classes:
            return far, None, len(words)
        near = js_distance(counts, self.classes[lang])
        c = near if far is None else own * near + (1 - own) * far
        if not words:
            return c, None, 0
        index, reference = self.words[lang]
        rest = len(reference) - 1
        seen = np.bincount([index.get(w, rest) for w in words], minlength=rest + 1)
        return c, own * js_distance(seen, reference), len(words)


def _count(batches):
    """Per task: word counts and, under keys that no word can have, documents by class and bin."""
    tally, read = defaultdict(Counter), 0

    def rows():
        for lang, c in tally.items():
            keys, values = list(c.keys()), list(c.values())
            for at in range(0, len(keys), 100_000):
                k = keys[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(k), pa.string()), pa.array(k, pa.binary()),
                     pa.array(values[at:at + 100_000], pa.int64())], names=["lang", "key", "n"])
        tally.clear()

    for batch in slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch.column("text"))):
            counts = class_counts(text)
            if total := int(counts.sum()):
                tally[lang].update([b" %d %d" % (k, n * BINS // total) for k, n in enumerate([*counts.tolist(), int(folded(counts)[0])])])
            tally[lang].update(bare_words(text))
        read += batch.nbytes
        # bounded memory, by entries and by the bytes that their words can hold: the aggregate adds the parts up
        if read > TALLY_BYTES or sum(map(len, tally.values())) * ENTRY_BYTES > TALLY_BYTES:
            yield from rows()
            read = 0
    yield from rows()


def _slice_of(lang, n: int):
    return F.pmod(F.xxhash64(F.coalesce(F.concat(F.lit("l"), lang), F.lit(""))), F.lit(n)) if n > 1 else F.lit(0)


def reference_slices(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", common: int = COMMON,
                     prior: float = PRIOR, max_languages: int = MAX_LANGUAGES):
    """(number of slices, iterator of their References): exact counts over all rows; of a slice, languages x (``common`` + classes)
    numbers reach the driver."""
    counts = store(docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
                   .mapInArrow(_count, "lang string, key binary, n long")
                   .groupBy("lang", "key").agg(F.sum("n").alias("n"))
                   .withColumn("is_class", F.substring("key", 1, 1) == F.lit(b" ")), "counts")  # read several times below
    text_key = F.split(F.col("key").cast("string"), " ")
    bins = counts.where("is_class").select("lang", "n", text_key[1].cast("int").alias("k"), text_key[2].cast("int").alias("b"))

    def medians(bins):
        below = W.partitionBy("lang", "k")
        return (bins.withColumn("up", F.sum("n").over(below.orderBy("b"))).withColumn("all", F.sum("n").over(below))
                .where(F.col("up") * 2 >= F.col("all")).groupBy("lang", "k").agg(F.min("b").alias("b")))

    pooled = {r.k: r.b for r in medians(bins.groupBy("k", "b").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(""))).collect()}
    pooled = [pooled[k] for k in (8, *range(1, 7))] if pooled else None
    n = max(1, -(-counts.select("lang").distinct().count() // max_languages))

    def one(k: int) -> References:
        here = _slice_of(F.col("lang"), n) == k
        # word totals, and the largest words first of each of 64 hash buckets: no task ranks all words of a language
        keyed = counts.where(here & ~F.col("is_class")).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(64)))
        totals = {r.lang: r.total for r in keyed.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
        largest = [F.desc("n"), F.col("key")]
        tops = (keyed.withColumn("r", F.row_number().over(W.partitionBy("lang", "bucket").orderBy(*largest))).where(F.col("r") <= common)
                .withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(*largest))).where(F.col("r") <= common))
        words, classes = defaultdict(list), defaultdict(lambda: [0] * 9)
        for r in tops.select("lang", "key", "n").collect():
            words[r.lang].append((bytes(r.key), r.n))
        for r in medians(bins.where(here)).collect():
            classes[r.lang][r.k] = r.b
        words = {lang: sorted(v, key=lambda x: (-x[1], x[0])) for lang, v in words.items()}
        return References({lang: classes[lang][:8] for lang in totals}, words, totals, prior, pooled)

    return n, map(one, range(n))


def references(docs: DataFrame, **options) -> References:
    """The references of all languages in one object (options: see ``reference_slices``)."""
    _, (refs,) = reference_slices(docs, **{"max_languages": 1 << 40, **options})
    return refs


def _by_slices(docs: DataFrame, refs: References | None, lang_col: str, text_col: str, limits: dict, judged) -> DataFrame:
    """``judged(rows, shared rules)`` of every slice of languages, together."""
    if refs is not None:
        return judged(docs, Shared(docs.sparkSession, Rules(refs, **limits)))
    made = {k: limits.pop(k) for k in ("common", "prior", "max_languages") if k in limits}
    n, every = reference_slices(docs, lang_col=lang_col, text_col=text_col, **made)
    out = None
    for k, part in enumerate(every):
        rows = docs if n == 1 else docs.where(_slice_of(F.col(f"`{lang_col}`").cast("string"), n) == k)
        rows = judged(rows, Shared(docs.sparkSession, Rules(part, **limits)))
        out = rows if out is None else out.unionAll(rows)
    return out


class Rules:
    """The verdict on one text; picklable."""

    def __init__(self, refs: References, char_limit: float = CHAR_LIMIT, char_slack: float = CHAR_SLACK,
                 word_limit: float = WORD_LIMIT, word_slack: float = WORD_SLACK, min_words: int = MIN_WORDS):
        self.refs, self.min_words = refs, min_words
        self.char_limit, self.char_slack, self.word_limit, self.word_slack = char_limit, char_slack, word_limit, word_slack

    def judge(self, lang, text: bytes):
        """(base counts, base_failed, class distance, word distance, kept)."""
        base = base_counts(text)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        found = self.refs.distances(lang, text)
        if found is None:
            return base, failed, None, None, not failed
        c, w, n = found
        bad = (base[0] >= max(1, self.min_words) and c > self.char_limit + self.char_slack / np.sqrt(base[0])
               or w is not None and n >= max(1, self.min_words) and w > self.word_limit + self.word_slack / np.sqrt(n))
        return base, failed, c, w, not failed and not bad


def score(docs: DataFrame, refs: References | None = None, *, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", **limits) -> DataFrame:
    """Per row: id, base counts, base_failed, char_distance, word_distance, kept."""
    return _by_slices(docs, refs, lang_col, text_col, limits, lambda rows, shared: _scored(rows, shared, id_col, text_col, lang_col))


def _scored(docs: DataFrame, shared: Shared, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def judge(batches):
        rule = shared.value
        for batch in slices(batches):
            out = [rule.judge(lang, t) for lang, t in zip(batch.column("lang").to_pylist(), texts_of(batch.column("text")))]
            cols = [pa.array([o[0][k] for o in out], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *cols, pa.array([o[1] for o in out], pa.bool_()),
                 pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.float64()),
                 pa.array([bool(o[4]) for o in out], pa.bool_())],
                names=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "char_distance", "word_distance", "kept"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(judge, f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                 "n_repeat_words long, base_failed boolean, char_distance double, word_distance double, "
                                 "kept boolean").withColumnRenamed("id", id_col)


def keep(docs: DataFrame, refs: References | None = None, *, text_col: str = "text", lang_col: str = "lang",
         **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    return _by_slices(docs, refs, lang_col, text_col, limits, lambda rows, shared: _kept(rows, shared, text_col, lang_col))


def _kept(docs: DataFrame, shared: Shared, text_col: str, lang_col: str) -> DataFrame:
    def kept(batches):
        rule = shared.value
        for batch in slices(batches):
            row = batch.column("row")
            langs = row.field(lang_col).cast(pa.string()).to_pylist()
            yield batch.filter(pa.array([bool(rule.judge(lang, t)[4]) for lang, t in zip(langs, texts_of(row.field(text_col)))], pa.bool_()))

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.mapInArrow(kept, rows.schema).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
