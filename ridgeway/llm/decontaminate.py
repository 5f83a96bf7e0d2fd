"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Texts are normalised (A-Z lower-cased, words are runs of ASCII digits, ASCII letters
and all non-ASCII characters).  Every window of ``window`` consecutive item words goes
into a hash set; an item of fewer words, but not none, is one window of its own length.
The set is arrays: sorted 64-bit window hashes, the place of each window in the items' normalised
words, its owners, and a table of flags that turns most document windows away at one look.  A document's
windows are hashed by whole arrays; a window whose hash is found is compared with the
item's words, so a hit is exact.  Every word inside an occurrence is hit.

The set is broadcast only up to ``max_bytes``, which bound the set itself: ``WORD_BYTES`` a word and the
normalised text, counted before it is built.  A larger benchmark is
cut into slices of at most that size (an item is never cut), which pass over the documents one after another;
the hits found so far travel with the rows in a table in the shared folder.

A very long text is one row, held by its task with its words and 8 bytes a window.
Defined cases: a null or empty text has no words, no hits and is not contaminated; an
item without words has no window; repeated item ids count once, a null item id is
"null"; an empty benchmark or table gives no hits or no rows; other columns are carried
through ``clean`` untouched, whatever their names.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeway.llm.common import Shared, mix64, slices, texts_of
from ridgeway.session import scratch_path

WINDOW = 13
#: Bytes that one broadcast set may hold, and bytes of it a benchmark word takes beside its text.
MAX_BYTES, WORD_BYTES = 128 << 20, 32


def _table() -> bytes:
    out = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        out[b] = ord(c.lower()) if c.isalnum() else 0x20
    return bytes(out)


_NORMAL = _table()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _hashes(words: list[bytes]) -> np.ndarray:
    return mix64(np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words)))


def _windows(codes: np.ndarray, longest: int):
    """(n, hashes of all windows of n words) for n = 1, 2, ..., ``longest``."""
    h = codes
    for n in range(1, min(longest, len(codes)) + 1):
        if n > 1:
            h = h[:-1] * _FACTOR + codes[n - 1:]
        yield n, h


class _Table:
    """The windows of one length: ``hashes`` (sorted), ``at`` (word at which the window stands), owners from
    ``first[k]`` to ``first[k + 1]``; ``flags`` says whether any window has a hash's low bits."""

    def __init__(self, h: np.ndarray, at: np.ndarray, owner: np.ndarray, text_of):
        order = np.lexsort((owner, h))
        h, at, owner = h[order], at[order], owner[order]
        new = np.ones(len(h), dtype=bool)        # entry starts a window of its own
        keep = np.ones(len(h), dtype=bool)       # entry names an owner not yet named
        same = np.flatnonzero(h[1:] == h[:-1]) + 1
        cuts = np.flatnonzero(np.diff(same) != 1) + 1
        for run in np.split(same, cuts) if len(same) else []:
            run = np.concatenate(([run[0] - 1], run))
            texts = [text_of(int(at[k])) for k in run]
            if len(set(texts)) > 1:              # equal hashes of different windows: put equal texts together
                by = sorted(range(len(run)), key=lambda k: (texts[k], owner[run[k]]))
                at[run], owner[run], texts = at[run[by]], owner[run[by]], [texts[k] for k in by]
            equal = np.array([x == y for x, y in zip(texts[1:], texts)])
            new[run[1:]] = ~equal
            keep[run[1:]] = ~equal | (owner[run[1:]] != owner[run[:-1]])
        self.hashes, self.at = h[new], at[new].astype(np.int32)
        self.owners = owner[keep].astype(np.int32)
        self.first = np.append(np.flatnonzero(new[keep]), keep.sum()).astype(np.int32)
        bits = max(1, int(4 * len(self.hashes) - 1).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.flags = np.zeros(1 << bits, dtype=bool)
        self.flags[(self.hashes & self.mask).astype(np.int64)] = True

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.hashes, self.at, self.owners, self.first, self.flags))

    def candidates(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in ``h`` with an equal hash here, and the range of entries of that hash."""
        i = np.flatnonzero(self.flags[(h & self.mask).astype(np.int64)])
        lo, hi = np.searchsorted(self.hashes, h[i], "left"), np.searchsorted(self.hashes, h[i], "right")
        found = hi > lo
        return i[found], lo[found], hi[found]


class NgramSet:
    """Windows of benchmark items; picklable."""

    def __init__(self, items, window: int = WINDOW):
        self.ids: list[str] = []
        texts, codes, ends = [], [], []
        for item_id, text in items:
            if words := words_of(text):
                self.ids.append("null" if item_id is None else str(item_id))
                texts.append(b" ".join(words))
                codes.append(_hashes(words))
                ends.append(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        self.text, self.tables = b" ".join(texts), {}
        self.starts = np.concatenate([[0], np.cumsum(np.concatenate(ends))] if ends else [[0]]).astype(np.int32)
        if not texts:
            return
        lengths = np.array([len(c) for c in codes])
        item = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        firsts = np.cumsum(lengths) - lengths
        for n, h in _windows(np.concatenate(codes), window):
            if n == window:
                at = np.flatnonzero(item[:len(h)] == item[n - 1:])
            else:
                at = firsts[lengths == n]
            if len(at):
                self.tables[n] = _Table(h[at], at, item[at], lambda k, n=n: self._words_at(k, n))

    def _words_at(self, k: int, n: int) -> bytes:
        return self.text[self.starts[k]:self.starts[k + n] - 1]

    @property
    def nbytes(self) -> int:
        return len(self.text) + self.starts.nbytes + sum(t.nbytes for t in self.tables.values())

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """(hit word positions or None, item ids with an occurring window)."""
        edge, found = None, set()
        if not self.tables or not words:
            return None, found
        for n, h in _windows(_hashes(words), max(self.tables)):
            if n not in self.tables:
                continue
            table, seen = self.tables[n], {}
            for i, lo, hi in zip(*(x.tolist() for x in table.candidates(h))):
                gram = b" ".join(words[i:i + n])
                if gram not in seen:             # owners once a window, however often it stands in the text
                    seen[gram] = False
                    for k in range(lo, hi):
                        if self._words_at(int(table.at[k]), n) == gram:
                            seen[gram] = True
                            found.update(table.owners[table.first[k]:table.first[k + 1]].tolist())
                if seen[gram]:
                    if edge is None:
                        edge = np.zeros(len(words) + 1, dtype=np.int64)
                    edge[i] += 1
                    edge[i + n] -= 1
        if edge is None:
            return None, set()
        return np.flatnonzero(np.cumsum(edge[:-1]) > 0), {self.ids[k] for k in found}


_STATE = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def _pass(rows: DataFrame, text: str, ngrams, out: T.StructType) -> DataFrame:
    """Adds one slice's hits to the state that travels with each row."""
    import pyarrow.types as pt

    def scan(batches):
        grams = ngrams.value
        for batch in slices(batches):
            column = batch.column("row").field(text)
            valid = batch.column("row").is_valid()
            assert pt.is_string(column.type) or pt.is_large_string(column.type), column.type
            old = batch.column("state").to_pylist() if "state" in batch.schema.names else [None] * batch.num_rows
            state = []
            for row, was, ok in zip(texts_of(column), old, valid.to_pylist()):
                words = words_of(row) if ok else []
                hits, items = grams.scan(words)
                was = was or {"hits": [], "items": []}
                hits = was["hits"] if hits is None else np.union1d(np.array(was["hits"], dtype=np.int32), hits.astype(np.int32))
                state.append({"n_words": len(words), "hits": hits, "items": sorted(items.union(was["items"]))})
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"),
                 pa.array(state, type=pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]))],
                names=["row", "state"])

    return rows.mapInArrow(scan, out)


def _scanned(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str,
             window: int, max_bytes: int) -> DataFrame:
    """(row struct of all columns, state) for every row."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("string").alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    n_words = F.size(F.split("t", r"[^0-9A-Za-z\x{80}-\x{10ffff}]+"))      # or one or two more
    total = items.agg(F.sum(F.octet_length("t") + n_words * WORD_BYTES)).first()[0] or 0
    n_slices = -(-total * 2 // max_bytes) if total > max_bytes else 1
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = T.StructType([rows.schema["row"], T.StructField("state", _STATE)])
    for k in range(n_slices):
        part = items if n_slices == 1 else items.where(F.pmod(F.xxhash64("t"), F.lit(n_slices)) == k)
        grams = NgramSet(((r.i, r.t.encode()) for r in part.toLocalIterator()), window)
        if k:  # bounded state: what earlier slices found is read back from the shared folder
            path = scratch_path(spark, "decontaminate")
            rows.write.parquet(path)
            rows = spark.read.schema(out).parquet(path)
        rows = _pass(rows, text, Shared(spark, grams), out)
    return rows


def _contaminated(share: int):
    n_hit = F.size("state.hits")
    return (n_hit > 0) & (n_hit * share >= F.col("state.n_words"))


def scan(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
         share: int = 20, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Per document: id, n_words, hit word positions, sorted ids of the items with an
    occurring window, contaminated (any hit, and ``share`` * hits >= words)."""
    rows = _scanned(docs.select(id_col, text_col), benchmark, text_col, item_col, item_text_col, window, max_bytes)
    return rows.select(F.col(f"row.`{id_col}`").alias(id_col), "state.n_words", F.col("state.hits").alias("hit_words"),
                       F.col("state.items").alias("item_ids"), _contaminated(share).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW, share: int = 20,
          max_bytes: int = MAX_BYTES, remove: str = "documents") -> DataFrame:
    """The rows of ``docs``, all columns as they were.  ``remove="documents"`` drops the
    contaminated ones; ``remove="spans"`` keeps every row and cuts the hit words (normalised
    word runs, with what stands between them) out of the text instead."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    rows = _scanned(docs, benchmark, text_col, item_col, item_text_col, window, max_bytes)
    if remove == "documents":
        rows = rows.where(~_contaminated(share))
        return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])

    @F.pandas_udf("string")
    def cut(text, hits):
        import pandas as pd
        return pd.Series([cut_spans(t or "", h) for t, h in zip(text, hits)], dtype=object)

    return rows.select(*[(F.when(F.size("state.hits") > 0, cut(F.col(f"row.`{c}`"), F.col("state.hits")))
                          .otherwise(F.col(f"row.`{c}`")) if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def cut_spans(text: str, hits) -> str:
    """``text`` without its hit words and the separators between neighbouring hit words."""
    import re
    spans = [m.span() for m in re.finditer(r"[0-9A-Za-z\u0080-\U0010ffff]+", text)]
    hit = set(map(int, hits))
    out, at = [], 0
    for k in sorted(hit):
        if k - 1 not in hit:
            out.append(text[at:spans[k][0]])
        at = spans[k][1]
    return "".join(out) + text[at:]
