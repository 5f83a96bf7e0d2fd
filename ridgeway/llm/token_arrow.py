"""Token ids as Arrow files of equal-length sequences.

Documents are put in ascending order of their id by a range partitioning, encoded, each
closed by an end id, and packed without gaps.  Each partition becomes one file in the
Arrow IPC file format: record batches of ``batch`` rows with two fixed-size-list columns,
``input_ids`` (``length`` ids; 16 bits where the vocabulary allows, else 32) and ``mask``
(false on the padding of the file's last sequence).  Buffers are not compressed, so a
memory-mapped file gives any sequence, and any document, without copying or parsing.

The index (document, file, first id in the file, number of ids) is written by the same
tasks as a Parquet table; only files that a committed row of it names are ever read.

Encoding: the tokenizers library.  With a byte-level file without a normaliser, a Western text
falls apart into the pre-tokenizer's runs: a batch's texts are cut into runs together, Arrow numbers the
distinct ones, and the library's model is called once for each of them that a worker does not keep; other
scripts, special tokens and other files send the whole text through the library.

Defined cases: null text: empty, the end id alone; equal ids: ordered by a hash of the text;
null ids first; special tokens in a text are their ids, as the library does by default;
an empty table: no files and no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeway.llm.common import AttemptFile, Cache, Shared, byte_symbols, open_input, slices, worker_state
from ridgeway.session import scratch_path

#: Ids in a sequence, sequences in a record batch, bytes of one generation of a worker's cache, characters cut into runs at a time.
LENGTH, BATCH, CACHE_BYTES, PIECE = 2048, 256, 96 << 20, 1 << 21


class RunEncoder:
    """Texts -> ids as little-endian uint32; keeps the ids of the pre-tokenizer's runs."""

    LETTER, NUMBER, SPACE, REST = range(4)
    #: The characters whose classes no two versions dispute.
    KNOWN = r"\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac"

    def __init__(self, source: str, cache: int = CACHE_BYTES, piece: int = PIECE):
        import json
        import re

        import regex
        from tokenizers import Tokenizer, models

        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        spec = json.loads(source)
        if spec["model"].get("type") == "BPE":  # the same model without a cache of its own: runs are asked for once
            merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
            rest = {k: v for k, v in spec["model"].items() if k not in ("type", "vocab", "merges") and v is not None}
            self.model = models.BPE(vocab=spec["model"]["vocab"], merges=merges, cache_capacity=0, **rest)
        pre = spec.get("pre_tokenizer") or {}
        self.splits = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                       and not pre.get("add_prefix_space"))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.runs, self.symbol, self.piece = Cache(self._run, cache), byte_symbols(), piece
        self.other = re.compile(f"[^{self.KNOWN}]").search
        # whatever lies around: a run ends in front of white space behind something else, and behind a letter in front of none
        self.border = re.compile(r"(?<=\S)(?=[\t-\r ])|(?<=[A-Za-z])(?=[!-@\[-`{-~])").search
        self.kinds = np.full(0x20ad, self.REST, dtype=np.uint8)
        for kind, pattern in ((self.LETTER, r"\p{L}"), (self.NUMBER, r"\p{N}"), (self.SPACE, r"\s")):
            fits = regex.compile(pattern).fullmatch
            self.kinds[[c for c in range(len(self.kinds)) if fits(chr(c))]] = kind

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _run(self, run: str) -> bytes:
        if run.isascii() and run.isprintable():  # all but the blank stand for themselves
            symbols = run.replace(" ", self.symbol[32])
        else:
            symbols = "".join([self.symbol[b] for b in run.encode()])
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def _starts(self, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where the runs of the byte-level pre-tokenizer start in texts that lie one behind another, each at a
        position of ``first``: ``'(?:s|t|re|ve|m|ll|d)| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``."""
        kind = self.kinds[chars]
        start = np.empty(len(chars), dtype=bool)
        start[0], start[1:] = True, kind[1:] != kind[:-1]
        space = kind == self.SPACE
        end = np.zeros(len(chars), dtype=bool)          # the last character of a text
        start[first], end[first[1:] - 1], end[-1] = True, True, True
        # the last of the white space in front of something else stands alone, a blank with what follows
        last = np.flatnonzero(space[:-1] & ~space[1:] & ~end[:-1])
        start[last] = True
        start[last[chars[last] == ord(" ")] + 1] = False
        # an apostrophe that starts a run takes the letters of its ending, whatever follows them
        at = np.flatnonzero((chars == ord("'")) & start & ~end)
        one = chars[at + 1]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pairs = at[~short & ~end[at + 1]]
        pair = chars[pairs + 1] << 8 | chars[pairs + 2]
        pairs = pairs[np.isin(pair, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])]
        for found, length in ((at[short], 2), (pairs, 3)):
            start[found + 1] = False
            behind = found + length
            start[behind[behind < len(chars)]] = True
        return np.flatnonzero(start)

    def _pieces(self, text: str):
        at = 0
        while len(text) - at > self.piece:
            cut = self.border(text, at + self.piece)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _joined(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text (none empty), all of known characters."""
        joined = "".join(texts)
        chars = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        lengths = np.array([len(t) for t in texts])
        first = np.cumsum(lengths) - lengths
        starts = self._starts(chars, first)
        data = joined.encode()
        borders = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)[starts]
        offsets = np.append(borders, len(data)).astype(np.int32)
        runs = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        ids = list(map(self.runs.__getitem__, runs.dictionary.to_numpy(zero_copy_only=False)))
        sizes = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) >> 2
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)),
                                         pa.array(np.frombuffer(b"".join(ids), dtype="<u4")))
        flat = lists.take(runs.indices).flatten().to_numpy()
        total = np.append(0, np.cumsum(sizes[runs.indices.to_numpy()], dtype=np.int64))
        return np.split(flat, total[np.searchsorted(starts, first[1:])])

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; about ``piece`` characters are taken at a time, however long the texts are."""
        out: list = [[] for _ in texts]
        held, owners, size = [], [], 0

        def flush():
            nonlocal held, owners, size
            if held:
                for k, ids in zip(owners, self._joined(held)):
                    out[k].append(ids)
            held, owners, size = [], [], 0

        for k, text in enumerate(texts):
            if not self.splits or not text.isascii() and self.other(text) or any(s in text for s in self.special):
                out[k].append(self.whole(text))
                continue
            for part in self._pieces(text):
                if size and size + len(part) > self.piece:
                    flush()
                if part:
                    held.append(part)
                    owners.append(k)
                    size += len(part)
        flush()
        return [v[0] if len(v) == 1 else np.concatenate(v) if v else np.zeros(0, dtype="<u4") for v in out]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0].tobytes()


class SequenceFile:
    """Packs ids into sequences and writes them in batches; holds one batch at most."""

    def __init__(self, folder: str, kind, length: int, batch: int):
        self.file = AttemptFile(folder, ".arrow")
        self.kind, self.length, self.room = kind, length, length * batch
        self.schema = pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(self.file.stream, self.schema)
        self.held, self.n_held, self.total = [], 0, 0

    def add(self, ids: np.ndarray) -> int:
        """Position of the first id in the file."""
        at = self.total
        self.total += len(ids)
        while len(ids):
            take = ids[:self.room - self.n_held]
            self.held.append(take)
            self.n_held += len(take)
            ids = ids[len(take):]
            if self.n_held == self.room:
                self._flush()
        return at

    def _flush(self):
        if not self.n_held:
            return
        n = -(-self.n_held // self.length) * self.length
        values = np.zeros(n, dtype=self.kind)
        np.concatenate(self.held, out=values[:self.n_held])
        mask = np.arange(n) < self.n_held
        self.writer.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(values), self.length),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))
        self.held, self.n_held = [], 0

    def close(self):
        self._flush()
        self.writer.close()
        self.file.close()


class SequenceReader:
    """Random access to the ids of a file; zero copy inside a record batch."""

    def __init__(self, folder: str, name: str):
        self.reader = pa.ipc.open_file(open_input(folder, name))
        self.length = self.reader.schema.field("input_ids").type.list_size
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0

    def sequence(self, k: int):
        """(ids, mask) of the k-th sequence."""
        batch = self.reader.get_batch(k // self.rows)
        return batch.column(0)[k % self.rows].values, batch.column(1)[k % self.rows].values

    def ids(self, start: int, n: int) -> np.ndarray:
        per, parts = self.rows * self.length, []
        while n:
            batch = self.reader.get_batch(start // per)
            values = batch.column(0).flatten().to_numpy()
            part = values[start % per:start % per + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write(docs: DataFrame, tokenizer_path: str, folder: str | None = None, *, end_id: int, id_col: str = "doc_id",
          text_col: str = "text", length: int = LENGTH, batch: int = BATCH) -> tuple[DataFrame, str]:
    """Writes the files; returns (index, folder).  Index: id, part, file, at, n_tokens, start
    (ids of all documents before it, over all files)."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    with open(tokenizer_path, encoding="utf-8") as f:
        source = f.read()
    shared, key = Shared(spark, source), str(hash(source))
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    ordered = src.withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text")

    def run(batches):
        state = worker_state("token_arrow")
        if state.get("run_key") != key:
            state["run_key"], state["run"] = key, RunEncoder(shared.value)
        coder = state["run"]
        kind = np.dtype("<u2" if max(coder.library.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        close, part, out = np.array([end_id], dtype=kind), TaskContext.get().partitionId(), None
        for rows in slices(batches, owner="token_arrow"):
            out = out or SequenceFile(folder, kind, length, batch)
            at, n = [], []
            for ids in coder.encode_all(rows.column("text").to_pylist()):
                ids = np.append(ids.astype(kind), close)
                at.append(out.add(ids))
                n.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array([part] * len(n), pa.int32()), pa.array([out.file.name] * len(n), pa.string()),
                 pa.array(at, pa.int64()), pa.array(n, pa.int64())], names=["id", "part", "file", "at", "n_tokens"])
        if out:
            out.close()

    kind = src.schema["id"].dataType.simpleString()
    ordered.mapInArrow(run, f"id {kind}, part int, file string, at long, n_tokens long").write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    # one row per file: the running total over files is as small as the list of files
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = files.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    full = index.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("at")).drop("before")
    return full.withColumnRenamed("id", id_col), folder


def read(index: DataFrame, folder: str, *, id_col: str = "doc_id", digest=None, digest_schema: str = "") -> DataFrame:
    """Per document from the files: id, start, n_tokens, ids (array of long).  ``digest`` maps one
    document's ids (numpy, as stored) to the value of a column ``digest_schema`` instead."""
    src = index.select(F.col(f"`{id_col}`").alias("id"), "file", "at", "start", "n_tokens")

    def run(batches):
        name = reader = None
        for rows in slices(batches, 1 << 20):
            values = []
            for file, at, n in zip(rows.column("file").to_pylist(), rows.column("at").to_pylist(), rows.column("n_tokens").to_pylist()):
                if file != name:
                    name, reader = file, SequenceReader(folder, file)
                ids = reader.ids(at, n)
                values.append(digest(ids) if digest else ids.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("start"), rows.column("n_tokens"),
                 pa.array(values, pa.int64() if digest else pa.list_(pa.int64()))], names=["id", "start", "n_tokens", "value"])

    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, start long, n_tokens long, value {'long' if digest else 'array<long>'}")
    return out.withColumnsRenamed({"id": id_col, "value": digest_schema or "ids"})


def crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
