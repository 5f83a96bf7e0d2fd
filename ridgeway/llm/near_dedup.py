"""MinHash near-dedup by a chosen-path set similarity join.

A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased; 64-bit
hashes).  Documents with equal sets are one class from the start.  ``coordinates``
minwise tokens describe a set.  In each of ``trees`` trees, every node picks one coordinate,
and with probability 1/4 a second one (1 / similarity on average), by its own hash out of those of
its tree and level, which no other tree or level uses at the default sizes (15 for the first level,
two for each later level of a tree); so the trees are independent.  The classes of the node go to a child per value of the picked coordinate, so
similar sets share children.  A node of at most ``leaf`` classes is compared exhaustively; a
larger one compares all classes with two pivots and branches again, up to ``depth``.

A pair at similarity 0.8 is lost by one tree with probability 0.16 on average where the first
level is small already, 0.28 and 0.38 where it has to meet at depth two and three; by all 12 trees
with 3.3e-11, 1.4e-7 and 6.1e-6 (at depth three 1.7e-6 at similarity 0.82, 1.8e-7 at 0.85).  Pairs pass when enough of their coordinates
agree (a bound that a similar pair misses with probability 1e-6) and their sizes allow the
similarity; what passes is confirmed on the full shingle sets.

Nodes still large at the last depth are finished exactly: after the components of all links
so far are known, only classes of different components need comparing.  The largest
component of the node is the bulk, the others the rest; blocks of the rest meet all blocks, a
pair only in the first of the nodes it shares.  A task of two blocks holds their full sets, so
only confirmed links leave it, and of these no more than join its components.  A group of
near-copies is thus linked through its pivots and leaves, what is left of it is compared
with all of it, and no pair is left out.

Defined cases: null or empty text and text without words: empty set, linked with nothing, kept;
fewer than ``words`` words: the whole sequence is the one shingle; repeated rows are one class;
null ids come last, so a component takes one only if it has no other; ``keep`` keeps exactly one
row of each component, all columns as they were; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import mix64, slices, texts_of
from ridgeway.llm.graph import components, join_hot, store

#: Defaults: coordinates of a sketch, trees, levels, classes of a leaf, classes of a block.
COORDINATES, TREES, DEPTH, LEAF, BLOCK = 64, 12, 3, 32, 256
_U = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = mix64(np.arange(1, 257, dtype=_U))
_BYTE[0x20] = 0
_BASE = _U(0x9E3779B97F4A7C15)
_PLACES = (_RNG.integers(0, 1 << 62, 64, dtype=np.uint64) << _U(1)) | _U(1)
_MUL = (_RNG.integers(0, 1 << 62, COORDINATES, dtype=np.uint64) << _U(1)) | _U(1)
_ADD = _RNG.integers(0, 1 << 62, COORDINATES, dtype=np.uint64)
_PIECE = 1 << 20
_TREE = _U(63)  # of a node: its tree


def _fold_table() -> bytes:
    out = bytearray(range(256))
    out[0x41:0x5B] = bytes(range(0x61, 0x7B))
    for b in b"\t\n\v\f\r":
        out[b] = 0x20
    return bytes(out)


_FOLD = _fold_table()


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words in order; works on pieces cut between words."""
    text, out, at = text.translate(_FOLD), [], 0
    while at < len(text):
        cut = len(text) if len(text) - at <= _PIECE else text.find(b" ", at + _PIECE)
        cut = len(text) if cut < 0 else cut
        raw = np.frombuffer(text, np.uint8, cut - at, at)
        inside = raw != 0x20
        starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        if len(starts):
            place = np.arange(len(raw)) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(raw)]))))
            powers = np.cumprod(np.full(int(place.max()) + 1, _BASE, dtype=_U))
            out.append(mix64(np.add.reduceat(_BYTE[raw] * powers[place], starts)))
        at = cut
    return np.concatenate(out) if out else np.zeros(0, _U)


def shingles(text: bytes, words: int = 4) -> np.ndarray:
    """The distinct shingle hashes, ascending."""
    w = word_hashes(text)
    n = min(words, len(w))
    if not n:
        return w
    total = np.full(len(w) - n + 1, n, dtype=_U) * _BASE
    for k in range(n):
        total += w[k:len(w) - n + 1 + k] * _PLACES[k % 64]
    return np.unique(mix64(total))


def minwise(grams: np.ndarray) -> np.ndarray:
    """The smallest value of each of the coordinates' hash functions (32 bits)."""
    out = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(grams), 4096):
        part = (grams[lo:lo + 4096, None] * _MUL + _ADD) >> _U(32)
        np.minimum(out, part.min(axis=0).astype(np.uint32), out=out)
    return out


def least_matches(similarity: float, miss: float = 1e-6) -> int:
    """The largest number of agreeing coordinates that a pair at ``similarity`` reaches but for ``miss``."""
    tail, k = 0.0, 0
    while True:
        tail += comb(COORDINATES, k) * similarity ** k * (1 - similarity) ** (COORDINATES - k)
        if tail > miss:
            return k
        k += 1


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sketches(words: int):
    def run(batches):
        for batch in slices(batches, 4 << 20):
            n, key, mins, sig = [], [], [], []
            for text in texts_of(batch.column("text")):
                grams = shingles(text, words)
                m = minwise(grams)
                n.append(len(grams))
                key.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                mins.append(m.tobytes())
                sig.append(m.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(mins, pa.binary()), pa.array(sig, pa.binary())], names=["row", "id", "n", "key", "mins", "sig"])
    return run


def _roots(trees: int):
    """First level: tree t picks coordinate t, every fourth one more.  The low bits of a node are its tree."""
    picks = [(t, t) for t in range(trees)] + [(t, trees + t // 4) for t in range(0, trees, 4)]

    def run(batches):
        for batch in batches:
            mins = _matrix(batch.column("mins"), np.uint32)
            for tree, c in picks:
                node = _child(np.full(len(mins), tree, dtype=_U), np.full(len(mins), c), mins[:, c])
                yield _rows(node, batch.column("key"))
    return run


def _branch(trees: int, depth: int, level: int):
    """Later levels: a node picks among the coordinates of its tree and level, which come behind those of the first."""
    first = trees + -(-trees // 4)
    rest = max(1, COORDINATES - first)
    width = max(1, min(2, rest // (trees * max(1, depth - 1))))

    def run(batches):
        for batch in batches:
            mins = _matrix(batch.column("mins"), np.uint32)
            node = batch.column("node").to_numpy().view(_U)
            h = mix64(node ^ _BASE)
            own = ((level - 1) * trees + (node & _TREE).astype(int)) * width
            pick = (h % _U(width)).astype(int)
            one, two = ((own + (pick + k) % width) % rest + COORDINATES - rest for k in (0, 1))
            every = np.arange(len(node))
            yield _rows(_child(node, one, mins[every, one]), batch.column("key"))
            more = np.flatnonzero(((h >> _U(32)) % _U(4) == 0) & (one != two))
            yield _rows(_child(node[more], two[more], mins[more, two[more]]), batch.column("key").take(pa.array(more)))
    return run


def _child(node, coordinate, value):
    return mix64(node * _BASE + mix64((coordinate.astype(_U) << _U(32)) + value.astype(_U))) & ~_TREE | node & _TREE


def _rows(node, key):
    return pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), key], names=["node", "key"])


def _matrix(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), COORDINATES)


def _passing(n_a, sig_a, n_b, sig_b, least: int, percent: int):
    fits = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return fits & ((sig_a == sig_b).sum(axis=-1) >= least)


def _compare_groups(least: int, percent: int):
    """Pairs of a group (array of key, n, sig, label) that may be similar and differ in label."""
    def run(batches):
        for batch in slices(batches, 4 << 20):
            a, b = [], []
            for members in batch.column("members").to_pylist():
                keys = [m["key"] for m in members]
                n = np.array([m["n"] for m in members])
                sig = np.frombuffer(b"".join(m["sig"] for m in members), np.uint8).reshape(len(keys), COORDINATES)
                label = [m["label"] for m in members]
                code = np.unique([x.hex() if x else str(i) for i, x in enumerate(label)], return_inverse=True)[1]
                for i in range(len(keys) - 1):
                    for j in np.flatnonzero(_passing(n[i], sig[i], n[i + 1:], sig[i + 1:], least, percent)
                                            & (code[i] != code[i + 1:])).tolist():
                        x, y = keys[i], keys[i + 1 + j]
                        a.append(max(x, y))
                        b.append(min(x, y))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
    return run


def _compare_blocks(words: int, least: int, percent: int):
    """Links between block i (of the rest) and block j of a node, confirmed on the full sets; a link
    is left out only if others of the task join the same classes."""
    def links(node: int, i: int, j: int, members: list[dict]):
        sets = [shingles(m["text"].encode(), words) for m in members]
        n, blocks = np.array([len(s) for s in sets]), np.array([m["block"] for m in members])
        sig = np.frombuffer(b"".join(m["sig"] for m in members), np.uint8).reshape(len(members), COORDINATES)
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
        group = np.unique([m["label"].hex() for m in members], return_inverse=True)[1]
        shared = [set(m["nodes"]) for m in members]
        for a in np.flatnonzero(blocks == i).tolist():
            may = np.flatnonzero(_passing(n[a], sig[a], n, sig, least, percent) & (blocks == j) & (group != group[a]))
            may = [b for b in may.tolist() if min(shared[a] & shared[b]) == node]
            if not may:
                continue
            at = np.searchsorted(sets[a], every)
            at[at == n[a]] = 0
            both = np.bincount(owner[sets[a][at] == every], minlength=len(sets))
            for b in may:
                if group[b] != group[a] and 100 * both[b] >= percent * (n[a] + n[b] - both[b]):
                    group[group == group[b]] = group[a]
                    yield members[a]["key"], members[b]["key"]

    def run(batches):
        for batch in slices(batches, 8 << 20):
            found = [x for r in batch.to_pylist() for x in links(r["node"], r["i"], r["j"], r["members"])]
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.binary()), pa.array([v for _, v in found], pa.binary())],
                                             names=["u", "v"])
    return run


def _compare_pairs(least: int, percent: int):
    def run(batches):
        for batch in batches:
            n = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            s = [_matrix(batch.column(c), np.uint8) for c in ("sig_a", "sig_b")]
            ok = pa.array(_passing(n[0], s[0], n[1], s[1], least, percent), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(ok)
    return run


def _confirm(words: int, percent: int):
    def run(batches):
        known = None, None
        for batch in slices(batches, 8 << 20):
            ok = []
            for b, x, y in zip(batch.column("b").to_pylist(), texts_of(batch.column("text_a")), texts_of(batch.column("text_b"))):
                if known[0] != b:
                    known = b, shingles(y, words)
                ok.append(similar(shingles(x, words), known[1], percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["u", "v"]).filter(pa.array(ok, pa.bool_()))
    return run


class Join:
    """One run over one table; holds the tables in the shared folder that its steps use."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, *, words: int, percent: int, trees: int = TREES,
                 depth: int = DEPTH, leaf: int = LEAF, block: int = BLOCK):
        self.words, self.percent, self.trees, self.depth, self.leaf, self.block = words, percent, trees, depth, leaf, block
        self.least = least_matches(percent / 100)
        # rows are numbered once and kept: a source that is not a table need not come in the same order again
        self.rows = store(docs.select(F.monotonically_increasing_id().alias("row"),
                                      F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), "rows")
        self.source = self.rows.select("row", F.col(f"doc.`{id_col}`").alias("id"), F.col(f"doc.`{text_col}`").alias("text"))
        kind = self.source.schema["id"].dataType.simpleString()
        self.docs = store(self.source.mapInArrow(_sketches(words), f"row long, id {kind}, n long, key binary, mins binary, sig binary"), "sketches")
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
        # mins and sig follow from the set, so any of a class's rows has them
        self.classes = store(self.docs.where("n > 0").groupBy("key").agg(
            first.alias("first"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("mins").alias("mins"), F.first("sig").alias("sig")), "classes")
        self.members = self.classes.select("key", "n", "sig")

    def run(self) -> DataFrame:
        """(key, first: struct of none, id, row) of the component of each class."""
        pairs, last = self._trees()
        links = self._confirmed(pairs)
        edges = components(links)
        edges = components(edges.unionByName(store(self._rest(last, edges), "links")))
        top = self.classes.select("key", "first").join(edges.select(F.col("u").alias("key"), F.col("v").alias("top")), "key", "left")
        top = top.select("key", "first", F.coalesce("top", "key").alias("top"))
        firsts = top.groupBy("top").agg(F.min("first").alias("best"))
        return join_hot(top.select("key", "top"), firsts, "top").select("key", F.col("best").alias("first"))

    def _trees(self) -> tuple[DataFrame, DataFrame]:
        """Candidate pairs of all levels, and the nodes (node, key) that are large at the last."""
        found, large = [], None
        for level in range(self.depth):
            if level == 0:
                rows = self.classes.select("key", "mins").mapInArrow(_roots(self.trees), "node long, key binary")
            else:
                rows = large.select("node", "key").join(self.classes.select("key", "mins"), "key").mapInArrow(_branch(self.trees, self.depth, level), "node long, key binary")
            rows = store(rows, "nodes")
            sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("key").alias("low"), F.max("key").alias("high")).where("size > 1")
            nodes = store(join_hot(rows, sizes, "node"), "nodes")
            large = nodes.where(F.col("size") > self.leaf)
            found.append(self._leaves(nodes.where(F.col("size") <= self.leaf).select("node", "key")))
            found.append(self._stars(large))
        pairs = found[0]
        for more in found[1:]:
            pairs = pairs.unionByName(more)
        return store(pairs.distinct(), "pairs"), large.select("node", "key")

    def _leaves(self, nodes: DataFrame) -> DataFrame:
        groups = (nodes.join(self.members, "key").withColumn("label", F.lit(None).cast("binary")).groupBy("node")
                  .agg(F.collect_list(F.struct("key", "n", "sig", "label")).alias("members")).select("members"))
        return groups.mapInArrow(_compare_groups(self.least, self.percent), "a binary, b binary")

    def _stars(self, large: DataFrame) -> DataFrame:
        ends = large.select("key", F.col("low").alias("pivot")).unionByName(large.select("key", F.col("high").alias("pivot")))
        pairs = (ends.where("key != pivot")
                 .select(F.greatest("key", "pivot").alias("a"), F.least("key", "pivot").alias("b")).distinct())
        side = lambda s: self.members.select(F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))
        return join_hot(join_hot(pairs, side("a"), "a"), side("b"), "b").mapInArrow(
            _compare_pairs(self.least, self.percent), "a binary, b binary")

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar, as links (u, v)."""
        texts = self._texts(pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))))
        side = lambda s: texts.select(F.col("key").alias(s), F.col("text").alias(f"text_{s}"))
        both = join_hot(join_hot(pairs, side("a"), "a"), side("b"), "b")
        return store(both.mapInArrow(_confirm(self.words, self.percent), "u binary, v binary"), "links")

    def _texts(self, keys: DataFrame) -> DataFrame:
        """A text (key, text) of each of the classes."""
        rows = keys.distinct().join(self.classes.select("key", "row"), "key")
        return store(self.source.select("row", "text").join(rows, "row").select("key", "text"), "texts")

    def _rest(self, last: DataFrame, edges: DataFrame) -> DataFrame:
        """Links between different components that share a node which the last level left large."""
        label = edges.select(F.col("u").alias("key"), F.col("v").alias("label"))
        rows = join_hot(last, label, "key", "left").select("node", "key", F.coalesce("label", "key").alias("label"))
        split = rows.groupBy("node").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("node")
        rows = store(join_hot(rows, split, "node"), "rest")
        counts = rows.groupBy("node", "label").agg(F.count("*").alias("c"))
        bulk = (counts.groupBy("node").agg(F.max_by("label", F.struct("c", "label")).alias("bulk"), F.max("c").alias("n_bulk"), F.sum("c").alias("n_all"))
                .withColumn("bulk_blocks", F.ceil(F.col("n_bulk") / self.block)).withColumn("rest_blocks", F.ceil((F.col("n_all") - F.col("n_bulk")) / self.block)))
        placed = join_hot(rows, bulk, "node").withColumn("is_bulk", F.col("label") == F.col("bulk"))
        placed = placed.withColumn("at", F.pmod(F.xxhash64("key"), F.when(F.col("is_bulk"), F.col("bulk_blocks")).otherwise(F.col("rest_blocks"))))
        # block i of the rest meets block j >= i of the rest, and every block of the bulk (numbered behind the rest)
        i_range, every = F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1), F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") + F.col("bulk_blocks") - 1)
        meets = F.when(F.col("is_bulk"), F.transform(i_range, lambda i: F.struct(i.alias("i"), (F.col("rest_blocks") + F.col("at")).alias("j")))).otherwise(
            F.transform(every, lambda k: F.struct(F.least(k, F.col("at")).alias("i"), F.greatest(k, F.col("at")).alias("j"))))
        block = F.when(F.col("is_bulk"), F.col("rest_blocks") + F.col("at")).otherwise(F.col("at"))
        tasks = placed.select("node", "key", "label", block.alias("block"), F.explode(meets).alias("t")).select("node", "t.i", "t.j", "key", "label", "block")
        keys = rows.groupBy("key").agg(F.collect_set("node").alias("nodes"))  # at most 2^depth nodes a tree
        full = keys.join(self.members.select("key", "sig"), "key").join(self._texts(rows.select("key")), "key")
        groups = (join_hot(tasks, full, "key").groupBy("node", "i", "j")
                  .agg(F.collect_list(F.struct("key", "label", "block", "sig", "nodes", "text")).alias("members")))
        return groups.mapInArrow(_compare_blocks(self.words, self.least, self.percent), "u binary, v binary")


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 80, **options) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable), kept (it is its component's)."""
    j = Join(docs.select(id_col, text_col), id_col, text_col, words=words, percent=percent, **options)
    out = join_hot(j.docs.select("id", "n", "key"), j.run(), "key", "left")
    component = F.when(F.col("n") > 0, F.col("first.id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def keep(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 80, **options) -> DataFrame:
    """One row of each component (the smallest id), and all rows with an empty set; all columns as they were."""
    j = Join(docs, id_col, text_col, words=words, percent=percent, **options)
    stay = j.run().select(F.col("first.row").alias("row")).distinct().unionByName(j.docs.where("n = 0").select("row"))
    return j.rows.join(stay, "row", "left_semi").select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
