"""BPE encoding and decoding by a bounded-lookahead streaming transducer.

``MergeList`` reads a tokenizer file (merges, vocabulary, end-of-word suffix).  The encoder
keeps, for every position of a word, the last token of the encoding of the prefix that
ends there: of the tokens that end there, the one that may stand behind the last token of
the prefix before it (two tokens may be neighbours if no merge would have joined across
them first).  Whatever follows, the final encoding passes through a boundary among the
last ``max_token`` positions, so the tokens before the point where the chains of all these
positions meet are stable: they are emitted at once and forgotten.

``lookahead`` is computed from the merge list: a difference in what follows can only move
left through merges of rising rank, each of which competes with the one before it for a
token; the longest such chain, in symbols, bounds how far, and so bounds the positions
that are held, whatever the length of the word.

Decoding is a state machine from token ids to text, fed any number of ids at a time; it
holds an unfinished UTF-8 character (byte-level decoders) or whether a separator is due
(files without a decoder: tokens joined by one space).

The pre-tokenizer is that of ``word`` files: NFC, lower case, white space dropped, then
``PATTERN`` makes the words.  Texts are fed to it in pieces of about ``PIECE`` characters, cut in front of an ASCII
letter or digit behind ASCII white space, where no composition, word or special token can lie across, so besides the ids the memory does
not grow with the text.  Pieces with characters on which Unicode versions differ go through the library's own normaliser
and pre-tokenizer (those of the file), so classes and lower case are its own for every code point.
A word's tokens do not depend on its neighbours: the words of many pieces are found together, Arrow numbers the distinct ones,
and each of them is looked up once in a cache of the worker, bounded in bytes; those it lacks go through the transducer side by
side, a position of all of them at a time.

Defined cases: null text: empty, no tokens; very long texts and words are streamed as above; special tokens in a text are their ids, as the
library does by default; repeated rows are encoded one by one; empty table: no rows;
other columns are not read.
"""

from __future__ import annotations

import codecs
import json
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import Cache, Shared, byte_symbols, slices, worker_state

#: Bytes of one generation of a worker's cache; characters of a piece, and of the pieces whose words are found together; words encoded side by side.
CACHE_BYTES, PIECE, GROUP, TOGETHER = 32 << 20, 1 << 16, 1 << 20, 8192
#: Fixed value: the split pattern of the word tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class MergeList:
    """Vocabulary and merges of a tokenizer file, in the form the transducer needs."""

    def __init__(self, source: str):
        self.source = source
        spec = json.loads(source)
        model = spec["model"]
        if model.get("dropout") or model.get("unk_token") or model.get("continuing_subword_prefix"):
            raise ValueError("dropout, unknown tokens and subword prefixes are not part of this transducer")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: t for t, i in (*self.ids.items(), *self.special.items())}
        self.decoder = (spec.get("decoder") or {}).get("type")
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        # order: symbols that no merge makes, then merges by rank
        made = {a + b: k for k, (a, b) in reversed(list(enumerate(merges)))}
        base = [t for t in self.ids if t not in made]
        self.order = {t: k for k, t in enumerate(base)}
        self.order.update({t: len(base) + k for t, k in made.items()})
        self.id_of = {self.order[t]: i for t, i in self.ids.items()}
        self.parts = {self.order[a + b]: (self.order[a], self.order[b])
                      for k, (a, b) in enumerate(merges) if made[a + b] == k}
        self.joined = {(self.order[a], self.order[b]): len(base) + k for k, (a, b) in reversed(list(enumerate(merges)))}
        self.length = {k: len(t.removesuffix(self.suffix) if self.suffix and t != self.suffix else t) for t, k in self.order.items()}
        self.max_token = max(self.length.values(), default=1)
        self.lookahead = self.max_token + self._reach(merges)
        self.known: dict[int, bool] = {}

    def _reach(self, merges) -> int:
        """Symbols to the left that a difference at the end can still change."""
        as_left: dict[int, int] = {}
        as_right: dict[int, int] = {}
        most = 0
        for a, b in reversed(merges):
            left, right, token = self.order[a], self.order[b], self.order[a + b]
            reach = max(0, as_left.get(token, 0), as_right.get(left, 0), as_right.get(token, 0))
            as_left[left] = max(as_left.get(left, 0), reach)
            as_right[right] = max(as_right.get(right, 0), reach + self.length[left])
            most = max(most, reach)
        return most

    def beside(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` (by order) can be neighbours in an encoding: undoing the
        later merge of the two again and again, no merge across the border came earlier."""
        key = a << 20 | b
        fits = self.known.get(key)
        if fits is None:
            if len(self.known) > 400_000:
                self.known.clear()
            fits = self.known[key] = self._compute_beside(a, b)
        return fits

    def _compute_beside(self, a: int, b: int) -> bool:
        limit = 1 << 60
        while True:
            across = self.joined.get((a, b))
            if across is not None and across < limit:
                return False
            if a in self.parts and (b not in self.parts or a > b):
                limit, a = a, self.parts[a][1]
            elif b in self.parts:
                # of equal ranks the left pair merges first, so a merge across the border at b's own rank wins
                limit, b = b + 1, self.parts[b][0]
            else:
                return True


class Transducer:
    """Encodes one word; symbols come in, tokens go out as soon as they are stable."""

    def __init__(self, merges: MergeList):
        import ahocorasick

        self.m = merges
        self.most_held = 0
        # all tokens that end at a position, longest first, in one pass over a word
        self.matches = ahocorasick.Automaton()
        self.size = np.zeros(len(merges.order), dtype=np.int64)
        for token, order in merges.order.items():
            ends = bool(merges.suffix) and token.endswith(merges.suffix) and token != merges.suffix
            text = token.removesuffix(merges.suffix) + "\0" if ends else token
            self.matches.add_word(text, order)
            self.size[order] = len(text)
        self.matches.make_automaton()
        self.ids = np.array([merges.id_of.get(k, -1) for k in range(len(merges.order))], dtype="<i4")
        # pairs of neighbours seen last, (left << 20 | right) << 1 | whether they fit, each in the place of its hash
        self.pairs = np.full(1 << 20, -1, dtype=np.int64)

    def encode(self, symbols: str) -> list[int]:
        """Token ids of a whole word of byte symbols (the last one ends the word).  A word no longer
        than the lookahead is one buffer: nothing of it can be stable before its end."""
        m, n = self.m, len(symbols)
        if n > m.lookahead:
            out: list[int] = []
            for part in self.stream(symbols, n):
                out += part
            return out
        if m.suffix:  # the end of the word is a symbol of the automaton, no position of the text
            symbols += "\0"
            n += 1
        known, beside, size = m.known.get, m.beside, self.size.item
        last, start = [-2] * (n + 1), [0] * (n + 1)
        for at, token in self.matches.iter(symbols):
            if last[at + 1] == -2:
                lo = at + 1 - size(token)
                if lo:
                    left = last[lo]
                    if left < 0:
                        continue
                    fits = known(left << 20 | token)
                    if not (beside(left, token) if fits is None else fits):
                        continue
                last[at + 1], start[at + 1] = token, lo
        out, to_id = [], m.id_of
        while n:
            out.append(to_id[last[n]])
            n = start[n]
        return out[::-1]

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``MergeList.beside`` of each pair."""
        pair = left << 20 | right
        place = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)
        held = self.pairs[place]
        fits = held & 1 == 1
        new = np.flatnonzero(held >> 1 != pair)
        if len(new):
            distinct, which = np.unique(pair[new], return_inverse=True)
            made = [self.m.beside(k >> 20, k & 0xFFFFF) for k in distinct.tolist()]
            fits[new] = np.array(made)[which]
            self.pairs[place[new]] = pair[new] << 1 | fits[new]
        return fits

    def encode_all(self, words: list[str]) -> list[bytes]:
        """Token ids (int32) of each word, as ``encode`` gives them; ``TOGETHER`` words are run side by side."""
        out = [b""] * len(words)
        short = [k for k, w in enumerate(words) if len(w) <= self.m.lookahead]
        if len(short) < 32:
            short = []
        for at in range(0, len(short), TOGETHER):
            some = short[at:at + TOGETHER]
            for k, ids in zip(some, self._side_by_side([words[k] for k in some])):
                out[k] = ids
        return [ids or array("i", self.encode(w)).tobytes() for ids, w in zip(out, words)]

    def _side_by_side(self, words: list[str]) -> list[bytes]:
        """The steps of ``encode``, each for all words of which a position that far from their start is left."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        first = np.cumsum(lengths) - lengths                     # where the words start in the text of all
        ends = first + lengths - (0 if self.m.suffix else 1)     # the end of a word is a symbol, as in ``encode``
        text = "\0".join(words) + "\0"
        found = np.fromiter(chain.from_iterable(self.matches.iter(text)), dtype=np.int64).reshape(-1, 2)
        at, token = found[:, 0], found[:, 1]
        begin = np.repeat(first, lengths)[at]
        far = (at - begin).astype(np.int16)
        order = np.argsort(far, kind="stable")                   # of one position: longest first, as found
        at, token, begin = at[order] + 1, token[order], begin[order]
        lo = at - self.size[token]
        last, start = np.full(len(text) + 1, -2, dtype=np.int64), np.zeros(len(text) + 1, dtype=np.int64)
        steps = np.append(0, np.cumsum(np.bincount(far))).tolist()
        for a, b in zip(steps, steps[1:]):
            left = last[lo[a:b]]
            fits = lo[a:b] == begin[a:b]
            inner = np.flatnonzero(~fits & (left >= 0))
            fits[inner] = self._fit(left[inner], token[a:b][inner])
            chosen = (np.flatnonzero(fits) + a)[::-1]            # of one position the longest is written last
            last[at[chosen]], start[at[chosen]] = token[chosen], lo[chosen]
        if (last[ends] < 0).any():
            raise KeyError("a word has a symbol that is no token")
        passed = np.zeros(len(text) + 1, dtype=bool)
        here, stop = ends, first
        while len(here):
            passed[here] = True
            here = start[here]
            left = here != stop
            here, stop = here[left], stop[left]
        places = np.flatnonzero(passed)
        ids = self.ids[last[places]].tobytes()
        cuts = [0, *(np.searchsorted(places, ends, side="right") * 4).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def stream(self, symbols, n: int):
        """Yields lists of ids.  ``held`` is the text since the last emission, ``last[i]`` the last
        token of the prefix of length ``i`` of it, ``before`` the token emitted last."""
        m = self.m
        get, beside, longest, length, to_id = m.order.get, m.beside, m.max_token, m.length, m.id_of
        held, last, before = "", [-1], -1
        check = m.lookahead + longest
        for at, symbol in enumerate(symbols, 1):
            held += symbol
            i = len(held)
            end = m.suffix if at == n else ""
            for lo in range(max(0, i - longest), i):
                token = get(held[lo:i] + end)
                if token is not None:
                    left = last[lo] if lo else before
                    if left == -2 or (left >= 0 and not beside(left, token)):
                        continue
                    if lo == 0 and before < 0 or left >= 0:
                        break
            else:
                token = -2  # no encoding of the prefix ends here
            last.append(token)
            if i >= check and at < n:
                stable = self._meet(last, i)
                if stable:
                    tokens = self._chain(last, stable)
                    yield [to_id[t] for t in tokens]
                    before = tokens[-1]
                    held, last = held[stable:], [-1, *last[stable + 1:]]
                check = len(held) + longest
                self.most_held = max(self.most_held, len(held))
        if held:
            yield [to_id[t] for t in self._chain(last, len(held))]

    def _chain(self, last, i):
        tokens = []
        while i:
            tokens.append(last[i])
            i -= self.m.length[last[i]]
        return tokens[::-1]

    def _meet(self, last, i) -> int:
        """The furthest position through which the chains of all of the last positions pass."""
        ends = {k for k in range(max(0, i - self.m.max_token) + 1, i + 1) if last[k] != -2}
        while len(ends) > 1:
            k = max(ends)
            ends.remove(k)
            ends.add(k - self.m.length[last[k]])
        return ends.pop() if ends else 0


class IncrementalDecoder:
    """Token ids to text, a few at a time."""

    def __init__(self, merges: MergeList):
        self.tokens, self.bytewise = merges.tokens, merges.decoder == "ByteLevel"
        self.due = False
        if self.bytewise:
            self.of = {c: b for b, c in enumerate(byte_symbols())}
            self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        parts = list(map(self.tokens.__getitem__, ids))
        if self.bytewise:
            return self.utf8.decode(b"".join(bytes([self.of[c] for c in p]) if all(c in self.of for c in p) else p.encode() for p in parts))
        text = " ".join(parts)
        if parts and self.due:
            text = " " + text
        self.due = self.due or bool(parts)
        return text

    def finish(self) -> str:
        return self.utf8.decode(b"", True) if self.bytewise else ""


class WordEncoder:
    """Texts -> ids as little-endian int32; keeps the ids of words."""

    LETTER, NUMBER, SPACE, REST = range(4)
    #: The characters whose classes, case and composition no two Unicode versions dispute; each is its own NFC, beside any other.
    KNOWN = r"\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac"

    def __init__(self, merges: MergeList, cache: int = CACHE_BYTES, piece: int = PIECE):
        import regex
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(merges.source)
        self.normal, self.pre = library.normalizer, library.pre_tokenizer
        self.merges, self.piece = merges, piece
        self.words, self.mapped = Cache(None, cache), Cache(None, cache)
        specials = sorted(merges.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.other = regex.compile(f"[^{self.KNOWN}]").search
        self.border = regex.compile(r"[\t-\r ](?=[0-9A-Za-z])").search
        known = regex.compile(f"[{self.KNOWN}]").fullmatch
        lower = "".join(c.lower() for c in map(chr, range(0x20ad)) if known(c))
        self.kinds = np.full(ord(max(lower)) + 1, self.REST, dtype=np.uint8)
        for kind, pattern in ((self.LETTER, r"\p{L}"), (self.NUMBER, r"\p{N}"), (self.SPACE, r"\s")):
            self.kinds[[ord(c) for c in regex.findall(pattern, lower)]] = kind
        self.transducer = Transducer(merges)
        self.symbol = byte_symbols()

    def _encode(self, words: list[str]) -> list[bytes]:
        symbol = self.symbol
        return self.transducer.encode_all([w if w.isascii() and w.isprintable() else "".join([symbol[b] for b in w.encode()]) for w in words])

    def _pieces(self, text: str):
        at = 0
        while len(text) - at > self.piece:
            cut = self.border(text, at + self.piece)
            if cut is None:
                break
            yield text[at:cut.end()]
            at = cut.end()
        yield text[at:] if at else text

    def _starts(self, chars: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where the words of ``PATTERN`` and the white space between them start, as a mask."""
        start = kind == self.NUMBER
        start[0] = True
        start[1:] |= kind[1:] != kind[:-1]
        # an apostrophe that starts a word takes the letters of its ending, whatever follows them
        at = np.flatnonzero((chars[:-1] == ord("'")) & start[:-1])
        one = chars[at + 1]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pairs = at[~short & (at + 2 < len(chars))]
        pair = chars[pairs + 1] << 8 | chars[pairs + 2]
        pairs = pairs[np.isin(pair, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])]
        for found, length in ((at[short], 2), (pairs, 3)):
            start[found + 1] = False
            behind = found + length
            start[behind[behind < len(chars)]] = True
        return start

    def _joined(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of each piece, all of known characters: the words of all are found together, and
        each distinct one is looked up once."""
        pieces = [p.lower() for p in pieces]
        joined = "\n".join(pieces)  # white space: no word lies across
        chars = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        if not len(chars):
            return [np.zeros(0, dtype="<i4")] * len(pieces)
        kind = self.kinds[chars]
        start, inside = self._starts(chars, kind), kind != self.SPACE
        begins = np.cumsum([0, *(len(p) + 1 for p in pieces[:-1])])
        # words of each piece, then the words behind one another without the white space
        first = np.searchsorted(np.flatnonzero(start & inside), begins)
        starts = np.flatnonzero(start[inside])
        data = chars[inside].tobytes().decode("utf-32-le").encode()
        borders = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)[starts]
        offsets = np.append(borders, len(data)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        ids = self.words.all(words.dictionary.to_numpy(zero_copy_only=False).tolist(), self._encode)
        sizes = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) >> 2
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)),
                                         pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
        flat = lists.take(words.indices).flatten().to_numpy()
        total = np.append(0, np.cumsum(sizes[words.indices.to_numpy()], dtype=np.int64))
        return np.split(flat, total[first[1:]])

    def _parts(self, text: str):
        """The text in turn: pieces (str), or ids of a special token or of a piece for the library's classes."""
        at = 0
        if self.special is not None and any(t in text for t in self.merges.special):
            for m in self.special.finditer(text):
                yield from self._pieces(text[at:m.start()])
                yield np.array([self.merges.special[m[0]]], dtype="<i4")
                at = m.end()
        yield from self._pieces(text[at:] if at else text)

    def _library(self, piece: str) -> np.ndarray:
        words = [symbols for symbols, _ in self.pre.pre_tokenize_str(self.normal.normalize_str(piece))]
        distinct = list(dict.fromkeys(words))
        ids = dict(zip(distinct, self.mapped.all(distinct, self.transducer.encode_all)))
        return np.frombuffer(b"".join(map(ids.__getitem__, words)), dtype="<i4")

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; about ``GROUP`` characters are taken at a time, however long the texts are."""
        out: list[list] = [[] for _ in texts]
        held, places, size = [], [], 0

        def flush():
            nonlocal held, places, size
            for (k, place), ids in zip(places, self._joined(held) if held else ()):
                out[k][place] = ids
            held, places, size = [], [], 0

        for k, text in enumerate(texts):
            for part in self._parts(text):
                if isinstance(part, str):
                    if not part.isascii() and self.other(part):
                        part = self._library(part)
                    else:
                        if size and size + len(part) > GROUP:
                            flush()
                        held.append(part)
                        places.append((k, len(out[k])))
                        size += len(part)
                out[k].append(part)
        flush()
        return [v[0] if len(v) == 1 else np.concatenate(v) for v in out]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


def decode(merges: MergeList, ids, step: int = 65536) -> str:
    machine = IncrementalDecoder(merges)
    parts = [machine.feed(ids[k:k + step]) for k in range(0, len(ids), step)]
    return "".join(parts) + machine.finish()


def encode(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
           digest=None, digest_schema: str = "") -> DataFrame:
    """Per row: id, ids (array of int), decoded (text of these ids).

    ``digest`` maps an Arrow batch of these columns to one of ``digest_schema`` (which starts
    with the id) inside the same task, for callers that need no ids outside it.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        source = f.read()
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    shared = Shared(docs.sparkSession, source)  # one file: bounded by the vocabulary
    key = str(hash(source))

    def run(batches):
        state = worker_state("bpe_stream")
        if state.get("bpe_key") != key:
            state["bpe_key"], state["bpe"] = key, WordEncoder(MergeList(shared.value))
        coder = state["bpe"]
        for batch in slices(batches, 4 << 20, owner="bpe_stream"):
            values = coder.encode_all([t or "" for t in batch.column("text").to_pylist()])
            offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
            flat = np.concatenate(values) if values else np.zeros(0, "<i4")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
            text = pa.array([decode(coder.merges, v.tolist()) for v in values], pa.large_string() if flat.size > 1 << 27 else pa.string())
            out = pa.RecordBatch.from_arrays([batch.column("id"), ids, text], names=["id", "ids", "decoded"])
            yield digest(out) if digest else out

    kind = src.schema["id"].dataType.simpleString()
    made = src.mapInArrow(run, f"id {kind}, {digest_schema}" if digest else f"id {kind}, ids array<int>, decoded string")
    return made.withColumnRenamed("id", id_col)
