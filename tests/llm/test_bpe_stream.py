from __future__ import annotations

import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from ridgeway.llm import bpe_stream as B

from tests.llm.helpers import rows

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def merges():
    with open(PATH, encoding="utf-8") as f:
        return B.MergeList(f.read())


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_fuzz_against_the_library(merges, library):
    random.seed(3)
    parts = list("aabcdeéßé'’sStT09 ,.<|>\n\t\x1c\x1f\u0301ΣİǅÀ中文字😀ﬁ①") + ["<|endoftext|>", "<|startoftext|>", "'s", "'ll", "the", "ing", "\u3000", "\u200b", "\u0085", "\u2028", "한", "각", "\x00"]
    w = B.WordEncoder(merges, cache=500)
    for _ in range(4000):
        s = "".join(random.choice(parts) for _ in range(random.randint(0, 30)))
        ids = library.encode(s, add_special_tokens=False).ids
        assert w.encode(s).tolist() == ids, repr(s)
        assert B.decode(merges, ids, step=3) == library.decode(ids, skip_special_tokens=False)


def test_every_code_point_against_the_library(merges, library):
    """Classes, lower case and composition of each character are the library's, whatever Unicode version Python has."""
    w = B.WordEncoder(merges)
    for lo in range(0, 0x110000, 256):
        if 0x30000 <= lo < 0xE0000 or 0xE0200 <= lo < 0x10FF00 or 0xD800 <= lo < 0xE000:
            continue
        for c in map(chr, range(lo, lo + 256)):
            s = f"ab{c}cd {c}9 E{c}'s{c}{c} \u0301{c}"
            assert w.encode(s).tolist() == library.encode(s, add_special_tokens=False).ids, hex(ord(c))


def test_texts_in_pieces(merges, library):
    """Pieces of a few characters give the ids of the whole text, special tokens and combining marks included."""
    random.seed(5)
    parts = list("aabcdeéß’sS09 ,.<|>\n\t\u0301ΣİÀ中😀ﬁ") + [" ", " ", "<|endoftext|>", "'s", "'ll", "the", "ing", "\u3000", "\u0085", "한", "각", "각"]
    for piece in (1, 2, 7, 40):
        w = B.WordEncoder(merges, cache=2000, piece=piece)
        for _ in range(800):
            s = "".join(random.choice(parts) for _ in range(random.randint(0, 60)))
            assert w.encode(s).tolist() == library.encode(s, add_special_tokens=False).ids, repr(s)
    w = B.WordEncoder(merges, piece=1000)
    text = "The naïve Σ words, " * 20_000
    assert max(map(len, w._pieces(text))) < 1100
    assert w.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_digests_against_the_library(spark, library):
    """The registered query on a whole table."""
    import hashlib

    from ridgeway.llm import queries as Q
    from tests.llm.helpers import SF
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert rows(Q.QUERIES["op9_streaming_bpe"](spark, SF), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(
        want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_long_words_are_emitted_while_they_come(merges, library):
    random.seed(4)
    t = B.Transducer(merges)
    for k in range(40):
        units = ["a", "b", "th", "ing", "ion", "e", "s", "in", "q", "er"][:random.randint(1, 10)]
        word = "".join(random.choice(units) for _ in range(random.randint(200, 4000)))
        got = list(t.stream(iter(word), len(word)))
        assert [i for part in got for i in part] == library.encode(word, add_special_tokens=False).ids
        assert len(got) > 1
    assert t.most_held <= merges.lookahead  # memory does not grow with the word


def test_lookahead_bounds_what_an_ending_can_change(merges):
    random.seed(6)
    t = B.Transducer(merges)
    enc = lambda s: t.encode(s)
    size = lambda ids: [len(merges.tokens[i].removesuffix("</w>")) for i in ids]
    for _ in range(150):
        head = "".join(random.choice("aeinstrlhod") for _ in range(160))
        runs = [enc(head + "".join(random.choice("aeinstrlhodz") for _ in range(random.randint(1, 8)))) for _ in range(4)]
        same = 0
        for column in zip(*runs):
            if len(set(column)) > 1:
                break
            same += size([column[0]])[0]
        assert len(head) - same <= merges.lookahead


def test_byte_level_decoder_holds_unfinished_characters():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        source = f.read()
    m, lib = B.MergeList(source), Tokenizer.from_str(source)
    ids = lib.encode("é中😀 naïve ½", add_special_tokens=False).ids
    one = B.IncrementalDecoder(m)
    assert "".join(one.feed([i]) for i in ids) + one.finish() == "é中😀 naïve ½"


def test_edges(spark, edge_docs, empty_docs, library):
    got = B.encode(edge_docs, PATH)
    want = []
    for r in edge_docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    assert rows(got) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert B.encode(empty_docs, PATH).count() == 0


def test_words_side_by_side_and_each_distinct_word_once(merges, library, monkeypatch):
    """Many words at a time give the ids of the library; a word that stands in many texts is encoded once."""
    random.seed(8)
    units = ["a", "the", "ing", "é", "ß", "q", "er", "st", "0", "x", "'s", "\x00", "ion", "w", "ü", "%"]
    words = ["".join(random.choice(units) for _ in range(random.randint(1, 40))) for _ in range(3000)] + ["ab" * 300]
    texts = [" ".join(random.choices(words, k=50)) for _ in range(200)] + ["", " \n ", "x"]
    monkeypatch.setattr(B, "TOGETHER", 700)
    w = B.WordEncoder(merges)
    asked = []
    once = w.transducer.encode_all
    monkeypatch.setattr(w.transducer, "encode_all", lambda some: asked.extend(some) or once(some))
    got = w.encode_all(texts)
    assert [v.tolist() for v in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(asked) == len(set(asked)) > 32
    asked.clear()
    assert all((a == b).all() for a, b in zip(got, w.encode_all(texts)))
    assert max(map(len, asked), default=65) > 64  # only words too long for the cache come again
    t = B.Transducer(merges)
    plain = [x for x in asked + ["hello", "a", "zz"] * 20 if len(x) <= merges.lookahead]
    assert t.encode_all(plain) == [B.array("i", t.encode(x)).tobytes() for x in plain]
    with pytest.raises(KeyError):
        t.encode_all(["a b"] * 40)


def test_known_characters_need_no_composition(merges):
    import re
    import unicodedata
    known = [c for c in map(chr, range(0x20ad)) if re.fullmatch(f"[{B.WordEncoder.KNOWN}]", c)]
    assert all(unicodedata.is_normalized("NFC", c) and not unicodedata.combining(c) for c in known)
    starts = "".join(map(chr, range(0x20ad)))
    assert all(len(unicodedata.normalize("NFC", a + c)) == 2 for c in known for a in "aeiouAEIOU" + starts[0x1100:0x1113])


def test_a_small_cache_keeps_its_bound_and_loses_no_value():
    from ridgeway.llm.common import Cache
    c = Cache(None, 2000)
    for lo in range(0, 60, 7):
        keys = [f"k{k % 25}" for k in range(lo, lo + 20)]
        assert c.all(keys, lambda new: [k.encode() for k in new]) == [k.encode() for k in keys]
        assert len(c) <= 11 and len(c.old) <= 11


def test_digest_of_ids_in_steps():
    import hashlib

    import pyarrow as pa

    from ridgeway.llm.queries import ids_sha256
    for n in (0, 1, 2, 3, 7, 50):
        ids = pa.array([*range(5, 5 + n), 9], pa.int32()).slice(0, n)
        want = hashlib.sha256(" ".join(map(str, range(5, 5 + n))).encode()).hexdigest()
        assert {ids_sha256(ids, step) for step in (1, 2, 7, 1 << 20)} == {want}
