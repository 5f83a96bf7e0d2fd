from __future__ import annotations

import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ridgeway.llm import token_arrow as A
from ridgeway.llm.common import local_path

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_runs_against_the_library(library):
    random.seed(1)
    with open(PATH, encoding="utf-8") as f:
        enc = A.RunEncoder(f.read(), cache=300)
    parts = list("aabT09 ,.'\n\t  \x1c\x1f\x85\xa0\x00é½²“…€中😀") + ["<|endoftext|>", "'s", " the", "\n\n", " \n", "\u3000", "ing "]
    for _ in range(4000):
        s = "".join(random.choice(parts) for _ in range(random.randint(0, 40)))
        assert np.frombuffer(enc.encode(s), "<u4").tolist() == library.encode(s, add_special_tokens=False).ids, repr(s)


def test_texts_together_against_the_library(library):
    """Runs do not cross texts or pieces, however texts are cut: batches of texts, pieces of a few characters."""
    random.seed(2)
    with open(PATH, encoding="utf-8") as f:
        source = f.read()
    parts = list("aabsT09 ,.'\n\t  \x1c\x85\xa0\x00é½²“€中") + ["<|endoftext|>", "'s", "'re", "'ll", "'v", "don't", " the", "\n\n", " \n", "ing "]
    known = [p for p in parts if p not in ("中", "<|endoftext|>")]
    for piece in (1, 7, 1 << 21):
        enc = A.RunEncoder(source, cache=300, piece=piece)
        for _ in range(150):
            texts = ["".join(random.choices(random.choice([parts, known, known]), k=random.randint(0, 30))) for _ in range(random.randint(0, 20))]
            want = [library.encode(s, add_special_tokens=False).ids for s in texts]
            assert [x.tolist() for x in enc.encode_all(texts)] == want, (piece, texts)


def test_endings_and_white_space_at_the_borders_of_texts(library):
    with open(PATH, encoding="utf-8") as f:
        enc = A.RunEncoder(f.read())
    texts = ["a'", "s", "'", "re", "'r", "e", " ", "a", "a ", " a", "\n", "\n b", "'s's", "'stop", " 's", "  's", "\n's", "''s", "'m9", "x'", "'ll", "", "\u00a0", "\u00e9'"]
    for some in (texts, texts[::-1], texts + texts):
        assert [x.tolist() for x in enc.encode_all(some)] == [library.encode(s, add_special_tokens=False).ids for s in some]


def test_a_batch_looks_up_each_distinct_run_once():
    """The work for a run that comes again is no Python call: neither a lookup of the cache nor one of the model."""
    with open(PATH, encoding="utf-8") as f:
        enc = A.RunEncoder(f.read())
    asked, made = [], enc.runs.make

    class Counted(type(enc.runs)):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    enc.runs = Counted(made, A.CACHE_BYTES)
    enc.encode_all(["the cat, the dog", "", " the dog's the cat's"] * 50)
    assert sorted(asked) == sorted({"the", " cat", ",", " the", " dog", "'s"})


def test_files_hold_the_documents_in_order(spark, edge_docs, library):
    index, folder = A.write(edge_docs.repartition(4), PATH, end_id=2, length=64, batch=8)
    order = sorted(edge_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = sorted(A.read(index, folder).collect(), key=lambda r: r.start)
    at = 0
    for r, want in zip(got, order):
        ids = library.encode(want.text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens) == (want.doc_id, at, len(ids)) and list(r.ids) == ids
        at += len(ids)
    assert len(got) == len(order)


def test_sequences_are_zero_copy_and_masked(spark, edge_docs):
    index, folder = A.write(edge_docs, PATH, end_id=2, length=32, batch=4)
    for part in index.groupBy("file").agg({"n_tokens": "sum"}).collect():
        reader = A.SequenceReader(folder, part.file)
        total = part["sum(n_tokens)"]
        table = pa.ipc.open_file(pa.memory_map(f"{local_path(folder)}/{part.file}")).read_all()
        assert table.schema.field("input_ids").type == pa.list_(pa.uint16(), 32)
        before = pa.total_allocated_bytes()
        ids, mask = reader.sequence(table.num_rows - 1)
        assert pa.total_allocated_bytes() == before and len(ids) == len(mask) == 32
        assert sum(x.as_py() for m in table["mask"] for x in m) == total
        flat = np.concatenate([c.flatten().to_numpy() for c in table["input_ids"].chunks])
        assert (reader.ids(0, total) == flat[:total]).all()
        assert reader.ids(total // 2, 5).base is not None or total < 10


def test_wide_vocabularies_and_empty_table(spark, empty_docs):
    f = A.SequenceFile(f"{A.scratch_path(spark, 'wide')}", np.dtype("<u4"), 4, 2)
    assert f.add(np.array([70_000, 1, 2], "<u4")) == 0 and f.add(np.arange(20, dtype="<u4")) == 3
    f.close()
    index, folder = A.write(empty_docs, PATH, end_id=2)
    assert A.read(index, folder).count() == 0


def test_query_rows_against_the_library(spark):
    """start and ids_crc32 of the registered query on a whole table."""
    from zlib import crc32

    from ridgeway.llm import queries as Q
    from tests.llm.helpers import SF
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        library = Tokenizer.from_str(f.read())
    library.no_truncation()
    library.no_padding()
    want, at = [], 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(ids), crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    got = Q.QUERIES["op10_token_arrow"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
