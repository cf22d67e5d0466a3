"""The registered queries over whole tables, against brute force."""

import hashlib
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from test_dedup import brute
from test_text import expected
from test_tokens import best_fit_decreasing
from test_vectors_and_chats import brute_nearest, cheapest, price
from tokenizers import Tokenizer as Library

from lakemoor.llm import chat
from lakemoor.llm.bpe import vocabulary
from lakemoor.llm.queries import QUERIES

SMALL, MIDDLE, LARGE = (f"/root/testdata/sf{x}" for x in ("0.001", "0.01", "0.1"))


def table(folder, name):
    return pq.read_table(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def library():
    return Library.from_file(vocabulary())


def test_packing(spark, library):
    docs = table(MIDDLE, "documents").to_pylist()
    want = {d["doc_id"]: len(library.encode(d["text"] or "", add_special_tokens=False).ids) + 1 for d in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in QUERIES["op2_packing"](spark, MIDDLE).collect():
        by_doc[r.doc_id].append((r.start, r.length, r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == want.keys()
    for i, pieces in by_doc.items():
        pieces.sort()
        assert [s for s, _, _ in pieces] == [sum(n for _, n, _ in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n, _ in pieces) == want[i] and {t for _, _, t in pieces} == {want[i]}
    for pieces in by_sequence.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))] and sum(n for _, n in pieces) <= 2048
    assert len(by_sequence) <= best_fit_decreasing([n for pieces in by_sequence.values() for _, n in pieces], 2048)


def test_license_scan(spark):
    texts = {d["doc_id"]: d["text"] for d in table(SMALL, "documents").to_pylist()}
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in QUERIES["op3_license_scan"](spark, SMALL).collect()}
    assert got == {i: expected(t) for i, t in texts.items()}


def test_nearest(spark):
    rows = table(LARGE, "embeddings")
    ids, vectors = np.array(rows.column("vec_id").to_pylist()), np.array(rows.column("embedding").to_pylist(), dtype=np.float64)
    want = {q: {i for i, _ in found} for q, found in brute_nearest(ids, vectors).items()}
    got = defaultdict(set)
    for r in QUERIES["op4_hash_prefix_forest"](spark, LARGE).collect():
        got[r.query_id].add(r.vec_id)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    assert np.mean([len(got[q] & want[q]) / 10 for q in want]) >= 0.9


def test_near_duplicates(spark):
    rows = [(d["doc_id"], d["text"]) for d in table(SMALL, "documents").to_pylist()]
    assert Counter(map(tuple, QUERIES["op5_near_dedup"](spark, SMALL).collect())) == brute(rows)


def test_round_trip(spark, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op9_bpe_round_trip"](spark, SMALL).collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for d in table(SMALL, "documents").to_pylist():
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        assert got[d["doc_id"]] == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(library.decode(ids, skip_special_tokens=False).encode()))


def test_chats(spark):
    turns = Counter(r["conv_id"] for r in table(SMALL, "conversations").to_pylist())
    by = defaultdict(list)
    for r in QUERIES["op10_chat_format"](spark, SMALL).collect():
        by[r.conv_id].append(r)
    assert {c: len(rows) for c, rows in by.items()} == turns
    for rows in by.values():
        rows.sort(key=lambda r: r.place)
        paid = sum(price(r.action, r.role, r.new_role) for r in rows) + chat.ENDS[chat.ROLES.index(rows[-1].new_role)][0]
        assert paid == cheapest([r.role for r in rows])
