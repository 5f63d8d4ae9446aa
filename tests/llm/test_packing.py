import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newsgraph.llm import packing
from newsgraph.llm.queries import BPE

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOKENIZER.encode_special_tokens = True
ENCODER = packing.WordEncoder(BPE)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z9.,'\n\t\x1c　é漢<|endoftext|>")) | st.characters(codec="utf-8")))
def test_word_encoder_equals_the_tokenizer(text):
    assert ENCODER.encode(text) + b"\0\0\0\0" == np.asarray(plain_ids(text), "<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_best_fit_decreasing_equals_brute_force(lengths):
    seq, off = packing.best_fit_decreasing(lengths, 50)
    room, want = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        fits = [r for r in room if r >= lengths[i]]
        if not fits:
            room.append(50)
            fits = [50]
        room[room.index(min(fits))] -= lengths[i]
        want[i] = min(fits)
    assert [50 - o for o in off] == want  # every length goes where the tightest room was
    assert len(set(seq)) == len(room)


def check(spark_rows, texts):
    """Every document whole, every sequence gapless from 0 and full enough."""
    sequences, documents = {}, {}
    for r in spark_rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append(r)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    for doc_id, text in texts.items():
        ids, at = plain_ids(text), 0
        for k, r in enumerate(sorted(documents[doc_id], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            part = np.asarray(ids[at:at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
            at += r["length"]
            assert k == 0 or r["length"] == 2048
        assert at == len(ids)
    return len(sequences)


def test_packs_the_table(docs):
    rows = packing.pack_documents(docs, BPE).collect()
    n = check(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    assert n <= 1 + 1.01 * sum(r["length"] for r in rows) / 2048


def test_many_groups_waste_little(docs):
    pieces = packing.tokenised_pieces(docs, BPE)
    few = packing.pack(pieces).select("sequence_id").distinct().count()
    many = packing.pack(pieces, group_pieces=60).select("sequence_id").distinct().count()
    assert few <= many <= few + 8


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs, BPE).collect()
    once = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] in (1, 2, 3, 4, 6, 7, 8, 10, 11)}
    assert sum(r["piece"] == 0 for r in rows) == odd_docs.count()
    check([r for r in rows], {})
    for doc_id, text in once.items():
        assert sum(r["length"] for r in rows if r["doc_id"] == doc_id) == len(plain_ids(text))
    assert packing.pack_documents(no_docs, BPE).collect() == []
