import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickloom.llm import packing


def brute_ids(text):
    whole = Tokenizer.from_file(packing.default_tokenizer())
    return whole.encode(text or "", add_special_tokens=False).ids + [packing.END]


@pytest.mark.parametrize("length", [7, 4096])
def test_every_id_lies_in_one_piece(docs_of, prose, length):
    texts = [None, "", " \n\t ", "Hello, world's end!", "ÜBER straße naïve ÉÇ", "数 字 and 語", "é café",
             "a <|endoftext|> b", "x" * 3000, prose(1, 3000), prose(2, 50), prose(2, 50), "İstanbul ΑΣ Σ", "1234 5.6%"]
    rows = packing.pack(docs_of(*texts), length=length).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    total = 0
    for i, text in enumerate(texts):
        want, at = brute_ids(text), 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            part = want[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids"]) == (at, len(want), part)
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(want)
        total += at
    assert len(by_sequence) == -(-total // length)  # all full but the last
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length


def test_fast_words_equal_the_tokenizer(prose):
    words = packing.Words(packing.default_tokenizer())
    whole = Tokenizer.from_file(packing.default_tokenizer())
    texts = [prose(i, 200).replace("0", "'ll ").replace("1", "É") + "don't 'S ñ%%% (x)[y]" for i in range(20)]
    for t in texts:
        assert np.frombuffer(words.encode(t), "<u2").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_hilbert_keys_are_a_walk_through_neighbouring_cells(monkeypatch):
    monkeypatch.setattr(packing, "BITS", 3)
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = packing.hilbert(cells)
    assert sorted(keys) == list(range(512))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_neighbours(docs_of, prose):
    a, b = prose(1, 300), "ganz andere wörter " * 100
    rows = packing.pack(docs_of(a, b, a + " x", b + " y", a + " z", b + " w"), length=100_000).collect()
    order = [r["doc_id"] % 2 for r in sorted(rows, key=lambda r: r["offset"])]
    assert sum(x != y for x, y in zip(order, order[1:])) == 1


def test_empty_table_and_repeated_rows(docs_of):
    assert packing.pack(docs_of("a").limit(0)).count() == 0
    rows = packing.pack(docs_of((1, "same"), (1, "same"))).collect()
    assert sorted(r["offset"] for r in rows) == [0, 2]
