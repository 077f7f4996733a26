import hashlib
from collections import Counter

import pytest

from clickloom.llm import suffixes


def brute(texts, size=200):
    bodies = [(t or "").encode() for t in texts]
    often = Counter(b[i:i + size] for b in bodies for i in range(len(b) - size + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if often[b[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cases(prose):
    passage, other = prose(1, 60), prose(2, 80)
    return [None, "", "short", passage[:199], passage[:200], "ab" * 150, "x" * 450, "ü" * 130,
            prose(3, 30) + passage + prose(4, 30), prose(5, 20) + passage, passage + prose(6, 10),
            prose(7, 10) + passage[40:260] + prose(8, 10), prose(9, 50) + other + prose(10, 5) + other,
            prose(11, 100), prose(11, 100), prose(12, 3000), prose(12, 3000)[5000:9000] + "é" + passage[100:320]]


@pytest.mark.parametrize("crowd", [512, 1])
def test_removed_bytes_match_brute_force(docs_of, prose, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    texts = cases(prose)
    out = suffixes.cut_repeats(docs_of(*texts)).orderBy("_0").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out] == brute(texts)


def test_a_passage_of_many_texts_is_put_out_in_few_spans(docs_of, prose, monkeypatch):
    """Only the parts at the edges of what is shared are cut again, not all of them to single strings."""
    monkeypatch.setattr(suffixes, "CROWD", 8)
    passage = prose(40, 120)
    texts = [prose(100 + i, 40) + passage + prose(200 + i, 40) for i in range(40)]
    spans = suffixes.repeats(docs_of(*texts)).collect()
    for r in spans:
        body = texts[r["d"]].encode()[r["start"]:r["start"] + r["length"]]
        assert len(body) >= 200 and sum(body in t.encode() for t in texts) > 1
    inside = len(passage) - 199  # strings of 200 bytes that a text shares
    assert len(spans) < 40 * inside / 8
    out = suffixes.cut_repeats(docs_of(*texts)).orderBy("_0").collect()
    assert [(r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out] == [x[1:] for x in brute(texts)]


def test_long_texts_are_read_in_parts(docs_of, prose, monkeypatch):
    monkeypatch.setattr(suffixes, "BATCH", 700)
    texts = cases(prose)
    out = suffixes.cut_repeats(docs_of(*texts)).orderBy("_0").collect()
    assert [(r["n_removed"], r["n_spans"]) for r in out] == [x[1:3] for x in brute(texts)]


def test_repeats_name_all_occurrences(docs_of, prose):
    passage = prose(20, 60)
    texts = [prose(21, 10) + "<" + passage + ">", "(" + passage + ")" + prose(22, 10), passage]
    rows = suffixes.repeats(docs_of(*texts)).collect()
    by_name = {}
    for r in rows:
        body = texts[r["d"]].encode()[r["start"]:r["start"] + r["length"]]
        by_name.setdefault(r["repeat"], set()).add((r["d"], body))
    assert all(len({b for _, b in found}) == 1 for found in by_name.values())
    assert any(len({d for d, _ in found}) == 3 for found in by_name.values())


def test_maximal_repeats_are_diverse_on_both_sides():
    length = suffixes.LENGTH
    left, right = b"l" * 100, b"r" * 150
    rows = [(b"a" + left, right + b"x"), (b"b" + left, right + b"y"), (b"c" + left[1:], right + b"x")]
    found = {(lo, hi, tuple(sorted(m))) for lo, hi, m in suffixes.maximal_repeats(
        [x[::-1] for x, _ in rows], [y for _, y in rows])}
    assert (100, 150, (0, 1)) in found
    assert all(lo + hi >= length for lo, hi, _ in found)


def test_repeated_rows_empty_table_and_other_columns(docs_of, prose):
    text = prose(30, 60)
    df = docs_of((1, text), (1, text), (2, None)).withColumn("n_bytes", suffixes.F.lit("mine"))
    out = suffixes.remove_repeats(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["text"], r["n_bytes"]) for r in out.collect()) == [
        (1, "", "mine"), (1, "", "mine"), (2, "", "mine")]
    assert suffixes.remove_repeats(df.limit(0)).count() == 0
