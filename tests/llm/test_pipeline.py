"""The rows of ``run`` against a plain chain of the five stages, on a small table."""

import numpy as np
import pytest

import corpus_pipeline
from clickloom.llm import quality

from .test_neardup import brute as brute_links
from .test_neardup import edited
from .test_packing import brute_ids
from .test_private import brute as brute_spans
from .test_quality import brute as brute_counts


def rated(rows):
    """The rows that pass the base rules and the limits; few texts: limits of the whole table."""
    counts = [brute_counts(t) for _, t in rows]
    good = [n >= 50 and 100 * repeat <= 50 * n for n, _, _, _, repeat in counts]
    for name, spread, at in (("symbols", 0.03, 2), ("repeat", 0.15, 4), ("lines", 0.02, 3), ("length", 1.0, 1)):
        share = [c[at] / c[0] if c[0] else 0 for c in counts]
        passed = [s for s, c in zip(share, counts) if c[0] >= 50 and 100 * c[4] <= 50 * c[0]]
        low, high = np.quantile(passed, [0.25, 0.75], method="inverted_cdf")
        good = [g and s <= high + 3 * max(high - low, spread) for g, s in zip(good, share)]
    return [r for r, g in zip(rows, good) if g]


def apart(rows):
    """The row with the least id of each group of near-copies."""
    least = brute_links(rows, 5, 80)
    return [r for r in dict(rows).items() if least[r[0]] == r[0]]


def without_repeats(rows, size=200):
    bodies, seen = [t.encode() for _, t in rows], {}
    for d, b in enumerate(bodies):
        for i in range(len(b) - size + 1):
            seen.setdefault(b[i:i + size], []).append((d, i))
    gone = [bytearray(len(b)) for b in bodies]
    for places in seen.values():
        for d, i in places if len(places) > 1 else ():
            gone[d][i:i + size] = b"\1" * size
    return [(i, bytes(x for x, g in zip(b, out) if not g).decode("utf-8", "ignore"))
            for (i, _), b, out in zip(rows, bodies, gone)]


def redacted(text):
    for kind, start, end in sorted((s.split(":") for s in brute_spans(text)), key=lambda s: -int(s[1])):
        text = f"{text[:int(start)]}<{kind}>{text[int(end):]}"
    return text


@pytest.fixture(scope="module")
def rows(prose):
    clean = [prose(500 + i, 90 + i) for i in range(24)]
    passage = prose(600, 70)
    found = ["mail me@here.org now", "from 10.0.0.1 on", "a.b+c@d-e.co.uk and x@y.zz"]
    texts = [None, "", "too short", prose(601, 49), "same same same " * 40,
             " ".join(w + "***" for w in prose(602, 90).split()), *clean,
             clean[0], clean[0].upper(), edited(clean[5], 50), prose(603, 60) + " ü " + passage + " é " + prose(604, 60),
             passage + "\n" + prose(605, 70), prose(606, 70) + passage,
             *[prose(610 + i, 60) + " " + f + " " + prose(620 + i, 60) for i, f in enumerate(found)]]
    return [*enumerate(texts), (7, texts[7])]  # a repeated row


def test_run_matches_a_plain_chain(spark, docs_of, rows, tmp_path):
    docs_of(*rows).withColumn("extra", quality.F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    good = rated(rows)
    single = apart(good)
    cut = without_repeats(single)
    want = {i: redacted(t) for i, t in cut}
    # every stage has something to do
    assert len(good) < len(rows) and len(single) < len(good)
    assert sum(a != b for a, b in zip(single, cut)) >= 3 and sum(want[i] != t for i, t in cut) == 3
    pieces = corpus_pipeline.run(spark, str(tmp_path)).orderBy("doc_id", "start").collect()
    ids = {}
    for p in pieces:
        assert p["start"] == len(ids.setdefault(p["doc_id"], []))
        ids[p["doc_id"]] += p["ids"]
    assert ids == {i: brute_ids(t) for i, t in want.items()}
    used = {}
    for p in pieces:
        used[p["sequence_id"]] = used.get(p["sequence_id"], 0) + p["length"]
    assert max(used.values()) <= 4096 and len(used) == -(-sum(used.values()) // 4096)


def test_run_on_an_empty_table(spark, docs_of, tmp_path):
    docs_of((1, "x")).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_personal_data_stage_learns_from_all_candidates(spark, docs_of, monkeypatch):
    """Every document's candidate is among what the stage learns from."""
    from clickloom.llm import private

    counted, whole = [], private.examples
    monkeypatch.setattr(private, "examples", lambda c: counted.append(whole(c).agg(private.F.sum("n")).first()[0]) or whole(c))
    docs = docs_of(*[f"card 4111111111111111 no {i}" for i in range(24_000)])
    corpus_pipeline.personal_data(spark, docs, "").count()
    assert counted == [96_000]  # two generators find each number, each with one looser form
