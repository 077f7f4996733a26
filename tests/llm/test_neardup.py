import re
from itertools import combinations

from clickloom.llm import components, neardup


def brute(rows, size, percent):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}

    sets = [(i, shingles(t)) for i, t in rows]
    least = {i: i for i, _ in rows}
    for _ in rows:
        for (a, x), (b, y) in combinations(sets, 2):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                least[a] = least[b] = min(least[a], least[b])
    return least


def edited(text, *places):
    words = text.split()
    for p in places:
        words[p] = f"edit{p}"
    return " ".join(words)


def check(df, rows, words=3, percent=85):
    got = {r["doc_id"]: r["component_id"] for r in neardup.connect(df, words, percent).collect()}
    assert got == brute(rows, words, percent)


def test_links_match_brute_force(docs_of, prose):
    a, b = prose(1, 200), prose(2, 120)
    texts = [None, "", "  ", "one", "ONE", "two words", a, a, edited(a, 50), edited(a, 20, 80), edited(a, 5, 60, 110, 160),
             a.upper(), b, edited(b, 30), edited(b, *range(0, 100, 9)), prose(3, 5), prose(3, 5) + " x", prose(4, 9000)]
    rows = list(enumerate(texts))
    check(docs_of(*texts), rows)


def test_chain_through_several_components(docs_of, prose):
    base, texts = prose(5, 300), []
    for i in range(25):  # each a few edits from the one before, the ends far apart
        texts.append(base)
        base = edited(base, 10 * i, 10 * i + 3)
    check(docs_of(*texts), list(enumerate(texts)))


def test_tiles_search_a_group_without_a_centre(docs_of, prose, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", 4)
    monkeypatch.setattr(neardup, "ROUNDS", 0)
    base = prose(6, 300)
    texts = [edited(base, *range(i, 300, 60)) for i in range(20)]
    check(docs_of(*texts), list(enumerate(texts)), percent=80)


def test_one_of_each_group_stays(docs_of, prose):
    a = prose(7, 100)
    kept = neardup.deduplicate(docs_of((5, a), (3, edited(a, 50)), (9, prose(8, 100)), (9, prose(8, 100)), (1, None)))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 9]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_table_and_missing_id(docs_of, prose):
    df = docs_of((None, prose(9, 50)), (1, prose(9, 50)))
    assert neardup.connect(df.limit(0)).count() == 0
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in neardup.connect(df).collect()}
    assert got[1] == (1, True)


def test_components_of_a_path_and_a_ring(spark):
    path = [(i, i + 1) for i in range(40)]
    ring = [(100 + i, 100 + (i + 1) % 9) for i in range(9)]
    edges = spark.createDataFrame(path + ring, "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(9)}


def test_equal_coordinates_asked_for_follow_the_similarity():
    assert neardup.matches(85) == 40
    for percent in (50, 70, 80, 85, 90, 95, 100):
        least, p = neardup.matches(percent), percent / 100
        tail = [sum(neardup.comb(64, k) * p**k * (1 - p) ** (64 - k) for k in range(m)) for m in (least, least + 1)]
        assert tail[0] <= 2.5e-6 and (least == 64 or tail[1] > 2.5e-6)


def test_a_pair_at_the_limit_with_few_equal_coordinates_is_linked():
    least = neardup.matches(80)
    assert least < 40
    sets = [list(range(0, 90)), list(range(10, 100))]  # 80 of 100 shingles
    for equal, found in ((least, 1), (least - 1, 0)):
        rows = neardup.pd.DataFrame({
            "lo": 0, "hi": 0, "tile": 0, "node": [1, 2], "n": 90, "m": 80, "at": [1, 2],
            "signature": [neardup.np.zeros(64, int), neardup.np.array([0] * equal + [1] * (64 - equal))],
            "hashes": [neardup.np.array(s) for s in sets]})
        assert len(neardup._tile_links(rows, 80)) == found
