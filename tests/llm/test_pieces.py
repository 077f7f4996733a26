import sentencepiece

from clickloom.llm import pieces

TEXTS = [None, "", " ", "  two  blanks ", "hello world", "Grüße\nan\talle 数字 😀", "the the the", "x" * 200, "the the the"]


def brute():
    p = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    ids = {p.id_to_piece(i): i for i in range(p.get_piece_size())
           if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i)) and (p.get_score(i) > pieces.LEAST_USED or len(p.id_to_piece(i)) == 1)}
    score = {x: p.get_score(i) for x, i in ids.items()}
    low = min(score.values()) - pieces.UNKNOWN_MARGIN

    def word(w):
        best = [(0.0, None)] + [None] * len(w)
        for e in range(1, len(w) + 1):
            for s in range(max(0, e - 16), e):
                v = score.get(w[s:e], low if e - s == 1 else None)
                if v is not None and (best[e] is None or best[s][0] + v > best[e][0]):
                    best[e] = (best[s][0] + v, s)
        out, e = [], len(w)
        while e:
            s = best[e][1]
            out = ([ids[w[s:e]]] if w[s:e] in ids else [p.piece_to_id(f"<0x{b:02X}>") for b in w[s:e].encode()]) + out
            e = s
        return out

    return lambda text: [i for w in (text or "").split(" ") for i in word(pieces.MARK + w)] if text else []


def test_ids_match_brute_force_and_decode(docs_of):
    want = brute()
    rows = pieces.encode(docs_of(*TEXTS)).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {i: want(t) for i, t in enumerate(TEXTS)}
    p = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    for r in rows:
        assert p.decode(r["ids"]) == (r["text"] or "")


def test_measures_with_few_and_many_frequent_words(docs_of, monkeypatch):
    want = brute()
    for head in (2, 1000):
        monkeypatch.setattr(pieces, "HEAD", head)
        rows = pieces.measure(docs_of(*TEXTS)).collect()
        assert {r["doc_id"]: (r["n_pieces"], r["ids_sum"], r["round_trip"]) for r in rows} == {
            i: (len(want(t)), sum(want(t)), True) for i, t in enumerate(TEXTS)}


def test_empty_table(docs_of):
    assert pieces.measure(docs_of("a").limit(0)).count() == 0


def test_whole_texts_decode_from_ids_in_order(docs_of):
    texts = [*TEXTS, "▁", "a▁b ▁▁c", "one two", "two one", "tab\tand\nline"]
    back = pieces.decode(pieces.encode(docs_of(*texts)))
    assert {r["doc_id"]: r["decoded"] for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}
    rows = {r["doc_id"]: r for r in pieces.measure(docs_of(*texts)).collect()}
    assert all(r["round_trip"] for r in rows.values())
    at = {t: i for i, t in enumerate(texts)}
    one, two = rows[at["one two"]], rows[at["two one"]]
    assert one["ids_sum"] == two["ids_sum"] and one["ids_sha256"] != two["ids_sha256"]


def test_a_wrong_order_is_seen(docs_of):
    coded = pieces.encode(docs_of("one two three"))
    turned = pieces.decode(coded.withColumn("ids", pieces.F.reverse("ids"))).first()
    assert turned["decoded"] != "one two three"


def test_long_texts_without_blanks(docs_of):
    short = ["数字和文字" * 20, "QmFzZTY0" * 30, "a\tb\n" * 50]
    want = brute()
    for r in pieces.encode(docs_of(*short)).collect():
        assert r["ids"] == want(r["text"])
    long = ["QmFzZTY0+/x9" * 87_400, "数字和文字" * 70_000, "line\tof\n" * 131_072]
    assert min(len(t.encode()) for t in long) > 1_000_000
    rows = pieces.measure(docs_of(*long)).collect()
    assert all(r["round_trip"] and r["n_words"] == 1 and r["n_pieces"] > 100_000 for r in rows)


def test_random_texts_by_lattice(docs_of, monkeypatch):
    """Rare and frequent runs, letters beside other characters, characters without a piece."""
    import random

    monkeypatch.setattr(pieces, "HEAD", 20)
    rnd, want = random.Random(6), brute()
    letters = "aeinrstzüé数😀 ̈.,'!-(1 9\n▁"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(200)]
    texts = [t.replace(pieces.MARK, "") for t in texts] + texts[:0]
    got = {r["doc_id"]: r["ids"] for r in pieces.encode(docs_of(*texts, texts[0])).collect()}
    assert got == {i: want(t) for i, t in enumerate([*texts, texts[0]])}


def test_decoding_cuts_a_leading_blank_only(spark):
    p = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    he = p.piece_to_id("he")
    (row,) = pieces.decode(spark.createDataFrame([([he, he],)], "ids array<int>")).collect()
    assert row["decoded"] == "hehe"


def test_encoding_joins_and_folds(docs_of, prose):
    plan = pieces.lattice(docs_of(prose(1, 30)).select(pieces.F.col("text").alias("run"), pieces.F.lit(1).alias("n")),
                          pieces.piece_table())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Generate explode" in plan and "Python" not in plan and "Arrow" not in plan


def test_other_columns_pass_through(docs_of):
    df = docs_of("a b c").withColumns({"run": pieces.F.lit("mine"), "n": pieces.F.lit(5), "ids": pieces.F.lit("old")})
    (row,) = pieces.encode(df).collect()
    assert row["run"] == "mine" and row["n"] == 5 and row["ids"] == brute()("a b c")


def test_a_model_whose_pieces_mix_letters_and_others_is_not_cut_there():
    plain, mixed = [("▁a", 0, -1.0), ("!!", 1, -1.0)], [("a!", 0, -1.0)]
    assert pieces.cutting(plain) != pieces.cutting(mixed) == f" ?[^ {pieces.MARK}]+| |{pieces.MARK}"


def test_measuring_takes_one_python_worker_a_task(docs_of, prose):
    """Ids and texts come from one pass: two would hold the tables twice; more texts than Python holds at a time."""
    texts = [*TEXTS, *(prose(i, 4) for i in range(2 * pieces.SLICE + 3))]
    measured = pieces.measure(docs_of(*texts))
    plan = measured._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    want = brute()
    assert {r["doc_id"]: (r["n_pieces"], r["round_trip"]) for r in measured.collect()} == {
        i: (len(want(t)), True) for i, t in enumerate(texts)}
    apart, one = docs_of(*TEXTS), pieces.encode(docs_of(*TEXTS), back=True)
    assert one.columns[-2:] == ["ids", "decoded"]
    assert one.exceptAll(pieces.decode(pieces.encode(apart))).isEmpty()


def test_texts_move_packed_and_alone(docs_of, prose, monkeypatch):
    """The disk holds one step's shuffle: what a text needs is written before, and texts move packed, without their runs."""
    monkeypatch.setattr(pieces, "HEAD", 5)
    names, freed, plain = [], [], pieces.written
    text = prose(1, 400)
    docs = docs_of(*TEXTS, text, text + " 😀▁", text)
    before = docs.sparkSession.conf.get(pieces.FREED)

    def written(df, name):
        names.append(name)
        freed.append(df.sparkSession.conf.get(pieces.FREED))
        return plain(df, name)

    monkeypatch.setattr(pieces, "written", written)
    coded = pieces.encode(docs, back=True)
    assert (names, freed) == (["runs", "paths"], ["true", "true"])
    assert docs.sparkSession.conf.get(pieces.FREED) == before
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("BatchEvalPython") == 1 and plan.count("Relation [__text") == 1
    want, rows = brute(), coded.collect()
    texts = [*TEXTS, text, text + " 😀▁", text]
    assert [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])] == texts
    assert all(r["decoded"] == (r["text"] or "") for r in rows)
    assert {r["doc_id"]: r["ids"] for r in rows if pieces.MARK not in (r["text"] or "")} == {
        i: want(t) for i, t in enumerate(texts) if pieces.MARK not in (t or "")}


def test_runs_are_cut_alike_in_and_out_of_spark(docs_of):
    table = [("\u2581a", 0, -1.0), ("!!", 1, -1.0)]
    texts = ["".join(map(chr, range(lo, lo + 7))) + " a\u0301b, 12\u2581x" for lo in (65, 0xC0, 0x2FE, 0x4E00, 0xAC00, 0xFFF8, 0x1F600, 0x20000)]
    pattern = pieces.cutting(table)
    cut = pieces.cutter(pattern, pieces.letters())
    rows = docs_of(*texts).select("text", pieces.runs_of(pieces.F.col("text"), pattern).alias("runs")).collect()
    assert {r["text"]: r["runs"] for r in rows} == {t: cut(t) for t in texts}
    assert cut("") == []


def test_ids_out_of_the_model_decode_to_nothing(spark):
    p = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    he = p.piece_to_id("he")
    rows = [([-1, he, 10**9, p.unk_id(), he, -(10**9)],), ([],), (None,), ([7 * 10**8],)]
    got = pieces.decode(spark.createDataFrame(rows, "ids array<int>").coalesce(1)).collect()
    assert [r["decoded"] for r in got] == ["hehe", "", None, ""]


def test_pieces_on_no_best_path_are_left_out(spark):
    """Pieces of any length and scores with many ties: paths are those of the whole table, and the join has few pieces."""
    import random

    rnd = random.Random(3)
    texts = {"".join(rnd.choice("abc") for _ in range(rnd.randrange(2, 9))) for _ in range(150)} | {pieces.MARK + "ab", pieces.MARK + "abcabca"}
    table = [(x, i, float(-rnd.randrange(1, 12))) for i, x in enumerate(["a", "b", pieces.MARK, *sorted(texts)])] + [("ab", 999, -1.0)]
    score = {}
    for x, _, s in table:
        score[x] = max(s, score.get(x, s))
    unknown = min(score.values()) - pieces.UNKNOWN_MARGIN

    def want(run):
        best = [(0.0, [])]
        for e in range(1, len(run) + 1):
            found = [(best[s][0] + v, e - s, s) for s in range(e)
                     if (v := score.get(run[s:e], unknown if e - s == 1 else None)) is not None]
            v, _, s = max(found)
            best.append((v, [*best[s][1], run[s:e]]))
        return best[-1][1]

    runs = sorted({rnd.choice(["", " "]) + "".join(rnd.choice("aabbcd") for _ in range(rnd.randrange(1, 30))) for _ in range(300)})
    got = pieces.lattice(spark.createDataFrame([(r, 1) for r in runs], "run string, n long"), table).collect()
    assert {r["run"]: r["path"] for r in got} == {
        r: "".join(p + " " for p in want(r.replace(" ", pieces.MARK))) for r in runs}
    kept = {x for x, _, _ in pieces.worth(table)}
    assert {x for r in runs for x in want(r.replace(" ", pieces.MARK)) if x in score} <= kept < score.keys()
    assert len(pieces.worth(pieces.piece_table())) < 11_000
    tied = [("a", 0, -1.0), ("b", 1, -2.0), ("ab", 2, -3.0), ("ba", 3, -3.5)]
    assert pieces.worth(tied) == tied[:3]


def test_grouping_the_edges_has_rows_in_order(spark):
    """The edges of all runs were sorted by run, twice, and each step of the fold copied all paths so far."""
    plan = pieces.lattice(spark.createDataFrame([(" abc", 1)], "run string, n long"), pieces.piece_table())
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" in text and "array<string>" not in text
