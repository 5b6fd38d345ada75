import brute

from alertloom.llm import quality


def test_statistics(docs, rows):
    found = quality.cleaned(docs).collect()
    assert len(found) == len(rows)
    texts = {i: t for i, t, *_ in rows}
    for r in found:
        expected = brute.quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
        assert not (r.base_failed and r.kept)


def test_boilerplate_of_a_host(spark):
    own = "this line number {} is only found in one single document of all"
    rows = [(i, f"Accept  Cookies {i % 10}\n{own.format(chr(97 + i % 26) * (i + 1))}", "a") for i in range(30)]
    rows += [(100 + i, "accept cookies 7\nand nothing else is in here but this other common line", "a") for i in range(30)]
    rows += [(200 + i, "accept cookies 7\nand nothing else is in here but this other common line", "b") for i in range(3)]
    rows += [(300 + i, "accept cookies 7\nand nothing else is in here but this other common line", None) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in quality.cleaned(df, line_limit=20).collect()}
    assert all(found[i].kept and found[i].removed_words == 3 for i in range(30))
    assert not any(found[100 + i].kept or found[300 + i].kept for i in range(30))
    assert all(found[200 + i].kept and found[200 + i].removed_words == 0 for i in range(3))


def test_repeated_rows_count_once_and_empty(spark):
    df = spark.createDataFrame([(1, "ten words " * 5 + "x y z", "a")] * 50, "doc_id long, text string, source string")
    rows = quality.measured(df)
    assert quality.frequent_lines(rows, 1).count() == 0
    assert quality.cleaned(df.limit(0)).count() == 0


def test_registered_limits_remove_lines(spark, tmp_path):
    """With the defaults of the query: boilerplate is judged by its share of a host, at any size."""
    own = "document {} of this host has a line with these very words of its own {}"
    sign = "subscribe to our letter today"

    def text(i, marked):
        return own.format(chr(97 + i % 26) * (i + 1), "z" * (i + 1)) + (f"\n{sign}" if marked else "")

    rows = [(i, text(i, i % 5 == 0), "large") for i in range(300)]
    rows += [(1000 + i, text(i, i < 8), "small") for i in range(40)]
    rows += [(2000 + i, text(i, i < 5), "floor") for i in range(40)]
    rows += [(3000 + i, text(i, i < 15), "rare") for i in range(300)]
    rows += [(4000 + i, sign + "\nand eight other words are in this page", None) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    measured = quality.measured(df)
    assert {r.host for r in quality.frequent_lines(measured).collect()} == {"large", "small", None}
    cut = {r.doc_id for r in quality.cleaned(df).collect() if r.removed_words}
    assert cut == {*range(0, 300, 5), *range(1000, 1008), *range(4000, 4006)}
    df.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.doc_id: r.kept for r in quality.op7_quality(spark, str(tmp_path)).collect()}
    assert {i for i, k in kept.items() if not k} == set(range(4000, 4006))


def test_frequent_lines_are_cut_out_of_texts(spark, docs):
    own = "a line of words that only this one document has {}"
    marked = ["Subscribe  NOW 1", own, "", "subscribe now 2 ", "end {}", "subscribe now 3"]
    rows = [(i, "\n".join(marked).replace("{}", "q" * (i + 1)), "a", "x", 1) for i in range(20)]
    rows += [(100, "subscribe now 4\nand a line of another host that stays here as it is", "b", "x", 1)]
    rows += [(200, None, "a", "x", 1), (201, "", None, "x", 1), (5, rows[5][1], "a", "x", 1)]
    rows += [(300 + i, "Only boilerplate of no host\r\n", None, "x", 1) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra string, kept int").repartition(4)
    want = {i: "\n".join([own, "", "end {}"]).replace("{}", "q" * (i + 1)) for i in range(20)}
    want |= {100: rows[20][1], 200: None, 201: ""} | {300 + i: "" for i in range(8)}
    found = quality.cleaned(df).collect()
    assert len(found) == len(rows)
    given = {i: t for i, t, *_ in rows}
    for r in found:
        assert r.text == want[r.doc_id] and r.extra == "x"
        assert r.removed_words == len(brute.words(given[r.doc_id])) - len(brute.words(r.text))
        assert r.n_words == len(brute.words(given[r.doc_id]))
        assert r.kept == (r.doc_id <= 100)
    hard = {r.doc_id: r.text for r in quality.cleaned(docs).collect()}
    assert hard == {r.doc_id: r.text for r in docs.collect()}
    assert quality.cleaned(df.limit(0)).count() == 0
