from perennial.llm import lines


def test_drops_lines_above_the_ratio_of_their_site_only(spark):
    rows = [(i, "a", f"Menu \r\nown {i}\n\nMenu") for i in range(10)] + [(10 + i, "b", f"Menu\nother {i}") for i in range(1)]
    rows += [(20 + i, "b", f"text {i}") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = {r["doc_id"]: r for r in lines.drop_boilerplate(df, ratio=0.5).collect()}
    assert out[3]["text"] == "own 3\n" and (out[3]["n_lines"], out[3]["n_dropped"]) == (4, 2)
    assert out[10]["text"] == "Menu\nother 0" and out[10]["n_dropped"] == 0
    assert len(out) == 20


def test_nulls_empties_ties_repeated_rows_and_clashing_names(spark):
    rows = [(None, None, "same", 1), (1, None, "same", 2), (1, None, "same", 2), (2, None, "", 3), (3, None, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, n_lines int")
    out = lines.drop_boilerplate(df, ratio=0.6, min_pages=1)
    # 3 of 5 pages carry the line: at the ratio, not above it
    assert sorted(((r["text"] or "-", r["n_lines"], r["n_dropped"]) for r in out.collect())) == [
        ("-", 0, 0), ("-", 1, 0), ("same", 1, 0), ("same", 1, 0), ("same", 1, 0)
    ]
    gone = lines.drop_boilerplate(df, ratio=0.5, min_pages=1)
    assert sorted(((r["text"] or "", r["n_dropped"]) for r in gone.collect())) == [("", 0), ("", 0), ("", 1), ("", 1), ("", 1)]
    assert gone.columns == ["doc_id", "source", "text", "n_lines", "n_dropped"]


def test_small_sites_keep_their_lines(spark):
    df = spark.createDataFrame([(1, "a", "only\nlines")], "doc_id long, source string, text string")
    assert lines.drop_boilerplate(df).first()["n_dropped"] == 0


def test_empty_table_and_long_text(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert lines.drop_boilerplate(df).count() == 0
    long = spark.createDataFrame([(i, "a", "x\n" * 50_000 + str(i)) for i in range(5)], "doc_id long, source string, text string")
    out = lines.drop_boilerplate(long, ratio=0.5).collect()
    assert {r["n_dropped"] for r in out} == {50_000}
