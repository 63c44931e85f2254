from churnlens.llm.line_dedup import drop_boilerplate


def test_share_is_relative_to_the_host(spark):
    rows = [(i, f"Menu\nbody {i}\n\n Menu \nfooter {i % 10}", "big") for i in range(50)]
    rows += [(100 + i, f"Menu\nbody {i}", "small") for i in range(2)]
    rows += [(200 + i, "rare line" if i < 3 else f"line {i}", None) for i in range(20)]
    out = {r["doc_id"]: r for r in drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), ratio=0.1).collect()}
    assert out[7]["kept_text"] == "body 7\n\nfooter 7" and (out[7]["n_lines"], out[7]["n_dropped"]) == (5, 2)
    assert out[100]["kept_text"] == "Menu\nbody 0"           # below min_pages
    assert out[200]["kept_text"] == "" and out[210]["kept_text"] == "line 10"
    # footers stand on exactly a tenth of the pages, which does not exceed the ratio
    assert all(out[i]["kept_text"].endswith(f"footer {i % 10}") for i in range(50))


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None, "h", "x"), (1, None, "h", "y"), (None, "a\na\na", "h", "z"), (2, "", None, "z")],
                                 "doc_id long, text string, source string, n_lines string")
    out = sorted(((r["doc_id"] or 0), r["n_lines"], r["n_dropped"], r["kept_text"]) for r in drop_boilerplate(docs).collect())
    assert out == [(0, 3, 0, "a\na\na"), (1, 1, 0, ""), (1, 1, 0, ""), (2, 1, 0, "")]
    assert drop_boilerplate(docs.limit(0)).collect() == []


def test_lists_joined_by_host_split_as_broadcast(spark):
    """The same rows whether the lists are small enough to go to the pages or not; a hot host, ties at the ratio."""
    rows = [(i, f"top\nx {i}\nshared {i % 7}", "hot" if i % 3 else f"h{i % 11}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    plain = sorted(map(tuple, drop_boilerplate(docs).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = drop_boilerplate(docs)
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, out.collect())) == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    pages = {}
    for i, text, host in rows:
        pages.setdefault(host, []).append((i, text.split("\n")))
    want = {}
    for host, held in pages.items():
        for i, lines in held:
            gone = [x for x in lines if (n := sum(x in other for _, other in held)) >= 3 and n > 0.1 * len(held)]
            want[i] = "\n".join(x for x in lines if x not in gone)
    assert {r[0]: r[4] for r in plain} == want and any("top" not in t for t in want.values())
