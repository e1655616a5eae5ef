from strandline.llm.common import only_ids
from strandline.llm.graph import connected_components


def test_only_ids_keeps_all_that_match(spark):
    df = spark.createDataFrame([(i, str(i)) for i in [None, *range(-50, 3000)]], "k long, v string")
    ids = spark.createDataFrame([(i,) for i in [None, *range(0, 3000, 7), 10**12]], "id long")
    got = {r.k for r in only_ids(df, "k", ids).collect()}
    assert set(range(0, 3000, 7)) <= got and len(got) < 600
    assert only_ids(df, "k", ids.where("false")).count() == 0
    assert {r.k for r in only_ids(df, "k", ids, bits=8).collect()} >= set(range(0, 3000, 7))


def test_components_of_odd_links(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1100)]
    links = [*chain, *star, (5, 5), (None, 1), (2, None), (160, 7), (160, 7), (-3, -9)]
    got = {r.id: r.label for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    expected = {i: 7 for i in [*range(100, 161), 7, *range(1000, 1100)]} | {-3: -9, -9: -9}
    assert got == expected
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
