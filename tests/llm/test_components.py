from eventide.llm.components import components


def test_components(spark):
    path = [(k, k + 1) for k in range(30)]
    star = [(100, k) for k in range(101, 120)]
    mixed = [(201, 205), (205, 203), (300, 300)]
    edges = spark.createDataFrame(path + star + mixed, "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    expected = {k: 0 for k in range(31)} | {k: 100 for k in range(100, 120)} | {201: 201, 205: 201, 203: 201}
    assert found == expected
    assert components(edges.limit(0)).collect() == []
