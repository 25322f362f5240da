from tidemark.operators.sampling import by_hash


def test_size_and_stability(spark):
    rows = spark.range(50_000)
    a = {r.id for r in by_hash(rows, ["id"], 500, 50_000).collect()}
    b = {r.id for r in by_hash(rows.repartition(7), ["id"], 500, 50_000).collect()}
    assert a == b and len(a) == 500
    assert by_hash(rows.limit(20), ["id"], 500, 20).count() == 20
    assert by_hash(rows.limit(0), ["id"], 500, 0).count() == 0
