"""Cell-wise lag and running sums equal plain ones, across cell borders too."""

from pyspark.sql import functions as F

from quire.functions import ordered


def test_across_cells(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CELL", 10)
    rows = [("a", n, n * 3) for n in (1, 2, 9, 10, 11, 35, 70)] + [("b", 5, 1)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    got = {(r["k"], r["o"]): (r["p"], r["s"]) for r in ordered.with_running_sum(ordered.with_previous(df, "k", "o", {"p": "v"}), "k", "o", "v", "s").collect()}
    want, last, total = {}, {}, {}
    for k, o, v in sorted(rows):
        total[k] = total.get(k, 0) + v
        want[k, o] = (last.get(k), total[k])
        last[k] = v
    assert got == want


def test_null_order_comes_first(spark):
    df = spark.createDataFrame([("a", None, 5), ("a", 1, 2)], "k string, o int, v int")
    assert sorted(r["s"] for r in ordered.with_running_sum(df, "k", "o", "v", "s").collect()) == [5, 7]
    assert ordered.with_previous(df.where(F.lit(False)), "k", "o", {"p": "v"}).count() == 0
