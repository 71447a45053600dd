"""Tables laid out along a curve."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from knownwhen.sources import layout, tables
from verification import queries

COLUMNS = ["cik", "ddate", "known_from_ts"]



def test_place_is_the_interleaved_ranks(spark):
    grid = spark.range(64).selectExpr("id % 8 AS x", "id div 8 AS y")
    cuts = {"x": list(range(1, 8)), "y": list(range(1, 8))}
    got = grid.withColumn("p", layout.place(grid, cuts, 3)).collect()
    for r in got:
        by_hand = sum((r.x >> b & 1) << (2 * b + 1) | (r.y >> b & 1) << (2 * b) for b in range(3))
        assert r.p == by_hand


def test_few_ranges_use_the_high_bits_and_nulls_come_first(spark):
    rows = spark.sql("SELECT * FROM VALUES (1), (5), (NULL) AS t(x)")
    got = {r.x: r.p for r in rows.withColumn("p", layout.place(rows, {"x": [5]}, 4)).collect()}
    assert got == {1: 0, 5: 8, None: 0}


def test_no_rows_repeats_nulls_and_a_clashing_column(spark):
    rows = spark.sql("SELECT CAST(x AS INT) x, DATE'2020-01-01' y, 'kept' _place "
                     "FROM VALUES (1), (1), (NULL) AS t(x)")
    for some in (rows, rows.limit(0)):
        got = layout.along_curve(some, ["x", "y"])
        assert got.columns == ["x", "y", "_place"]
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, some.collect()))
    with pytest.raises(ValueError):
        layout.along_curve(rows, ["x", "y"], bits=32)


def test_one_company_with_most_rows_spreads_over_files(spark, tmp_path):
    rows = spark.range(8000).selectExpr(
        "CASE WHEN id % 4 < 3 THEN 7 ELSE id END AS cik", "id % 50 AS day", "id")
    layout.along_curve(rows, ["cik", "day"], files=16).write.parquet(str(tmp_path / "t"))
    files = layout.extents(spark, str(tmp_path / "t"), ["cik", "day"]).collect()
    assert sum(f.n_rows for f in files) == 8000 and max(f.n_rows for f in files) < 1500


def test_each_column_prunes_files_of_intervals(spark, medium, tmp_path):
    root = str(tmp_path)
    rows = queries.pit(spark, medium).persist()
    kept = {}
    for name, how in (("lexicographic", None), ("curve", COLUMNS)):
        if how:
            folder = tables.publish_along_curve(
                rows, f"{root}/{name}", "fact_fundamental_pit", how, files=64)
        else:
            by = tables.CATALOGUE["fact_fundamental_pit"].cluster
            folder = f"{root}/{name}"
            rows.repartitionByRange(64, *by).sortWithinPartitions(*by).write.parquet(folder)
        files = layout.extents(spark, folder, COLUMNS).persist()
        total = files.count()
        kept[name] = {c: layout.files_between(files, c, *[
            F.lit(x).cast(rows.schema[c].dataType) for x in ends]).count() / total
            for c, ends in queries.RANGES.items()}
        assert files.agg(F.sum("n_rows")).first()[0] == rows.count()
    print(kept)
    # A range of companies is found as before, give or take; the other ranges are pruned, too.
    assert kept["lexicographic"]["known_from_ts"] > 0.9
    assert kept["curve"]["known_from_ts"] < 0.5 and kept["curve"]["ddate"] < 0.7
    assert kept["curve"]["cik"] < 0.5
