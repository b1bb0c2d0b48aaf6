"""Most and least frequent values by pruning: exact, and without shuffling all values."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from qualia.operators.extremes import contenders, frequency_extremes, least_frequent
from qualia.operators.profile import profile


def plain(values):
    """(most, count, least, count) by the tie rule: smallest text, null first."""
    counts = Counter(values)
    if not counts:
        return None, 0, None, 0
    order = lambda v: (v is not None, (v or "").encode())
    most = min(counts, key=lambda v: (-counts[v], order(v)))
    least = min(counts, key=lambda v: (counts[v], order(v)))
    return most, counts[most], least, counts[least]


RNG = random.Random(6)
CASES = {
    "unique": [f"k{i}" for i in range(500)],
    "unique with null": [None, *(f"k{i}" for i in range(300))],
    "pairs": [f"k{i // 2}" for i in range(400)],
    "pairs and one": [*(f"k{i // 2}" for i in range(400)), "zz"],
    "skewed": [f"v{int(RNG.paretovariate(0.8))}" for _ in range(600)],
    "hot": ["hot"] * 300 + [f"k{i}" for i in range(300)],
    "hot smallest": ["a"] * 300 + [f"k{i}" for i in range(300)],
    "nulls most": [None] * 200 + ["x", "y", "y"],
    "one value": ["x"] * 50,
    "ties": ["b", "a", "a", "b", "c"],
    "odd texts": ["", " ", "é", "z", "Z", "漢", "", "é"],
    "none": [],
    "all null": [None] * 7,
}


@pytest.mark.parametrize("bits,walk_rows", [(4, 5), (16, 10_000)])
def test_extremes_are_exact(spark, bits, walk_rows):
    longest = max(map(len, CASES.values()))
    for name, values in CASES.items():
        df = spark.createDataFrame([(v,) for v in RNG.sample(values, len(values))], "v string").repartition(3)
        got = frequency_extremes(df, ["v"], bits=bits, walk_rows=walk_rows).first()
        assert tuple(got)[1:] == plain(values), name
    assert longest == 600


def test_several_columns_of_several_types(spark):
    df = spark.range(0, 300).selectExpr(
        "id", "id % 7 AS seven", "CAST(IF(id % 2 = 0, -0.0, 0.0) AS DOUBLE) AS zero", "IF(id < 250, NULL, id) AS some",
        "DATE '2020-01-01' AS day", "CAST(id % 3 AS DECIMAL(10,2)) AS d", "CAST(id % 5 AS STRING) AS s", "id % 2 = 0 AS even", "id % 11 AS m")
    got = {r.column_name: tuple(r)[1:] for r in frequency_extremes(df).collect()}
    whole = {r.column_names: (r.most_freq_value, r.most_freq_value_count, r.least_freq_value, r.least_freq_value_count)
             for r in profile(df).collect()}
    assert got == whole
    lean = {r.column_names: (r.most_freq_value, r.most_freq_value_count, r.least_freq_value, r.least_freq_value_count)
            for r in profile(df, frequencies_mode="extremes").collect()}
    assert lean == whole


def test_a_unique_column_shuffles_few_values(spark):
    df = spark.range(0, 100_000).selectExpr("CAST(id AS STRING) AS v")
    left = contenders(df, [F.col("v")], bits=20)
    # 2 * 100,000 ** 2 / 2 ** 20 / 2 values are expected to share a bucket
    assert left.count() < 12_000
    assert least_frequent(df, F.col("v"), 10_000, 2) == ("0", 1)
    assert tuple(frequency_extremes(df).first())[1:] == ("0", 1, "0", 1)


def test_a_favourite_leaves_only_its_bucket(spark):
    df = spark.range(0, 50_000).selectExpr("IF(id % 3 = 0, 'top', CAST(id AS STRING)) AS v")
    # far more values than buckets: 33,000 in 64
    left = contenders(df, [F.col("v")], bits=6).groupBy("v").count().collect()
    assert len(left) < 1500 and {r.v: r["count"] for r in left}["top"] == 16_667


def test_complex_columns_are_refused(spark):
    with pytest.raises(TypeError, match="complex"):
        frequency_extremes(spark.range(1).selectExpr("array(id) AS a"))


def test_a_walk_reads_the_table_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(0, 600, 1, 3).selectExpr("CAST(id DIV 2 AS STRING) AS v").mapInArrow(counted, "v string")
    assert least_frequent(df, F.col("v"), 50, 2) == ("0", 2)
    assert read.value == 3 * 600  # two walks without a single value, and the count
