"""Dictionaries as JSON objects, run-time classification, distributed quantiles, the repeatable sample."""

import json
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesmart.functions.classify import classify_ordered, first_match
from salesmart.operators import profile as pf
from salesmart.schema import STORE_FORMAT_DEFAULT, STORE_FORMATS
from salesmart.sources import raw, sinks


def entries(df):
    return [(r.key, r.value) for r in df.orderBy("pos").collect()]


def test_an_object_keeps_its_order(spark, tmp_dir):
    content = {"zebra": "Z", "apple": "9999", 'quo"te': "a\nb", "none": None, "números": "ñ", "nested": {"a": [1, 2]}, "n": 12}
    path = f"{tmp_dir}/one.json"
    with open(path, "w") as f:
        json.dump(content, f, indent=4)
    read = entries(raw.read_dictionary(spark, path))
    assert read == [("zebra", "Z"), ("apple", "9999"), ('quo"te', "a\nb"), ("none", None), ("números", "ñ"),
                    ("nested", '{"a":[1,2]}'), ("n", "12")]
    sinks.write_dictionary(raw.read_dictionary(spark, path), f"{tmp_dir}/two.json")
    assert entries(raw.read_dictionary(spark, f"{tmp_dir}/two.json")) == read
    # any JSON reader takes the written file
    text = "\n".join(r.value for r in spark.read.text(f"{tmp_dir}/two.json", wholetext=True).collect())
    assert list(json.loads(text).items()) == read


def test_empty_and_wrong_dictionaries(spark, tmp_dir):
    sinks.write_dictionary(raw.lookup_df(spark, {}), f"{tmp_dir}/empty.json")
    assert entries(raw.read_dictionary(spark, f"{tmp_dir}/empty.json")) == []
    with open(f"{tmp_dir}/list.json", "w") as f:
        f.write("no object")
    with pytest.raises(PySparkException, match="no JSON object"):
        raw.read_dictionary(spark, f"{tmp_dir}/list.json").collect()
    large = spark.range(raw.MAX_DICTIONARY + 1).select(F.col("id").cast("int").alias("pos"), F.lit("k").alias("key"), F.lit("v").alias("value"))
    with pytest.raises(ValueError):
        raw.as_mapping(large)


def test_first_match_is_the_ordered_search(spark):
    names = ["HY-VEE FOOD STORE #1", "food and drug wine & spirits", "pharmacy", "GAS", "", None, "Grocery Store", "elsewhere"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    c = F.col("name")
    rows = df.select(c, first_match(c, dict(STORE_FORMATS), STORE_FORMAT_DEFAULT).alias("a"),
                     classify_ordered(c, STORE_FORMATS, None, STORE_FORMAT_DEFAULT).alias("b"),
                     first_match(c, [("food", "1"), ("food and", "2")], "none", keep_values=False).alias("first"),
                     first_match(c, {}, "none").alias("empty")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]
    assert [r.first for r in rows] == ["1", "1"] + ["none"] * 6
    assert {r.empty for r in rows} == {"none"}


@pytest.mark.parametrize("n, hot", [(1, 0), (2, 0), (5, 0), (1000, 0), (1000, 700), (997, 330)])
def test_quantiles_are_exact(spark, n, hot):
    rng = random.Random(n + hot)
    values = [None] * 3 + [7.0] * hot + [rng.randrange(-5_000, 5_000) / 4 for _ in range(n - hot)]
    rng.shuffle(values)
    df = spark.createDataFrame([(v, None, 1 if v is None else 2) for v in values], "v double, empty double, w int").repartition(5)
    probs = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = {(r.column_name, r.prob): r.value for r in pf.exact_quantiles(df, ["v", "empty", "w"], probs).collect()}
    own = [v for v in values if v is not None]
    want = {("v", p): np.quantile(own, p) for p in probs} | {("w", p): np.quantile([2] * len(own) + [1] * 3, p) for p in probs}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_no_task_holds_all_values(spark):
    """The described column's values lie in as many parts as there are shuffle partitions, and no plain percentile is left."""
    df = spark.range(4_000).select((F.col("id") * 3).alias("v"))
    described = pf.describe(df, ["v"])
    plan = described._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan
    r = described.first()
    assert (r["count"], float(r.p25), float(r.p50), float(r.p75)) == (4_000, 2999.25, 5998.5, 8997.75)


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).cast("string").alias("s"), F.lit(None).cast("int").alias("none"))
    one = pf.sample_n(df.repartition(1), 20).collect()
    assert one == pf.sample_n(df.repartition(9), 20).collect() and len(one) == 20
    assert one != pf.sample_n(df, 20, seed=7).collect()
    assert pf.sample_n(df.limit(5), 20).count() == 5 and pf.sample_n(df.limit(0), 20).count() == 0
