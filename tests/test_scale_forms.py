"""Forms for large inputs: ranked labels, bucketed tables, and the entry without an optional package."""

from __future__ import annotations

import os
import random
import subprocess
import sys

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from orderlens.operators import rollup
from orderlens.plans import prepare
from orderlens.session import scratch_path
from orderlens.sources import tables


def test_ranks_equal_the_string_indexer(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["b", "a", "é", "", " ", "B", "10", "9"]) if i % 11 else None) for i in range(400)] + [(i, f"x{i % 90}") for i in range(400, 580)]
    df = spark.createDataFrame(rows, "k long, c string").repartition(6)
    ranks = prepare.label_ranks(df, "c")
    model = prepare.index_categories(["c"], ["i"]).fit(df.where("c is not null"))
    assert [r.label for r in ranks.orderBy("rank").collect()] == list(model.labelsArray[0])
    new = df.unionByName(spark.createDataFrame([(9999, "unseen")], "k long, c string"))
    ours = {r.k: r.i for r in prepare.index_by_rank(new, "c", "i", ranks).collect()}
    theirs = {r.k: r.i for r in model.transform(new).collect()}
    assert ours == theirs and len(ours) == 581


def test_many_labels_are_ranked_without_the_driver(spark):
    df = spark.range(0, 200_000, 1, 8).select((F.col("id") % 150_000).cast("string").alias("c"))
    ranks = prepare.label_ranks(df, "c")
    assert ranks.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first() == (0, 149_999, 150_000)
    assert ranks.where("n = 2").agg(F.max("rank")).first()[0] == 49_999
    assert prepare.label_ranks(df.limit(0), "c").count() == 0


def test_bucketed_tables_shuffle_nothing(spark):
    rows = [(i % 50, i, f"p{i % 7}", float(i), 1.0) for i in range(600)]
    items = spark.createDataFrame(rows, "order_id long, order_item_id int, product_id string, price double, shipping_cost double")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        kept = tables.save_bucketed(items, scratch_path(spark, "bucketed"), buckets=4)
        joined = kept.join(rollup.order_money_rollup(kept), "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" in plan
        plain = items.join(rollup.order_money_rollup(items), "order_id")
        assert sorted(map(tuple, joined.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


@pytest.mark.parametrize("package", ["xxhash", "tokenizers", "public_tokenizers"])
def test_core_queries_stay_without_an_optional_package(package):
    code = f"import sys; sys.modules[{package!r}] = None\nimport __spark_entry__ as e\nq = e.queries()\nprint(len(q), 'pearson_screen' in q, any(k.startswith('op') for k in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True, check=True)
    n, core, llm = out.stdout.split()
    assert int(n) > 60 and core == "True" and llm == "False" or not os.path.isdir(f"{ROOT}/orderlens/llm")


def test_a_missing_core_module_is_an_error():
    code = "import sys; sys.modules['orderlens.session'] = None\nimport __spark_entry__"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True, check=False)
    assert out.returncode and "orderlens.session" in out.stderr
