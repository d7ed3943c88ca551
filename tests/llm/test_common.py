"""The salted join, broadcast and dealt over tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterflow.llm.common import is_small, read, salted_join


@pytest.fixture(params=["10485760", "-1"])
def threshold(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield int(request.param)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_sides_are_broadcast_others_salted(spark, threshold, tmp_path):
    path = str(tmp_path / "right")
    spark.createDataFrame([("hot", 1), ("rare", 2), (None, 3)], "k string, v int").write.parquet(path)
    right = spark.read.parquet(path)
    left = spark.createDataFrame([(i, "hot" if i % 3 else ["rare", None, "none"][i // 3 % 3]) for i in range(300)], "id int, k string")
    assert is_small(right) == (threshold > 0)
    joined = salted_join(left, right, ["k"], F.col("id"))
    assert joined.columns == ["k", "id", "v"]
    known = {"hot": 1, "rare": 2}
    assert sorted((r.id, r.v) for r in joined.collect()) == sorted((r.id, known.get(r.k)) for r in left.collect())
    plan = joined._jdf.queryExecution().toString()
    assert ("_salt" in plan) == (threshold < 0)


def test_results_do_not_depend_on_the_side_sizes(spark, threshold):
    from .test_variants import SF_DIR, check

    docs = read(spark, SF_DIR, "documents")
    check(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
