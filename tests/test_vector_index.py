"""The stored inverted-file index: folders per cluster, added batches, calibrated probes."""

import numpy as np
import pytest

from reviewloom.operators import topk
from reviewloom.operators.topk import top_k
from reviewloom.store import vector_index
from reviewloom.store.vector_index import VectorIndex


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], f"t{i}") for i, v in rows],
                                 "vector_id long, embedding array<float>, title string")


def clustered(n, dim=8, centres=6, seed=1, first=0):
    rng = np.random.default_rng(seed)
    middle = np.random.default_rng(99).normal(size=(centres, dim)) * 4
    return [(first + i, (middle[i % centres] + rng.normal(size=dim)).tolist()) for i in range(n)]


def asked_of(df, every=10):
    return df.filter(f"vector_id % {every} = 0").selectExpr("vector_id AS query_id", "embedding AS query_vec")


def pairs(df):
    return {(r.query_id, r.vector_id, r.rank) for r in df.collect()}


def test_build_append_and_exact_when_all_are_probed(spark, tmp_path):
    one, two = frame(spark, clustered(300)), frame(spark, clustered(100, seed=2, first=1000))
    index = VectorIndex(spark, str(tmp_path / "index"))
    built = index.build(one, n_list=6)
    before = {str(p) for p in tmp_path.rglob("*.parquet")}
    added = index.append(two)
    assert before < {str(p) for p in tmp_path.rglob("*.parquet")}
    assert (built.rows, added.rows, added.version, len(added.paths)) == (300, 400, built.version, 2)
    both = one.unionByName(two)
    assert pairs(index.search(asked_of(both), 4, nprobe=6)) == pairs(top_k(asked_of(both), both, 4))
    # Rows keep their columns; a new build takes the place of all batches.
    assert set(index.rows().columns) == {"vector_id", "embedding", "title", "cluster"}
    assert index.build(two, n_list=3).rows == 100 and index.rows().count() == 100


def test_a_search_reads_the_probed_clusters_only(spark, tmp_path):
    rows = frame(spark, clustered(400))
    index = VectorIndex(spark, str(tmp_path / "index"))
    index.build(rows, n_list=6)
    part = index.rows([2])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cluster" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {f.split("cluster=")[1].split("/")[0] for f in part.inputFiles()} <= {"2"} or part.select("cluster").distinct().count() == 1
    asked = asked_of(rows)
    assert index.probed(asked, 2).groupBy("query_id").count().filter("count <> 2").isEmpty()


def test_probes_are_settled_when_built(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    rows = frame(spark, [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 16)))])
    index = VectorIndex(spark, str(tmp_path / "index"))
    state = index.build(rows, n_list=12, k=5)
    assert 1 < state.nprobe <= 12 and state.recall >= 0.9
    asked = asked_of(rows, 20)
    assert index.measured(asked) >= 0.88
    exact, found = pairs(top_k(asked, rows, 5)), pairs(index.search(asked, 5))
    assert len({p[:2] for p in exact} & {p[:2] for p in found}) >= 0.88 * len(exact)
    # Centres may be learnt on a sample; every row is indexed all the same.
    monkeypatch.setattr(vector_index, "FIT_PER_LIST", 10)
    assert index.build(rows, n_list=12).rows == 600 and index.rows().count() == 600


def test_one_cluster_holds_most_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "ROWS_PER_FILE", 50)
    rows = frame(spark, [(i, [1.0, 1e-4 * i]) for i in range(300)] + [(1000 + i, [-1.0, float(i)]) for i in range(20)])
    index = VectorIndex(spark, str(tmp_path / "index"))
    index.build(rows, n_list=2)
    assert pairs(index.search(asked_of(rows, 50), 3, nprobe=2)) == pairs(top_k(asked_of(rows, 50), rows, 3))
    assert len(list((tmp_path / "index" / "data").rglob("*.parquet"))) > 4


def test_odd_vectors_take_no_part_and_few_rows(spark, tmp_path):
    odd = [(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 1.0])]
    index = VectorIndex(spark, str(tmp_path / "index"))
    with pytest.raises(KeyError):
        index.state()
    assert index.build(frame(spark, odd + [(6, [1.0, 0.0]), (7, [0.0, 2.0])]), n_list=8).rows == 2
    asked = spark.createDataFrame([(1, [3.0, 1.0]), (2, None), (3, [0.0, 0.0])], "query_id long, query_vec array<double>")
    assert {(r.query_id, r.vector_id) for r in index.search(asked, 5, nprobe=8).collect()} == {(1, 6), (1, 7)}
    assert index.build(frame(spark, [(1, [2.0, 1.0])])).rows == 1
    assert {(r.query_id, r.vector_id, round(r.score, 6)) for r in index.search(asked, 5).collect()} == {(1, 1, round(7 / 50 ** 0.5, 6))}


def test_a_large_cluster_is_searched_in_bounded_blocks(spark, monkeypatch):
    """A Python task holds one block several times over, so its size must not follow the cluster's."""
    asked = spark.createDataFrame([(1, [1.0, 0.0], 0)], "query_id bigint, query_vec array<double>, cluster int")
    rows = spark.range(40_000).selectExpr("id AS vector_id", "array(cos(id / 40000.0), sin(id / 40000.0)) AS embedding", "0 AS cluster")
    seen, search = [], topk._block_search
    monkeypatch.setattr(topk, "_block_search", lambda left, right, blocks, *rest: seen.append(blocks) or search(left, right, blocks, *rest))
    found = topk.cluster_top_k(asked, rows, 3)
    assert [r.vector_id for r in found.orderBy("rank").collect()] == [0, 1, 2]
    assert seen == [3]
