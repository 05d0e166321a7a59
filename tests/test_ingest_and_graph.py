"""Ingest of new files with rejects, and jobs taken up again after an interruption."""

import json

import pytest
from pyspark.sql import functions as F

from reviewloom.plans.graph import JobGraph, Stage, StageFailed, files_of
from reviewloom.sources.ingest import ReviewIngest, read_reviews, sample_run
from reviewloom.store import FeatureStore, Source
from reviewloom.store.views import raw_views

GOOD = {"user_id": "u", "parent_asin": "i", "rating": 4.0, "timestamp": 1_704_067_200_000, "title": "t", "text": "x"}


def lines_to(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")


BAD = ["{broken", "[1]", '"text"', {**GOOD, "rating": 9}, {**GOOD, "rating": "four"}, {**GOOD, "user_id": ""}, {k: v for k, v in GOOD.items() if k != "user_id"},
       {**GOOD, "parent_asin": None}, {**GOOD, "timestamp": None}]


def test_good_and_bad_lines(spark, tmp_path):
    lines_to(tmp_path / "in" / "a.jsonl", [GOOD, "", "   ", *BAD, {**GOOD, "parent_asin": None, "asin": "old"}, {**GOOD, "more": 1}])
    found = read_reviews(spark, [str(tmp_path / "in" / "a.jsonl")])
    reasons = {r["reason"]: r["n"] for r in found.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert sum(reasons.values()) == 12 and reasons[None] == 3
    assert reasons["no user"] == 2 and reasons["no item"] == 1 and reasons["no time"] == 1 and reasons["no rating from 0 to 5"] >= 1


def test_each_run_takes_new_files_only(spark, tmp_path):
    lines_to(tmp_path / "in" / "a.jsonl", [{**GOOD, "user_id": f"u{i}"} for i in range(5)] + ["{bad"])
    ingest = ReviewIngest(spark, str(tmp_path / "out"))
    assert ingest.reviews() is None and ingest.rejects().count() == 0
    counts = {r["reason"]: r["lines"] for r in ingest.run(str(tmp_path / "in"), "Books").collect()}
    assert counts == {None: 5, "not a review object": 1}
    assert ingest.run(str(tmp_path / "in"), "Books").count() == 0 and ingest.reviews().count() == 5
    lines_to(tmp_path / "in" / "b.jsonl", [{**GOOD, "user_id": f"v{i}"} for i in range(4)])
    assert ingest.run(str(tmp_path / "in"), "Toys", per_category=3).count() == 1
    assert {(r["category"], r["n"]) for r in ingest.reviews().groupBy("category").agg(F.count("*").alias("n")).collect()} == {("Books", 5), ("Toys", 3)}
    bad = ingest.rejects().collect()
    assert [(r["line"], r["reason"], r["file"].endswith("a.jsonl")) for r in bad] == [("{bad", "not a review object", True)]
    assert sample_run(ingest, str(tmp_path / "in")).count() == 0


def test_a_run_that_lost_the_race_looks_again(spark, tmp_path, monkeypatch):
    lines_to(tmp_path / "in" / "a.jsonl", [GOOD])
    first, second = (ReviewIngest(spark, str(tmp_path / "out")) for _ in range(2))
    claim = second.log.claim

    def late(entry, after=None):
        monkeypatch.setattr(second.log, "claim", claim)
        first.run(str(tmp_path / "in"), "Books")
        return claim(entry, after)

    monkeypatch.setattr(second.log, "claim", late)
    assert second.run(str(tmp_path / "in"), "Books").count() == 0
    assert second.reviews().count() == 1


def graph_of(spark, tmp_path, calls, broken=()):
    def job(name, source, target):
        def run():
            calls.append(name)
            if name in broken:
                raise RuntimeError("lost")
            rows = spark.read.parquet(str(source))
            rows.withColumn(name, F.lit(1)).write.mode("overwrite").parquet(str(target))
            return {"rows": rows.count()}
        return run

    raw, a, b, c = (tmp_path / n for n in ("raw", "a", "b", "c"))
    return JobGraph(spark, str(tmp_path / "graph"), [
        Stage("last", job("last", a, c), needs=("left", "right"), outputs=(str(c),)),
        Stage("left", job("left", raw, a), inputs=(str(raw),), outputs=(str(a),)),
        Stage("right", job("right", raw, b), inputs=(str(raw),), outputs=(str(b),), parameters={"n": 1})])


def test_finished_stages_are_skipped_until_something_changes(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "raw"))
    calls = []
    with pytest.raises(StageFailed, match="right"):
        graph_of(spark, tmp_path, calls, broken=("right",)).run()
    assert sorted(calls) == ["left", "right"]
    calls.clear()
    done = graph_of(spark, tmp_path, calls).run()
    assert calls == ["right", "last"] and done["left"] == {"result": {"rows": 5}, "skipped": True} and not done["last"]["skipped"]
    calls.clear()
    assert all(s["skipped"] for s in graph_of(spark, tmp_path, calls).run().values()) and calls == []
    # More input: what reads it and what needs that runs again.
    spark.range(3).write.mode("append").parquet(str(tmp_path / "raw"))
    graph_of(spark, tmp_path, calls).run()
    assert sorted(calls) == ["last", "left", "right"]
    # A lost output is made again.
    calls.clear()
    spark.range(1).write.mode("overwrite").parquet(str(tmp_path / "b"))
    graph_of(spark, tmp_path, calls).run()
    assert calls == ["right", "last"]
    with pytest.raises(ValueError, match="need each other"):
        JobGraph(spark, str(tmp_path / "g"), [Stage("x", dict, needs=("y",)), Stage("y", dict, needs=("x",))])
    assert files_of(spark, str(tmp_path / "nowhere")) == []


def test_views_of_one_source_are_made_from_one_scan(spark, tmp_path, monkeypatch):
    rows = [(f"u{i % 3}", f"i{i % 4}", float(i % 5 + 1), "t", "x" * i, 1_704_067_200_000 + i, i, "c") for i in range(30)]
    spark.createDataFrame(rows, "user_id string, parent_asin string, rating double, title string, text string, timestamp bigint, helpful_vote int, category string") \
         .write.parquet(str(tmp_path / "raw"))
    loads = []

    def load(session):
        loads.append(1)
        return session.read.parquet(str(tmp_path / "raw"))

    store = FeatureStore(spark, str(tmp_path / "store"), buckets=2)
    store.apply(raw_views(Source("raw", loader=load, millis_field="timestamp")))
    loads.clear()
    seen = {}
    latest = FeatureStore.latest
    monkeypatch.setattr(FeatureStore, "latest", lambda self, view, raw, *a, **k: seen.setdefault(view.name, latest(self, view, raw, *a, **k)))
    from datetime import datetime
    assert store.materialize(datetime(2023, 1, 1), datetime(2025, 1, 1)) == {"user_features": 3, "item_features": 4}
    assert len(loads) == 1
    for rows in seen.values():
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and "text#" not in plan
