"""Factors with features, and the two-phase partition writer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.operators import towers
from reviewloom.sources.partition_sink import JsonFolderSink, write_partitions


def interactions(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    users, items = rng.normal(size=(40, 2)), rng.normal(size=(30, 2))
    rows = []
    for _ in range(n):
        u, i, f = int(rng.integers(40)), int(rng.integers(30)), float(rng.normal())
        logit = 1.5 * f + 2 * float(users[u] @ items[i])
        rows.append((f"u{u}", f"i{i}", float(rng.random() < 1 / (1 + np.exp(-logit))), f * 100 + 7, None if rng.random() < 0.1 else 5.0))
    return spark.createDataFrame(rows, "user_id string, item_id string, label double, signal double, flat double")


def test_features_and_factors_beat_what_each_gives_alone(spark):
    rows = interactions(spark)
    held = F.pmod(F.xxhash64("user_id", "item_id", "signal"), F.lit(5)) == 0
    train, test = rows.filter(~held), rows.filter(held)
    decay = towers.choose_decay(train, ("signal", "flat"), steps=40)
    assert decay == 2.0
    both = towers.fit_towers(train, ("signal", "flat"), steps=60, decay=decay)
    plain = towers.fit_towers(train, ("signal", "flat"), factors=False, steps=60)
    ids = towers.fit_towers(train, (), steps=60, decay=decay)
    loss = {n: towers.log_loss(towers.score_towers(test, m)) for n, m in (("both", both), ("plain", plain), ("ids", ids))}
    p = train.agg(F.avg("label")).first()[0]
    mean = towers.log_loss(test.withColumn("score", F.lit(p)))
    assert loss["both"] < min(loss["plain"], loss["ids"]) < mean
    again = towers.fit_towers(train, ("signal", "flat"), steps=3), towers.fit_towers(train, ("signal", "flat"), steps=3)
    assert np.allclose(again[0].weights, again[1].weights) and np.allclose(again[0].table, again[1].table)


def test_models_fitted_together_read_the_samples_once_a_step(spark, monkeypatch):
    """Two models and their pulls come from the passes of one, with the parameters that each gets alone."""
    rows, passes = interactions(spark, 300), []
    plain = towers._gradients

    def counted(*args):
        passes.append(len(args[1]))
        return plain(*args)

    monkeypatch.setattr(towers, "_gradients", counted)
    fits = [towers.Fit(("signal", "flat"), decay=2.0), towers.Fit((), decay=50.0), towers.Fit(("flat",), factors=False)]
    together = towers.fit_several(rows, fits, steps=3)
    assert passes == [3, 3, 3]
    for fit, model in zip(fits, together):
        alone = towers.fit_towers(rows, fit.features, fit.factors, steps=3, decay=fit.decay)
        assert np.allclose(model.weights, alone.weights) and np.allclose(model.table, alone.table) and model.features == alone.features
    passes.clear()
    towers.choose_decay(rows, ("signal",), steps=2)
    assert passes == [3, 3]


def test_gradient_agrees_with_differences(spark):
    rows = interactions(spark, 40)
    model = towers.fit_towers(rows, ("signal",), steps=2)
    prepared = towers._prepared(rows, model.features, model.centre, model.scale, "label")
    got = {r["row"]: r["g"] for r in towers._gradient(prepared, model, True)}
    data = [(r["label"], r["_u"], r["_i"], r["_x"]) for r in prepared.collect()]
    y, u, i, x = (np.array(c) for c in zip(*data))

    def loss():
        z = model.logits(u, i, x)
        return float(np.sum(np.log1p(np.exp(z)) - y * z))

    for row, at in [(int(u[0]), 0), (int(u[1]), towers.DIM), (towers.TABLE_ROWS + int(i[0]), 3)]:
        model.table[row, at] += 1e-5
        high = loss()
        model.table[row, at] -= 2e-5
        low = loss()
        model.table[row, at] += 1e-5
        assert got[row][at] == pytest.approx((high - low) / 2e-5, abs=1e-5)
    assert got[2 * towers.TABLE_ROWS][0] == pytest.approx(float(np.sum((1 / (1 + np.exp(-model.logits(u, i, x))) - y) * x[:, 0])))


def test_no_rows_and_unknown_ids(spark):
    rows = interactions(spark, 20)
    model = towers.fit_towers(rows.limit(0), ("signal", "flat"))
    assert {r["score"] for r in towers.score_towers(rows, model).collect()} == {0.5}
    assert towers.score_towers(rows.limit(0), model).count() == 0
    odd = spark.createDataFrame([(None, "new", None, None, None)], rows.schema)
    assert 0 < towers.score_towers(odd, towers.fit_towers(rows, ("signal", "flat"), steps=1)).first()["score"] < 1


def test_a_failed_task_shows_nothing_and_a_rerun_writes_once(spark, tmp_path):
    rows = spark.range(200).withColumn("k", F.col("id") % 7)
    sink = JsonFolderSink(str(tmp_path / "store"), fail=(str(tmp_path / "marker"), 2))
    with pytest.raises(Exception, match="store went away"):
        write_partitions(rows, sink, ["id"], 4)
    assert sink.published(spark, "id long, k long").count() == 0
    write_partitions(rows, sink, ["id"], 4)
    assert {tuple(r) for r in sink.published(spark, "id long, k long").collect()} == {(i, i % 7) for i in range(200)}
    assert sink.published(spark, "id long, k long").count() == 200
    # Another write adds; publishing a run again changes nothing.
    run = write_partitions(rows.limit(5), sink, partitions=2)
    files = [p.name for p in (tmp_path / "store" / "staged").iterdir() if p.name.startswith(run)]
    sink.publish(run, [{"file": f, "rows": sum(1 for _ in open(tmp_path / "store" / "staged" / f))} for f in files])
    assert sink.published(spark, "id long, k long").count() == 205


def test_rows_of_equal_keys_meet_one_writer(spark, tmp_path):
    sink = JsonFolderSink(str(tmp_path / "store"))
    write_partitions(spark.range(100).withColumn("k", F.col("id") % 5), sink, ["k"], 3)
    owners = {}
    for path in (tmp_path / "store" / "staged").iterdir():
        for line in open(path):
            owners.setdefault(line.split('"k": ')[1].rstrip("}\n"), set()).add(path.name)
    assert len(owners) == 5 and all(len(v) == 1 for v in owners.values())
    write_partitions(spark.range(0).withColumn("k", F.col("id")), JsonFolderSink(str(tmp_path / "empty")), ["k"], 2)
