"""Factor models: rows, stripes and what stays on disk."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.operators import factors, recommend, towers
from reviewloom.plans import work_queries
from reviewloom.session import CLEANED, shared_dir, written


def stored(spark):
    """Shuffle files that executors of a local session hold."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {x for x in files.mkString("\n").split("\n") if "shuffle_" in x}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = stored(spark)
    pairs = spark.range(2_000).select((F.col("id") % 7).alias("k"), "id").repartition(5, "id").groupBy("k").agg(F.sum("id").alias("n"))
    made = written(pairs, "sums")
    assert stored(spark) <= before
    assert made.count() == 7 and pairs.count() == 7
    assert spark.conf.get(CLEANED) == "false"


def test_factors_do_not_depend_on_pieces_and_lessen_the_loss(spark, monkeypatch):
    """Rows and stripes of few ids, an id with more samples than a row, against one row and stripe; and no blocks meet in pairs."""
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(60, 3)), rng.normal(size=(40, 3))
    rows = [(int(u), int(i), float(users[u] @ items[i] > 0)) for u, i in zip(rng.integers(60, size=1500), rng.integers(40, size=1500))]
    rows += [(7, int(i), float(users[7] @ items[i] > 0)) for i in rng.integers(40, size=300)]
    samples = spark.createDataFrame(rows, "user_idx bigint, item_idx bigint, label double")

    def fitted(iterations):
        model = recommend.fit_factors(samples, rank=4, iterations=iterations)
        tables = [{r["id"]: np.array(r["features"]) for r in t.collect()} for t in (model.userFactors, model.itemFactors)]
        u, i = tables
        assert u.keys() == {r[0] for r in rows} and i.keys() == {r[1] for r in rows}
        return model, tables, sum((y - u[a] @ i[b]) ** 2 + 0.1 * (u[a] @ u[a] + i[b] @ i[b]) for a, b, y in rows)

    model, whole, loss = fitted(3)
    assert loss < fitted(1)[2] < sum(y for _, _, y in rows)
    # The users' factors solve their equations: the gradient of each is nothing.
    u, i = whole
    for own in (7, 20):
        mine = [(b, y) for a, b, y in rows if a == own]
        gradient = sum((u[own] @ i[b] - y) * i[b] + 0.1 * u[own] for b, y in mine)
        assert np.abs(gradient).max() < 1e-3
    assert model.transform(samples.selectExpr("cast(user_idx AS int) AS user_idx", "cast(item_idx AS int) AS item_idx")).count() == len(rows)
    monkeypatch.setattr(factors, "CHUNK", 64)
    monkeypatch.setattr(factors, "STRIPE_BYTES", 16 * 4 * 4)
    layout = factors.laid_out(factors.checked(samples, "user_idx", "item_idx", "label"), 3, 4)
    assert layout.filter("key = 7").count() > 1 and layout.select("stripe").distinct().count() == 4
    _, pieces, again = fitted(3)
    assert again == pytest.approx(loss)
    assert all(np.allclose(one[k], other[k], atol=1e-4) for one, other in zip(whole, pieces) for k in one)


def test_samples_without_id_or_label_are_refused(spark):
    kind = "user_idx bigint, item_idx bigint, label double"
    for row in ((None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan"))):
        with pytest.raises(Exception, match="must be a number"):
            recommend.fit_factors(spark.createDataFrame([(2, 2, 1.0), row], kind), rank=2, iterations=1)
    with pytest.raises(ValueError, match="no samples"):
        recommend.fit_factors(spark.createDataFrame([], kind), rank=2, iterations=1)


def folders(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file:")))


def test_steps_and_fitted_samples_leave_nothing(spark):
    rng = np.random.default_rng(5)
    rows = [(f"u{u}", f"i{i}", float(y), float(x)) for u, i, y, x in zip(rng.integers(9, size=400), rng.integers(7, size=400), rng.integers(2, size=400), rng.normal(size=400))]
    samples = written(spark.createDataFrame(rows, "user_id string, item_id string, label double, signal double"), "given")
    samples.agg(F.count("*")).first()
    before, kept = stored(spark), folders(spark)
    towers.choose_decay(samples, ("signal",), steps=3)
    # The aggregations of moments and losses may leave theirs: one row a task.
    assert folders(spark) == kept
    slices = [x for x in stored(spark) - before if x.endswith(".data")]
    assert sum(os.path.getsize(x) for x in slices if os.path.exists(x)) < 100_000


def test_feature_factor_model_keeps_one_table(spark, monkeypatch):
    """What the rows are made from goes, and the reviews are read once."""
    asked = []
    rows = [(f"u{n * 7 % 40}", f"i{n * 11 % 90}", float(n % 5 + 1), n * 10 ** 9, n % 7, "only", "text " * (n % 4)) for n in range(600)]
    reviews = spark.createDataFrame(rows, "user_id string, parent_asin string, rating double, timestamp bigint, helpful_vote int, category string, text string")
    monkeypatch.setattr(work_queries.dt, "reviews", lambda session, sf: asked.append(sf) or reviews)
    monkeypatch.setattr(work_queries.dt, "metadata", lambda session, sf: spark.createDataFrame([("i1", 2.5)], "parent_asin string, price double"))
    monkeypatch.setattr(towers, "STEPS", 2)
    kept = folders(spark)
    row = work_queries.feature_factor_model(spark, "").first()
    assert row["rows"] == 600 and row["weights"] == 13 and len(asked) == 1
    assert [x.split("-")[0] for x in folders(spark) - kept] == ["rows"]
