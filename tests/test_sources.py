import json

import pytest
from pyspark.sql import functions as F

from reviewloom.operators.encode import hashing_encoder
from reviewloom.plans import jobs
from reviewloom.plans.cli import main, parser
from reviewloom.sources import readers, writers
from reviewloom.store import FeatureStore
from reviewloom.store.views import stored_views

RAW = "user_id string, asin string, rating double, title string, text string, timestamp bigint, helpful_vote int"


def raw_rows(n=40):
    return [(f"u{i % 5}", f"i{i % 7}", float(1 + i % 5), f"title {i % 3}", f"<p>review {i} " + "word " * (10 + i), 1_700_000_000_000 + i * 86_400_000, i % 4)
            for i in range(n)]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "reviews")
    spark.createDataFrame(raw_rows(), RAW).repartition(3).write.parquet(path)
    return path


def test_path_lists():
    assert readers.split_paths(" a , ,b,") == ["a", "b"]
    assert readers.split_paths(["x", " "]) == ["x"]
    with pytest.raises(ValueError):
        readers.split_paths(" , ")


def test_head_over_several_files(spark, tmp_path):
    for name, low in (("part-b", 100), ("part-a", 0), ("part-c", 200)):
        spark.range(low, low + 10).coalesce(1).write.parquet(str(tmp_path / "m" / name))
    paths = [str(tmp_path / "m" / n) for n in ("part-c", "part-a", "part-b")]
    for cap, want in ((15, [*range(10), *range(100, 105)]), (10, [*range(10)]), (99, [*range(10), *range(100, 110), *range(200, 210)])):
        got = readers.first_rows_by_file(spark, paths, cap)
        assert got.columns == ["id"] and sorted(r.id for r in got.collect()) == want


def test_rows_per_part_and_counts(spark, tmp_path):
    out = str(tmp_path / "parts")
    assert writers.write_dataset(spark.range(0, 25, 1, 1), out, rows_per_part=10) == 25
    sizes = spark.read.parquet(out).groupBy(F.input_file_name()).count()
    assert sorted(r["count"] for r in sizes.collect()) == [5, 10, 10]


def test_rerun_replaces_only_its_categories(spark, tmp_path):
    out = str(tmp_path / "cat")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, category string")
    writers.write_by_category(df, out)
    writers.write_by_category(df.filter("category = 'a'").withColumn("v", F.lit(9)), out)
    assert {(r.v, r.category) for r in spark.read.parquet(out).collect()} == {(9, "a"), (2, "b")}


def test_jsonl_with_declared_schema(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text(json.dumps({"user_id": "u", "asin": "a", "rating": 4, "extra": 1}) + "\n\n")
    df = readers.read_jsonl(spark, str(tmp_path / "r.jsonl"), category="Books")
    row = df.first()
    assert (row.user_id, row.asin, row.rating, row.text, row.category) == ("u", "a", 4.0, None, "Books") and df.count() == 1


def test_embedding_validation(spark):
    schema = "review_id string, item_id string, user_id string, rating double, embed_text string, embedding array<float>, event_timestamp timestamp"
    good = spark.createDataFrame([("r", "i", "u", 1.0, "t", [1.0, 2.0], None)], schema)
    assert readers.validate_embeddings(good, 2) is good
    with pytest.raises(ValueError, match="bad vectors"):
        readers.validate_embeddings(good, 3)
    with pytest.raises(ValueError, match="bad vectors"):
        readers.validate_embeddings(good.unionByName(good.withColumn("embedding", F.lit(None).cast("array<float>"))), 2)
    with pytest.raises(ValueError, match="missing"):
        readers.embedding_report(good.drop("user_id"), 2)


def test_vector_row_defaults(spark):
    schema = "review_id bigint, item_id string, user_id string, rating float, review_title string, embed_text string, embedding array<float>"
    df = spark.createDataFrame([(7, None, None, None, None, None, None), (8, "i" * 600, "u", 0.0, "t" * 600, "é" * 300, [1.0, 2.0]), (9, "i", "u", 4.5, "t", "x", [])], schema)
    got = {r.review_id: r for r in writers.vector_rows(df, 2).collect()}
    assert (got["7"].item_id, got["7"].rating, got["7"].embed_text, got["7"].embedding) == ("", "0", "", [0.0, 0.0])
    assert (len(got["8"].item_id), got["8"].rating, got["8"].embed_text, len(got["8"].review_title)) == (500, "0", "é" * 254, 500)
    assert (got["9"].rating, got["9"].embedding, len(got["9"].review_id_pk)) == ("4.5", [0.0, 0.0], 64)
    small = {r.review_id: r for r in writers.compact_vector_rows(df).collect()}
    assert small["7"].rating == 0.0 and small["7"].embed_text == ""
    cut = writers.precomputed_vector_rows(df).filter("review_id = '8'").first()
    assert len(cut.review_title) == 511


def test_vector_table_is_created_once(spark, tmp_path):
    path = str(tmp_path / "vt")
    assert writers.ensure_vector_table(spark, "vt_once", path) is True
    assert writers.ensure_vector_table(spark, "vt_once", path) is False
    assert spark.table("vt_once").columns == list(writers.VECTOR_COLUMNS)


def test_partition_feed(spark, tmp_path):
    folder = str(tmp_path)

    def open_writer():
        import uuid
        return lambda rows: open(f"{folder}/{uuid.uuid4().hex}", "w").write("\n".join(str(r.id) for r in rows))

    writers.send_partitions(spark.range(30), ["id"], open_writer, partitions=4)
    lines = [line for f in tmp_path.iterdir() for line in f.read_text().split()]
    assert sorted(map(int, lines)) == list(range(30)) and len(list(tmp_path.iterdir())) == 4


def test_feature_job_and_report(spark, raw, tmp_path):
    meta, out, table = (str(tmp_path / n) for n in ("meta", "out", "runs"))
    spark.createDataFrame([(f"i{i}", "9.5", 4.0, 10) for i in range(3)], "parent_asin string, price string, average_rating double, rating_number int").write.parquet(meta)
    bundle = jobs.feature_job(spark, f"{raw}, ", out, meta, report_table=table)
    assert (bundle["metrics"]["total_reviews"], bundle["metrics"]["unique_users"], bundle["metrics"]["unique_items"]) == (40, 5, 7)
    pairs, users, items = readers.read_feature_tables(spark, out)
    assert (pairs.count(), users.count(), items.filter("item_price = 9.5").count()) == (40, 5, 3)
    jobs.feature_job(spark, raw, out, report_table=table)   # overwrites the outputs, appends to the report
    assert spark.read.parquet(f"{out}/interactions").count() == 40 and spark.read.parquet(table).count() == 2


def test_text_job_splits(spark, raw, tmp_path):
    out = str(tmp_path / "text")
    bundle = jobs.text_job(spark, raw, out)
    m = bundle["metrics"]
    assert m["total_input_reviews"] == 40 and m["clean_reviews"] == 40
    lines = [json.loads(r.value) for name in ("train", "val", "test") for r in spark.read.text(f"{out}/{name}").collect()]
    assert len(lines) == m["total_examples"] and all(set(e) == {"instruction", "input", "output", "metadata"} for e in lines)
    assert not any("<p>" in e["input"] for e in lines)
    assert readers.read_training_split(spark, out, "train").count() <= m["train_examples"]
    assert readers.read_training_split(spark, out, "train", max_files=None).count() == m["train_examples"]
    capped = jobs.text_job(spark, raw, str(tmp_path / "capped"), max_examples=10)["metrics"]
    assert capped["clean_reviews"] == 10


def test_single_jsonl_split(spark, tmp_path):
    (tmp_path / "val.jsonl").write_text('{"instruction":"a","input":"b","output":""}\n')
    assert readers.read_training_split(spark, str(tmp_path), "val").first().input == "b"


def test_embedding_and_vector_jobs(spark, raw, tmp_path):
    out = str(tmp_path / "emb")
    assert jobs.embedding_job(spark, raw, out, max_reviews=15, encoder=hashing_encoder(8))["metrics"]["total_embeddings"] == 15
    assert readers.validate_embeddings(spark.read.parquet(out), 8).count() == 15
    copy, place = str(tmp_path / "copy"), str(tmp_path / "table")
    done = jobs.vector_table_job(spark, raw, "job_vectors", place, parquet_output=copy, dim=8, max_reviews=None)
    assert done["metrics"]["total_embeddings"] == 40 == spark.table("job_vectors").count() == spark.read.parquet(copy).count()
    moved = writers.rekeyed_vectors(spark.table("job_vectors"), max_rows=11)
    assert moved.count() == 11 and moved.schema["rating"].dataType.simpleString() == "double"
    surrogate = jobs.review_vectors(spark.read.parquet(raw), encoder=hashing_encoder(8), stable_ids=False)
    assert surrogate.select("review_id").distinct().count() == 40


def test_preprocess_job(spark, tmp_path):
    rows = spark.createDataFrame(raw_rows(6), RAW)
    for name in ("Books", "Toys"):
        rows.write.parquet(str(tmp_path / "raw" / name))
    out = str(tmp_path / "processed")
    for _ in range(2):   # a rerun does not duplicate
        assert jobs.preprocess_job(spark, str(tmp_path / "raw"), out, ["Books", "Toys"])["metrics"]["written_rows"] == 12
    df = spark.read.parquet(out)
    assert df.count() == 12 and {"item_id", "event_timestamp", "category"} <= set(df.columns)


def test_training_set_job(spark, raw, tmp_path):
    base = str(tmp_path / "base")
    jobs.feature_job(spark, raw, base)
    jobs.embedding_job(spark, raw, f"{base}/review_embeddings", encoder=hashing_encoder(8))
    dry = jobs.training_set_job(spark, base, f"{base}/none", dry_run=True)
    assert dry["metrics"]["training_rows"] == 40
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{base}/none")
    jobs.training_set_job(spark, base, f"{base}/training", embeddings=f"{base}/review_embeddings")
    df = spark.read.parquet(f"{base}/training")
    assert df.count() == 40 and df.filter("user_avg_rating is null").count() == 0
    assert df.filter("size(item_embedding_avg) = 8").count() == 40
    # A user's features exist from the last review on, so exactly each user's last review finds them.
    assert df.filter("user_review_count > 0").count() == 5
    store = FeatureStore(spark, f"{base}/store")
    store.apply(stored_views(base))
    assert jobs.training_set(store, spark.read.parquet(f"{base}/interactions"), max_interactions=9).count() == 9


def test_run_all(spark, raw, tmp_path):
    done = jobs.run_all(spark, raw, str(tmp_path / "all"), encoder=hashing_encoder(8))
    assert done["materialize"] == {"user_features": 5, "item_features": 7}
    assert done["training_set"]["metrics"]["training_rows"] == 40


def test_command_line(spark, raw, tmp_path):
    args = parser().parse_args(["text", "--input", "a", "--output", "b", "--max-examples", "3"])
    assert (args.job, args.max_examples, args.train_ratio) == ("text", 3, 0.9)
    done = main(["features", "--input", raw, "--output", str(tmp_path / "cli")])
    assert done["status"] == "FINISHED" and done["metrics"]["unique_items"] == 7


def test_no_default_cap_on_files_folders_or_reviews(spark, raw, tmp_path):
    folder = str(tmp_path / "split")
    spark.range(44).selectExpr("'i' AS instruction", "cast(id AS string) AS input", "'o' AS output").repartition(11).write.json(f"{folder}/train")
    assert readers.read_training_split(spark, folder, "train").count() == 44
    base = str(tmp_path / "categories")
    for name in ("A", "B C", "D", "E"):
        spark.read.parquet(raw).write.parquet(f"{base}/{name}")
    assert readers.category_folders(spark, base) == ["A", "B C", "D", "E"]
    jobs.preprocess_job(spark, base, str(tmp_path / "processed"))
    assert spark.read.parquet(str(tmp_path / "processed")).groupBy("category").count().count() == 4
