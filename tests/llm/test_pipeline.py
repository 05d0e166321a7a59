"""Every stage against a plain version of it, on small tables written for it."""

import random

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reviewloom.llm import lines, mixing, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    items = [" ".join(make(14)) for _ in range(6)]
    docs = []
    for i in range(480):
        parts = [" ".join(make(rng.randrange(15, 50))) for _ in range(rng.randrange(1, 4))]
        if i % 6 == 0:
            parts[0] = "stupid " + parts[0] + " moron scum stupid moron"
        if i % 9 == 1:
            parts.append(rng.choice(items))
        if i % 10 == 3:
            parts.append("the same closing line for all of these documents here")
        docs.append([i, "\n".join(parts), "en", f"s{i % 4}"])
    for i in range(480, 540):  # near copies, in one line so that they are not removed as lines
        base = docs[(i - 480) * 3 + 1][1].replace("\n", " ").split()
        base[rng.randrange(len(base))] = "changed"
        docs.append([i, " ".join(base), "en", "s1"])
    docs += [[600, None, "en", None], [601, "", "en", "s2"], [602, "word", None, "s2"]]
    rows = [(*d, len(d[1] or "")) for d in docs]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d[0], 1, int(d[0] % 6 == 0 and d[0] < 480)) for d in docs], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, monkeypatch):
    monkeypatch.setattr(toxicity, "UPDATES", 300)
    extra = {c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in ("Score", "predicted", "n_removed", "n_words", "items", "key", "node", "size")}
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns(extra)
    columns, before = docs.columns, {r["doc_id"]: r.asDict() for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        seen[name] = (before, {r["doc_id"]: r.asDict() for r in out.collect()})
        if name != "mixing":
            assert out.columns == columns
            assert all(row[c] == f"{c}{i}" for i, row in seen[name][1].items() for c in extra)
            docs, before = spark.createDataFrame(out.collect(), out.schema), seen[name][1]

    given, kept = seen["toxicity"]
    gone = set(given) - set(kept)
    toxic = {i for i in given if i < 480 and i % 6 == 0}
    assert len(gone & toxic) > 0.75 * len(toxic) and len(gone - toxic) < 0.05 * len(given)

    given, kept = seen["line_dedup"]
    assert set(kept) == set(given)
    frame = spark.createDataFrame([(i, r["text"]) for i, r in given.items()], "doc_id long, text string")
    repeated = {tuple(r) for r in lines.duplicate_lines(frame).collect()}
    assert any("closing line" in given[i]["text"].split("\n")[n] for i, n in repeated)
    for i, row in kept.items():
        text = given[i]["text"]
        want = None if text is None else "\n".join(t for n, t in enumerate(text.split("\n")) if (i, n) not in repeated)
        assert row["text"] == want and row["n_chars"] == len(want or "")

    given, kept = seen["near_dedup"]
    judged = brute.near_duplicates({i: r["text"] for i, r in given.items()}, 5, 80)
    assert set(kept) == {i for i, (_, _, stays) in judged.items() if stays} and len(kept) < len(given)

    given, kept = seen["decontamination"]
    windows = {tuple(w[s:s + 10]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()
               for w in [brute.normal_words(r["text"])] for s in range(len(w) - 9)}
    leaks = {i for i, r in given.items() for w in [brute.normal_words(r["text"])] if any(tuple(w[s:s + 10]) in windows for s in range(len(w) - 9))}
    assert set(kept) == set(given) - leaks and leaks

    given, kept = seen["mixing"]
    assert set(kept) == set(given)
    assert all(r["taken"] == r["copies"] * r["size"] <= mixing.MOST * r["size"] for r in kept.values())


def test_run_writes_every_stage(spark, folder, monkeypatch):
    monkeypatch.setattr(toxicity, "UPDATES", 20)
    rows = corpus_pipeline.run(spark, folder)
    assert rows.columns == ["doc_id", "source", "size", "source_size", "target", "copies", "taken"] and rows.count() > 0
