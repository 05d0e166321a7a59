"""Command line: ``python -m reviewloom <job> --input ... --output ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
from datetime import datetime

from reviewloom.plans import jobs
from reviewloom.session import build_session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="reviewloom")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, output: bool = True) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=text)
        p.add_argument("--input", required=True, help="input path, or a comma list of paths")
        if output:
            p.add_argument("--output", required=True)
        p.add_argument("--report-table", default=None)
        return p

    job("features", "user features, item features, interactions").add_argument("--metadata-input", default=None)
    text = job("text", "instruction examples as JSONL splits")
    text.add_argument("--max-examples", type=int, default=None)
    text.add_argument("--train-ratio", type=float, default=0.9)
    text.add_argument("--val-ratio", type=float, default=0.05)
    job("embeddings", "review embeddings to Parquet").add_argument("--max-reviews", type=int, default=None)
    vectors = job("vectors", "review embeddings to a vector table", output=False)
    vectors.add_argument("--table", default="review_embeddings")
    vectors.add_argument("--table-path", required=True)
    vectors.add_argument("--max-reviews", type=int, default=None)
    vectors.add_argument("--parquet-output", default=None)
    job("preprocess", "raw category folders to one dataset").add_argument("--categories", default=None, help="comma list; all folders below the input otherwise")
    training = job("training-set", "point-in-time training dataset (input: the feature job's output)")
    training.add_argument("--interactions", default=None)
    training.add_argument("--embeddings", default=None)
    training.add_argument("--include-embeddings", action="store_true")
    training.add_argument("--max-interactions", type=int, default=None)
    training.add_argument("--dry-run", action="store_true")
    ingest = job("ingest", "new review JSONL files to Parquet by category, bad lines apart")
    ingest.add_argument("--category", default=None)
    ingest.add_argument("--sample", action="store_true")
    index = job("index", "a stored vector index of an embedding table")
    index.add_argument("--id-column", default="review_id")
    index.add_argument("--append", action="store_true")
    everything = job("all", "all stages in order; taken up again after an interruption")
    everything.add_argument("--metadata-input", default=None)
    everything.add_argument("--start", type=datetime.fromisoformat, default=None)
    everything.add_argument("--end", type=datetime.fromisoformat, default=None)
    return top


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = build_session(f"reviewloom-{args.job}")
    table = args.report_table
    if args.job == "features":
        return jobs.feature_job(spark, args.input, args.output, args.metadata_input, report_table=table)
    if args.job == "text":
        return jobs.text_job(spark, args.input, args.output, args.max_examples, args.train_ratio, args.val_ratio, table)
    if args.job == "embeddings":
        return jobs.embedding_job(spark, args.input, args.output, args.max_reviews, report_table=table)
    if args.job == "vectors":
        return jobs.vector_table_job(spark, args.input, args.table, args.table_path, args.max_reviews,
                                     args.parquet_output, report_table=table)
    if args.job == "preprocess":
        return jobs.preprocess_job(spark, args.input, args.output, args.categories.split(",") if args.categories else None, table)
    if args.job == "training-set":
        embeddings = args.embeddings or f"{args.input.rstrip('/')}/review_embeddings"
        return jobs.training_set_job(spark, args.input, args.output, args.interactions,
                                     embeddings if args.include_embeddings else None, args.max_interactions,
                                     args.dry_run, table)
    if args.job == "ingest":
        return jobs.ingest_job(spark, args.input, args.output, args.category, args.sample)
    if args.job == "index":
        return jobs.index_job(spark, args.input, args.output, args.id_column, args.append)
    return jobs.run_all(spark, args.input, args.output, args.metadata_input, args.start, args.end)
