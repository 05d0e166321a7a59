"""Bucketed tables that grow by the size of a change, and the commit log behind them.

A table is a folder of data folders, each partitioned by ``bucket``, and a log with one
small file per version.  A writer first writes its data under a fresh name, then its log
entry under a passing name, and then gives the entry the next version's name, which must
not exist yet: of two writers one gets the number and the other takes the next.  An
entry is whole as soon as it can be seen.  Nothing is ever rewritten in place, so
buckets that a change does not touch keep their files.

Local folders (hard links) and Hadoop file systems (renames that do not overwrite) do
this atomically; an object store must offer the same for this log.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.sources.writers import key_bucket, write_keyed


class VersionTaken(RuntimeError):
    """Another writer committed since the caller read the log."""


@dataclass(frozen=True)
class Commit:
    """One version: rows by bucket in ``path``, and which older versions they replace in those buckets."""

    version: int
    path: str | None
    buckets: int
    filled: frozenset[int]
    rows: int
    folds: frozenset[int] = frozenset()
    whole: bool = False  # replaces the folded versions in all buckets, not in the filled ones alone
    order: int = 0       # what its rows count as in time, which for compacted rows is the newest folded version
    info: dict = field(default_factory=dict)


class CommitLog:
    """Numbered files below ``path``; creating one is the commit."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str = ""):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self._conf), path

    def numbers(self) -> list[int]:
        """All versions."""
        fs, folder = self._at()
        if not fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(folder))
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def read(self) -> dict[int, dict]:
        """Entries by version."""
        found = {}
        for version in self.numbers():
            fs, path = self._at(f"v{version:09d}.json")
            stream = fs.open(path)
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            found[version] = json.loads(text)
        return found

    def claim(self, entry: dict, after: int | None = None) -> int:
        """Write ``entry`` as the next version; with ``after``, only as the one behind that version."""
        while True:
            last = max(self.numbers(), default=0)
            if after is not None and last != after:
                raise VersionTaken(f"{self.path}: version {last} was committed after {after}")
            if self._create(f"v{last + 1:09d}.json", json.dumps(entry)):
                return last + 1

    def _create(self, name: str, text: str) -> bool:
        """A file with ``text`` under a name that must not exist; False if another writer was first."""
        fs, passing = self._at(f"_new-{uuid.uuid4().hex}")
        _, path = self._at(name)
        stream = fs.create(passing)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if fs.getUri().getScheme() != "file":
                return fs.rename(passing, path)
            new, old = (self._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (path, passing))
            self._jvm.java.nio.file.Files.createLink(new, old)
            return True
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            fs.delete(passing, False)


class BucketTable:
    """Rows by key in hash buckets; ``combine`` reduces the rows of several versions, marked by ``_order``, to the table's."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int, combine: Callable[[DataFrame], DataFrame],
                 max_parts: int = 8) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.combine, self.max_parts = combine, max_parts
        self.log = CommitLog(spark, f"{self.path}/log")

    # Log

    def commits(self) -> list[Commit]:
        return [Commit(version=v, path=e["path"], buckets=e["buckets"], filled=frozenset(e["filled"]), rows=e["rows"],
                       folds=frozenset(e["folds"]), whole=e["whole"], order=e["order"] or v, info=e["info"])
                for v, e in sorted(self.log.read().items())]

    def live(self, commits: list[Commit] | None = None) -> list[tuple[Commit, frozenset[int]]]:
        """Versions with the buckets in which nothing has replaced them."""
        commits = self.commits() if commits is None else commits
        out = []
        for c in commits:
            kept = set(c.filled)
            for later in commits:
                if c.version in later.folds:
                    kept -= kept if later.whole else later.filled
            if kept:
                out.append((c, frozenset(kept)))
        return out

    # Reading

    def _wanted(self, of: dict[int, list[int]] | None, commits: list[Commit] | None) -> list[tuple[Commit, frozenset[int]]]:
        wanted = []
        for commit, kept in self.live(commits):
            kept = kept if of is None else kept & set(of.get(commit.buckets, range(commit.buckets)))
            if kept:
                wanted.append((commit, kept))
        return wanted

    def stored(self, of: dict[int, list[int]] | None = None, commits: list[Commit] | None = None) -> DataFrame | None:
        """Rows as they lie in the versions, several of a key among them; None if empty."""
        wanted = self._wanted(of, commits)
        return _union([self._part(c, kept).drop("_order") for c, kept in wanted]) if wanted else None

    def rows(self, of: dict[int, list[int]] | None = None, commits: list[Commit] | None = None,
             chosen: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame | None:
        """The table's rows, or those of some buckets (numbers by bucket count, as tables may be rebuilt with another); None if empty.

        ``chosen`` keeps all or none of a key's stored rows and is applied before several versions are combined.
        """
        wanted = self._wanted(of, commits)
        if not wanted:
            return None
        counts = {c.buckets for c, _ in wanted}
        # With one count of buckets, those that lie in one version alone have nothing to combine.
        single = {b for b in set().union(*(k for _, k in wanted)) if len(counts) == 1 and sum(b in k for _, k in wanted) == 1}
        keep = chosen or (lambda rows: rows)
        alone = [self._part(c, kept & single).drop("_order") for c, kept in wanted if kept & single]
        alone = [keep(_union([a.select(*alone[0].columns) for a in alone]))] if alone else []
        several = [self._part(c, kept - single) for c, kept in wanted if kept - single]
        if several:
            alone.append(self.combine(keep(_union(several))))
        return _union([a.select(*alone[0].columns) for a in alone])

    def _part(self, commit: Commit, kept: Iterable[int]) -> DataFrame:
        rows = self.spark.read.parquet(commit.path)
        return rows.filter(F.col("bucket").isin(sorted(kept))).drop("bucket").withColumn("_order", F.lit(commit.order))

    def bucket_counts(self) -> set[int]:
        return {c.buckets for c, _ in self.live()}

    def lookup(self, asked: DataFrame) -> DataFrame | None:
        """Rows of the buckets that the keys in ``asked`` (a bounded frame) lie in."""
        commits = self.commits()
        counts = {c.buckets for c, _ in self.live(commits)}
        of = {n: [r[0] for r in asked.select(key_bucket(self.keys, n).alias("b")).distinct().collect()] for n in counts}
        return self.rows(of, commits)

    # Writing

    def append(self, rows: DataFrame, info: dict, after: int | None = None) -> Commit:
        """Add ``rows`` as one version; with ``after``, only if nothing was committed since that version."""
        buckets = next((c.buckets for c in reversed(self.commits())), self.buckets)
        path, count, filled = self._written(rows, buckets)
        return self._committed(path, buckets, filled, count, frozenset(), False, 0, info, after)

    def replace(self, rows: DataFrame, info: dict) -> Commit:
        """``rows`` instead of every version seen now."""
        folds = frozenset(c.version for c in self.commits())
        path, count, filled = self._written(rows, self.buckets)
        return self._committed(path, self.buckets, filled, count, folds, True, 0, info, None)

    def compact(self, max_parts: int | None = None) -> Commit | None:
        """Rewrite the buckets that lie in more than ``max_parts`` versions; the others keep their files."""
        most = self.max_parts if max_parts is None else max_parts
        commits = self.commits()
        live = self.live(commits)
        if not live:
            return None
        buckets = live[-1][0].buckets
        live = [(c, kept) for c, kept in live if c.buckets == buckets]
        full = sorted(b for b in range(buckets) if sum(b in kept for _, kept in live) > most)
        if not full:
            return None
        parts = [(c, kept & set(full)) for c, kept in live if kept & set(full)]
        rows = self.combine(_union([self._part(c, kept) for c, kept in parts]))
        path, count, filled = self._written(rows, buckets)
        newest = max(c.order for c, _ in parts)
        return self._committed(path, buckets, frozenset(full) | filled, count, frozenset(c.version for c, _ in parts), False, newest,
                               {"compacted": True}, None)

    def _written(self, rows: DataFrame, buckets: int) -> tuple[str | None, int, frozenset[int]]:
        path = f"{self.path}/data/{uuid.uuid4().hex}"
        count = write_keyed(rows, self.keys, path, buckets)
        fs, folder = CommitLog(self.spark, path)._at()
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if count else []
        filled = frozenset(int(n.split("=")[1]) for n in names if n.startswith("bucket="))
        return (path if count else None), count, filled

    def _committed(self, path: str | None, buckets: int, filled: frozenset[int], count: int, folds: frozenset[int], whole: bool, order: int,
                   info: dict, after: int | None) -> Commit:
        entry = {"path": path, "buckets": buckets, "filled": sorted(filled), "rows": count, "folds": sorted(folds), "whole": whole,
                 "order": order, "info": info}
        version = self.log.claim(entry, after)
        return Commit(version, path, buckets, filled, count, folds, whole, order or version, info)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
