"""Historical features, materialisation and online lookup over registered views."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators.asof import HOT_ROWS, asof_join, profile_keys
from reviewloom.operators.dedup import latest_per_key
from reviewloom.operators.skew import join_unique, key_load
from reviewloom.session import discard
from reviewloom.session import written as stage
from reviewloom.store.buckets import BucketTable, Commit, VersionTaken
from reviewloom.store.registry import FeatureView, Registry

LOG_SCHEMA = "view string, version bigint, path string, start_us bigint, end_us bigint, rows bigint, buckets int"

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def within(df: DataFrame, time: str, start: datetime | None, end: datetime | None, millis: str | None = None) -> DataFrame:
    """Rows of the closed interval; with a raw millisecond column the bounds are plain numbers that push down."""
    if millis and millis in df.columns:
        low = None if start is None else -(-epoch_micros(start) // 1000)
        high = None if end is None else epoch_micros(end) // 1000
        column = F.col(millis)
    else:
        low, high = (None if t is None else _utc(t) for t in (start, end))
        column = F.col(time)
    if low is not None:
        df = df.filter(column >= F.lit(low))
    return df if high is None else df.filter(column <= F.lit(high))


def behind(df: DataFrame, time: str, start: datetime, end: datetime, millis: str | None = None) -> DataFrame:
    """Rows after ``start`` up to ``end``."""
    if millis and millis in df.columns:
        return within(df, time, start, end, millis).filter(F.col(millis) > F.lit(epoch_micros(start) // 1000))
    return within(df, time, start, end).filter(F.col(time) > F.lit(_utc(start)))


def alive(df: DataFrame, time: str, ttl: timedelta | None, as_of: datetime | Column) -> DataFrame:
    """Rows not older than the time-to-live at ``as_of``."""
    if ttl is None:
        return df
    now = as_of if isinstance(as_of, Column) else F.lit(_utc(as_of))
    return df.filter(F.unix_micros(F.col(time).cast("timestamp")) >= F.unix_micros(now) - F.lit(int(ttl / timedelta(microseconds=1))))


def _utc(moment: datetime) -> datetime:
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment


def epoch_micros(moment: datetime) -> int:
    return (_utc(moment) - EPOCH) // timedelta(microseconds=1)


def from_micros(micros: int) -> datetime:
    return EPOCH + timedelta(microseconds=micros)


class FeatureStore:
    """Registered views plus an online area of bucketed tables below ``path``.

    A full materialisation replaces a view's online rows; incremental ones add the rows
    of the keys they touched, in those keys' buckets.  A key's newest row counts, the
    later run's on equal times.  Runs may overlap: each takes a version of its own and
    none is lost.  Buckets that lie in more than ``max_parts`` versions are rewritten.
    """

    def __init__(self, spark: SparkSession, path: str, registry: Registry | None = None, buckets: int | None = None,
                 max_parts: int = 8) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.registry = registry or Registry()
        # One writer task per bucket; follows the cluster's shuffle parallelism unless set.
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.max_parts = max_parts

    def apply(self, views: Sequence[FeatureView]) -> DataFrame:
        """Validate and register views, and record them in the registry table."""
        table = self.registry.apply(self.spark, views)
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/registry")
        return table

    # Historical features

    def get_historical_features(self, entities: DataFrame, features: Sequence[str],
                                hot_rows: int | None = HOT_ROWS) -> DataFrame:
        """Point-in-time features of ``entities`` (keys and ``event_timestamp``) from several views."""
        result = entities
        for name, columns in self.registry.select(features).items():
            view = self.registry.view(name)
            if len(view.keys) != 1:
                raise ValueError("historical retrieval joins views with one key")
            rows = view.rows(self.spark)
            created = view.source.created_field if view.source.created_field in rows.columns else None
            key = view.keys[0]
            # Counted on the entities as given, not on the rows already joined to earlier views.
            profile = profile_keys(entities, rows, key, hot_rows) if hot_rows else None
            result = asof_join(result, rows, key, columns, feature_time=view.source.timestamp_field,
                               ttl=view.ttl, created=created, hot_rows=hot_rows, profile=profile)
        return result

    # Materialisation

    def latest(self, view: FeatureView, raw: DataFrame, as_of: datetime | Column, finished: bool = False) -> DataFrame:
        """Source rows, or rows that are already the view's, to one newest live row per key."""
        time = view.source.timestamp_field
        rows = alive(raw if finished else view.rows(self.spark, raw), time, view.ttl, as_of)
        created = view.source.created_field if view.source.created_field in rows.columns else None
        orderable = [n for n, t in view.schema if t.typeName() != "map"]
        return latest_per_key(rows, view.keys, time, created, ties=orderable).select(*view.keys, time, *view.features)

    def materialize(self, start: datetime, end: datetime, views: Sequence[str] | None = None,
                    as_of: datetime | None = None) -> dict[str, int]:
        """Write the newest live rows of [start, end] to the online tables; returns rows per view.

        Views that declare the same fold of one source are made from one scan of it.
        """
        written, chosen = {}, self._online(views)
        groups: dict[tuple[int, int], list[FeatureView]] = {}
        for view in chosen:
            if view.fold is not None and view.partial is None:
                groups.setdefault((id(view.source), id(view.fold)), []).append(view)
        for members in groups.values():
            if len(members) > 1:
                source = members[0].source
                raw = within(source.load(self.spark), source.timestamp_field, start, end, source.millis_field)
                folded = stage(members[0].fold(raw), "fold")
                for view in members:
                    rows = self.latest(view, view.of_folded(folded), as_of or F.current_timestamp(), finished=True)
                    written[view.name] = self.publish(view, rows, start, end, whole=True)
                discard(folded)
        for view in (v for v in chosen if v.name not in written):
            source = view.source
            raw = within(source.load(self.spark), source.timestamp_field, start, end, source.millis_field)
            info = {}
            if view.partial is not None:
                raw, info = self._folded(view, raw, start, end)
            rows = self.latest(view, raw, as_of or F.current_timestamp(), finished=view.partial is not None)
            written[view.name] = self.publish(view, rows, start, end, whole=True, info=info)
        return {v.name: written[v.name] for v in chosen}

    def materialize_incremental(self, end: datetime, views: Sequence[str] | None = None, mode: str = "recompute",
                                start: datetime | None = None, as_of: datetime | None = None) -> dict[str, int]:
        """Bring the online tables up to ``end`` from the end of the last run; returns rows written per view.

        ``interval`` computes the view on the new interval only.  ``recompute`` finds the
        keys touched in the interval and computes them over their full history, so that
        aggregates stay complete.  ``partial`` adds the interval's partial results to the
        stored ones and finishes the touched keys from those; history is not read.
        """
        if mode not in ("recompute", "interval", "partial"):
            raise ValueError("mode is recompute, interval or partial")
        written = {}
        for view in self._online(views):
            last = self.current(view.name)
            if last is None:
                if start is None:
                    raise ValueError(f"view {view.name} was never materialised: give start")
                written.update(self.materialize(start, end, [view.name], as_of))
                continue
            source, info = view.source, {}
            history = source.load(self.spark)
            fresh = within(history, source.timestamp_field, last["end_time"], end, source.millis_field)
            if mode == "interval":
                raw = fresh
            elif mode == "partial":
                raw, info = self._advanced(view, history, end, last)
            else:
                touched = fresh.select(*self._raw_keys(view, history)).distinct()
                whole = within(history, source.timestamp_field, last["start_time"], end, source.millis_field)
                # Touched keys are distinct, so this keeps each row of their history once.
                raw = join_unique(whole, touched, touched.columns, "inner")
            update = self.latest(view, raw, as_of or F.current_timestamp(), finished=mode == "partial")
            written[view.name] = self.publish(view, update, last["start_time"], end, info=info)
        return written

    def table(self, view: FeatureView) -> BucketTable:
        """The online table of a view: of several rows of a key the newest counts, the later version's on equal times."""
        def newest(rows: DataFrame) -> DataFrame:
            time = view.source.timestamp_field
            return latest_per_key(rows, view.keys, time, "_order").select(*view.keys, time, *view.features)

        return BucketTable(self.spark, f"{self.path}/online/{view.name}", view.keys, self.buckets, newest, self.max_parts)

    def publish(self, view: FeatureView, rows: DataFrame, start: datetime, end: datetime, whole: bool = False, info: dict | None = None) -> int:
        """Commit ``rows`` as a version of the online table, ``whole`` instead of what is there; returns their number."""
        table, span = self.table(view), {"start_us": epoch_micros(start), "end_us": epoch_micros(end), **(info or {})}
        done = table.replace(rows, span) if whole else table.append(rows, span)
        table.compact()
        return done.rows

    # Partial results

    def state(self, view: FeatureView) -> BucketTable:
        """Stored partial results of a view, bucketed by its keys; rows of several versions add up."""
        partial = view.partial
        if partial is None:
            raise ValueError(f"view {view.name} declares no partial results")
        return BucketTable(self.spark, f"{self.path}/state/{view.name}", view.keys, self.buckets,
                           lambda rows: partial.combine(rows.drop("_order")), self.max_parts)

    def _folded(self, view: FeatureView, raw: DataFrame, start: datetime, end: datetime) -> tuple[DataFrame, dict]:
        """Start the stored partial results anew from ``raw``; the view's rows come from them."""
        state = self.state(view)
        done = state.replace(view.partial.fold(raw), {"start_us": epoch_micros(start), "end_us": epoch_micros(end)})
        rows = state.rows()
        return view.partial.finish(view.partial.fold(raw) if rows is None else rows), {"state_version": done.version}

    def _advanced(self, view: FeatureView, history: DataFrame, end: datetime, last: dict) -> tuple[DataFrame, dict]:
        """Add the rows behind the stored end to the partial results and finish the keys not yet published.

        The interval is open at its start, so a row is added once.  The commit holds only if
        no other run has advanced the state meanwhile; then the interval is cut again.  A
        run that was lost between the state's commit and the publishing is caught up here.
        """
        state, partial, source = self.state(view), view.partial, view.source
        while True:
            commits = state.commits()
            marks = [c for c in commits if "end_us" in c.info]
            if not marks:
                raise ValueError(f"view {view.name} has no stored partial results: materialise it first")
            mark = max(c.info["end_us"] for c in marks)
            if mark >= epoch_micros(end):
                break
            fresh = behind(history, source.timestamp_field, from_micros(mark), end, source.millis_field)
            try:
                state.append(partial.fold(fresh), {"start_us": mark, "end_us": epoch_micros(end)}, after=commits[-1].version)
            except VersionTaken:
                continue
            commits = state.commits()
            break
        unpublished = [c for c in commits if "end_us" in c.info and c.version > last.get("state_version", 0) and c.path]
        newest = {"state_version": commits[-1].version}
        if not unpublished:
            return partial.finish(partial.fold(history.limit(0))), newest
        touched = None
        for c in unpublished:
            keys = self.spark.read.parquet(c.path).select(*view.keys)
            touched = keys if touched is None else touched.unionByName(keys)
        of: dict[int, list[int]] = {}
        for c in unpublished:
            of[c.buckets] = sorted({*of.get(c.buckets, []), *c.filled})
        # Rewritten first, so that buckets of many versions are combined once and not here again; a
        # rewriting that took in a version of another run is left to that run.
        done = state.compact()
        if done is not None and done.folds <= {c.version for c in commits}:
            commits = [*commits, done]
        # Touched keys are picked from the stored rows, before these are combined: heavy ones are counted without that
        # work, and what is joined by key needs no other shuffle to be combined and finished.
        touched = touched.distinct()
        load = key_load(state.stored(of, commits), view.keys)
        return partial.finish(state.rows(of, commits, lambda rows: join_unique(rows, touched, view.keys, "inner", load))), newest

    def _raw_keys(self, view: FeatureView, raw: DataFrame) -> list[str]:
        """Key columns of the raw rows; a view function may rename ``parent_asin`` to ``item_id``."""
        names = []
        for key in view.keys:
            options = [key] + (["parent_asin", "asin"] if key == "item_id" else [])
            found = [o for o in options if o in raw.columns]
            if not found:
                raise ValueError(f"view {view.name}: key {key} is not a raw column, use mode='interval'")
            names.append(found[0])
        return names

    def _online(self, names: Sequence[str] | None) -> list[FeatureView]:
        views = [self.registry.view(n) for n in names] if names else list(self.registry.views.values())
        return [v for v in views if v.online]

    def history(self, view: str) -> DataFrame | None:
        """Runs of one view, or None before the first."""
        runs = self._runs(self.registry.view(view))
        rows = [(view, c.version, c.path, c.info["start_us"], c.info["end_us"], c.rows, c.buckets) for c in runs]
        return self.spark.createDataFrame(rows, LOG_SCHEMA) if rows else None

    def _runs(self, view: FeatureView) -> list[Commit]:
        return [c for c in self.table(view).commits() if "end_us" in c.info]

    def current(self, view: str) -> dict | None:
        """The newest run of one view: version, path, rows, buckets, start and end time, and what of the state it has published."""
        runs = self._runs(self.registry.view(view))
        if not runs:
            return None
        newest = runs[-1]
        # Overlapping runs may commit out of order; what is up to date is the latest end.
        since = max((r.version for r in runs if r.whole), default=0)
        counted = [r for r in runs if r.version >= since] or runs
        return {"view": view, "version": newest.version, "path": newest.path, "rows": newest.rows, "buckets": newest.buckets,
                "start_time": from_micros(min(r.info["start_us"] for r in counted)), "end_time": from_micros(max(r.info["end_us"] for r in counted)),
                "state_version": max(r.info.get("state_version", 0) for r in counted)}

    # Online features

    def online_table(self, view: str) -> DataFrame:
        """All current rows of a view."""
        declared = self.registry.view(view)
        if self.current(view) is None:
            raise KeyError(f"feature view {view} is not materialised")
        return self._current_rows(declared, self.table(declared).rows())

    def _current_rows(self, view: FeatureView, rows: DataFrame | None) -> DataFrame:
        if rows is not None:
            return rows
        empty = self.latest(view, view.source.load(self.spark).limit(0), F.current_timestamp())
        return self.spark.createDataFrame([], empty.schema)

    def get_online_features(self, features: Sequence[str], requests: DataFrame, few_requests: int = 10_000) -> DataFrame:
        """Current features of the requested keys; keys without a row give nulls.

        Up to ``few_requests`` distinct keys are counted and looked up without a shuffle,
        reading only their buckets; more keys are joined with heavy keys set apart.
        """
        result = requests
        for name, columns in self.registry.select(features).items():
            view = self.registry.view(name)
            if self.current(name) is None:
                raise KeyError(f"feature view {name} is not materialised")
            asked = requests.select(*view.keys).distinct()
            head = asked.limit(few_requests + 1).collect()
            if len(head) <= few_requests:
                # One row per key: at most as many found rows as counted keys.
                few = self.spark.createDataFrame(head, asked.schema)
                near = self._current_rows(view, self.table(view).lookup(few)).select(*view.keys, *columns)
                found = F.broadcast(near.join(F.broadcast(few), view.keys))
                result = result.join(found, view.keys, "left")
            else:
                rows = self._current_rows(view, self.table(view).rows()).select(*view.keys, *columns)
                result = join_unique(result, rows, view.keys, "left", key_load(requests, view.keys))
            result = result.select(*[c for c in result.columns if c not in columns], *columns)
        return result
