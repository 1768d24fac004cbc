"""Run a stream over everything its source holds now, and read the results back as a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.times import to_micros
from tidemark.operators.rows import stacked
from tidemark.session import removed_at_end, settings, shared_folder
from tidemark.sources.streams import line_stream, table_stream
from tidemark.streaming import sinks, views
from tidemark.streaming.levels import Levels

#: Quantiles of time from which spans are cut, and how many cuts are searched at a time.
POINTS, GROUP = 4096, 64

#: Steps that each let some data arrive.
Feed = Iterable[Callable[[], None]]

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _started(stream: DataFrame, partitions: int | None, start, feed: Feed | None) -> None:
    """Start under the settings a stateful query fixes for the life of its checkpoint, and wait for its end.

    State lives in RocksDB, off the heap, and a micro-batch saves only its changes. ``partitions`` is the number of state partitions.
    With a ``feed`` the query is started once and runs on while the steps of the feed let data arrive, one after the other.
    """
    spark = stream.sparkSession
    with settings(
        spark,
        spark__sql__streaming__stateStore__providerClass=STATE_STORE,
        spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
        spark__sql__shuffle__partitions=partitions,
    ):
        query = start(sinks.ALL_THERE_IS if feed is None else None)
    if feed is None:
        query.awaitTermination()
        return
    try:
        for arrives in feed:
            arrives()
            query.processAllAvailable()
    finally:
        query.stop()


def replay(stream: DataFrame, mode: str, keys: Sequence[str] = (), *, partitions: int | None = None,
           folder: str | None = None, checkpoint: str | None = None, feed: Feed | None = None) -> DataFrame:
    """Results after all available input: every row (append), the last row per key (update), or the last
    micro-batch (complete). Handing in the same folders again goes on where the last replay ended.
    """
    spark = stream.sparkSession
    fresh = folder is None
    folder, checkpoint = folder or shared_folder(spark, "results"), checkpoint or shared_folder(spark, "query")
    _started(stream, partitions, lambda trigger: sinks.to_table(stream, mode, folder, checkpoint, trigger, keys), feed)
    if fresh:
        removed_at_end(spark, folder, checkpoint)
    return stored(spark, folder, stream.schema, mode, keys)


def stored(spark: SparkSession, folder: str, schema: StructType, mode: str, keys: Sequence[str] = ()) -> DataFrame:
    if mode == "append":
        return spark.read.schema(schema).parquet(folder)
    return Levels(spark, folder, schema, keys).read()


def replay_into(view, stream: DataFrame, mode: str, *, partitions: int | None = None, folder: str | None = None,
                checkpoint: str | None = None, feed: Feed | None = None):
    """Replay into one of the ``views``, handed in as a function of the stream and of the folder it lives in; returns it."""
    spark = stream.sparkSession
    fresh = folder is None
    folder, checkpoint = folder or shared_folder(spark, "results"), checkpoint or shared_folder(spark, "query")
    kept = view(stream, folder)
    _started(stream, partitions, lambda trigger: views.kept_by(kept, stream, mode, checkpoint, trigger), feed)
    if fresh:
        removed_at_end(spark, folder, checkpoint)
    return kept


def replay_branches(stream: DataFrame, mode: str, branches: Mapping[str, Column], *, partitions: int | None = None,
                    folder: str | None = None, checkpoint: str | None = None, feed: Feed | None = None) -> DataFrame:
    """Replay into several outputs; the result stacks them under a column ``branch``."""
    spark = stream.sparkSession
    fresh = folder is None
    folder, checkpoint = folder or shared_folder(spark, "results"), checkpoint or shared_folder(spark, "query")
    _started(stream, partitions, lambda trigger: sinks.to_branches(stream, mode, branches, folder, checkpoint, trigger), feed)
    if fresh:
        removed_at_end(spark, folder, checkpoint)
    return stacked(*(
        spark.read.schema(stream.schema).parquet(f"{folder}/{name}/batch_id=*").withColumn("branch", F.lit(name))
        for name in branches
    ))


def spans_of_time(rows: DataFrame, ts: str, slice_rows: int, least: int) -> tuple[Column, int]:
    """The number of the span of time a row lies in, and the last number; spans of about ``slice_rows`` rows, ``least`` at least.

    Rows of one time share a span; the number of a row without a time is 0. The cuts come from one pass over the times alone; no more than POINTS of them exist.
    """
    us = to_micros(F.col(ts))
    found = rows.agg(
        F.count(ts).alias("n"),
        F.percentile_approx(us, [k / POINTS for k in range(1, POINTS)], 10 * POINTS).alias("points")).first()
    many = min(max(least, -(-found["n"] // slice_rows)), POINTS)
    points = found["points"] or []
    cuts = sorted({points[k * POINTS // many - 1] for k in range(1, many)} if points else ())
    if not cuts:
        return F.lit(0), 0
    # First among every GROUP-th cut, then among those between two of them.
    groups = [cuts[k : k + GROUP] for k in range(0, len(cuts), GROUP)]
    behind = lambda numbers: F.size(F.filter(numbers, lambda cut: cut < us))
    whole = behind(F.array(*(F.lit(some[-1]) for some in groups)))
    inside = F.get(F.array(*(F.array(*map(F.lit, some)) for some in groups)), whole)
    return F.when(whole < len(groups), whole * GROUP + behind(inside)).otherwise(len(cuts)), len(cuts)


def by_time(rows: DataFrame, ts: str, slice_rows: int, least: int = 1, parts: int = 8, form: str = "parquet",
            timeless: bool = False) -> str:
    """Write the rows to the shared folder, once, partitioned by ``slice``: the span of time they lie in.

    A span is written by up to ``parts`` tasks. Rows without a time are left out or, with ``timeless``, come in the last
    span. ``form`` is parquet or, for a column ``value``, text.
    """
    spark = rows.sparkSession
    span, last = spans_of_time(rows, ts, slice_rows, least)
    numbered = rows.withColumn("slice", F.when(F.col(ts).isNull(), last).otherwise(span).cast("int"))
    if not timeless:
        numbered = numbered.where(F.col(ts).isNotNull())
    hashed = [name for name, kind in rows.dtypes if "map<" not in kind]
    dealt = numbered.repartition("slice", F.pmod(F.xxhash64(*hashed), F.lit(parts)))
    folder = shared_folder(spark, "slices")
    (dealt.select("value", "slice") if form == "text" else dealt).write.partitionBy("slice").format(form).save(folder)
    removed_at_end(spark, folder)
    return folder


def arrivals(spark: SparkSession, spans: str, arriving: str) -> list[Callable[[], None]]:
    """One step per span of time, in order, that lets its files arrive in a folder; files are renamed, not copied."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(spans).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(arriving))
    folders = {s.getPath().getName(): s.getPath() for s in files.listStatus(path(spans)) if s.isDirectory()}
    numbers = sorted(int(name.split("=")[1]) for name in folders if name.startswith("slice="))

    def step(number: int) -> Callable[[], None]:
        def arrive() -> None:
            for status in files.listStatus(folders[f"slice={number}"]):
                name = status.getPath().getName()
                if name.startswith("part-"):
                    files.rename(status.getPath(), path(f"{arriving}/{number:06d}-{name}"))

        return arrive

    return [step(number) for number in numbers]


def replay_in_slices(rows: DataFrame, ts: str, build: Callable[[DataFrame], DataFrame], run: Callable[..., DataFrame],
                     slice_rows: int = 50_000_000, least: int = 1, form: str = "parquet", timeless: bool = False):
    """Replay a table through a job that follows event time, a span of time after the other, in one streaming query.

    Rows arrive in time order whatever the table's layout, so none is behind the watermark, and no micro-batch holds
    more than about ``slice_rows`` rows. ``build`` makes the job from the arriving rows (lines, with the form text),
    ``run`` is a replay with everything set but the folders and the feed; its result is returned. The times are read once to find the spans, the
    rows once to write them; their files then arrive one span after the other.
    """
    spark = rows.sparkSession
    arriving = shared_folder(spark, "arriving")
    feed = arrivals(spark, by_time(rows, ts, slice_rows, least, form=form, timeless=timeless), arriving)
    folders = {"folder": shared_folder(spark, "results"), "checkpoint": shared_folder(spark, "query")}
    stream = line_stream(spark, arriving) if form == "text" else table_stream(spark, arriving, rows.schema)
    found = run(build(stream), feed=feed or [lambda: None], **folders)
    removed_at_end(spark, arriving, *folders.values())
    return found
