"""Event output (K-1 .. K-8): envelopes, null trimming, conformance checks,
size-bounded batching and batch files.

Batches are cut in order over all rows: where one begins depends on where the one
before it began. The rows are range-partitioned, the open group is carried from
partition to partition, and no task sees more than one partition (``_in_order``).
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.functions.scalars import col_of
from lakelens.session import cut_lineage


def envelope(kind: str, entity: Column) -> Column:
    """K-1: a change event holding exactly one aspect, named after its kind."""
    return F.struct(entity.alias(kind))


def event_json(kind: str, entity: Column) -> Column:
    """K-1 + K-2: JSON text of the envelope; ``to_json`` leaves null fields out
    (empty lists and objects stay)."""
    return F.to_json(envelope(kind, entity))


def drop_null_items(arr) -> Column:
    """K-2 for arrays: null members removed."""
    return F.filter(col_of(arr), lambda x: x.isNotNull())


def union_events(frames: Mapping[str, DataFrame]) -> DataFrame:
    """K-1 / U-5: one (kind, entity_id, event) table from per-kind frames that
    each hold ``entity_id`` and ``entity`` (a struct)."""
    out = None
    for kind, df in frames.items():
        x = df.select(F.lit(kind).alias("kind"), "entity_id", event_json(kind, F.col("entity")).alias("event"))
        out = x if out is None else out.unionByName(x)
    return out


def check(df: DataFrame, rules: Mapping[str, Column], name: str = "conformance") -> tuple[DataFrame, Observation]:
    """K-3 / X-5 (custom checks are named boolean Columns): evaluate named
    boolean rules per row; adds ``failed_rules`` (array of
    rule names, empty when valid) and ``valid``. Row counts are collected with
    an Observation while the data is written, without a second pass."""
    failed = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]),
                      lambda x: x.isNotNull())
    out = df.withColumn("failed_rules", failed).withColumn("valid", F.size("failed_rules") == 0)
    obs = Observation(name)
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("valid")).alias("valid_rows"))
    return out, obs


def _next_starts(total: np.ndarray, most: int, limit: int, reach: bool) -> np.ndarray:
    """For a group that starts at each row, the row at which the next one starts (the
    row count where the group is still open). ``total`` are running sums of sizes, 0
    first. A group ends after ``most`` rows, and before the row that would exceed
    ``limit`` or, with ``reach``, after the one that reaches it."""
    n = len(total) - 1
    at = np.arange(n)
    ends = np.searchsorted(total, total[:-1] + limit, side="left") if reach else np.searchsorted(total, total[:-1] + limit, side="right") - 1
    return np.minimum(np.maximum(np.minimum(ends, at + most), at + 1), n)


def _carried_rows(rows: int, held: int, head: np.ndarray, most: int, limit: int, reach: bool) -> int:
    """How many rows of a partition with running sums ``head`` belong to a group that
    has ``rows`` rows of ``held`` bytes before it (no rows: none)."""
    if not rows:
        return 0
    fit = np.searchsorted(head, limit - held, side="left") if reach else np.searchsorted(head, limit - held, side="right") - 1
    return int(max(0, min(fit, most - rows)))


def _cuts(sizes: np.ndarray, place: int, taken: int, most: int, limit: int, reach: bool) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(group, place in the group) of rows that follow ``place`` rows of ``taken`` bytes of
    an open group, which is number 0, and what is open after them. One step per group."""
    total, n = np.concatenate([[0], sizes]).cumsum(), len(sizes)
    after = _next_starts(total, most, limit, reach)
    starts, begin = [], _carried_rows(place, taken, total, most, limit, reach)
    while begin < n:
        starts.append(begin)
        begin = int(after[begin])
    mark = np.zeros(n, np.int64)
    mark[starts] = 1
    groups = np.cumsum(mark)
    places = np.arange(n) - np.array([-place, *starts])[groups]
    if starts:
        place, taken, n = 0, -int(total[starts[-1]]), n - starts[-1]
    return groups, places, place + n, taken + int(total[-1])


def _in_order(df: DataFrame, order: str, size: str, most: int, limit: int, reach: bool, per_event: int | None) -> DataFrame:
    """``df`` with ``__group`` and ``__event`` as cuts over all rows in order give them.

    Rows are range-partitioned by the order key, size and a hash of the row, so that
    a key with very many rows is split too. Where a partition's last group starts
    depends only on where its first one does; each partition reports this for every
    first start there can be (runs of equal answers) with its first sums, and the
    driver follows the chain. With the group carried in known, partitions number
    their rows, and counts of the partitions before are added."""
    spark = df.sparkSession
    key = [F.col(order).asc_nulls_last(), F.col("__size"), F.col("__tie")]
    sized = df.withColumns({"__size": F.coalesce(F.col(size).cast("long"), F.lit(0)), "__tie": F.xxhash64(*df.columns)})
    rows = cut_lineage(sized.repartitionByRange(*key).sortWithinPartitions(*key).drop("__tie").withColumn("__part", F.spark_partition_id()))

    def summary(frames):
        frames = [f for f in frames if len(f)]
        if not frames:
            return
        total = np.concatenate([[0], *[f["__size"].to_numpy() for f in frames]]).cumsum()
        n, part = len(total) - 1, int(frames[0]["__part"].iloc[0])
        after = _next_starts(total, most, limit, reach)
        last = np.arange(n)
        for i in range(n - 1, -1, -1):
            if after[i] < n:
                last[i] = last[after[i]]
        head = total[:1 + min(n, most, int(np.searchsorted(total, limit, side="right")))]
        first = np.flatnonzero(np.diff(last[:len(head)], prepend=-1))
        yield pd.DataFrame({"part": [part], "n": [n], "bytes": [int(total[-1])], "head": [head.tolist()], "first": [first.tolist()],
                            "rows": [(n - last[first]).tolist()], "held": [(total[-1] - total[last[first]]).tolist()]})

    schema = "part int, n long, bytes long, head array<long>, first array<long>, rows array<long>, held array<long>"
    carried, open_rows, held = {}, 0, 0
    told = cut_lineage(rows.select("__part", "__size").mapInPandas(summary, schema))
    for r in told.orderBy("part").toLocalIterator():  # the driver holds a few partitions' answers at a time
        carried[r.part] = (open_rows, held)
        begin = _carried_rows(open_rows, held, np.array(r.head), most, limit, reach)
        if open_rows and begin >= r.n:
            open_rows, held = open_rows + r.n, held + r.bytes
        else:
            run = int(np.searchsorted(r.first, begin, side="right")) - 1
            open_rows, held = r.rows[run], r.held[run]
    shipped = spark.sparkContext.broadcast(carried)  # two numbers a partition

    def number(frames):
        state = None
        for f in frames:
            if not len(f):
                continue
            if state is None:
                state, group, event = shipped.value[int(f["__part"].iloc[0])], 0, 0
            groups, places, *state = _cuts(f["__size"].to_numpy(), *state, most, limit, reach)
            events = event + np.cumsum(places % per_event == 0) if per_event else np.zeros(len(f), np.int64)
            yield f.assign(__group=group + groups, __event=events)
            group, event = group + int(groups[-1]), int(events[-1])

    numbered = cut_lineage(rows.mapInPandas(number, T.StructType(rows.schema.fields + [T.StructField(c, T.LongType()) for c in ("__group", "__event")])))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    base = numbered.groupBy("__part").agg(F.max("__group").alias("g"), F.max("__event").alias("e")).select(
        "__part", *[(F.coalesce(F.sum(c).over(before), F.lit(0)) - 1).alias(f"__{c}") for c in ("g", "e")])
    return numbered.join(F.broadcast(base), "__part").withColumns({
        "__group": (F.col("__group") + F.col("__g")).cast("int"), "__event": (F.col("__event") + F.col("__e")).cast("int")})


def pack(df: DataFrame, order: str, size: str, items_per_chunk: int, chunk_size: int) -> DataFrame:
    """K-4 / X-4: add ``batch`` to every row. In order, a batch takes rows while it has
    at most ``items_per_chunk`` of them and at most ``chunk_size`` bytes; a larger row
    stands alone. Rows of one order key go by size."""
    x = _in_order(df, order, size, items_per_chunk, chunk_size, False, None)
    return x.select(*df.columns, F.col("__group").alias("batch"))


def query_log_batches(df: DataFrame, order: str, size: str, logs_per_event: int = 100, events_per_file: int = 200,
                      bytes_per_file: int = 100 * 1024 * 1024) -> DataFrame:
    """K-6 / W-9: add ``event_no`` and ``file_no`` to every log row. In order, a file
    takes logs until it has reached ``bytes_per_file`` or its events are full; an event
    takes ``logs_per_event`` logs of one file."""
    x = _in_order(df, order, size, logs_per_event * events_per_file, bytes_per_file, True, logs_per_event)
    return x.select(*df.columns, F.col("__event").alias("event_no"), F.col("__group").alias("file_no"))


def positional_batches(df: DataFrame, seq: Column, per_event: int, per_file: int) -> Column:
    """W-9 count-only form without a fold: from a dense 1-based sequence number,
    event = (seq-1) div per_event, file = event div per_file."""
    ev = F.floor((seq - 1) / per_event)
    return F.struct(ev.cast("int").alias("event_no"), F.floor(ev / per_file).cast("int").alias("file_no"))


def write_batches(df: DataFrame, path: str, batch_cols: list[str], mode: str = "overwrite") -> None:
    """K-5 / K-8: one folder of JSON files per batch (``partitionBy``), written
    by the executors; no data passes through the driver."""
    df.write.mode(mode).partitionBy(*batch_cols).json(path)


def run_record(name: str, obs: Observation, started, finished, status: str = "SUCCESS", error: str | None = None) -> dict:
    """K-7: the run record, from metrics the job observed while running."""
    m = obs.get if obs is not None else {}
    return {"crawler_name": name, "start_time": str(started), "end_time": str(finished), "status": status,
            "entity_count": int(m.get("valid_rows", 0)), "error": error}
