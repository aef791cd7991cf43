"""First copies of headlines across the batches of a stream, by arbitrary state per bucket of keys."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

DAY_MS = 86_400_000
_KEY, _LANDED, _BUCKET = "_headline", "_landed", "_bucket"
_DIGEST = 32  # bytes
BUCKETS = 1024


def headline_key(headline: Column) -> Column:
    """Digest of the headline without case, outer white space and outer quotes."""
    bare = F.regexp_replace(F.trim(headline), r"""^["']+|["']+$""", "")
    return F.sha2(F.lower(F.trim(bare)), 256)


def _local_first(order: list[str]):
    """Drop later copies inside a record batch, before rows are shuffled: a headline of
    very many copies reaches its state as few rows from each task."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            at = t.append_column("_at", pa.array(range(len(t)), pa.int64())).sort_by([(c, "ascending") for c in (*order, "_at")])
            first = at.group_by(_KEY, use_threads=False).aggregate([("_at", "first")])["_at_first"]
            yield from t.take(first.combine_chunks()).to_batches()
    return run


def first_copies(stream: DataFrame, headline: str = "headline", order: tuple[str, ...] = ("date",), keep_ms: int = 30 * DAY_MS,
                 buckets: int = BUCKETS) -> DataFrame:
    """Rows whose headline no earlier batch held; inside a batch the first by ``order``.

    A headline is remembered for ``keep_ms`` from its first copy on and then dropped, so
    the state is bounded by the headlines of that time; a copy that comes later counts as
    new. The clock is the time at which batches start: rows are never late for it, and a
    run over what has landed ends (timers on processing time would keep it awake). Rows
    without a headline are dropped.

    Headlines share ``buckets`` states by their digests, so Python is called once a bucket
    and not once a headline. A state holds the digests of each batch under their common
    end of time; a batch rewrites the states of the buckets it meets. The number is part of
    the checkpoint and cannot change later."""
    columns = stream.columns
    rows = stream.where(F.col(headline).isNotNull()).withColumn(_KEY, F.unhex(headline_key(F.col(headline))))
    local = rows.mapInArrow(_local_first(list(order)), rows.schema).withColumn(_LANDED, F.current_timestamp()).withWatermark(_LANDED, "0 seconds")
    dealt = local.withColumn(_BUCKET, F.pmod(F.xxhash64(_KEY), F.lit(buckets)).cast("int"))

    def first(key, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        best, now = None, state.getCurrentWatermarkMs() if state.hasTimedOut else 0
        for chunk in () if state.hasTimedOut else chunks:
            now = max(now, chunk[_LANDED].max().value // 1_000_000)
            both = chunk if best is None else pd.concat([best, chunk], ignore_index=True)
            best = both.sort_values(list(order), kind="stable").drop_duplicates(_KEY)
        held = [(until, bytes(digests)) for until, digests in zip(*state.get) if until > now] if state.exists else []
        if best is not None:
            known = {digests[i:i + _DIGEST] for _, digests in held for i in range(0, len(digests), _DIGEST)}
            new = best[[bytes(k) not in known for k in best[_KEY]]]
            if len(new):
                held.append((now + keep_ms, b"".join(bytes(k) for k in new[_KEY])))
                yield new[columns]
        if not held:
            state.remove()
            return
        state.update(tuple(map(list, zip(*held))))
        state.setTimeoutTimestamp(int(max(min(until for until, _ in held), state.getCurrentWatermarkMs() + 1)))

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    return dealt.groupBy(_BUCKET).applyInPandasWithState(first, out, "until array<bigint>, digests array<binary>", "append",
                                                         GroupStateTimeout.EventTimeTimeout)
