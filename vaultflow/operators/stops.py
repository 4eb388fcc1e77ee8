"""Stops of accounts that spread along shared ids.

An account stops at its first request that waits: that request and all later ones of the account wait. A request that repeats the id of an
earlier waiting one waits too, whatever its account, and so stops that account. Causes come before what they cause, so one walk in order settles
all rows that it sees. The rows are cut into slices of the sequence that are walked in parallel, each from the stops that the round before found;
rounds end when one finds no more, so there are as many as a chain of causes crosses slices, not as many as it has links.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow.operators.lookups import Lookup, lookup_join
from vaultflow.operators.slices import slice_of
from vaultflow.session import stage

_WAITING_DDL = "seq bigint, accountId string, transactionId string"


def _walk():
    """Arrow function over rows sorted by (slice, seq) that gives those that wait. ``stopAt`` and ``since`` are what is known of the account and of the id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at, stopped, first, free = None, None, set(), {}, {}
        names = ("slice", "seq", "accountId", "transactionId", "stopAt", "since")
        for b in batches:
            out = []
            for part, seq, account, id, stop, since in zip(*(b.column(c).to_pylist() for c in names)):
                if part != here:
                    here, at, stopped, first = part, None, set(), {}
                if seq != at:
                    at, free = seq, {}
                if (account in stopped or (stop is not None and stop <= seq) or (since is not None and since < seq)
                        or first.get(id, seq) < seq):
                    stopped.add(account)
                    # the stop holds for rows of the same place as well
                    for i in (id, *free.pop(account, ())):
                        first.setdefault(i, seq)
                        out.append((seq, account, i))
                else:
                    free.setdefault(account, []).append(id)
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["seq", "accountId", "transactionId"])

    return run


def spread(links: DataFrame, stops: DataFrame, slice_rows: int = 1_000_000) -> DataFrame:
    """(``_account``, ``stopAt``): ``stops`` and those that follow from them along ``links``. Both are written tables.

    ``links`` (seq, accountId, transactionId; no nulls) are the requests whose id several accounts share.
    """
    rows = links.withColumn("slice", slice_of("seq", slice_rows).cast("bigint"))
    n, low, high = rows.agg(F.count("*"), F.min("slice"), F.max("slice")).first()
    if n == 0:
        return stops
    found, ids = -1, None
    while True:
        known = lookup_join(rows, Lookup(stops, "_account"), "accountId", "stop").withColumn("stopAt", F.col("stop.stopAt")).drop("stop")
        if ids is None:
            known = known.withColumn("since", F.lit(None).cast("bigint"))
        else:
            known = lookup_join(known, Lookup(ids, "_id"), "transactionId", "first").withColumn("since", F.col("first.since")).drop("first")
        waiting = stage(known.repartition("slice").sortWithinPartitions("slice", "seq").mapInArrow(_walk(), _WAITING_DDL), "stream-met")
        more = waiting.groupBy(F.col("accountId").alias("_account")).agg(F.min("seq").alias("stopAt"))
        stops = stage(stops.unionByName(more).groupBy("_account").agg(F.min("stopAt").alias("stopAt")), "stream-stops")
        if low == high:
            return stops
        was, found = found, waiting.count()
        if found == was:
            return stops
        ids = stage(waiting.groupBy(F.col("transactionId").alias("_id")).agg(F.min("seq").alias("since")), "stream-ids")
