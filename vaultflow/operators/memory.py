"""Resubmitted ids with a memory of a bounded number of ids.

A request is a repeat while its id is among the ``most`` ids that were marked last; an id is marked when a request with it
is validated or rejected and is no repeat, and a repeat does not make it any younger. A dead letter is only looked up.

Which requests are marked depends on which were before, and so on to the first, but only through the ids that are remembered, and
those are at most ``most``. So the sequence is cut into slices that are walked in parallel, each from a supposed memory: the one that the
slice before it closed with in the round before. Slices whose memory turns out different are walked again, until none is. What a slice
closes with depends little on what it opened with once it has marked more than ``most`` ids, so slices far longer than that settle in two or
three rounds; in the worst case every round settles one more slice. No task holds more than one memory.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.operators.slices import running_sum_before, slice_of
from vaultflow.session import stage

# Kinds of rows that a walk reads and writes: what a slice opens with, its requests, what it closes with.
_OPENING, _REQUEST, _CLOSING = 0, 1, 2
_SLICE_ROWS = 100_000
_WALKED_DDL = "slice bigint, kind int, seq bigint, id string, repeat boolean, mark boolean"


def _walk(most: int):
    """Arrow function over rows sorted by (slice, kind, seq). The ``seq`` of a remembered id is its age: 1 for the one marked last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, marks, number, order = None, 0, {}, deque()

        def closing() -> list[tuple]:
            return [(here, _CLOSING, marks - n, id, None, None) for id, n in number.items() if marks - n <= most]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["slice", "kind", "seq", "id", "repeat", "mark"])

        for b in batches:
            out = []
            for part, kind, seq, id, dead in zip(*(b.column(c).to_pylist() for c in ("slice", "kind", "seq", "id", "dead"))):
                if part != here:
                    if here is not None:
                        out += closing()
                    here, marks, number, order = part, 0, {}, deque()
                if kind == _OPENING:
                    number[id] = -seq
                    continue
                if not order and number:
                    order.extend(sorted((n, id_) for id_, n in number.items()))
                # the n-th mark is remembered while fewer than ``most`` came after it
                while order and marks - order[0][0] > most:
                    n, old = order.popleft()
                    if number.get(old) == n:
                        del number[old]
                repeat = id is not None and id in number
                mark = not repeat and not dead
                if mark:
                    if id is not None:
                        number[id] = marks
                        order.append((marks, id))
                    marks += 1
                out.append((part, _REQUEST, seq, id, repeat, mark))
            yield batch_of(out)
        if here is not None:
            yield batch_of(closing())

    return run


def marked(requests: DataFrame, most: int, known: DataFrame | None = None, before: int = 0, slice_rows: int | None = None) -> DataFrame:
    """(seq, transactionId, repeat, mark, number): of every request whether it is a repeat, whether it is marked, and its mark number. Written.

    ``requests`` (seq, transactionId, dead) are in the order of a unique ``seq``; ``dead`` ones are never marked. Earlier ones left ``before``
    marks and ``known`` (transactionId, number), the last mark of each id that is still remembered. A request without an id is no repeat.
    Slices are many times longer than the memory, so that they settle early, and no longer than a task walks in a second or so.
    """
    slice_rows = slice_rows or max(_SLICE_ROWS, 100 * most)
    rows = stage(requests.select(slice_of("seq", slice_rows).cast("bigint").alias("slice"), F.lit(_REQUEST).alias("kind"), "seq",
                                 F.col("transactionId").alias("id"), "dead"), "memory-rows")
    order = Window.orderBy("slice")
    chain = stage(rows.select("slice").distinct().withColumn("follows", F.lag("slice").over(order)), "memory-slices")

    def openings(memory: DataFrame) -> DataFrame:
        return memory.select("slice", F.lit(_OPENING).alias("kind"), "seq", "id", F.lit(False).alias("dead"))

    def signed(memory: DataFrame) -> DataFrame:
        """One number for the memory of each slice."""
        return memory.groupBy("slice").agg(F.sum(F.xxhash64("id", "seq").cast("decimal(38,0)")).alias("sign"))

    carried = rows.select("slice", "seq", "id").where("false")
    if known is not None:
        first = chain.where("follows is null").first()
        age = F.lit(before + 1) - F.col("number")
        old = known.where(age <= most).select(age.cast("bigint").alias("seq"), F.col("transactionId").alias("id"))
        carried = stage(old.withColumn("slice", F.lit(first["slice"] if first else None).cast("bigint")).where("slice is not null"), "memory-known").select("slice", "seq", "id")
    used, todo, rounds = carried, chain.select("slice"), []
    while True:
        some = rows.unionByName(openings(used)).join(todo, "slice", "left_semi")
        rounds.append(stage(some.repartition("slice").sortWithinPartitions("slice", "kind", "seq").mapInArrow(_walk(most), _WALKED_DDL), "memory-walked"))
        settled = _last_walk(rounds)
        closed = settled.where(F.col("kind") == _CLOSING)
        memory = stage(closed.select(F.col("slice").alias("follows"), "seq", "id").join(chain, "follows").select("slice", "seq", "id")
                       .unionByName(carried), "memory-opened")
        was, now = signed(used).withColumnRenamed("sign", "was"), signed(memory)
        stale = stage(chain.select("slice").join(now, "slice", "left").join(was, "slice", "left")
                      .where(~F.col("sign").eqNullSafe(F.col("was"))).select("slice"), "memory-stale")
        if stale.isEmpty():
            break
        used, todo = memory, stale
    asked = settled.where(F.col("kind") == _REQUEST).select("seq", F.col("id").alias("transactionId"), "repeat", "mark")
    numbered = running_sum_before(asked, "seq", F.col("mark").cast("bigint"), "number", slice_rows)
    return stage(numbered.withColumn("number", F.when(F.col("mark"), F.col("number") + F.lit(before) + 1)), "memory-marked")


def _last_walk(rounds: list[DataFrame]) -> DataFrame:
    """Of every slice the rows of its last walk."""
    if len(rounds) == 1:
        return rounds[0]
    tagged = reduce(DataFrame.unionByName, [r.withColumn("round", F.lit(k)) for k, r in enumerate(rounds)])
    last = tagged.groupBy("slice").agg(F.max("round").alias("round"))
    return tagged.join(last, ["slice", "round"], "left_semi").drop("round")


def dispositions(judged: DataFrame, most: int, dead: Column, duplicate: str, slice_rows: int | None = None) -> DataFrame:
    """``judged`` with ``outcome`` ``duplicate`` and no reason where a request repeats one of the last ``most`` marked ids."""
    found = marked(judged.select("seq", "transactionId", dead.alias("dead")), most, slice_rows=slice_rows).where("repeat").select(F.col("seq").alias("_repeat"))
    again = F.col("_repeat").isNotNull()
    return (judged.join(found, F.col("seq") == F.col("_repeat"), "left")
            .withColumn("outcome", F.when(again, F.lit(duplicate)).otherwise(F.col("outcome")))
            .withColumn("reason", F.when(~again, F.col("reason"))).drop("_repeat"))
