"""Packing by optimal length buckets.

The histogram of lengths over all rows is one aggregate. Dynamic programming over it chooses the bucket boundaries with the
least padding; every row goes to the smallest boundary that holds it, and batches of a token budget fill up inside each bucket.

The histogram has a cell per length that occurs, so the boundaries are the best there are. n different lengths need n squared / 2 tokens
of text, so even 100 TB have at most some millions, and usually some hundred thousand; the driver holds three numbers for each. With ``coarse``
lengths from 4,096 on share cells, 2,048 per doubling, and a boundary is the longest length of its cell.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.session import stage

BUCKETS = 8
BUDGET = 32_768
#: Candidate cuts compared at a time.
STEP = 1 << 20
WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text as its length in tokens; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cell(length: Column) -> Column:
    """Lower end of a length's cell: the twelve leading bits are kept."""
    drop = F.greatest(F.length(F.bin(length)) - 12, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", length, drop), drop)


def _row(best: np.ndarray, rows: np.ndarray, tokens: np.ndarray, top: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Least padding of the first j cells with one run more, and where that run begins, for every j.

    Ends are solved from far apart to close together: the best cut of one lies between those of its solved neighbours. The ends of
    one distance are solved at once, some ``STEP`` candidates at a time.
    """
    now, cut = np.full(m + 1, np.iinfo(np.int64).max // 4), np.zeros(m + 1, np.int64)
    apart = 1 << max(0, m.bit_length() - 1)
    while apart:
        ends = np.arange(apart, m + 1, 2 * apart)
        after = ends + apart
        low = np.where(ends > apart, cut[ends - apart], 0)
        high = np.minimum(np.where(after <= m, cut[np.minimum(after, m)], m - 1), ends - 1)
        many = np.append(0, np.cumsum(high - low + 1))
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(many, many[at] + STEP, "right")) - 1)
            size, head = many[at + 1:to + 1] - many[at:to], many[at:to] - many[at]
            i = np.arange(many[to] - many[at]) + np.repeat(low[at:to] - head, size)
            j = np.repeat(ends[at:to], size)
            cost = best[i] + top[j - 1] * (rows[j] - rows[i]) - (tokens[j] - tokens[i])
            least = np.minimum.reduceat(cost, head)
            first = np.flatnonzero(cost == np.repeat(least, size))
            owner = np.searchsorted(head, first, "right") - 1
            _, once = np.unique(owner, return_index=True)  # the earliest of equal ones
            now[ends[at:to]], cut[ends[at:to]] = least, i[first[once]]
            at = to
        apart //= 2
    return now, cut


def boundaries(count: np.ndarray, total: np.ndarray, top: np.ndarray, buckets: int) -> list[int]:
    """Boundaries of the best split of the cells, in ascending order, into at most ``buckets`` runs.

    Padding is ``top * count - total`` of each run. Among equally good splits the earlier cut wins. The cost is Monge, so
    the best cut moves only forward and each row of the table takes m log m steps.
    """
    m = len(count)
    rows, tokens = np.append(0, np.cumsum(count)), np.append(0, np.cumsum(total))
    best = np.full(m + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, m)):
        best, cut = _row(best, rows, tokens, top, m)
        cuts.append(cut)
    found, j = [], m
    for cut in reversed(cuts):
        found.append(int(top[j - 1]))
        j = int(cut[j])
    return found[::-1]


def pack(rows: DataFrame, length: Column, id_col: str = "doc_id", buckets: int = BUCKETS, budget: int = BUDGET,
         coarse: bool = False) -> DataFrame:
    """(doc_id, length, bucket, padded_length, batch, slot) for every row.

    Within a bucket rows are taken in order of their id (null first); ``batch`` counts from 0 in each bucket and holds as
    many rows as fit the budget at the padded length, at least one. Null lengths count as 0; rows of equal id are in order of length.
    An empty table gives an empty one. Other columns, whatever their names, are not read.
    """
    # written before the ranges are drawn, which reads the input twice
    narrow = stage(rows.select(F.col(id_col).alias("_id"), F.coalesce(length.cast("bigint"), F.lit(0).cast("bigint")).alias("length")), "measured")
    # ranges of ids, and of lengths where an id repeats: a bucket of any size is numbered range by range
    placed = stage(narrow.repartitionByRange("_id", "length").withColumn("_range", F.spark_partition_id()), "lengths")
    cells = (placed.groupBy((cell(F.col("length")) if coarse else F.col("length")).alias("c")).agg(F.count("*").alias("n"), F.sum("length").alias("s"), F.max("length").alias("top"))
             .orderBy("c").toArrow())
    ends = boundaries(*(cells[c].to_numpy().astype(np.int64) for c in ("n", "s", "top")), buckets) if cells.num_rows else []
    bucket = F.lit(0)
    for end in ends[:-1]:
        bucket = bucket + (F.col("length") > end).cast("int")
    padded = F.element_at(F.array(*[F.lit(e).cast("bigint") for e in ends or [0]]), F.col("bucket") + 1)
    known = placed.withColumn("bucket", bucket).withColumn("padded_length", padded)
    before = Window.partitionBy("_b").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    # a row per bucket and range
    counted = (known.groupBy(F.col("bucket").alias("_b"), F.col("_range").alias("_r")).agg(F.count("*").alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    within = Window.partitionBy("bucket", "_range").orderBy("_id", "length")
    rank = F.col("_before") + F.col("_place") - 1
    size = F.greatest(F.lit(1).cast("bigint"), F.expr(f"{budget}L div greatest(padded_length, 1L)"))
    return (known.withColumn("_place", F.row_number().over(within))
            .join(F.broadcast(counted), (F.col("bucket") == F.col("_b")) & (F.col("_range") == F.col("_r")))
            .withColumn("_rank", rank).withColumn("_size", size)
            .select(F.col("_id").alias(id_col), "length", "bucket", "padded_length",
                    F.expr("_rank div _size").alias("batch"), F.expr("cast(_rank % _size as int)").alias("slot")))


def oracle(buckets: int = BUCKETS, budget: int = BUDGET) -> str:
    """The same over ``documents`` in SQL."""
    steps = [f"""f1 as (select j, top * n - s as cost, [top] as ends from u)"""]
    for k in range(2, buckets + 1):
        steps.append(f"""f{k} as (select x.j, min({{'cost': x.cost, 'i': x.i, 'ends': x.ends}}) as b from (
            select u.j, f.cost + u.top * (u.n - p.n) - (u.s - p.s) as cost, f.j as i, list_append(f.ends, u.top) as ends
            from u join u p on p.j < u.j join {f'(select j, b.cost as cost, b.ends as ends from f{k - 1})' if k > 2 else 'f1'} f on f.j = p.j) x group by x.j)""")
    last = f"""ends as (select unnest(ends) as top, generate_subscripts(ends, 1) - 1 as bucket from (
        select coalesce({', '.join(f'(select b.ends from f{k} where j = (select max(j) from u))' for k in range(buckets, 1, -1))},
                        (select ends from f1 where j = (select max(j) from u))) as ends))"""
    return f"""with l as (
        select doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as length from documents),
      c as (select length as c, count(*) as n, sum(length)::bigint as s, length as top from l group by length),
      u as (select row_number() over (order by c) as j, top, (sum(n) over (order by c))::bigint as n, (sum(s) over (order by c))::bigint as s from c),
      {', '.join(steps)}, {last},
      k as (select l.*, (select min(bucket) from ends where top >= l.length)::int as bucket from l),
      r as (select k.*, e.top as padded_length, row_number() over (partition by k.bucket order by doc_id, length) - 1 as rank,
                   greatest(1, {budget} // greatest(e.top, 1)) as size from k join ends e on e.bucket = k.bucket)
      select doc_id, length, bucket, padded_length, (rank // size)::bigint as batch, (rank % size)::int as slot from r"""
