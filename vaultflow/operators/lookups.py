"""Joins of a large fact table with a table that has one row per key, and joins on keys that may be hot."""

from __future__ import annotations

from copy import copy

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultflow.session import stage

# A table is broadcast only when its measured size is at most this many bytes.
BROADCAST_BYTES = 32 << 20
# A key with more facts than this is spread over several tasks, one per so many facts.
SPREAD_ROWS = 1_000_000


def measured_bytes(df: DataFrame) -> int:
    """Size of a table: the lengths of its texts, 16 bytes for any other plain value, and nested values as JSON."""
    fixed, lengths = 0, []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            fixed += 8
            lengths.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            lengths.append(F.octet_length(F.to_json(F.struct(c), {"ignoreNullFields": "false"})))
        else:
            fixed += 16
    width = F.lit(fixed).cast("bigint")
    for n in lengths:
        width = width + n
    return df.agg(F.sum(width)).first()[0] or 0


class Lookup:
    """A table with a unique key, measured once to decide how it may be joined."""

    def __init__(self, df: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES, spread_rows: int = SPREAD_ROWS):
        self.df = df
        self.key = key
        self.spread_rows = spread_rows
        self.small = measured_bytes(df) <= broadcast_bytes

    def only(self, *columns: str | Column) -> "Lookup":
        """The same keys with other, no wider columns, not measured again."""
        narrow = copy(self)
        narrow.df = self.df.select(self.key, *columns)
        return narrow


def hot_table(facts: DataFrame, keys: list[Column], names: list[str], rows: int) -> DataFrame | None:
    """(names, _salts) of the keys with more than ``rows`` facts, a salt for each ``rows`` of them; None if there are none.

    There are fewer such keys than facts / ``rows``. The table is written, and sent to the tasks only if its size was
    measured to be small. Counting adds up before its shuffle.
    """
    counted = (facts.groupBy(*[k.alias(n) for k, n in zip(keys, names)]).agg(F.count("*").alias("n"))
               .where(F.col("n") > rows).where(" and ".join(f"{n} is not null" for n in names))
               .select(*names, F.ceil(F.col("n") / rows).cast("bigint").alias("_salts")))
    hot = stage(counted, "hot-keys")
    if hot.isEmpty():
        return None
    return F.broadcast(hot) if measured_bytes(hot) <= BROADCAST_BYTES else hot


def with_salt(facts: DataFrame, keys: list[Column], hot: DataFrame | None, names: list[str], spread_by: Column,
              out: str = "_salt") -> DataFrame:
    """Add the salt of every fact: a hot key's facts are dealt by ``spread_by``, facts without a key to anywhere."""
    missing = keys[0].isNull()
    for k in keys[1:]:
        missing = missing | k.isNull()
    anywhere = F.xxhash64(spread_by, F.lit(out))
    none = F.lit(0).cast("bigint")
    if hot is None:
        return facts.withColumn(out, F.when(missing, anywhere).otherwise(none))
    match = keys[0] == F.col(names[0])
    for k, n in zip(keys[1:], names[1:]):
        match = match & (k == F.col(n))
    return (facts.join(hot, match, "left")
            .withColumn(out, F.when(missing, anywhere).when(F.col("_salts").isNotNull(), F.pmod(anywhere, F.col("_salts"))).otherwise(none))
            .drop(*names, "_salts"))


def with_copies(table: DataFrame, keys: list[Column], hot: DataFrame | None, names: list[str], out: str = "_copy") -> DataFrame:
    """A copy of each row for every salt that facts of its key may have."""
    one = F.lit(0).cast("bigint")
    if hot is None:
        # always 0, but no constant: Spark would not deal facts by their salt, and all without a key would come to one task
        return table.withColumn(out, F.pmod(F.xxhash64(*keys), one + 1))
    match = keys[0] == F.col(names[0])
    for k, n in zip(keys[1:], names[1:]):
        match = match & (k == F.col(n))
    return (table.join(hot, match, "left")
            .withColumn(out, F.explode(F.sequence(one, F.coalesce(F.col("_salts") - 1, one)))).drop(*names, "_salts"))


def lookup_join(facts: DataFrame, lookup: Lookup, fact_key: str, alias: str,
                how: str = "left", spread_by: str = "seq", counted: DataFrame | None = None) -> DataFrame:
    """``facts`` plus a struct column ``alias`` with the matching row of ``lookup``.

    A small table is broadcast, so facts do not move. For a large one the facts of each key are counted: only the lookup rows
    of hot keys are copied, as often as their facts need tasks, and facts without a key are dealt out evenly. ``left_anti`` keeps
    facts without a match and adds no column. A table that was measured as large is never broadcast, whatever Spark takes its size for:
    such a guess goes by compressed files, and each task then holds the whole table. ``counted`` has the keys of
    ``facts`` at least as often, for counting them without what made ``facts``.
    """
    table = lookup.df.select(F.col(lookup.key).alias("_key"), F.struct("*").alias(alias))
    if how == "left_anti":
        table = table.select("_key")
    if lookup.small:
        return facts.join(F.broadcast(table), F.col(fact_key) == F.col("_key"), how).drop("_key")
    hot = hot_table(facts if counted is None else counted, [F.col(fact_key)], ["_hot"], lookup.spread_rows)
    salted = with_salt(facts, [F.col(fact_key)], hot, ["_hot"], F.col(spread_by))
    copies = with_copies(table, [F.col("_key")], hot, ["_hot"])
    match = (F.col(fact_key) == F.col("_key")) & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies.hint("merge"), match, how).drop("_key", "_salt", "_copy")
