"""Token counts from flat token files.

A token file is nothing but token ids, one document after another, each ended by a separator; there is no index. Files are kept
as rows of equal blocks (file, block, data), so a block may hold many documents or a part of one. ``scan`` looks for separators
in each block by itself with one vectorised comparison, and a prefix sum over the blocks of a file, in two levels, turns them
into documents: how many tokens and separators lie before a block, and where its first document began.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultflow.session import stage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The id after the last one of the vocabulary ends a document.
SEPARATOR = 50256
BLOCK = 1 << 16
#: Blocks whose sums are added up together in the first level.
TOGETHER = 4096
#: Largest vocabulary file that is sent to the tasks.
MOST_BYTES = 64 << 20
PIECE = 1 << 20

# Fixed value: how this vocabulary's texts are split before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[int, object] = {}
_BETWEEN = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def vocabulary(spark: SparkSession, path: str = VOCABULARY) -> bytes:
    """The vocabulary file, which may be in any store that Spark reads; its size is checked before it is sent to tasks."""
    found = spark.read.format("binaryFile").load(path).where(F.col("length") <= MOST_BYTES).select("content").first()
    if found is None:
        raise ValueError(f"no vocabulary of at most {MOST_BYTES} bytes at {path}")
    return bytes(found[0])


def encoder(ranks: bytes):
    """The tokenizer of a vocabulary, made once per worker."""
    key = hash(ranks)
    if key not in _encoders:
        import tiktoken
        pairs = (line.split() for line in ranks.splitlines() if line)
        _encoders[key] = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
    return _encoders[key]


def encoded(text: str, enc) -> Iterator[np.ndarray]:
    """Token ids of a text, a bounded part at a time; parts begin at a space between letters, where no token spans."""
    at = 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + PIECE) if len(text) > at + PIECE else None
        to = cut.start() if cut else len(text)
        yield np.array(enc.encode_ordinary(text[at:to]), np.uint16)
        at = to


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str = VOCABULARY,
          block: int = BLOCK) -> None:
    """Tokenize ``docs`` into files of blocks, one file per partition.

    ``doc_ids`` beside a block names the documents that end in it, in order; the scan does not read it. Null texts are
    documents without tokens.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(docs.sparkSession, vocabulary_path))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, file = encoder(sent.value), TaskContext.get().partitionId()
        held, size, ended, number = [], 0, [], 0
        end = np.array([SEPARATOR], np.uint16)
        id_kind = None

        def filled(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, ended, number
            while size >= block or (last and size):
                flat = np.concatenate(held)
                held, size = [flat[block:]], max(0, size - block)
                own = [i for i, at in ended if at < block]
                ended = [(i, at - block) for i, at in ended if at >= block]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file], pa.int32()), pa.array([number], pa.int64()), pa.array([flat[:block].tobytes()], pa.binary()),
                     pa.array([own], pa.list_(id_kind))], ["file", "block", "data", "doc_ids"])
                number += 1

        for b in batches:
            id_kind = b.column(0).type
            for i, t in zip(b.column(0), b.column(1)):
                for part in (*encoded(t.as_py() or "", enc), end):
                    held.append(part)
                    size += len(part)
                    if part is end:
                        ended.append((i.as_py(), size - 1))
                    if size >= block:
                        yield from filled(False)
        yield from filled(True)

    kinds = f"file int, block bigint, data binary, doc_ids array<{id_type}>"
    (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, kinds)
     .write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path))


def scan(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = "uint16", together: int = TOGETHER) -> DataFrame:
    """(file, block, place, document, start, n_tokens, ended) for every document of token files given as blocks.

    ``document`` counts from 0 in a file and ``start`` is its first token; ``place`` counts the documents that end in the same
    block. Separators belong to no document; two in a row enclose a document without tokens. Tokens after the last separator of a
    file are a document with ``ended`` false, in the file's last block. Null data is an empty block; blocks of a file are in
    order of ``block`` and need not be numbered without gaps. An empty table gives an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.frombuffer(x.as_buffer() if x.is_valid else b"", dtype) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(x) for x in found], pa.int64()),
                 pa.array([np.flatnonzero(x == separator) for x in found], pa.list_(pa.int64()))], ["file", "block", "n", "ends"])

    file_type = blocks.schema["file"].dataType.simpleString()
    seen = stage(blocks.select("file", F.col("block").cast("bigint").alias("block"), "data")
                 .mapInArrow(run, f"file {file_type}, block bigint, n bigint, ends array<bigint>"), "separators")
    group = F.expr(f"block div {together}")
    inside = Window.partitionBy("file", "_g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_f").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    sums = (seen.groupBy(F.col("file").alias("_f"), group.alias("_h"))
            .agg(F.sum("n").alias("_n"), F.sum(F.size("ends").cast("bigint")).alias("_k"))
            .select("_f", "_h", F.coalesce(F.sum("_n").over(whole), none).alias("_n0"), F.coalesce(F.sum("_k").over(whole), none).alias("_k0")))
    based = (seen.withColumn("_g", group)
             .withColumn("_n1", F.coalesce(F.sum("n").over(inside), none)).withColumn("_k1", F.coalesce(F.sum(F.size("ends").cast("bigint")).over(inside), none))
             .join(sums, F.col("file").eqNullSafe(F.col("_f")) & (F.col("_g") == F.col("_h")))
             .withColumn("_base", F.col("_n0") + F.col("_n1")).withColumn("_before", F.col("_k0") + F.col("_k1"))
             .withColumn("_last", F.col("_base") + F.element_at("ends", -1)))
    based = stage(based.select("file", "block", "_g", "n", "ends", "_base", "_before",
                               F.when(F.size("ends") > 0, F.col("_last")).alias("_last")), "blocks")
    # the last separator before a block: within its group, else in an earlier group
    tops = (based.groupBy(F.col("file").alias("_f"), F.col("_g").alias("_h"))
            .agg(F.max("_last").alias("_top"), F.max("block").alias("_end"))
            .select("_f", "_h", F.max("_top").over(whole).alias("_top0"),
                    (F.max("_end").over(Window.partitionBy("_f")) == F.col("_end")).alias("_final")))
    last_block = Window.partitionBy("file", "_g").orderBy(F.desc("block"))
    opened = (based.withColumn("_top1", F.max("_last").over(inside)).withColumn("_nth", F.row_number().over(last_block))
              .join(tops, F.col("file").eqNullSafe(F.col("_f")) & (F.col("_g") == F.col("_h")))
              .withColumn("_open", F.coalesce("_top1", "_top0", F.lit(-1).cast("bigint")) + 1))
    at = F.transform("ends", lambda e: F.col("_base") + e)
    rest = F.col("_base") + F.col("n")
    tail = F.coalesce("_last", F.col("_open") - 1) + 1
    closes = F.when(F.col("_final") & (F.col("_nth") == 1) & (rest > tail), F.concat(at, F.array(rest))).otherwise(at)
    begins = F.concat(F.array("_open"), F.transform(at, lambda e: e + 1))
    return (opened.withColumn("_closes", closes).withColumn("_begins", begins)
            .select("file", "block", "_begins", "_before", F.size("ends").alias("_k"), F.posexplode("_closes").alias("place", "_close"))
            .select("file", "block", "place", (F.col("_before") + F.col("place")).alias("document"),
                    F.get("_begins", F.col("place")).alias("start"), (F.col("_close") - F.get("_begins", F.col("place"))).alias("n_tokens"),
                    (F.col("place") < F.col("_k")).alias("ended")))


def counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str = VOCABULARY,
           block: int = BLOCK) -> DataFrame:
    """(doc_id, file, document, start, n_tokens) of every row of ``docs``, written to token files at ``path`` and scanned."""
    write(docs, path, id_col, text_col, vocabulary_path, block)
    files = docs.sparkSession.read.parquet(path)
    names = files.select(F.col("file").alias("_f"), F.col("block").alias("_b"), F.posexplode("doc_ids").alias("_p", id_col))
    found = scan(files)
    return (found.join(names, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")) & (F.col("place") == F.col("_p")))
            .select(id_col, "file", "document", "start", "n_tokens"))
