"""Turn a table into a stream that arrives in several pieces, in order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow.session import new_folder
from vaultflow.sources.streams import file_stream

# A range lies in few files of the table; written in files of so many rows, a piece is read by all tasks that there are.
FILE_ROWS = 50_000


def replay(table: DataFrame, order: str, job: Callable[[DataFrame], DataFrame], pieces: int = 3) -> DataFrame:
    """Let ``table`` arrive in ``pieces`` ranges of ``order`` and run ``job`` after each arrival.

    The job resumes from its checkpoint every time. Returns what it gave after the last piece.
    """
    folder = new_folder(table.sparkSession, "replay")
    low, high = table.agg(F.min(order), F.max(order)).first()
    width = (high - low) // pieces + 1
    result = None
    for i in range(pieces):
        start = low + i * width
        piece = table.where((F.col(order) >= start) & (F.col(order) < start + width))
        piece.write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{folder}/piece-{i}")
        result = job(file_stream(table.sparkSession, f"{folder}/*", table.schema))
    return result
