"""Functions a user registers for SQL text, as vectorized Python but for ``WordLengths``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import arrow_udtf, pandas_udf, udtf
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


@pandas_udf(StringType())
def plain_number(name: pd.Series) -> pd.Series:
    """``Customer#000000012`` as ``12``."""
    return name.str.split("#").str[1].astype("int64").astype("string")


@pandas_udf(DoubleType())
def sum_squares(value: pd.Series) -> float:
    return float((value * value).sum())


# A call per row: making Arrow batches of each call's few words costs more than the words.
@udtf(
    returnType=StructType().add("word", StringType()).add("letters", IntegerType()),
    useArrow=False,
)
class WordLengths:
    def eval(self, text: str) -> Iterator[tuple[str, int]]:
        for word in text.split(" "):
            yield word, len(word)


@arrow_udtf(returnType="p_partkey bigint, word string, letters int")
class WordsOfTable:
    """The words of a table (key, text), a batch at a time."""

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        words = pc.split_pattern(rows.column(1), " ")
        word = pc.list_flatten(words)
        key = rows.column(0).take(pc.list_parent_indices(words))
        yield pa.table({"p_partkey": key, "word": word, "letters": pc.utf8_length(word).cast(pa.int32())})


@udtf
class Sessions:
    """``sessions(TABLE(t), key, time, gap)``: rows of a key no more than ``gap`` seconds apart.

    The function asks for its table by key and in order of time, and holds one session at a time,
    however many rows a key has. Rows without a time are in no session.
    """

    @staticmethod
    def analyze(
        rows: AnalyzeArgument, key: AnalyzeArgument, time: AnalyzeArgument, gap: AnalyzeArgument
    ) -> AnalyzeResult:
        if not rows.isTable or not all(a.isConstantExpression for a in (key, time, gap)):
            raise ValueError("sessions takes a table, two column names and a number of seconds")
        of, at = rows.dataType[key.value], rows.dataType[time.value]
        schema = StructType().add(of.name, of.dataType).add("session", LongType())
        schema = schema.add("begin", at.dataType).add("end", at.dataType).add("n_rows", LongType())
        return AnalyzeResult(
            schema, partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(time.value)]
        )

    def __init__(self):
        self.open = None  # key, number, begin, end, rows

    def eval(self, rows: Row, key: str, time: str, gap: int) -> Iterator[tuple]:
        at = rows[time]
        if at is None:
            return
        if self.open is not None and (at - self.open[3]).total_seconds() <= gap:
            self.open[3], self.open[4] = at, self.open[4] + 1
            return
        number = 1
        if self.open is not None:
            yield tuple(self.open)
            number = self.open[1] + 1
        self.open = [rows[key], number, at, at, 1]

    def terminate(self) -> Iterator[tuple]:
        if self.open is not None:
            yield tuple(self.open)


def register_functions(spark: SparkSession) -> None:
    spark.udf.register("plain_number", plain_number)
    spark.udf.register("sum_squares", sum_squares)
    spark.udtf.register("word_lengths", WordLengths)
    spark.udtf.register("words_of_table", WordsOfTable)
    spark.udtf.register("sessions", Sessions)
