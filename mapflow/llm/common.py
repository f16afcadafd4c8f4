"""Reading the given tables, shared intermediate tables and the tokenizer files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.session import scratch_path

#: White space of the word and equality contracts: space, and tab to carriage return.
BLANKS = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends, lost executors cost nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def unused_name(docs: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `docs` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_columns(docs: DataFrame) -> list[Column]:
    """All columns by name, whatever characters the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordNumbers(dict):
    """Numbers of words in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def fold(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of an id as text, modulo a number of folds."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


FILTER_BITS = 24


def hash_bitmap(keys: DataFrame) -> Column:
    """A 2 MB bitmap of hash slots as one literal value, whatever the number of rows; `keys` has one column `hash`."""
    slot = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    words = keys.select(slot.alias("slot")).groupBy((F.col("slot") / 64).cast("long").alias("id")).agg(
        F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("bits")
    )
    every = keys.sparkSession.range(2**FILTER_BITS // 64).join(words, "id", "left")
    pair = F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))
    return every.agg(F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["bits"]).alias("bits")).scalar()


def may_hold(bitmap: Column, value: Column) -> Column:
    """Whether a hash is possibly among the bitmap's; never false for one that is."""
    slot = F.shiftrightunsigned(value, 64 - FILTER_BITS)
    word = F.get(bitmap, F.floor(slot / 64).cast("int"))
    return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))) != 0
