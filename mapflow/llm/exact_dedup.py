"""Operator 6: exact deduplication by an extendible-hash index on shared files. Native: no Python on executors.

Two texts are equal when they are identical after deleting white space. A text's key is
a 64-bit hash of its normalised form; a bucket is named by the key's leading bits.

- *Pre-aggregation.* Rows are first reduced to one entry for each key and sha256, so a
  text with millions of copies is one entry.
- *Directory doubling.* Starting from one bucket, every bucket with more than `capacity`
  entries is split in two by the next bit, again and again. The end state does not
  depend on the order of insertion: a prefix's bucket is the shortest prefix that holds
  at most `capacity` entries. All depths are counted at once from one histogram.
- *Index on shared files.* Entries are written ordered by bucket and key; an owner task
  holds a range of keys.
- *Chaining.* Entries of one key form its chain. Every key that more than one row has
  met is checked on the bytes: those rows' normalised texts are compared, and each
  distinct text is a link of its own. A key met once needs no comparison.

Of equal texts the row with the most code points in the original text stays, then the
smallest doc_id. Defined results: a null text counts as empty; texts of white space only
are equal to the empty text; a row without doc_id loses to one that has it; rows that
repeat a doc_id and its text carry the same answer.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapflow.llm.common import BLANKS, hash_bitmap, may_hold, own_columns, stored, text_or_empty, unused_name

BUCKET_ENTRIES = 65_536
MOST_BITS = 24


def normalised(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def entries(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, key, text_sha256 and rank, which is larger for the row that stays."""
    plain = normalised(text_or_empty())
    points = F.length(text_or_empty()).cast("decimal(12,0)")
    bounded = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).cast("decimal(20,0)")
    unit = F.lit(str(2**64)).cast("decimal(20,0)")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(plain).alias("key"),
        F.sha2(plain.cast("binary"), 256).alias("text_sha256"),
        (points * unit - bounded).cast("decimal(38,0)").alias("rank"),
    )


def directory(index: DataFrame, capacity: int = BUCKET_ENTRIES) -> tuple[DataFrame, int]:
    """Bucket and depth for every key prefix of the deepest level, and that level's bits.

    The number of bits follows from the number of entries, so the histogram has a few
    rows for each bucket whatever the size.
    """
    n = max(1, index.count())
    bits = min(MOST_BITS, max(1, ceil(log2(max(1.0, n / capacity))) + 4))
    slot = F.shiftrightunsigned("key", 64 - bits)
    histogram = index.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    depths = F.explode(F.sequence(F.lit(0), F.lit(bits)))
    levels = histogram.select("slot", "n", depths.alias("depth")).withColumn("prefix", F.expr(f"shiftright(slot, {bits} - depth)"))
    filled = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("filled"))
    fits = (F.col("filled") <= capacity) | (F.col("depth") == bits)
    chosen = levels.join(filled, ["depth", "prefix"]).where(fits).groupBy("slot").agg(F.min("depth").alias("depth"))
    bucket = F.expr(f"shiftleft(shiftright(slot, {bits} - depth), {bits} - depth)").alias("bucket")
    return chosen.select("slot", bucket, "depth"), bits


def build_index(rows: DataFrame, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """The stored index of `entries`: bucket, key, text_sha256, keep_id and group_size, in key order."""
    reduced = rows.groupBy("key", "text_sha256").agg(
        F.max_by("doc_id", "rank").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    reduced = stored(reduced, "entries")
    slots, bits = directory(reduced, capacity)
    placed = reduced.withColumn("slot", F.shiftrightunsigned("key", 64 - bits)).join(slots, "slot").drop("slot", "depth")
    owned = placed.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "text_sha256")
    return stored(owned, "hash-index")


def compared(docs: DataFrame, index: DataFrame) -> DataFrame:
    """Chains that more than one row has met, with their texts compared byte by byte.

    Per link: key, text_sha256, group_size. Two different texts under one key and one
    sha256 are an error, never one group. A bitmap of fixed size keeps most texts of other
    keys out of the shuffle.
    """
    chains = stored(index.groupBy("key").agg(F.sum("group_size").alias("met")).where("met > 1").select("key"), "chains")
    plain = normalised(text_or_empty())
    links = (
        docs.select(F.xxhash64(plain).alias("key"), plain.alias("plain"))
        .where(may_hold(hash_bitmap(chains.select(F.col("key").alias("hash"))), F.col("key")))
        .join(chains, "key", "left_semi")
        .groupBy("key", "plain")
        .agg(F.count(F.lit(1)).alias("group_size"))
        .select("key", F.sha2(F.col("plain").cast("binary"), 256).alias("text_sha256"), "group_size")
        .groupBy("key", "text_sha256")
        .agg(F.count(F.lit(1)).alias("texts"), F.max("group_size").alias("group_size"))
    )
    clash = F.raise_error(F.concat(F.lit("different texts under one sha256: "), F.col("text_sha256"))).cast("long")
    return links.select("key", "text_sha256", F.when(F.col("texts") > 1, clash).otherwise(F.col("group_size")).alias("bytes_equal"))


def groups(docs: DataFrame, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(entries(docs), "rows")
    index = build_index(rows, capacity)
    links = compared(docs, index)
    classes = index.join(links, ["key", "text_sha256"], "left").select(
        "key", "text_sha256", "keep_id", F.coalesce("bytes_equal", "group_size").alias("group_size")
    )
    return rows.join(classes, ["key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def deduplicate(docs: DataFrame, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """The rows that stay, with all their columns; of rows that repeat one doc_id and text, any one.

    A bitmap of fixed size passes over most rows that are neither dropped nor repeated, so
    their texts need not be shuffled; the joins decide about the rest.
    """
    found = stored(groups(docs, capacity), "groups")
    sha = unused_name(docs, "text_sha")  # apart from whatever columns documents bring
    id_name, sha_name = unused_name(docs, "found_id"), unused_name(docs, "found_sha")
    named = lambda rows: rows.select(F.col("doc_id").alias(id_name), F.col("text_sha256").alias(sha_name))
    dropped = stored(named(found.where(~F.col("kept"))).distinct(), "dropped")
    again = stored(named(found.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")), "repeated")
    marked = docs.withColumn(sha, F.sha2(normalised(text_or_empty()).cast("binary"), 256))

    number = F.col("doc_id").cast("long")
    either = dropped.unionByName(again).select(F.xxhash64(id_name, sha_name).alias("hash"))
    possible = may_hold(hash_bitmap(either), F.xxhash64(number, F.col(sha)))
    untouched, rest = marked.where(~possible), marked.where(possible)

    same = number.eqNullSafe(F.col(id_name)) & (F.col(sha) == F.col(sha_name))
    kept = rest.join(dropped, same, "left_anti")
    once = kept.join(again, same, "left_anti")
    more = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", sha])
    return untouched.unionByName(once).unionByName(more).select(*own_columns(docs))
