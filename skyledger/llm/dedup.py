"""Exact dedup: counting quotient filters per partition, merged, then byte verification.

A text's fingerprint is the first 64 bits of the SHA-256 of its normalised
text. Every input partition builds counting quotient filters: the quotient (the
fingerprint's leading bits) names a slot range, the remainders stay sorted with
a count each. Filters of one range merge without loss by merging their sorted
remainders and adding counts. Only texts whose fingerprint counts above one
are compared byte by byte, by grouping on the normalised text itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import text as tx

REMAINDER_BITS = 52      # 2^12 slot ranges; a range of 30 billion texts holds 8 million remainders
BLOCK = 1_000_000        # fingerprints that a partition gathers before it emits its filter


def normal_text(column: str | Column) -> Column:
    """Each run of space and \\t..\\r as one space; null as empty."""
    col = F.col(column) if isinstance(column, str) else column
    return F.regexp_replace(F.coalesce(col, F.lit("")), tx.SPACE_SQL, " ")


def _filters(batches):
    """Counting quotient filters of a partition's fingerprints, one row per slot range."""
    def emit(parts):
        fp, count = np.unique(np.concatenate(parts).view(np.uint64), return_counts=True)
        slot = (fp >> np.uint64(REMAINDER_BITS)).astype(np.int32)
        rest = (fp & np.uint64((1 << REMAINDER_BITS) - 1)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(slot)) + 1
        return pd.DataFrame({"slot": slot[np.r_[0, cuts]],
                             "rest": [x.tobytes() for x in np.split(rest, cuts)],
                             "n": [x.astype(np.int32).tobytes() for x in np.split(count, cuts)]})

    held, size = [], 0
    for batch in batches:
        held.append(batch["fp"].to_numpy(np.int64))
        size += len(batch)
        if size >= BLOCK:
            yield emit(held)
            held, size = [], 0
    if size:
        yield emit(held)


def _merge(key, filters: pd.DataFrame) -> pd.DataFrame:
    """Merge one slot range's filters; the fingerprints counted more than once."""
    rest = np.concatenate([np.frombuffer(x, np.int64) for x in filters["rest"]])
    n = np.concatenate([np.frombuffer(x, np.int32) for x in filters["n"]]).astype(np.int64)
    order = np.argsort(rest, kind="stable")
    rest, n = rest[order], n[order]
    first = np.flatnonzero(np.r_[True, rest[1:] != rest[:-1]])
    total = np.add.reduceat(n, first)
    many = rest[first][total > 1].astype(np.uint64)
    return pd.DataFrame({"fp": (many | (np.uint64(key[0]) << np.uint64(REMAINDER_BITS))).view(np.int64)})


def fingerprint(sha: str = "text_sha256") -> Column:
    """The first 64 bits of a hexadecimal SHA-256 as a long."""
    return F.conv(F.substring(sha, 1, 16), 16, -10).cast("long")


def repeated_fingerprints(fps: DataFrame) -> DataFrame:
    """Fingerprints (column ``fp``) that occur more than once, from merged counting quotient filters."""
    filters = fps.select("fp").mapInPandas(_filters, "slot int, rest binary, n binary")
    return filters.groupBy("slot").applyInPandas(_merge, "fp long")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after replacing each white-space run by one
    space; null is the empty text, which is a text like any other. Of equal
    texts the smallest id stays; rows that also share the id keep one of them.
    A null id stays only when its group has no other. Other columns of
    ``docs`` are ignored; an empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), normal_text(text_col).alias("_t"))
    shas = base.select("doc_id", F.sha2("_t", 256).alias("text_sha256"))
    suspects = repeated_fingerprints(shas.select(fingerprint().alias("fp")))
    # Byte verification: grouping on the text compares its bytes; copies combine before the shuffle.
    groups = (
        base.withColumn("text_sha256", F.sha2("_t", 256)).withColumn("fp", fingerprint())
        .join(suspects, "fp", "left_semi")
        .groupBy("text_sha256", "_t").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("text_sha256", "keep_id", "group_size")
    )
    rows = shas.groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("_copies"))
    joined = rows.join(groups, "text_sha256", "left")
    lone = F.col("group_size").isNull()
    keep = F.when(lone, F.col("doc_id")).otherwise(F.col("keep_id"))
    each = F.explode(F.expr("sequence(1, cast(_copies as int))"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", "_copies").alias("group_size"),
        each.alias("_i"), "text_sha256",
    ).select("doc_id", "keep_id", "group_size",
             (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_i") == 1)).alias("kept"), "text_sha256")


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows equal in id and text, one."""
    key = tx.fresh(docs, "copy_key")
    name = lambda i, sha: F.concat_ws(":", sha, i)  # noqa: E731  a null id leaves the hash alone
    kept = exact_duplicates(docs, id_col, text_col).filter("kept").select(
        name(F.col("doc_id").cast("string"), F.col("text_sha256")).alias(key))
    marked = docs.withColumn(key, name(F.col(id_col).cast("long").cast("string"), F.sha2(normal_text(text_col), 256)))
    return marked.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
