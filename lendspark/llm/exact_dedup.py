"""Exact duplicates by a tree merge of sorted digest runs.

Every document becomes a narrow row: a SHA-256 of its text without blanks, and two witnesses against a
collision (XXH64 and length of the same text). The rows are dealt into runs. Within a run, rows of one
digest are merged into one entry that keeps the best row and the number of rows; Spark sorts the runs on
both sides of each exchange, so that merging is one pass over sorted input. Then runs are merged in rounds,
`FAN` neighbouring runs at a time (three binomial rounds in one), until one is left. An entry is merged
with another only if the digest and both witnesses agree, in every round.

A text that fills a third of the corpus is one entry per run from the first exchange on, so that no task of
a later round sees more than `FAN` entries of it. Nothing but narrow rows is moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import BLANKS, cut, split_row, text_of

FAN_BITS = 3
FAN = 1 << FAN_BITS
ROUNDS = 3
RUNS = FAN**ROUNDS

KEY = ("digest", "witness", "chars")


def digests(df: DataFrame, row: Column, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document: row number, id, digest and witnesses, length of the original, run."""
    text = text_of(text_col)
    plain = F.regexp_replace(text, BLANKS, "")
    narrow = df.select(row.alias("row"), F.col(id_col).alias("id"), F.length(text).alias("length"), plain.alias("plain"))
    return narrow.select(
        "row",
        "id",
        "length",
        F.unhex(F.sha2("plain", 256)).alias("digest"),
        F.xxhash64("plain").alias("witness"),
        F.length("plain").alias("chars"),
        F.pmod(F.xxhash64("row"), F.lit(RUNS)).cast("int").alias("run"),
    )


def merge_runs(rows: DataFrame) -> DataFrame:
    """The entry of each digest after all rounds: (digest, witness, chars, best, group_size)."""
    # The longest original first, then the smallest id (null last), then the first of repeated rows.
    best = F.struct((-F.col("length")).alias("shorter"), F.col("id").isNull().alias("no_id"), "id", "row")
    runs = rows.groupBy(*KEY, "run").agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
    for _ in range(ROUNDS):
        pair = F.shiftright("run", FAN_BITS).alias("run")
        runs = runs.groupBy(*KEY, pair).agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size"))
    return runs.drop("run")


def decide(rows: DataFrame) -> DataFrame:
    """For every row of `digests`: its group's best row, the size of the group, and whether it stays."""
    joined = rows.join(merge_runs(rows), list(KEY))
    return joined.select(
        "row",
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of `df`, dropped ones too.

    Texts are equal when identical after deleting all blanks; a null text counts as empty, so null, empty
    and blank texts form one group. Of equal texts the row with the most code points in the original stays,
    then the smallest id, a null id last. Rows that repeat an id and a text are told apart: one stays.
    Other columns of `df` are not read, whatever their names. An empty table gives no rows.
    """
    stored = cut(digests(df, F.monotonically_increasing_id(), id_col, text_col))
    return decide(stored).drop("row")


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that `exact_duplicates` keeps, with all their columns; cases as there."""
    whole = split_row(df, [id_col, text_col])
    kept = decide(cut(digests(whole, F.col("_row"), "_0", "_1"))).where("kept")
    return whole.join(kept.select(F.col("row").alias("_row")), "_row", "left_semi").select("_doc.*")
