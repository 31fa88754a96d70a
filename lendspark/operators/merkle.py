"""Merkle trees over the segments of the snapshot chains: verify one day without reading the others.

A chain shows tampering only to someone who hashes all of it again, and a chain whose end was cut off is still whole.
So every segment of a product's chain becomes a leaf, in order, of a tree that only grows to the right (a Merkle
mountain range): its perfect subtrees are the *peaks*, one for each binary digit of the number of leaves, and the hash over the
peaks is the *root*. After every batch one narrow *head* per product is signed and stored: batch, number of leaves and rows,
peaks and root.

* Verifying batch n reads the rows of batch n and two heads. The peaks of head n-1 and the leaves worked out again from
  the stored rows must give the root of head n. What the batch lacks, at its end too, changes a leaf or the number of leaves.
* Verifying everything works out all leaves again and compares them with the stored ones and with the last head.
* A segment is shown to be part of a root by its siblings on the way up: O(log n) hashes (`proofs`, `proven`).

Whoever can rewrite every table still cannot sign a head: the key stays outside. A head that was taken away together
with its batch is missed by whoever knows the number of the last batch (`last_batch`).
"""

from __future__ import annotations

import hashlib
import hmac
import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.operators.audit import rehashed, segment_digests
from lendspark.operators.skew import small

_PEAK = "struct<level:int,at:bigint,hash:string>"
LEAVES = "product string, batch bigint, at bigint, segment bigint, rows bigint, hash string"
NODES = "product string, batch bigint, level int, at bigint, hash string"
HEADS = f"product string, batch bigint, leaves bigint, rows bigint, peaks array<{_PEAK}>, root string, signature string"

FORGED_HEAD = "forged_head"
SEGMENT_ALTERED = "segment_altered"
SEGMENT_MISSING = "segment_missing"
SEGMENT_ADDED = "segment_added"
ROOT_MISMATCH = "root_mismatch"
HEAD_MISSING = "head_missing"

Peak = tuple[int, int, str]


def _parent(left: str, right: str) -> str:
    return hashlib.sha256(f"node:{left}{right}".encode()).hexdigest()


def root_of(peaks: Iterable[Peak]) -> str:
    """The hash over the peaks, from the smallest to the largest."""
    root = ""
    for _, _, peak in sorted(peaks):
        root = _parent(peak, root) if root else peak
    return root


def grow(peaks: Iterable[Peak], leaves: Iterable[str]) -> tuple[list[Peak], list[Peak]]:
    """(new nodes, peaks afterwards) of appending leaves to the tree with these peaks."""
    stack = sorted(peaks, reverse=True)
    size = sum(1 << level for level, _, _ in stack)
    nodes: list[Peak] = []
    for at, leaf in enumerate(leaves, size):
        node = (0, at, leaf)
        nodes.append(node)
        while stack and stack[-1][0] == node[0]:
            left = stack.pop()
            node = (node[0] + 1, node[1] // 2, _parent(left[2], node[2]))
            nodes.append(node)
        stack.append(node)
    return nodes, stack


# --- leaves and nodes ---------------------------------------------------------------------------


def leaves(index: DataFrame, bodies: DataFrame, batch: int | None = None) -> DataFrame:
    """(product, batch, segment, rows, hash): every segment hashed again from its stored rows, or those of one batch.

    A leaf covers each row's place, its hash in the index, and body and pointer as they are now; a body that is gone counts as such.
    """
    if batch is not None:
        index, bodies = (df.where(F.col("batch") == batch) for df in (index, bodies))
    rows = rehashed(index, bodies)
    digest = F.sha2(F.concat_ws("|", "seq", "decision_id", "listed", F.coalesce("_rehashed", F.lit("gone")), F.coalesce("stored", F.lit("gone"))), 256)
    # Rows are counted on the way: a sum of its own would have index and bodies meet twice.
    placed = rows.select("product", "segment", "batch", "seq", digest.alias("_digest")).repartition("product", "segment")
    text = F.concat_ws("|", F.lit("leaf"), "product", "segment", "rows", "digest")
    return segment_digests(placed).select("product", "batch", "segment", "rows", F.sha2(text, 256).alias("hash"))


def _signed(key: bytes, product: str, batch: int, count: int, rows: int, peaks: list[Peak], root: str) -> str:
    text = json.dumps([product, batch, count, rows, [list(p) for p in sorted(peaks)], root], separators=(",", ":"))
    return hmac.new(key, text.encode(), hashlib.sha256).hexdigest()


def latest_heads(heads: DataFrame, before: int | None = None) -> DataFrame:
    """The head of every product, or the last one before a batch."""
    known = heads if before is None else heads.where(F.col("batch") < before)
    return known.groupBy("product").agg(F.max_by(F.struct(*heads.columns), "batch").alias("h")).select("h.*")


def _with_peaks(new: DataFrame, before: DataFrame) -> DataFrame:
    """New leaves in their order, numbered on from the tree that is there, beside its peaks and rows."""
    known = before.select("product", F.col("leaves").alias("_size"), F.col("rows").alias("_rows"), F.col("peaks").alias("_peaks"))
    place = F.row_number().over(Window.partitionBy("product").orderBy("segment")) - 1
    joined = new.join(small(known), "product", "left")
    return joined.withColumn("at", (F.coalesce("_size", F.lit(0).cast("long")) + place).cast("long"))


def append(new: DataFrame, before: DataFrame, key: bytes) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(leaves, nodes, heads) to store for a batch: `new` from `leaves`, `before` from `latest_heads`.

    A product's part is one row per segment of the batch and the peaks of its tree, however long its history.
    """

    def grown(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        first = group.iloc[0]
        old = [] if first["_peaks"] is None else [(int(p["level"]), int(p["at"]), p["hash"]) for p in first["_peaks"]]
        nodes, peaks = grow(old, group["hash"])
        product, batch, root = first["product"], int(group["batch"].max()), root_of(peaks)
        count = sum(1 << level for level, _, _ in peaks)
        rows = int(group["rows"].sum()) + (0 if pd.isna(first["_rows"]) else int(first["_rows"]))
        listed = [{"level": level, "at": at, "hash": node} for level, at, node in peaks]
        head = (product, batch, count, rows, listed, root, _signed(key, product, batch, count, rows, peaks, root))
        lines = [(product, batch, level, at, node, *[None] * 5) for level, at, node in nodes]
        lines.append((product, batch, None, None, None, *head[2:]))
        return pd.DataFrame(lines, columns=["product", "batch", "level", "at", "hash", "leaves", "rows", "peaks", "root", "signature"])

    both = f"{NODES}, {HEADS.removeprefix('product string, batch bigint, ')}"
    numbered = _with_peaks(new, before)
    made = numbered.groupBy("product").applyInPandas(grown, both)
    nodes = made.where("level IS NOT NULL").select("product", "batch", "level", "at", "hash")
    heads = made.where("level IS NULL").select("product", "batch", "leaves", "rows", "peaks", "root", "signature")
    return numbered.select("product", "batch", "at", "segment", "rows", "hash"), nodes, heads


# --- verification -------------------------------------------------------------------------------


def _peaks(row) -> list[Peak]:
    return [(p["level"], p["at"], p["hash"]) for p in row["peaks"]]


def _genuine(row, key: bytes) -> bool:
    peaks = _peaks(row)
    signed = _signed(key, row["product"], row["batch"], row["leaves"], row["rows"], peaks, row["root"])
    return hmac.compare_digest(signed, row["signature"] or "") and root_of(peaks) == row["root"]


_ISSUES = "product string, batch bigint, segment bigint, kind string"


def _compared(now: DataFrame, stored: DataFrame) -> DataFrame:
    """Segments whose leaf is not what was stored."""
    was = stored.select("product", "segment", F.col("batch").alias("_batch"), F.col("hash").alias("_was"))
    joined = now.join(was, ["product", "segment"], "full")
    kind = (
        F.when(F.col("hash").isNull(), SEGMENT_MISSING).when(F.col("_was").isNull(), SEGMENT_ADDED).when(F.col("hash") != F.col("_was"), SEGMENT_ALTERED)
    )
    found = joined.select("product", F.coalesce("_batch", "batch").alias("batch"), "segment", kind.alias("kind"))
    return found.where(F.col("kind").isNotNull())


def _head_issues(spark: SparkSession, found: list[tuple]) -> DataFrame:
    return spark.createDataFrame(found, _ISSUES)


def _roots(numbered: DataFrame) -> dict[str, str]:
    """The root of each product's tree after the leaves of `_with_peaks`; a row per product comes to the driver."""

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        old = group.iloc[0]["_peaks"]
        peaks = [] if old is None else [(int(p["level"]), int(p["at"]), p["hash"]) for p in old]
        return pd.DataFrame({"product": [group.iloc[0]["product"]], "root": [root_of(grow(peaks, group["hash"])[1])]})

    return {r["product"]: r["root"] for r in numbered.groupBy("product").applyInPandas(fold, "product string, root string").collect()}


def verify_batch(index: DataFrame, bodies: DataFrame, stored: DataFrame, heads: DataFrame, batch: int, key: bytes) -> DataFrame:
    """Issues of one batch: (product, batch, segment, kind). Reads the batch, its leaves (`stored`) and two heads per product.

    An issue of a whole product has no segment. That all batches verify says the same as `verify_all`.
    """
    spark = index.sparkSession
    ends = {r["product"]: r for r in heads.where(F.col("batch") == batch).collect()}
    before = latest_heads(heads, batch)
    starts = {r["product"]: r for r in before.collect()}
    found = [(r["product"], r["batch"], None, FORGED_HEAD) for r in (*ends.values(), *starts.values()) if not _genuine(r, key)]
    now = small(leaves(index, bodies, batch))
    roots = _roots(_with_peaks(now, before))
    found += [(product, batch, None, HEAD_MISSING) for product in roots if product not in ends]
    found += [(product, batch, None, ROOT_MISMATCH) for product, head in ends.items() if roots.get(product) != head["root"]]
    return _compared(now, stored.where(F.col("batch") == batch)).unionByName(_head_issues(spark, found))


def verify_all(index: DataFrame, bodies: DataFrame, stored: DataFrame, heads: DataFrame, key: bytes, last_batch: int | None = None) -> DataFrame:
    """Issues of the whole history: (product, batch, segment, kind). `last_batch` is the number an auditor remembers."""
    spark = index.sparkSession
    now = small(leaves(index, bodies))
    ends = {r["product"]: r for r in latest_heads(heads).collect()}
    found = [(r["product"], r["batch"], None, FORGED_HEAD) for r in ends.values() if not _genuine(r, key)]
    roots = _roots(_with_peaks(now, heads.limit(0)))
    found += [(product, None, None, HEAD_MISSING) for product in roots if product not in ends]
    found += [(product, head["batch"], None, ROOT_MISMATCH) for product, head in ends.items() if roots.get(product) != head["root"]]
    if last_batch is not None:
        found += [(product, last_batch, None, HEAD_MISSING) for product, head in ends.items() if head["batch"] < last_batch]
    return _compared(now, stored).unionByName(_head_issues(spark, found))


# --- proofs of inclusion ------------------------------------------------------------------------


def proofs(nodes: DataFrame, leaf: DataFrame, heads: DataFrame) -> DataFrame:
    """(product, at, hash, path, peaks, root) of the leaves (product, at, hash) under the latest head of their product.

    `path` holds the siblings on the way from the leaf to its peak, lowest first: their level, and whether they stand left.
    """
    ends = latest_heads(heads).select("product", "leaves", "peaks", "root")
    own = leaf.join(small(ends), "product").where(F.col("at") < F.col("leaves"))
    # The peak above a leaf is the one whose leaves reach beyond it; a level below it, every ancestor has a sibling.
    above = F.filter("peaks", lambda p: F.call_function("shiftright", F.col("at"), p["level"]) == p["at"])
    height = F.element_at(above, 1)["level"]
    levels = F.when(height > 0, F.sequence(F.lit(0), height - 1)).otherwise(F.array().cast("array<int>"))
    steps = own.withColumn("level", F.explode_outer(levels)).withColumn(
        "beside", F.call_function("shiftright", F.col("at"), F.col("level")).bitwiseXOR(F.lit(1))
    )
    siblings = nodes.select("product", "level", F.col("at").alias("beside"), F.col("hash").alias("sibling"))
    met = steps.join(siblings, ["product", "level", "beside"], "left")
    step = F.struct("level", (F.col("beside") % 2 == 0).alias("is_left"), F.col("sibling").alias("hash"))
    path = F.array_sort(F.filter(F.collect_list(step), lambda s: s["level"].isNotNull()))
    return met.groupBy("product", "at", "hash").agg(path.alias("path"), F.first("peaks").alias("peaks"), F.first("root").alias("root"))


def proven(proof: DataFrame) -> DataFrame:
    """The proofs with `holds`: whether leaf and path lead to a peak of the root."""

    def node(left, right):
        return F.sha2(F.concat(F.lit("node:"), left, right), 256)

    top = F.aggregate("path", F.col("hash"), lambda acc, s: F.when(s["is_left"], node(s["hash"], acc)).otherwise(node(acc, s["hash"])))
    ordered = F.array_sort("peaks")
    bagged = F.aggregate(ordered, F.lit(""), lambda acc, p: F.when(acc == "", p["hash"]).otherwise(node(p["hash"], acc)))
    is_peak = F.exists("peaks", lambda p: (p["hash"] == top) & (p["level"] == F.size("path")))
    return proof.withColumn("holds", F.coalesce(is_peak & (bagged == F.col("root")), F.lit(False)))

