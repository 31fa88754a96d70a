"""Tamper-evident decision snapshots: minimised vectors, hash chains, verification and replay.

Every snapshot holds the hash of the one before it, so that one product's snapshots form a chain from
a fixed genesis hash. Hashing along a chain is serial by nature; to spread it, every batch is dealt into
`shards` segments by the customer, whatever its size. Within a segment the chain is folded row by row; the
first row of a later segment points to an anchor instead, the hash of the previous anchor and of the
previous segment's contents. All anchors are known before any fold starts, so segments run in parallel,
while every row still depends on all rows before it. One shard is a plain chain. A long segment is counted by
ranges of decisions and hashed in blocks of bounded size one after the other, so that writing it takes no task
that holds all its rows; the number of shards is stored with every row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark import schemas
from lendspark.config import GENESIS_HASH, PII_FIELDS, PIPELINE_VERSION
from lendspark.functions.canonical import canonical_json, sha256
from lendspark.functions.text import iso_timestamp, pii_token
from lendspark.operators.packs import PACKS, RulePack, evaluate_version
from lendspark.operators.skew import small
from lendspark.operators.vectors import VECTOR_COLUMNS
from lendspark.session import cut, discard_later, scratch_path

# Segments per product and batch: as many tasks can hash at once. A property of the stored chain, not of its size.
SHARDS = 32

# Rows of a segment that one task hashes at a time; a longer segment takes several steps, each from the last hash of the one before.
BLOCK_ROWS = 250_000

HASH_MISMATCH = "hash_mismatch"
CHAIN_BREAK = "chain_break"
VECTOR_MISMATCH = "vector_mismatch"
MISSING_FILE = "missing_file"

# Keys of a snapshot body before and after the pointer to the previous snapshot, in sorted order.
_BEFORE = (
    "decision_id", "decision_ts", "emirates_id", "engine_version", "feature_vector_path",
    "feature_vector_sha256", "outcome", "pipeline_version",
)
_AFTER = ("product", "reason_codes", "rule_pack_version")
_PREV = "prev_snapshot_sha256"
_THIS = "this_snapshot_sha256"


# --- minimised vectors --------------------------------------------------------------------------


def tokenise(vectors: DataFrame) -> DataFrame:
    """Personal fields replaced by deterministic tokens; the Emirates ID stays."""
    return vectors.withColumns({field: pii_token(F.col(field)) for field in PII_FIELDS})


# Fixed: these flags are hashed as 0 and 1, all others as false and true.
_AS_NUMBERS = ("had_overdue_before", "is_new_user", "payment_order_flag")


def vector_json(vectors: DataFrame) -> Column:
    """Canonical JSON of a vector's columns, timestamps as UTC text."""
    fields = {c: F.col(c) for c in VECTOR_COLUMNS}
    fields["as_of_ts"] = iso_timestamp(F.col("as_of_ts"))
    fields |= {c: F.col(c).cast("int") for c in _AS_NUMBERS}
    return canonical_json(fields, doubles={name for name, kind in vectors.dtypes if kind == "double"})


def _with_stored_fields(vectors: DataFrame) -> tuple[DataFrame, Callable[[str], Column]]:
    """(feature_vector_sha256 and a column per field) of stored texts, and how to name a field; flags may be numbers or truth values.

    The fields come out of a generator, which parses a text once. Taken out of a struct, whether read or rebuilt by
    `withField`, they are split by the optimiser into a parse for every field that is read.
    """
    as_text = schemas.VECTOR
    for flag in _AS_NUMBERS:
        as_text = as_text.replace(f"{flag} boolean", f"{flag} string")
    names = [field.split()[0] for field in schemas.VECTOR.split(", ")]
    fields = F.inline(F.array(F.from_json("json", as_text))).alias(*[f"_v_{name}" for name in names])

    def field(name: str) -> Column:
        return F.col(f"_v_{name}").cast("boolean") if name in _AS_NUMBERS else F.col(f"_v_{name}")

    return vectors.select(F.col("sha256").alias("feature_vector_sha256"), fields), field


def hashed_vectors(decided: DataFrame) -> DataFrame:
    """The rows with their minimised vector as `json` and its hash as `feature_vector_sha256`."""
    minimised = tokenise(decided)
    return minimised.withColumn("json", vector_json(minimised)).withColumn(
        "feature_vector_sha256", sha256(F.col("json"))
    )


def vector_store_rows(hashed: DataFrame) -> DataFrame:
    """Distinct vectors for the content-addressed store (prefix, sha256, json)."""
    return hashed.select(
        F.col("feature_vector_sha256").alias("sha256"),
        "json",
        F.substring("feature_vector_sha256", 1, 2).alias("prefix"),
    ).dropDuplicates(["sha256"])


def new_vectors(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows whose content the store does not hold yet."""
    return rows.join(stored.select("prefix", "sha256"), ["prefix", "sha256"], "left_anti")


# --- writing chains -----------------------------------------------------------------------------


def _segment_of(shards: int) -> Column:
    """A customer's segment within the batch. Customers are distinct within a product, so segments
    are of like size whatever the data."""
    bits = F.conv(F.substring(F.sha2("emirates_id", 256), 1, 8), 16, 10).cast("bigint")
    return F.pmod(bits, F.lit(shards))


def _bodies(decided: DataFrame) -> DataFrame:
    """Snapshot bodies without the two chain hashes, as text around the pointer."""
    rows = hashed_vectors(decided).select(
        "decision_id",
        "emirates_id",
        "product",
        iso_timestamp(F.col("decision_ts")).alias("decision_ts"),
        F.date_format("decision_ts", "yyyy-MM-dd").alias("dt"),
        "outcome",
        "reason_codes",
        "engine_version",
        "rule_pack_version",
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        "feature_vector_sha256",
        F.concat_ws(
            "/", F.lit("audit/feature_vectors"), F.substring("feature_vector_sha256", 1, 2),
            F.concat("feature_vector_sha256", F.lit(".json")),
        ).alias("feature_vector_path"),
    )
    return _with_text(rows)


def _with_text(rows: DataFrame) -> DataFrame:
    """Canonical body text split at the pointer's value, and the digest of all but the pointer.

    The outer brackets are trimmed off: before the last and after the first there is a quote or `null`, never another one.
    """
    head = canonical_json({c: F.col(c) for c in _BEFORE})
    tail = canonical_json({c: F.col(c) for c in _AFTER})
    return rows.select(
        "*",
        F.concat(F.rtrim(head, F.lit("}")), F.lit(f',"{_PREV}":"')).alias("_head"),
        F.concat(F.lit('",'), F.ltrim(tail, F.lit("{"))).alias("_tail"),
    ).withColumn("_digest", F.sha2(F.concat("_head", "_tail"), 256))


_DIGESTS = "product string, segment bigint, batch bigint, rows bigint, digest string"


def _fold_digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of a segment's digests in their order, with its rows and their last batch; one row per segment."""
    columns = [c.split()[0] for c in _DIGESTS.split(", ")]
    at, batch, rows, state = None, 0, 0, hashlib.sha256()
    for frame in frames:
        done = []
        for product, segment, own, digest in zip(frame["product"], frame["segment"], frame["batch"], frame["_digest"]):
            if (product, segment) != at:
                if at is not None:
                    done.append((*at, batch, rows, state.hexdigest()))
                at, batch, rows, state = (product, segment), own, 0, hashlib.sha256()
            batch, rows = own if batch != batch else max(batch, own), rows + 1  # an unknown batch comes as NaN
            state.update(digest.encode())
        yield pd.DataFrame(done, columns=columns)
    if at is not None:
        yield pd.DataFrame([(*at, batch, rows, state.hexdigest())], columns=columns)


def segment_digests(rows: DataFrame, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """(product, segment, batch, rows, digest) of rows (product, segment, batch, _digest) that are dealt by product and segment already."""
    ordered = rows.sortWithinPartitions("product", "segment", *order).select("product", "segment", "batch", "_digest")
    return ordered.mapInPandas(_fold_digests, _DIGESTS)


def _anchored(segments: DataFrame) -> DataFrame:
    """The anchor of each segment: (product, segment, anchor).

    `segments` has one narrow row per segment: product, segment, digest, start (the chain's head).
    """

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        product, anchor, digest = None, "", ""
        for frame in frames:
            anchors = []
            for row in frame.itertuples(index=False):
                if row.product != product:
                    product, anchor = row.product, row.start
                else:
                    anchor = hashlib.sha256((anchor + digest).encode()).hexdigest()
                digest = row.digest
                anchors.append(anchor)
            yield frame[["product", "segment"]].assign(anchor=anchors)

    ordered = segments.repartition("product").sortWithinPartitions("product", "segment")
    return ordered.mapInPandas(fold, "product string, segment bigint, anchor string")


_CHAINED = f"_row bigint, product string, segment bigint, seq bigint, {_PREV} string, {_THIS} string"


def _fold_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Number and hash along each segment; place and hash carry over between Arrow batches."""
    at, seq, last = None, 0, ""
    for frame in frames:
        places, previous, current = [], [], []
        rows = frame[["product", "segment", "anchor", "done", "_head", "_tail"]].itertuples(index=False, name=None)
        for product, segment, anchor, done, head, tail in rows:
            if (product, segment) != at:
                at, seq, last = (product, segment), done, anchor
            seq += 1
            places.append(seq)
            previous.append(last)
            last = hashlib.sha256((head + last + tail).encode("utf-8")).hexdigest()
            current.append(last)
        out = frame[["_row", "product", "segment"]].copy()
        out["seq"], out[_PREV], out[_THIS] = places, previous, current
        yield out


# The order along a segment; rows of the same decision stand as they are stored.
_ALONG = ("decision_id", "_row")


def _folded(texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """Places and hashes of rows (_row, product, segment, decision_id, _head, _tail) that follow on the `done` rows before
    them in their segment, of which the last has the hash `anchor`."""
    dealt = texts.join(anchors, ["product", "segment"]).repartition("product", "segment")
    return dealt.sortWithinPartitions("product", "segment", *_ALONG).mapInPandas(_fold_rows, _CHAINED)


def _folded_in_blocks(texts: DataFrame, anchors: DataFrame, longest: int, block_rows: int) -> DataFrame:
    """As `_folded`, for segments of up to `longest` rows: a step hashes the next `block_rows` of every segment that has as many."""
    path = scratch_path(texts.sparkSession, "blocks")
    discard_later(path)
    block = F.floor((F.col("seq") - 1) / block_rows)
    places = _numbered(texts.select("_row", "product", "segment", "decision_id")).select("_row", block.alias("_block"))
    blocks = texts.join(places, "_row").repartition("product", "segment", "_block")
    blocks.write.partitionBy("_block").parquet(path)
    stored = texts.sparkSession.read.schema(blocks.schema).parquet(path)
    steps = []
    for i in range(-(-longest // block_rows)):
        steps.append(cut(_folded(stored.where(F.col("_block") == i).drop("_block"), anchors)))
        ends = steps[-1].groupBy("product", "segment").agg(F.max_by(_THIS, "seq").alias("anchor"), F.max("seq").alias("done"))
        anchors = small(ends)
    return reduce(DataFrame.unionByName, steps)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows (_row, product, segment, decision_id) with `seq`, their place in the segment. A task counts a range of them,
    and goes on from the rows that the ranges before hold of a segment."""
    order = ("product", "segment", *_ALONG)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("decision_id")
    counted = cut(ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    parts = cut(counted.groupBy("product", "segment", "_part").agg(F.count("*").alias("n"), F.min("_at").alias("_low")))
    before = Window.partitionBy("product", "segment").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("product", "segment", "_part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("_low") + 1).alias("_shift"))
    placed = counted.join(small(starts), ["product", "segment", "_part"])
    return placed.withColumn("seq", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def chain_heads(index: DataFrame) -> DataFrame:
    """The last hash of each product's chain and where it stands: (product, head, segment, batch)."""
    place = F.struct("segment", "seq")
    return index.groupBy("product").agg(
        F.max_by(_THIS, place).alias("head"), F.max("segment").alias("segment"), F.max("batch").alias("batch")
    )


def _with_starts(bodies: DataFrame, heads: DataFrame | None) -> DataFrame:
    """Bodies with the head of the chain they continue, and where it stands."""
    none = {"start": "string", "_last": "bigint", "_batch": "bigint"}
    if heads is None:
        return bodies.withColumns({name: F.lit(None).cast(kind) for name, kind in none.items()})
    starts = heads.select("product", F.col("head").alias("start"), F.col("segment").alias("_last"), F.col("batch").alias("_batch"))
    return bodies.join(small(starts), "product", "left")  # one row per product


def write_snapshots(
    decided: DataFrame, heads: DataFrame | None = None, shards: int = SHARDS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Snapshots of one batch of decisions (index and body columns together).

    `heads` (from `chain_heads`) continues existing chains; without it chains start at genesis.
    """
    placed = (
        _with_starts(_bodies(decided), heads)
        .withColumn("start", F.coalesce("start", F.lit(GENESIS_HASH)))
        .withColumn("batch", F.coalesce("_batch", F.lit(0).cast("bigint")) + 1)
        .withColumn("segment", F.coalesce("_last", F.lit(-1).cast("bigint")) + 1 + _segment_of(shards))
        .withColumn("shards", F.lit(shards).cast("bigint"))
        .withColumn("_row", F.monotonically_increasing_id())
        .drop("_last", "_batch")
    )
    # Stored: all steps go on from here, and only the last needs the whole rows.
    stored = cut(placed)
    segments = small(stored.groupBy("product", "segment").agg(F.max("start").alias("start"), F.count("*").alias("rows")))
    # Only what another segment of the batch is tied to: a plain chain has no digests.
    follower = F.lead("segment").over(Window.partitionBy("product").orderBy("segment"))
    tied_to = segments.select("product", "segment", follower.alias("_next")).where("_next IS NOT NULL").drop("_next")
    narrow = stored.select("_row", "product", "segment", "batch", "decision_id", "_digest")
    digests = segment_digests(narrow.join(tied_to, ["product", "segment"], "left_semi").repartition("product", "segment"), _ALONG)
    tied = segments.drop("rows").join(digests.select("product", "segment", "digest"), ["product", "segment"], "left")
    anchors = small(_anchored(tied)).withColumn("done", F.lit(0).cast("bigint"))
    texts = stored.select("_row", "product", "segment", "decision_id", "_head", "_tail")
    longest = segments.agg(F.max("rows")).head()[0] or 0
    chained = _folded(texts, anchors) if longest <= block_rows else _folded_in_blocks(texts, anchors, longest, block_rows)
    whole = stored.drop("_head", "_tail", "_digest", "start")
    return whole.join(chained.drop("product", "segment"), "_row").drop("_row")


def snapshot_index(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        "segment", "seq", "shards", "decision_id", "emirates_id", "decision_ts", "outcome",
        "feature_vector_sha256", _PREV, _THIS, "engine_version", "rule_pack_version", "pipeline_version",
        "dt", "product", "batch",
    )


def snapshot_bodies(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        "decision_id", "emirates_id", "decision_ts", "outcome", "reason_codes", "engine_version",
        "rule_pack_version", "pipeline_version", "feature_vector_sha256", "feature_vector_path",
        _PREV, _THIS, "dt", "product", "batch",
    )


# --- verification -------------------------------------------------------------------------------


def rehashed(index: DataFrame, bodies: DataFrame) -> DataFrame:
    """Index and bodies side by side, every body hashed again: (product, segment, seq, batch, decision_id, listed, present,
    feature_vector_sha256, prev, stored, _digest, _rehashed). `listed` is the hash in the index, `stored` the one in the body."""
    places = index.select("decision_id", "batch", F.col("product").alias("chain"), "segment", "seq", F.col(_THIS).alias("listed"))
    # The body's own product is part of its text; the index decides which chain it stands in.
    joined = _with_text(places.join(bodies.withColumn("present", F.lit(True)), ["decision_id", "batch"], "left"))
    return joined.select(
        F.col("chain").alias("product"), "segment", "seq", "batch", "decision_id", "listed", F.coalesce("present", F.lit(False)).alias("present"),
        "feature_vector_sha256", F.col(_PREV).alias("prev"), F.col(_THIS).alias("stored"), "_digest",
        F.sha2(F.concat("_head", F.col(_PREV), "_tail"), 256).alias("_rehashed"),
    )


def _short(digest: str) -> str:
    return digest[:12] + ".."


def _broken(pointer: str, expected: str) -> str:
    return f"points to {_short(pointer)}, follows {_short(expected)}"


_WALKED = "product string, segment bigint, batch bigint, decision_id string, kind string, detail string, prev string, last string, digest string"


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Along each segment in order: its issues, and at its end one row without a kind that says how it begins and
    ends and what its rows hash to. A row that is not there is stepped over."""
    at, first, last, state = None, None, None, hashlib.sha256()

    def end() -> list[tuple]:
        return [] if first is None else [(*at, first[0], first[1], None, None, first[2], last, state.hexdigest())]

    for frame in frames:
        out: list[tuple] = []
        for row in frame.itertuples(index=False):
            if (row.product, row.segment) != at:
                out += end()
                at, first, last, state = (row.product, row.segment), None, None, hashlib.sha256()
            issue = (row.product, row.segment, row.batch, row.decision_id)
            if not row.present:
                out.append((*issue, MISSING_FILE, "no body is stored for this snapshot", None, None, None))
                continue
            if row.rehashed != row.stored:
                out.append((*issue, HASH_MISMATCH, f"hashes to {_short(row.rehashed)}, stored as {_short(row.stored)}", None, None, None))
            if first is None:
                first = (row.batch, row.decision_id, row.prev)
            elif row.prev != last:
                out.append((*issue, CHAIN_BREAK, _broken(row.prev, last), None, None, None))
            last = row.stored
            state.update(row.digest.encode())
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _WALKED.split(", ")])
    yield pd.DataFrame(end(), columns=[c.split()[0] for c in _WALKED.split(", ")])


def verify_chain(
    index: DataFrame, bodies: DataFrame, vectors: DataFrame, product: str | None = None
) -> DataFrame:
    """Every integrity issue of the stored chains: (decision_id, product, kind, detail).

    Index and bodies meet once and are dealt by segment once. What is left of a segment is its issues and one narrow
    row, over which the segments are tied together. A vector that is no longer stored is not an issue.
    """
    if product is not None:
        index = index.where(F.col("product") == product)
        bodies = bodies.where(F.col("product") == product)
    rows = rehashed(index, bodies).select(
        "product", "segment", "seq", "batch", "decision_id", "present", "prev", "stored", F.col("_rehashed").alias("rehashed"), F.col("_digest").alias("digest")
    )
    ordered = rows.repartition("product", "segment").sortWithinPartitions("product", "segment", "seq")
    walked = cut(ordered.mapInPandas(_walk, _WALKED))
    own = walked.where("kind IS NOT NULL").select("decision_id", "product", "kind", "detail")

    along = Window.partitionBy("product").orderBy("segment")
    follows_batch = F.lag("batch").over(along) == F.col("batch")
    opening = F.when(follows_batch, F.sha2(F.concat(F.lag("prev").over(along), F.lag("digest").over(along)), 256)).otherwise(
        F.coalesce(F.lag("last").over(along), F.lit(GENESIS_HASH))
    )
    short = lambda c: F.concat(F.substring(c, 1, 12), F.lit(".."))
    tied = walked.where("kind IS NULL").withColumn("_opening", opening).where(F.col("prev") != F.col("_opening"))
    detail = F.concat(F.lit("points to "), short("prev"), F.lit(", follows "), short("_opening"))
    untied = tied.select("decision_id", "product", F.lit(CHAIN_BREAK).alias("kind"), detail.alias("detail"))

    altered = vectors.where(F.sha2("json", 256) != F.col("sha256")).select(F.col("sha256").alias("feature_vector_sha256"))
    touched = bodies.select("decision_id", "batch", "feature_vector_sha256").join(small(altered), "feature_vector_sha256", "left_semi")
    mismatched = index.select("decision_id", "batch", "product").join(small(touched.select("decision_id", "batch")), ["decision_id", "batch"], "left_semi")
    mismatched = mismatched.select(
        "decision_id", "product", F.lit(VECTOR_MISMATCH).alias("kind"), F.lit("the stored vector hashes to another value").alias("detail")
    )
    return own.unionByName(untied).unionByName(mismatched)


def issue_summary(issues: DataFrame) -> DataFrame:
    """Issues by kind."""
    return issues.groupBy("kind").agg(F.count(F.lit(1)).alias("issues"))


class ChainError(RuntimeError):
    """The stored chains do not verify."""


def require_intact(issues: DataFrame) -> None:
    """Raise `ChainError` with the count by kind and the first three issues, if there are any."""
    by_kind = {row["kind"]: row["issues"] for row in issue_summary(issues).collect()}
    if not by_kind:
        return
    first = issues.orderBy("product", "decision_id", "kind").limit(3).collect()
    shown = "; ".join(f"[{row['kind']}] {row['decision_id']}: {row['detail']}" for row in first)
    raise ChainError(f"audit chain check failed: {sum(by_kind.values())} issue(s) {by_kind}; first: {shown}")


# --- replay -------------------------------------------------------------------------------------


def _vectors_of(few: DataFrame, vectors: DataFrame) -> DataFrame:
    """The vectors of some snapshots, found in one pass that moves none of the others."""
    wanted = small(few.select(F.col("feature_vector_sha256").alias("sha256")).distinct())
    return vectors.join(wanted, "sha256", "left_semi")


def replay(bodies: DataFrame, vectors: DataFrame, packs: Iterable[RulePack] = PACKS) -> DataFrame:
    """Each snapshot decided again from its stored vector: original, replayed, and whether they match.

    The vectors are as many as the snapshots. Spark takes a text that is worked out for 20 bytes, whatever its length, and
    would send all of them through the driver to every task; a merge join is asked for instead.
    """
    stored, field = _with_stored_fields(vectors)
    rows = bodies.select(
        "decision_id", "product", "rule_pack_version", "outcome", "reason_codes", "feature_vector_sha256"
    ).join(stored.hint("merge"), "feature_vector_sha256")
    answer = evaluate_version(
        F.col("product"), F.col("rule_pack_version"), field, packs
    )
    again = rows.withColumn("_again", answer)
    return again.select(
        "decision_id",
        "product",
        (
            F.col("_again.outcome").eqNullSafe(F.col("outcome"))
            & F.col("_again.reason_codes").eqNullSafe(F.col("reason_codes"))
        ).alias("matches"),
        F.col("outcome").alias("original_outcome"),
        F.col("_again.outcome").alias("replayed_outcome"),
        F.col("reason_codes").alias("original_reasons"),
        F.col("_again.reason_codes").alias("replayed_reasons"),
    )


def replay_sample(
    bodies: DataFrame, vectors: DataFrame, n: int = 10, seed: int = 0, packs: Iterable[RulePack] = PACKS
) -> DataFrame:
    """Replay of `n` snapshots picked at random; a seed picks the same ones every time."""
    chance = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("decision_id")), 256)
    chosen = cut(bodies.orderBy(chance, "decision_id").limit(n))
    return replay(chosen, _vectors_of(chosen, vectors), packs)


def replay_decision(
    bodies: DataFrame, vectors: DataFrame, decision_id: str, packs: Iterable[RulePack] = PACKS
) -> DataFrame:
    """Replay of one decision; raises `LookupError` if it is not stored."""
    body = bodies.where(F.col("decision_id") == decision_id)
    if body.isEmpty():
        raise LookupError(f"no snapshot of decision {decision_id!r}")
    return replay(body, _vectors_of(body, vectors), packs)


def decision_detail(bodies: DataFrame, vectors: DataFrame, decision_id: Column | str) -> DataFrame:
    """Snapshot, stored vector and replay of the decisions with the given id, side by side."""
    wanted = F.lit(decision_id) if isinstance(decision_id, str) else decision_id
    chosen = cut(bodies.where(F.col("decision_id") == wanted))
    kept = cut(_vectors_of(chosen, vectors))
    again = replay(chosen, kept).select("decision_id", "matches", "replayed_outcome", "replayed_reasons")
    stored = kept.select(F.col("sha256").alias("feature_vector_sha256"), F.col("json").alias("vector"))
    # As in `replay`: the ids may be any number.
    return chosen.join(stored.hint("merge"), "feature_vector_sha256", "left").join(again.hint("merge"), "decision_id", "left")
