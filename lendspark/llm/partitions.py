"""Approximate nearest neighbours by inner product, over learned partitions.

1. Equal vectors are collapsed to one, which keeps its `k + 1` smallest ids: more of them are never among the
   `k` nearest of anything.
2. A node of more than `LEAF` vectors is split: the neighbour graph of a bounded sample is cut into parts of
   nearly equal size with few edges between them, and a softmax classifier learns to say in which parts the
   neighbours of a vector lie. All vectors of the node then go to their most probable part. This goes on in the
   parts, so that leaves stay small however many vectors there are, and a model has `FANOUT` parts at most.
3. A query goes down the tree with the product of its probabilities, and is compared with all vectors of the
   most probable leaves. How many leaves these must be is measured: for a sample of queries the true neighbours
   are found among all vectors, and the smallest number of leaves is taken that holds `RECALL` of them.

Models meet vectors, and leaves their queries, in groups of bounded size: a node or leaf that holds very many is
dealt over several, so that none has to be gathered in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.common import cut, lean
from lendspark.llm.embeddings import usable
from lendspark.operators.skew import lookup, small

NEAREST = 20
EVERY = 20
LEAF = 512
FANOUT = 128
SAMPLE = 8192  # vectors, on average, that a model is fitted to
CHUNK = 4096
NEIGHBOURS = 10
AUDITED = 256
RECALL = 0.95
FIRST_WIDTH = 64
FIRST_ROUND = 8
STUCK = 0.9  # a part with more of its node than this is not split again
SPARE = 4
_AT_ONCE = 512


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _inputs(vectors: np.ndarray) -> np.ndarray:
    """What the classifier sees: the direction, with components of about one, and a constant."""
    rows = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    rows *= np.sqrt(rows.shape[1]) / np.linalg.norm(rows, axis=1, keepdims=True)
    return np.hstack([rows, np.ones((len(rows), 1))]).astype(np.float32)


def neighbour_graph(vectors: np.ndarray, count: int = NEIGHBOURS) -> np.ndarray:
    """The places of the `count` nearest other rows of every row."""
    count = min(count, len(vectors) - 1)
    rows = (vectors / np.abs(vectors).max()).astype(np.float32)
    found = np.empty((len(rows), count), dtype=np.int64)
    for i in range(0, len(rows), _AT_ONCE):
        near = rows[i : i + _AT_ONCE] @ rows.T
        near[np.arange(len(near)), np.arange(i, i + len(near))] = -np.inf
        found[i : i + _AT_ONCE] = np.argpartition(-near, count - 1, axis=1)[:, :count]
    return found


def _halve(rows: np.ndarray, own: np.ndarray, parts: int, first: int, label: np.ndarray) -> None:
    """Cut across the direction of the largest spread, again and again, into parts of equal size."""
    if parts == 1:
        label[own] = first
        return
    spread = rows[own] - rows[own].mean(axis=0)
    axis = spread[np.abs(spread).sum(axis=1).argmax()].copy()
    for _ in range(8):
        axis = spread.T @ (spread @ axis)
        axis /= max(float(np.linalg.norm(axis)), 1e-30)
    left = parts // 2
    order = own[np.argsort(spread @ axis, kind="stable")]
    at = len(own) * left // parts
    _halve(rows, order[:at], left, first, label)
    _halve(rows, order[at:], parts - left, first + left, label)


def balanced_parts(rows: np.ndarray, near: np.ndarray, parts: int, rounds: int = 10, slack: float = 0.05) -> np.ndarray:
    """A part for every row, none larger than the mean by more than `slack`, with few edges of `near` between parts.

    Starts from equal cuts of space; then rows move to the part where most of their neighbours are, those that gain
    most first, as long as there is room.
    """
    label = np.empty(len(rows), dtype=np.int64)
    _halve(rows, np.arange(len(rows)), parts, 0, label)
    a = np.repeat(np.arange(len(rows)), near.shape[1])
    b = near.ravel()
    most = int(np.ceil(len(rows) / parts * (1 + slack)))
    held = np.bincount(label, minlength=parts)
    for _ in range(rounds):
        cells = np.concatenate([a * parts + label[b], b * parts + label[a]])
        votes = np.bincount(cells, minlength=len(rows) * parts).reshape(len(rows), parts)
        better = votes.argmax(axis=1)
        gain = votes[np.arange(len(rows)), better] - votes[np.arange(len(rows)), label]
        moved = 0
        for i in np.argsort(-gain, kind="stable")[: np.count_nonzero(gain > 0)].tolist():
            if held[better[i]] < most:
                held[label[i]] -= 1
                held[better[i]] += 1
                label[i] = better[i]
                moved += 1
        if not moved:
            break
    return label


def train(inputs: np.ndarray, wanted: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 0.02, decay: float = 1e-4) -> np.ndarray:
    """Weights of a softmax classifier with the shares `wanted` of every row as its goal (Adam, fixed order)."""
    weights = np.zeros((wanted.shape[1], inputs.shape[1]), dtype=np.float32)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    pick, step = np.random.default_rng(0), 0
    for epoch in range(epochs):
        order = pick.permutation(len(inputs))
        pace = rate * (1 - epoch / epochs)
        for i in range(0, len(order), batch):
            some = order[i : i + batch]
            step += 1
            error = np.exp(_log_softmax(inputs[some] @ weights.T)) - wanted[some]
            slope = error.T @ inputs[some] / len(some) + decay * weights
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            weights -= pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights


def _log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def _fit(leaf: int, fanout: int, group: pa.Table) -> pa.Table:
    """The model of one node, from the sampled rows (node, n, unit, vec)."""
    group = group.sort_by("unit")
    vectors = _matrix(group.column("vec"))
    parts = int(min(fanout, -(-group.column("n")[0].as_py() // leaf), len(vectors)))
    near = neighbour_graph(vectors) if len(vectors) > 1 else np.zeros((1, 0), dtype=np.int64)
    inputs = _inputs(vectors)
    label = balanced_parts(inputs[:, :-1], near, parts)
    wanted = np.zeros((len(vectors), parts), dtype=np.float32)
    np.add.at(wanted, (np.arange(len(vectors)), label), 1)
    np.add.at(wanted, (np.repeat(np.arange(len(vectors)), near.shape[1]), label[near.ravel()]), 1)
    weights = train(inputs, wanted / wanted.sum(axis=1, keepdims=True))
    return pa.table({"node": group.column("node").slice(0, 1), "parts": pa.array([parts], pa.int64()), "weights": pa.array([weights.tobytes()])})


def _descend(width: int, rows: pa.Table, model: pa.Table) -> pa.Table:
    """Every row once for each of the `width` most probable parts of its node."""
    if not rows.num_rows or not model.num_rows:
        return rows.slice(0, 0).drop_columns("chunk")
    rows = rows.drop_columns("chunk")
    parts = model.column("parts")[0].as_py()
    weights = np.frombuffer(model.column("weights")[0].as_py(), dtype=np.float32).reshape(parts, -1)
    logs = _log_softmax(_inputs(_matrix(rows.column("vec"))) @ weights.T)
    best = np.argsort(-logs, axis=1, kind="stable")[:, : min(width, parts)]
    row = np.repeat(np.arange(rows.num_rows), best.shape[1])
    prefix = model.column("node")[0].as_py()
    names = pa.array([f"{prefix}.{i}" for i in range(parts)])
    taken = rows.take(pa.array(row))
    total = taken.column("logp").to_numpy() + logs[row, best.ravel()]
    taken = taken.set_column(taken.column_names.index("node"), "node", names.take(pa.array(best.ravel())))
    return taken.set_column(taken.column_names.index("logp"), "logp", pa.array(total, pa.float64()))


def _down(rows: DataFrame, models: DataFrame, width: int) -> DataFrame:
    """`rows` (node, logp, unit, vec, ...) with those of a node that has a model handed on to its parts."""
    inner = small(models.select("node"))
    stays = rows.join(inner, "node", "left_anti")
    goes = rows.join(inner, "node", "left_semi")
    chunks = small(goes.groupBy("node").agg(F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias("chunks")))
    chunk = F.pmod(F.xxhash64("unit"), F.col("chunks")).cast("int")
    dealt = goes.join(chunks, "node").withColumn("chunk", chunk).drop("chunks")
    models = models.join(chunks, "node").select("node", "parts", "weights", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    handed = dealt.groupBy("node", "chunk").cogroup(models.groupBy("node", "chunk")).applyInArrow(partial(_descend, width), rows.schema)
    return stays.unionByName(handed)


def _sampled(members: DataFrame, inner: DataFrame) -> DataFrame:
    """About SAMPLE vectors of every node of (node, n): no two members are equal, so hashes spread them evenly."""
    share = F.pmod(F.xxhash64("vec", F.lit(SAMPLE)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return members.join(small(inner), "node").where(share * F.col("n") < SAMPLE).select("node", "n", "unit", "vec")


def build(units: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The leaf of every unit, and the models level by level, of (root, unit, vec, ids)."""
    members = units.select(F.col("root").alias("node"), F.lit(0.0).alias("logp"), F.lit(None).cast("long").alias("above"), "unit", "vec", "ids")
    models: list[DataFrame] = []
    leaf, fanout = LEAF, FANOUT
    while True:
        sizes = cut(members.groupBy("node").agg(F.count("*").alias("n"), F.max("above").alias("above")))
        inner = sizes.where((F.col("n") > LEAF) & (F.col("above").isNull() | (F.col("n") < STUCK * F.col("above")))).select("node", "n")
        if inner.isEmpty():
            return members, models
        model = cut(_sampled(members, inner).groupBy("node").applyInArrow(lambda group: _fit(leaf, fanout, group), "node string, parts long, weights binary"))
        models.append(model)
        marked = members.drop("above").join(small(sizes.select("node", F.col("n").alias("above"))), "node")
        members = cut(_down(marked.select(*members.columns), model, 1))


def _best(rows: DataFrame, by: str, order: list[Column], count: int, name: str) -> DataFrame:
    """The first `count` rows of each `by`, numbered; map tasks drop the rest before rows are dealt."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col(name) <= count)


def route(asking: DataFrame, models: list[DataFrame], width: int) -> DataFrame:
    """(unit, vec, node, place) with the `width` most probable leaves of every row of (root, unit, vec), best first."""
    at = asking.select(F.col("root").alias("node"), F.lit(0.0).alias("logp"), "unit", "vec")
    order = [F.desc("logp"), F.asc("node")]
    for model in models:
        at = cut(_best(_down(at, model, width), "unit", order, width, "place").drop("place"))
    return _best(at, "unit", order, width, "place").select("unit", "vec", "node", "place")


def _true(shared, count: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The `count` nearest of the task's rows (unit, vec, node) for every audited query, by its length."""
    best = {length: None for length in shared.value}
    for batch in batches:
        lengths = np.diff(batch.column(1).offsets.to_numpy())
        for length, (asked, matrix) in shared.value.items():
            mine = batch.take(pa.array(np.flatnonzero(lengths == length)))
            if not mine.num_rows:
                continue
            score = matrix @ _matrix(mine.column(1)).T
            score[asked[:, None] == mine.column(0).to_numpy()] = -np.inf
            unit = np.broadcast_to(mine.column(0).to_numpy(), score.shape)
            node = np.broadcast_to(np.array(mine.column(2).to_pylist(), dtype=object), score.shape)
            if best[length] is not None:
                score, unit, node = (np.hstack(pair) for pair in zip(best[length], (score, unit, node)))
            top = np.argsort(-score, axis=1, kind="stable")[:, :count]
            best[length] = tuple(np.take_along_axis(x, top, axis=1) for x in (score, unit, node))
    for length, found in best.items():
        if found is not None:
            score, unit, node = (x.ravel() for x in found)
            query = np.repeat(shared.value[length][0], found[0].shape[1])
            good = score > -np.inf
            columns = [pa.array(query[good]), pa.array(unit[good]), pa.array(node[good].tolist(), pa.string()), pa.array(score[good])]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "unit", "node", "score"])


def _leaves_needed(asking: DataFrame, members: DataFrame, models: list[DataFrame], k: int) -> tuple[int, float]:
    """How many leaves hold RECALL of the true neighbours of a bounded sample of queries, and what share they hold."""
    drawn = asking.orderBy(F.xxhash64("unit"), "unit").limit(AUDITED).select("unit", "vec", "root").toArrow()
    if not models or not drawn.num_rows:
        return 1, 1.0
    lengths = np.array([len(v) for v in drawn.column("vec")])
    held = {
        int(length): (drawn.filter(pa.array(lengths == length)).column("unit").to_numpy(), _matrix(drawn.filter(pa.array(lengths == length)).column("vec")))
        for length in np.unique(lengths)
    }
    spark = asking.sparkSession
    shared = spark.sparkContext.broadcast(held)
    near = members.select("unit", "vec", "node").mapInArrow(lean(partial(_true, shared, k)), "query long, unit long, node string, score double")
    true = cut(_best(near, "query", [F.desc("score"), F.asc("unit")], k, "rank").select("query", "node"))
    audited = spark.createDataFrame(drawn.to_pandas(), asking.select("unit", "vec", "root").schema)
    leaves, width = members.select("node").distinct().count(), FIRST_WIDTH
    while True:
        places = route(audited, models, width).select(F.col("unit").alias("query"), "node", "place")
        found = true.join(places, ["query", "node"], "left").groupBy("place").count().collect()  # a row per place, width + 1 at most
        whole = sum(r["count"] for r in found)
        if not whole:
            return 1, 1.0
        reached = 0
        for place, count in sorted((r["place"], r["count"]) for r in found if r["place"] is not None):
            reached += count
            if reached >= RECALL * whole:
                return place, reached / whole
        if width >= leaves:
            return leaves, reached / whole
        width *= 8


def _meet(wanted: int, stock: pa.Table, asking: pa.Table) -> pa.Table:
    """The `wanted` nearest members of a leaf for each of its queries, as far as they reach its `floor`; ties to the
    member with the smallest id."""
    schema = pa.schema([("query", pa.int64()), ("unit", pa.int64()), ("low", pa.int64()), ("held", pa.int64()), ("score", pa.float64())])
    if not stock.num_rows or not asking.num_rows:
        return schema.empty_table()
    stock = stock.sort_by("low")
    rows, (unit, low, held) = _matrix(stock.column("vec")), (stock.column(c).to_numpy() for c in ("unit", "low", "held"))
    queries, own = _matrix(asking.column("vec")), asking.column("unit").to_numpy()
    floor = asking.column("floor").combine_chunks().fill_null(-np.inf).to_numpy()
    found = []
    for i in range(0, len(queries), _AT_ONCE):
        some = queries[i : i + _AT_ONCE]
        top = np.argsort(-(some @ rows.T), axis=1, kind="stable")[:, : wanted + SPARE]
        score = np.zeros(top.shape)
        for j in range(rows.shape[1]):  # added up in order, so that equal products give equal sums
            score += some[:, j, None] * rows[top, j]
        keep = np.lexsort((top, -score), axis=-1)[:, :wanted]
        top, score = np.take_along_axis(top, keep, axis=1), np.take_along_axis(score, keep, axis=1)
        good = score >= floor[i : i + _AT_ONCE, None]
        query = np.broadcast_to(own[i : i + _AT_ONCE, None], top.shape)[good]
        columns = [query, *(x[top[good]] for x in (unit, low, held)), score[good]]
        found.append(pa.table([pa.array(c) for c in columns], schema=schema))
    return pa.concat_tables(found)


def _compared(members: DataFrame, routed: DataFrame, wanted: int) -> DataFrame:
    """(query, unit, low, held, score): the nearest members of each leaf a query was routed to, and how many ids they have."""
    chunks = lambda name: F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias(name)
    counts = members.groupBy("node").agg(chunks("m_all")).join(routed.groupBy("node").agg(chunks("q_all")), "node")
    counts = small(counts)
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    m, q = (F.pmod(F.xxhash64("unit"), F.col(name)).cast("int") for name in ("m_all", "q_all"))
    ids = [F.col("ids")[0].alias("low"), F.size("ids").cast("long").alias("held")]
    stock = members.join(counts, "node").select("node", m.alias("m"), every("q_all").alias("q"), "unit", "vec", *ids)
    asking = routed.join(counts, "node").select("node", every("m_all").alias("m"), q.alias("q"), "unit", "vec", "floor")
    keys = ["node", "m", "q"]
    found = "query long, unit long, low long, held long, score double"
    return stock.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(partial(_meet, wanted), found)


def _search(asking: DataFrame, members: DataFrame, models: list[DataFrame], width: int, wanted: int) -> DataFrame:
    """(query, unit, score) of the nearest `wanted` rows in the `width` most probable leaves of every query.

    Leaves are compared in rounds, four times as many with every round. From the second on, a leaf gives only
    members as near as the `wanted` best so far, so that a query has some `wanted` rows a round and not a leaf.
    A query whose leaves hold fewer rows than `wanted` goes on to more leaves.
    """
    leaves = 1 + sum(model.agg(F.sum("parts")).head()[0] for model in models)
    routed = cut(route(asking, models, width))
    best, done = None, 0
    while done < width:
        upto = min(width, max(FIRST_ROUND, 4 * done))
        part = routed.where((F.col("place") > done) & (F.col("place") <= upto)).drop("place")
        if best is None:
            part = part.withColumn("floor", F.lit(None).cast("double"))
        else:
            floors = best.groupBy(F.col("query").alias("unit")).agg(F.when(F.count("*") >= wanted, F.min("score")).alias("floor"))
            part = part.join(floors, "unit", "left")
        found = _compared(members, part, wanted)
        found = found if best is None else found.unionByName(best)
        best = cut(_best(found, "query", [F.desc("score"), F.asc("low")], wanted, "rank").drop("rank"))
        done = upto
    part = best.select("query", "unit", "score")
    if width >= leaves:
        return part
    full = best.groupBy(F.col("query").alias("unit")).agg(F.sum("held").alias("rows")).where(F.col("rows") >= wanted).select("unit")
    short = cut(asking.join(full, "unit", "left_anti"))
    if short.isEmpty():
        return part
    kept = part.join(full.withColumnRenamed("unit", "query"), "query", "left_semi")
    return kept.unionByName(_search(short, members, models, 4 * width, wanted))


def _units(rows: DataFrame, count: int) -> DataFrame:
    """(root, unit, vec, ids) of the distinct vectors of (id, vec), with their `count` smallest ids in order."""
    ids = _best(rows.groupBy("vec", "id").agg(F.count("*")).select("vec", "id"), "vec", [F.asc("id")], count, "rank")
    groups = ids.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # `count` ids at most
    return groups.select(F.size("vec").cast("string").alias("root"), F.monotonically_increasing_id().alias("unit"), "vec", "ids")


def nearest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = NEAREST, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score, recall): the `k` nearest found of every row whose id `every` divides.

    Candidates are all rows of `df` but the query's own; fewer than `k` are all returned. `score` is the inner product of
    the vectors in double precision, ties go to the smaller id. Vectors that are null, empty, zero or hold a null or
    non-finite component, and rows without an id, take no part. Vectors meet those of their own length only. A row that
    repeats id and vector counts once; an id with several vectors is several rows, each with a list of its own. Other columns
    are not read; an empty table gives no rows. `recall` is the audited share of true neighbours in the leaves searched.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where(F.col("id").isNotNull() & usable(F.col("vec")))
    units = cut(_units(rows, k + 1))
    queries = rows.where(F.col("id") % every == 0).distinct()
    queries = cut(lookup(queries, units.select("vec", "unit", "root"), ["vec"]).select("id", "unit", "root", "vec"))
    asking = cut(queries.groupBy("unit").agg(F.first("root").alias("root"), F.first("vec").alias("vec")))
    members, models = build(units)
    leaves, recall = _leaves_needed(asking, members, models, k)
    best = cut(_search(asking, members, models, leaves, k + 1))
    named = lookup(best, members.select("unit", "ids"), ["unit"]).select("query", "unit", "score", F.explode("ids").alias("id"))
    named = _best(named, "query", [F.desc("score"), F.asc("id")], k + 1, "rank")
    found = F.sort_array(F.collect_list(F.struct("rank", "id", "unit", "score"))).alias("found")  # k + 1 rows
    lists = named.groupBy(F.col("query").alias("unit")).agg(found)
    own = lambda x: (x.id == F.col("query_id")) & (x.unit == F.col("unit"))
    others = lookup(queries.select(F.col("id").alias("query_id"), "unit"), lists, ["unit"])
    ranked = others.select("query_id", F.posexplode(F.slice(F.filter("found", lambda x: ~own(x)), 1, k)).alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"), F.lit(recall).alias("recall"))
