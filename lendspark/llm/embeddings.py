"""Near-duplicate vectors by a robust-pruned graph, built and searched in overlapping cluster shards.

1. Equal vectors are collapsed, however many there are, and compared once.
2. Centroids are fitted to a bounded sample; there are at most `CENTROIDS`, so they fit every executor. Each
   vector has its home in the shard of the nearest one, and is a member of every shard whose centroid is
   nearly as close (`slack`), at most `OVERLAP` of them. A shard of more than `PART` vectors is cut into parts, whatever its size.
3. Every part gets a flat graph: close candidates of a vector are pruned so that each kept neighbour leads in
   a direction of its own. Then the adjacency lists that a vector has in its shards are united.
4. A vector queries all parts of its home shard: a greedy search finds its surroundings, and as long as it
   finds vectors in range, it goes on through their neighbours. As a large group of near copies has no edges
   but to itself, the search starts from the medoid and from a place in every group that the edges close to the range form.
   Cosines are computed in double precision, and only links that reach the threshold are counted.
5. An audit compares bounded samples of vectors, with few links and with many, with all rows. Below `RECALL`,
   slack, overlap and beam are doubled and the search is done again; after `ATTEMPTS` searches all vectors are compared
   with all. The recall reached comes with the result.

Parts meet queries in groups of bounded size, each of which sends back counts and a spanning forest of its
links, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.bktree import unite
from lendspark.llm.blocks import gather
from lendspark.llm.common import cut
from lendspark.llm.components import components

THRESHOLD = 0.95
CENTROIDS = 4096
PER_CENTROID = 400
SAMPLE = 16_384
PART = 4096
SLACK = 1.2  # over the root of the dimension: what separates close vectors points anywhere
OVERLAP = 4
BEAM = 48
DEGREE = 24
ALPHA = 1.2
AUDITED = 256
RECALL = 0.9
ATTEMPTS = 3
_EDGES_AT_ONCE = 1 << 14
_QUERIES_AT_ONCE = 256
_ROWS_AT_ONCE = 2048


def usable(vec: Column) -> Column:
    """Not null, not empty, every component finite, and not all zero."""
    as_double = vec.cast("array<double>")
    finite = F.forall(as_double, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(finite & F.exists(as_double, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_centroids(sample: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means from evenly spaced rows of a sample in hash order; empty clusters keep their centroid."""
    centroids = sample[np.linspace(0, len(sample) - 1, min(count, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([np.argmax(sample[i : i + 2048] @ centroids.T, axis=1) for i in range(0, len(sample), 2048)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centroids)
    return centroids


def _assign(shared, slack: float, overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    centroids = shared.value
    for batch in batches:
        if not batch.num_rows:
            continue
        near = _unit(_matrix(batch.column(1))) @ centroids.T
        home = near.argmax(axis=1)
        best = near[np.arange(len(near)), home]
        close = near >= best[:, None] - slack
        if overlap < near.shape[1]:  # the nearest ones, so that a vector's shards do not multiply with the centroids
            close &= near >= -np.partition(-near, overlap - 1, axis=1)[:, overlap - 1 : overlap]
        row, shard = np.nonzero(close)
        is_home = pa.array(shard == home[row])
        taken = batch.take(pa.array(row))
        yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), is_home, *taken.columns], names=["shard", "home", "node", "vec", "n"])


def robust_prune(near: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Out-neighbours of every row from the matrix of cosines: keep the closest candidate, drop those that it is
    `alpha` times closer to than the row itself is, and go on with the rest."""
    size = len(near)
    pool = min(size - 1, 3 * degree)
    if pool < 1:
        return [np.empty(0, dtype=np.int64)] * size
    masked = near.copy()
    np.fill_diagonal(masked, -2.0)
    top = np.argpartition(-masked, pool - 1, axis=1)[:, :pool]
    kept = []
    for i in range(size):
        ids = top[i][np.argsort(-masked[i, top[i]], kind="stable")]
        between = 1.0 - near[np.ix_(ids, ids)]
        own = 1.0 - near[i, ids]
        alive = np.ones(pool, dtype=bool)
        chosen = []
        for j in range(pool):
            if alive[j]:
                chosen.append(ids[j])
                if len(chosen) == degree:
                    break
                alive &= alpha * between[j] > own
                alive[j] = False
        kept.append(np.array(chosen, dtype=np.int64))
    return kept


def _build(group: pd.DataFrame) -> pd.DataFrame:
    """The graph of one part, in both directions, by node."""
    vectors = _unit(np.array(group["vec"].tolist(), dtype=np.float64))
    node = group["node"].to_numpy()
    lists: list[set] = [set() for _ in node]
    for i, out in enumerate(robust_prune(vectors @ vectors.T)):
        lists[i].update(out.tolist())
        for j in out:
            lists[j].add(i)
    return pd.DataFrame({"node": node, "near": [node[sorted(s)] for s in lists]})


def _entries(vectors: np.ndarray, edges: tuple[np.ndarray, ...], reach: float) -> np.ndarray:
    """The medoid, and one place of every component of two or more that the edges of at least `reach` form: a group of
    near copies that has no edge out, or a few that no search follows, is entered as well."""
    _, size, flat = edges
    source = np.repeat(np.arange(len(vectors)), size)
    parent = np.arange(len(vectors))
    for i in range(0, len(flat), _EDGES_AT_ONCE):
        a, b = source[i : i + _EDGES_AT_ONCE], flat[i : i + _EDGES_AT_ONCE]
        close = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= reach
        unite(parent, a[close], b[close])
    held = np.bincount(parent, minlength=len(vectors))
    medoid = int(np.argmax(vectors @ vectors.mean(axis=0)))
    return np.union1d(np.flatnonzero(held > 1), [medoid])


def _greedy(
    query: np.ndarray, vectors: np.ndarray, edges: tuple[np.ndarray, ...], start: np.ndarray, near: np.ndarray, beam: int, reach: float
) -> np.ndarray:
    """Places found in range: best-first search with a beam from the places `start`, whose cosines are `near`;
    whatever comes close to the range is expanded at once."""
    first, size, flat = edges
    seen = np.zeros(len(vectors), dtype=bool)
    seen[start] = True
    ids, done = start, np.zeros(len(start), dtype=bool)
    while True:
        if len(ids) > beam:
            # Whatever is close to the range stays beside the best ones, so that the range can expand.
            keep = near >= reach
            keep[np.argpartition(-near, beam - 1)[:beam]] = True
            ids, near, done = ids[keep], near[keep], done[keep]
        if done.all():
            return ids
        at = ~done & (near >= reach)
        if not at.any():
            at[np.argmax(np.where(done, -2.0, near))] = True
        done |= at
        new = flat[gather(first[ids[at]], size[ids[at]])]
        new = np.unique(new[~seen[new]])
        if not len(new):
            continue
        seen[new] = True
        ids, near = np.concatenate([ids, new]), np.concatenate([near, vectors[new] @ query])
        done = np.concatenate([done, np.zeros(len(new), dtype=bool)])


def _forest(own: np.ndarray, counts: list[int], every: np.ndarray, parent: np.ndarray) -> pd.DataFrame:
    """The links of the queries `own`, and one link of each of `every` that is not a root."""
    tied = np.flatnonzero(parent != np.arange(len(every)))
    return pd.DataFrame(
        {
            "node": np.concatenate([own, every[tied]]),
            "links": np.concatenate([np.array(counts, dtype=np.int64), np.zeros(len(tied), dtype=np.int64)]),
            "root": np.concatenate([own, every[parent[tied]]]),
        }
    )


def _search(threshold: float, beam: int, group: pd.DataFrame) -> pd.DataFrame:
    """Links of the queries of one group to its members, and the forest they span."""
    group = group.reset_index(drop=True)
    member = group.loc[group["role"] == 0].drop_duplicates("node").reset_index(drop=True)
    asking = group.loc[group["role"] == 1]
    if not len(member) or not len(asking):
        return pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")
    raw = np.array(member["vec"].tolist(), dtype=np.float64)
    vectors, node, weight = _unit(raw), member["node"].to_numpy(), member["n"].to_numpy()
    place = {n: i for i, n in enumerate(node.tolist())}
    lists = [np.array([place[x] for x in near if x in place], dtype=np.int64) for near in member["near"]]
    size = np.array([len(x) for x in lists])
    edges = (np.cumsum(size) - size, size, np.concatenate(lists))
    reach = threshold - 0.05
    start = _entries(vectors, edges, reach)
    doors = vectors[start]
    own = asking["node"].to_numpy()
    every = np.unique(np.concatenate([node, own]))
    parent = np.arange(len(every))
    members_at = np.searchsorted(every, node)
    queries = _unit(np.array(asking["vec"].tolist(), dtype=np.float64))
    counts = []
    for i in range(0, len(queries), _QUERIES_AT_ONCE):
        some = queries[i : i + _QUERIES_AT_ONCE]
        for query, me, near in zip(some, own[i : i + _QUERIES_AT_ONCE], some @ doors.T):
            found = _greedy(query, vectors, edges, start, near, beam, reach)
            found = found[(vectors[found] @ query >= threshold) & (node[found] != me)]
            counts.append(int(weight[found].sum()))
            if len(found):
                unite(parent, np.full(len(found), np.searchsorted(every, me)), members_at[found])
    return _forest(own, counts, every, parent)


def _links(vectors: DataFrame, centroids: np.ndarray, threshold: float, slack: float, overlap: int, beam: int) -> DataFrame:
    """(node, links, root) of the distinct vectors (node, vec, n): counts, and links that connect the linked."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    schema = f"shard long, home boolean, node long, {vectors.schema['vec'].name} {vectors.schema['vec'].dataType.simpleString()}, n long"
    members = vectors.select("node", "vec", "n").mapInArrow(partial(_assign, shared, slack, overlap), schema)
    members = cut(members)
    # A row per shard, and there are at most CENTROIDS.
    sizes = members.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
    members = cut(members.join(F.broadcast(sizes), "shard").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    graph = members.groupBy("shard", "part").applyInPandas(_build, "node long, near array<long>")
    united = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    whole = cut(members.join(united, "node"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    stock = whole.select("shard", F.col("part").alias("m"), every.alias("q"), F.lit(0).alias("role"), "node", "vec", "n", "near")
    no_list = F.lit(None).cast("array<long>").alias("near")
    asking = whole.where("home").select("shard", every.alias("m"), F.col("part").alias("q"), F.lit(1).alias("role"), "node", "vec", "n", no_list)
    return stock.unionByName(asking).groupBy("shard", "m", "q").applyInPandas(partial(_search, threshold, beam), "node long, links long, root long")


def _meet(threshold: float, group: pd.DataFrame) -> pd.DataFrame:
    """Like `_search`, but every query is compared with every member."""
    member, asking = group.loc[group["role"] == 0], group.loc[group["role"] == 1]
    if not len(member) or not len(asking):
        return pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")
    vectors, queries = (_unit(np.array(rows["vec"].tolist(), dtype=np.float64)) for rows in (member, asking))
    node, weight, own = member["node"].to_numpy(), member["n"].to_numpy(), asking["node"].to_numpy()
    every = np.unique(np.concatenate([node, own]))
    parent = np.arange(len(every))
    members_at, own_at = np.searchsorted(every, node), np.searchsorted(every, own)
    counts: list[int] = []
    for i in range(0, len(queries), _QUERIES_AT_ONCE):
        part = slice(i, i + _QUERIES_AT_ONCE)
        hit = (queries[part] @ vectors.T >= threshold) & (node != own[part, None])
        counts += (hit @ weight).tolist()
        asked, found = np.nonzero(hit)
        unite(parent, own_at[part][asked], members_at[found])
    return _forest(own, counts, every, parent)


def _exact(vectors: DataFrame, threshold: float) -> DataFrame:
    """What `_links` gives, by comparing all parts of all vectors with each other; the work grows with the square."""
    parts = -(-vectors.count() // PART)
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    dealt = cut(vectors.select("node", "vec", "n", F.pmod(F.xxhash64("node"), F.lit(parts)).cast("int").alias("part")))
    stock = dealt.select(F.col("part").alias("m"), every.alias("q"), F.lit(0).alias("role"), "node", "vec", "n")
    asking = dealt.select(every.alias("m"), F.col("part").alias("q"), F.lit(1).alias("role"), "node", "vec", "n")
    return stock.unionByName(asking).groupBy("m", "q").applyInPandas(partial(_meet, threshold), "node long, links long, root long")


def _tied(vectors: DataFrame, found: DataFrame) -> DataFrame:
    """`vectors` with the links found of each, and the root of its component."""
    tied = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = vectors.join(links, "node", "left").join(tied, "node", "left")
    return cut(whole.withColumn("root", F.coalesce("root", "node")).withColumn("links", F.coalesce("links", F.lit(0).cast("long"))))


def _compare(shared, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    asked, own, own_root = shared.value
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            rows = batch.slice(at, _ROWS_AT_ONCE)
            node, n, root = (rows.column(i).to_numpy() for i in (0, 2, 3))
            hit = (_unit(_matrix(rows.column(1))) @ asked.T >= threshold) & (node[:, None] != own)
            together = hit & (root[:, None] == own_root)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n @ hit), pa.array(n @ together)], names=["node", "true", "together"])


def _audit(whole: DataFrame, threshold: float) -> float | None:
    """The recall of the worst class of vectors, by comparing some with all others.

    At most AUDITED vectors are drawn of each number of digits of the links found, and as many of those without
    any, so that neither hot groups nor loose vectors crowd out the rest. A vector's recall is the share of its
    true links that was found, or the share that its component holds if that is less. Classes are the powers
    of two of the true links; a class has the mean of its vectors, each standing for those it was drawn from. None if
    no vector drawn has a true link: then nothing was measured, and nothing is claimed.
    """
    digits = F.when(F.col("links") == 0, 0).otherwise(F.least(F.length(F.col("links").cast("string")), F.lit(4)))
    layered = whole.withColumn("layer", digits)
    held = {r["layer"]: r["count"] for r in layered.groupBy("layer").count().collect()}
    drawn = [layered.where(F.col("layer") == k).orderBy(F.xxhash64("node"), "node").limit(AUDITED) for k in sorted(held)]
    chosen = pa.concat_tables([d.select("node", "vec", "root", "links", "layer").toArrow() for d in drawn])
    own, root, mine, layer = (chosen.column(c).to_numpy() for c in ("node", "root", "links", "layer"))
    shared = whole.sparkSession.sparkContext.broadcast((_unit(_matrix(chosen.column("vec"))), own, root))
    met = whole.select("node", "vec", "n", "root").mapInArrow(partial(_compare, shared, threshold), "node long, true long, together long")
    sums = {r["node"]: (r["true"], r["together"]) for r in met.groupBy("node").agg(F.sum("true").alias("true"), F.sum("together").alias("together")).collect()}
    true, together = np.array([sums[i] for i in own.tolist()], dtype=np.int64).T
    linked = np.flatnonzero(true > 0)
    if not len(linked):
        return None
    recall = np.minimum(np.minimum(mine, true), together)[linked] / true[linked]
    weight = np.array([held[k] / np.count_nonzero(layer == k) for k in layer.tolist()])[linked]
    class_ = np.frexp(true[linked].astype(np.float64))[1]
    return min(float(np.average(recall[class_ == c], weights=weight[class_ == c])) for c in np.unique(class_))


def _one_length(rows: DataFrame, threshold: float) -> DataFrame:
    """(vec, n_links, component_id, recall) of the distinct vectors of (id, vec), all of one length."""
    groups = rows.groupBy("vec").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    vectors = cut(groups.withColumn("node", F.monotonically_increasing_id()))
    count = vectors.count()
    sample = vectors.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).select("vec").toArrow()
    wanted = min(CENTROIDS, -(-count // PER_CENTROID))
    centroids = fit_centroids(_unit(_matrix(sample.column("vec"))), wanted)
    slack, overlap, beam = SLACK / np.sqrt(centroids.shape[1]), OVERLAP, BEAM
    for _ in range(ATTEMPTS):
        whole = _tied(vectors, cut(_links(vectors, centroids, threshold, slack, overlap, beam)))
        recall = _audit(whole, threshold)
        if recall is None or recall >= RECALL:
            break
        slack, overlap, beam = 2 * slack, 2 * overlap, 2 * beam
    else:
        whole, recall = _tied(vectors, cut(_exact(vectors, threshold))), 1.0
    lowest = whole.groupBy("root").agg(F.min("low").alias("component_id"))
    n_links = F.col("links") + F.col("n") - 1
    return whole.join(lowest, "root").select("vec", n_links.alias("n_links"), "component_id", F.lit(recall).cast("double").alias("recall"))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) for every row of `df`.

    Vectors link at a cosine of `threshold` or more; n_links counts the other rows a row is linked with, rows
    that repeat a vector included. Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing: they are their own component. Vectors of different lengths never link. Null ids are
    linked, and name a component only if no member has an id. Other columns are not read; an empty table
    gives no rows. `recall` is what the audit found, null where none of the vectors drawn has a link.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    good = usable(F.col("vec"))
    none = F.lit(None).cast("double")
    results = [
        rows.where(~good).select(
            F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"), none.alias("recall")
        )
    ]
    lengths = [r[0] for r in rows.where(good).select(F.size("vec")).distinct().orderBy(F.size("vec")).collect()]
    for length in lengths:
        same = rows.where(good & (F.size("vec") == length))
        classes = _one_length(same, threshold)
        kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
        results.append(same.join(classes, "vec").select(F.col("id").alias("vec_id"), "n_links", "component_id", kept, "recall"))
    whole = results[0]
    for other in results[1:]:
        whole = whole.unionByName(other)
    return whole
