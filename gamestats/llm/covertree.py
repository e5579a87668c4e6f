"""Exact top-k inner-product search with cover trees on both sides.

The top of the data's cover tree is built on a bounded sample of the vectors;
every vector is then filed under the nearest of its cells, and a cell's
covering radius is taken over all its vectors.  Queries are grouped by a
coarser level of the same tree.  The sample gives each query a first bound on
its kth score; a pair of query group and cell whose best possible score,

    q.c + r_q |c| + r_c |q| + r_q r_c,

is below the group's worst kth score is pruned.  For the pairs that are left
the queries travel to the cells, which are kept in chunks of about ``CHUNK``
vectors: the data are shuffled once, whatever the number of query groups.  There
a local cover tree over the queries and one over the chunk are searched
together with the same rule; a chunk's tree serves all groups that ask it.

Every row has a position in the order of ids and vectors; positions stand for
rows throughout, so that rows that repeat an id stay rows of their own.

Vectors have integer components here (``floor(256 x)``), so scores are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamestats.llm.common import materialize, ship_package, with_global_rank

K = 5
EVERY = 50             # queries: ids divisible by this
SAMPLE = 2048          # vectors that shape the top of the tree
CELLS = 128            # at most, in the level that the data are filed under
CHUNK = 4096           # vectors
GROUP = 1024           # queries
LEAF, SPREAD = 64, 8   # vectors in a leaf of a chunk's tree; in a child, on average
Q_LEAF, Q_SPREAD = 2, 2  # the same for queries: each has a bound of its own
SCALE = 0.5            # covering radius of a level, as a part of the one above
_SLACK = 1e-9


# --- local cover trees --------------------------------------------------------

@dataclass
class Node:
    """Points ``rows`` within ``radius`` of ``centre``."""

    centre: np.ndarray
    radius: float
    rows: np.ndarray
    children: list["Node"] = field(default_factory=list)


def _far(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def cover(points: np.ndarray, radius: float, most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """A net: centres (row numbers) more than ``radius`` apart such that every
    point is within ``radius`` of one, and the centre of each point.  None if
    it takes more than ``most`` centres."""
    near = np.full(len(points), np.inf)
    owner = np.zeros(len(points), np.int64)
    centres: list[int] = []
    while True:
        k = int(near.argmax()) if centres else 0
        if centres and near[k] <= radius:
            return np.array(centres), owner
        if len(centres) == most:
            return None
        d = _far(points, points[k])
        closer = d < near
        near[closer], owner[closer] = d[closer], len(centres)
        centres.append(k)


def build_tree(points: np.ndarray, rows: np.ndarray | None = None, leaf: int = LEAF,
               spread: int = SPREAD) -> Node:
    """Cover tree: each level covers a node's points with balls of ``SCALE`` of
    its radius.  A node of up to ``leaf`` points is a leaf, and one that such a
    net would split into children of fewer than ``spread`` points."""
    rows = np.arange(len(points)) if rows is None else rows
    own = points[rows]
    far = _far(own, own[0])
    node = Node(own[0], float(far.max()), rows)
    if len(rows) > leaf and node.radius > 0:
        net = cover(own, node.radius * SCALE, max(2, len(rows) // spread))
        if net is not None:
            node.children = [build_tree(points, rows[net[1] == k], leaf, spread)
                             for k in range(len(net[0]))]
    return node


def best_possible(q: Node, r: Node) -> float:
    """Upper bound of the inner product between points of two nodes."""
    bound = (float(q.centre @ r.centre) + q.radius * float(np.linalg.norm(r.centre))
             + r.radius * float(np.linalg.norm(q.centre)) + q.radius * r.radius)
    return bound + abs(bound) * _SLACK + 1e-6


class TopK:
    """The best ``k`` of each query so far: by score, then by smaller id."""

    def __init__(self, worst: np.ndarray, k: int):
        self.k = k
        self.products = 0                   # inner products computed
        self.floor = worst.copy()           # a query needs at least this score
        self.score = np.full((len(worst), k), -np.inf)
        self.id = np.full((len(worst), k), np.iinfo(np.int64).max)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores[i, j]`` of query ``rows[i]`` with ``ids[j]``; -inf: none."""
        useful = (scores >= self.floor[rows, None]).any(axis=0)
        if not useful.any():
            return
        s = np.concatenate([self.score[rows], scores[:, useful]], axis=1)
        i = np.concatenate([self.id[rows], np.broadcast_to(
            ids[useful], (len(rows), int(useful.sum())))], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(s, order, 1)
        self.id[rows] = np.take_along_axis(i, order, 1)
        self.floor[rows] = np.maximum(self.floor[rows], self.score[rows, -1])


def dual_search(queries: np.ndarray, query_ids: np.ndarray, worst: np.ndarray,
                data: np.ndarray, ids: np.ndarray, k: int, d_root: Node | None = None) -> TopK:
    """Search a tree over the queries and one over the data (``d_root``, if it
    is there already) together."""
    exact = np.int64 if max(np.abs(queries).max(), np.abs(data).max()) ** 2 * \
        queries.shape[1] >= 2 ** 53 else np.float64
    q_all, d_all = queries.astype(exact), data.astype(exact)
    top = TopK(worst, k)
    q_root, d_root = build_tree(queries, None, Q_LEAF, Q_SPREAD), d_root or build_tree(data)
    stack = [(best_possible(q_root, d_root), q_root, d_root)]
    while stack:
        bound, q, d = stack.pop()
        if bound < top.floor[q.rows].min():
            continue
        if q.children or d.children:
            split_q = q.children and (not d.children or q.radius > d.radius)
            pairs = [(c, d) for c in q.children] if split_q else [(q, c) for c in d.children]
            stack += sorted(((best_possible(a, b), a, b) for a, b in pairs), key=lambda x: x[0])
            continue
        top.products += len(q.rows) * len(d.rows)
        for at in range(0, len(d.rows), 1024):
            rows = d.rows[at:at + 1024]
            scores = (q_all[q.rows] @ d_all[rows].T).astype(np.float64 if exact is np.float64
                                                            else np.longdouble)
            scores[query_ids[q.rows][:, None] == ids[rows][None, :]] = -np.inf
            top.offer(q.rows, scores, ids[rows])
    return top


# --- distributed search -------------------------------------------------------

def integer_vectors(table: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` with ``v`` the components ``floor(256 x)``.  A row whose
    id or vector is null, or whose vector has a null, NaN or infinite
    component, takes no part; rows that repeat an id all stay."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (table.where(F.col(ident).isNotNull() & F.col(vector).isNotNull())
            .select(F.col(ident).cast("long").alias("vec_id"), x.alias("x")).where(~bad)
            .select("vec_id", F.transform("x", lambda c: F.floor(F.lit(256.0) * c)).alias("v")))


def _matrix(lists, dim: int) -> np.ndarray:
    """Rows of one length; shorter vectors are filled with zeros."""
    out = np.zeros((len(lists), dim), np.int64)
    for row, values in zip(out, lists):
        row[:len(values)] = values
    return out


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the distance, in blocks."""
    owner = np.empty(len(points), np.int64)
    away = np.empty(len(points))
    for at in range(0, len(points), 2048):
        p = points[at:at + 2048].astype(float)
        d = (p ** 2).sum(1)[:, None] - 2 * p @ centres.T + (centres ** 2).sum(1)
        k = d.argmin(axis=1)
        owner[at:at + 2048] = k
        away[at:at + 2048] = np.sqrt(((p - centres[k]) ** 2).sum(axis=1))
    return owner, away


def _level(points: np.ndarray, most: int) -> np.ndarray:
    """The finest level of the sample's cover tree with at most ``most``
    centres.  Components are integers, so below a radius of 1 every distinct
    point is a centre and no level is finer."""
    radius = float(_far(points, points[0]).max())
    best = points[:1]
    while radius >= 0.5 and len(best) < most:
        net = cover(points, radius, most)
        if net is None:
            break
        best = points[net[0]]
        radius *= 0.8
    return best


def _file(centres: np.ndarray, dim: int, group_centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column(2).to_pylist(), dim)
            if not len(m):
                continue
            cell, away = _nearest(m, centres)
            group, _ = _nearest(m, group_centres)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int64()),
                pa.array([r.tobytes() for r in m], pa.binary()),
                pa.array(cell, pa.int64()), pa.array(away, pa.float64()),
                pa.array(group, pa.int64())], names=["pos", "vec_id", "v", "cell", "away", "grp"])
    return run


def _group_queries(sample: np.ndarray, sample_ids: np.ndarray, centres: np.ndarray,
                   radii: np.ndarray, dim: int, k: int):
    """Per query group: its queries, their first bounds, and the cells that the
    group cannot do without."""
    cells = [Node(c, r, np.empty(0, np.int64)) for c, r in zip(centres, radii)]

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        ids = pdf["pos"].to_numpy(np.int64)
        q = np.frombuffer(b"".join(pdf["v"]), np.int64).reshape(len(pdf), dim)
        scores = (q.astype(float) @ sample.T.astype(float))
        scores -= np.abs(scores) * _SLACK + 1e-6
        scores[ids[:, None] == sample_ids[None, :]] = -np.inf
        worst = (np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k
                 else np.full(len(ids), -np.inf))
        mean = q.mean(axis=0)
        group = Node(mean, float(_far(q, mean).max()), np.arange(len(ids)))
        kept = [c for c, cell in enumerate(cells)
                if radii[c] >= 0 and best_possible(group, cell) >= worst.min()]
        return pd.DataFrame({
            "grp": [key[0]], "part": [key[1]], "q_ids": [ids.tobytes()],
            "q_names": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
            "q": [q.tobytes()], "worst": [worst.tobytes()], "cells": [kept]})
    return run


def _chunk(key, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("pos")
    return pd.DataFrame({"cell": [key[0]], "chunk": [key[1]],
                         "ids": [pdf["pos"].to_numpy(np.int64).tobytes()],
                         "names": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                         "m": [b"".join(pdf["v"])]})


def _search(dim: int, k: int):
    """Rows ``(cell, chunk, queries, data)``; those of a chunk follow each
    other, so its tree is built once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, data, ids, names, root = None, None, None, None, None
        for batch in batches:
            for row in range(batch.num_rows):
                cell, chunk, q_ids, q_names, q, worst = (
                    batch.column(c)[row].as_py() for c in range(6))
                if held != (cell, chunk):
                    held = (cell, chunk)
                    ids, names, m = (np.frombuffer(batch.column(c)[row].as_py(), np.int64)
                                     for c in range(6, 9))
                    data = m.reshape(-1, dim)
                    root = build_tree(data)
                query_ids, query_names = np.frombuffer(q_ids, np.int64), np.frombuffer(q_names, np.int64)
                queries = np.frombuffer(q, np.int64).reshape(-1, dim)
                top = dual_search(queries, query_ids, np.frombuffer(worst, np.float64),
                                  data, ids, k, root)
                hit = (top.score > -np.inf) & (top.score >= np.frombuffer(worst)[:, None])
                at = np.nonzero(hit)
                # the integer scores themselves, of the few that are left
                where = np.searchsorted(ids, top.id[hit])
                exact = (queries[at[0]] * data[where]).sum(axis=1, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[at[0]]), pa.array(query_names[at[0]]),
                     pa.array(top.id[hit]), pa.array(names[where]), pa.array(exact)],
                    names=["query", "query_id", "pos", "vec_id", "score"])
    return run


def top_k_search(table: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each vector whose id is
    divisible by ``every``, the ``k`` other vectors of the highest integer
    inner product, ties to the smaller id; all of them if there are fewer.

    Rows that repeat a ``vec_id`` are vectors of their own: each is a candidate
    of every other row, and each is a query with its own ranks if the id is
    divisible by ``every``.  See ``integer_vectors`` for rows that take no part.  Vectors of different
    lengths are compared as if the shorter one went on with zeros.  Scores are
    64-bit.  An empty table, or a query without another vector, gives no row.
    """
    spark = table.sparkSession
    ship_package(spark)
    vectors = materialize(
        with_global_rank(integer_vectors(table), [F.col("vec_id"), F.col("v")], "pos")
        .select("pos", "vec_id", "v"), "vectors")
    sizes = vectors.agg(F.max(F.size("v")).alias("d"), F.count(F.lit(1)).alias("n"),
                        F.sum((F.col("vec_id") % every == 0).cast("long")).alias("q")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not sizes["n"] or not sizes["q"]:
        return spark.createDataFrame([], schema)
    dim = max(1, sizes["d"])
    picked = (vectors.orderBy(F.xxhash64("pos"), "pos").limit(SAMPLE)).collect()
    sample_ids = np.array([r["pos"] for r in picked], np.int64)
    sample = _matrix([r["v"] for r in picked], dim)
    points = sample.astype(float)
    centres = _level(points, CELLS)
    groups = max(1, math.ceil(sizes["q"] / GROUP))
    group_centres = _level(points, min(groups, CELLS))

    filed = materialize(vectors.mapInArrow(
        _file(centres, dim, group_centres),
        "pos long, vec_id long, v binary, cell long, away double, grp long"), "filed")
    spread = filed.groupBy("cell").agg(F.max("away").alias("r"),
                                       F.count(F.lit(1)).alias("n")).collect()  # <= CELLS rows
    radii = np.full(len(centres), -1.0)
    for row in spread:
        radii[row["cell"]] = row["r"] * (1 + _SLACK) + 1e-6
    in_chunks = {r["cell"]: math.ceil(r["n"] / CHUNK) for r in spread}
    chunks = F.element_at(F.create_map(*[F.lit(x) for kv in in_chunks.items() for x in kv]),
                          F.col("cell"))
    data = (filed.select("pos", "vec_id", "v", "cell",
                         F.pmod(F.xxhash64("pos"), chunks).cast("long").alias("chunk"))
            .groupBy("cell", "chunk")
            .applyInPandas(_chunk, "cell long, chunk long, ids binary, names binary, m binary"))
    asked = filed.where(F.col("vec_id") % every == 0)
    per_group = asked.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()  # <= CELLS rows
    parts = F.element_at(F.create_map(*[F.lit(x) for r in per_group
                                        for x in (r["grp"], math.ceil(r["n"] / GROUP))]),
                         F.col("grp"))
    queries = materialize(
        asked.select("pos", "vec_id", "v", "grp",
                     F.pmod(F.xxhash64("pos", F.lit(1)), parts).cast("long").alias("part"))
        .groupBy("grp", "part")
        .applyInPandas(_group_queries(sample, sample_ids, centres, radii, dim, k),
                       "grp long, part long, q_ids binary, q_names binary, q binary, worst binary, "
                       "cells array<long>"), "query-groups")
    data = materialize(data, "chunks")
    pairs = (queries.select("grp", "part", F.explode("cells").alias("cell"))
             .join(data.select("cell", "chunk"), "cell"))
    met = (pairs.join(queries.drop("cells"), ["grp", "part"])
           .join(data.hint("merge"), ["cell", "chunk"])     # sorted: a chunk's rows follow each other
           .select("cell", "chunk", "q_ids", "q_names", "q", "worst", "ids", "names", "m"))
    found = met.mapInArrow(
        _search(dim, k), "query long, query_id long, pos long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("pos"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
