"""Embedding near-dedup by product quantisation: inverted lists, residual codes, exact rerank."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookledger.llm.batches import column
from brookledger.llm.components import components
from brookledger.llm.shared_folder import written

THRESHOLD = 0.93
#: Vectors that the index is fitted on at least and at most, lists at most.
FIT_LEAST, FIT_MOST, MAX_LISTS = 20_000, 131_072, 4096
SUBSPACES, CODES = 8, 256
#: Vectors of a tile, on each side.
TILE = 1024


# ---- the index -------------------------------------------------------------
def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    out = np.empty(len(x), np.int64)
    for at in range(0, len(x), 4096):
        out[at : at + 4096] = (x[at : at + 4096] @ centres.T - half).argmax(axis=1)
    return out


def _k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres by Lloyd's rounds from evenly spaced members; an empty centre stays where it is."""
    k = max(1, min(k, len(x)))
    centres = x[np.linspace(0, len(x) - 1, k).astype(np.int64)].copy()
    for _ in range(rounds):
        nearest = _nearest(x, centres)
        n = np.bincount(nearest, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, x)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


@dataclass
class Index:
    """Coarse centres, and for each subspace the codebook of what is left after them."""

    centres: np.ndarray
    books: np.ndarray  # (subspace, code, coordinate)

    @staticmethod
    def fit(x: np.ndarray, lists: int) -> "Index":
        centres = _k_means(x, lists)
        rest = _padded(x - centres[_nearest(x, centres)])
        books = [_k_means(rest[:20_000, m], CODES) for m in range(SUBSPACES)]
        return Index(centres, np.stack(books))

    @staticmethod
    def trivial(dim: int) -> "Index":
        return Index(np.zeros((1, dim)), np.zeros((SUBSPACES, 1, -(-dim // SUBSPACES))))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, error): error is the distance between a vector and what its codes stand for."""
        nearest = _nearest(x, self.centres)
        rest = _padded(x - self.centres[nearest])
        codes = np.stack([_nearest(rest[:, m], self.books[m]) for m in range(SUBSPACES)], axis=1).astype(np.uint8)
        error = np.sqrt(sum(((rest[:, m] - self.books[m][codes[:, m]]) ** 2).sum(axis=1) for m in range(SUBSPACES)))
        return nearest, codes, error

    def probes(self, x: np.ndarray, nearest: np.ndarray, radius: float) -> list[np.ndarray]:
        """Lists whose cut (the plane half way between the centres) lies within half the ``radius`` of each vector.

        Two vectors of different lists lie on different sides of the cut between
        their centres, so their distances from it add up to at most their own.
        One of two vectors within the radius therefore lies within half of it
        from the cut: each link is found from one of its ends at least.
        """
        limit = radius / 2
        square = (self.centres**2).sum(axis=1)
        out = []
        for at in range(0, len(x), 1024):
            part, own = x[at : at + 1024], nearest[at : at + 1024]
            reach = square - 2 * part @ self.centres.T
            apart = np.sqrt(np.maximum(square[own][:, None] + square - 2 * self.centres[own] @ self.centres.T, 0))
            ahead = reach - reach[np.arange(len(part)), own][:, None]
            out += [np.flatnonzero(r) for r in ahead <= 2 * limit * apart + 1e-12]
        return out

    def distances(self, q: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """From each query to each coded vector of a list, by tables of the query's own distances to the codes."""
        rest = _padded(q - self.centres[which])
        total = np.zeros((len(q), len(codes)))
        for m in range(SUBSPACES):
            book = self.books[m]
            table = (rest[:, m] ** 2).sum(axis=1)[:, None] + (book**2).sum(axis=1) - 2 * rest[:, m] @ book.T
            total += table[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def _padded(x: np.ndarray) -> np.ndarray:
    """(vector, subspace, coordinate), with zeros to fill the last one."""
    width = -(-x.shape[1] // SUBSPACES)
    out = np.zeros((len(x), SUBSPACES * width))
    out[:, : x.shape[1]] = x
    return out.reshape(len(x), SUBSPACES, width)


def _unit(raw, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(-1, dim)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# ---- rows ------------------------------------------------------------------
def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's vector as bytes of doubles; null where it links with nothing."""
    for batch in batches:
        raw, dims = [], []
        labels = column(batch, "label")
        ids = column(batch, "vec_id")
        for k, v in enumerate(column(batch, "embedding")):
            values = v.values
            x = None
            if values is not None and len(values) and values.null_count == 0 and labels[k].is_valid and ids[k].is_valid:
                x = values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
                largest = np.abs(x).max()
                if not (np.isfinite(x).all() and largest > 0):
                    x = None
                elif not 1e-100 < largest < 1e100:
                    x = x / largest  # squares would leave the range of doubles
            raw.append(None if x is None else x.tobytes())
            dims.append(None if x is None else len(x))
        yield pa.RecordBatch.from_arrays([ids, labels, pa.array(raw, pa.binary()), pa.array(dims, pa.int32())], ["vec_id", "label", "raw", "dim"])


def _fit(nodes: DataFrame) -> dict[int, Index]:
    """An index for each dimension, on a bounded sample drawn by a hash of the row."""
    sizes = {r["dim"]: r["count"] for r in nodes.groupBy("dim").count().collect()}
    total = sum(sizes.values())
    lists = {d: max(1, min(MAX_LISTS, math.isqrt(n))) for d, n in sizes.items()}
    wanted = min(FIT_MOST, max([FIT_LEAST, *(32 * k for k in lists.values())]))
    draw = F.pmod(F.xxhash64("node", F.lit("fit")), F.lit(1_000_000)) / 1_000_000
    sample = nodes.where(draw < F.lit(wanted / max(1, total))).select("node", "dim", "raw").orderBy("node").toPandas()
    return {d: Index.fit(_unit(part["raw"], d), lists[d]) for d, part in sample.groupby("dim")}


def _coded(indexes, radius: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = column(batch, "dim").to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                index = indexes.value.get(d) or Index.trivial(d)
                x = _unit([r.as_buffer().to_pybytes() for r in column(part, "raw")], d)
                nearest, codes, error = index.encode(x)
                probes = index.probes(x, nearest, radius)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(column(part, n) for n in ("node", "label", "dim", "copies", "raw")), pa.array(nearest.astype(np.int32)),
                        pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array([p.astype(np.int32) for p in probes], pa.list_(pa.int32())),
                    ],
                    ["node", "label", "dim", "copies", "raw", "list", "codes", "error", "probes"],
                )

    return run


CODED = "node long, label {label}, dim int, copies long, raw binary, list int, codes binary, error double, probes array<int>"


# ---- tiles -----------------------------------------------------------------
def _roots(q: np.ndarray, x: np.ndarray, n_q: int, n_x: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest position reachable over the pairs (q, x), for both sides."""
    of_q, of_x = np.arange(n_q), np.full(n_x, n_q)
    while True:
        before = of_q.copy()
        np.minimum.at(of_x, x, of_q[q])
        np.minimum.at(of_q, q, of_x[x])
        if (before == of_q).all():
            return of_q, of_x


def _tile(indexes, threshold: float, radius: float):
    def run(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"node": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
        if not len(queries) or not len(members):
            return empty
        dim, which = int(queries["dim"].iloc[0]), int(members["list"].iloc[0])
        index = indexes.value.get(dim) or Index.trivial(dim)
        q, x = _unit(queries["raw"], dim), _unit(members["raw"], dim)
        codes = np.frombuffer(b"".join(members["codes"]), np.uint8).reshape(-1, SUBSPACES)
        error, copies = members["error"].to_numpy(), members["copies"].to_numpy()
        q_node, x_node = queries["node"].to_numpy(), members["node"].to_numpy()
        found_q, found_x = [], []
        for at in range(0, len(q), 256):
            # What the codes stand for is at most ``error`` from the vector: nothing within the radius is left out.
            near = index.distances(q[at : at + 256], which, codes) <= radius + error + 1e-9
            i, j = np.nonzero(near & (q_node[at : at + 256, None] != x_node))
            exact = np.einsum("ij,ij->i", q[at + i], x[j]) if len(i) < 200_000 else (q[at : at + 256] @ x.T)[i, j]
            found_q.append(at + i[exact >= threshold])
            found_x.append(j[exact >= threshold])
        i, j = np.concatenate(found_q), np.concatenate(found_x)
        if not len(i):
            return empty
        n = np.bincount(i, copies[j], len(q)).astype(np.int64)
        # A link counts for the other end too, unless that end looks into this one's list and finds it itself.
        probes = members["probes"]
        n_probes = np.array([len(p) for p in probes], np.int64)
        asking = np.repeat(np.arange(len(x)), n_probes) << 32 | np.concatenate([*probes, np.zeros(0, np.int32)]).astype(np.int64)
        one_sided = ~np.isin(j << 32 | queries["own"].to_numpy(np.int64)[i], asking)
        n_x = np.bincount(j[one_sided], queries["copies"].to_numpy()[i[one_sided]], len(x)).astype(np.int64)
        of_q, of_x = _roots(i, j, len(q), len(x))
        has_q, has_x = np.unique(i), np.unique(j)
        return pd.DataFrame({
            "node": np.concatenate([q_node[has_q], x_node[has_x]]),
            "n": np.concatenate([n[has_q], n_x[has_x]]),
            "root": q_node[np.concatenate([of_q[has_q], of_x[has_x]])],
        })

    return run


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per input row: vec_id, label, n_links, component_id, kept.

    Vectors of one label (and one length) link when their cosine in double
    precision is at least the threshold. Rows whose label, id or vector is null,
    zero, empty or holds null or non-finite components link with nothing;
    component_id is then the own id, and null for a null id, which is not kept.
    Rows that repeat an id and a vector are one vector and get the same result.
    Other columns are ignored.

    Equal vectors of a label are one node with a number of copies. Nodes are
    put in the inverted list of their nearest coarse centre and coded by what is
    left of them; each looks into the lists within half the radius (so one end
    of every link sees it, and it counts for both ends), filters by
    distances from its table and compares the rest exactly. The work on a list
    is cut into tiles of at most about TILE queries and TILE members, so a list
    (or a cluster) with a third of all vectors is many tasks; a tile returns
    counts and a spanning forest of its links, never the pairs.
    """
    spark = vectors.sparkSession
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    kind = vectors.schema[label].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    rows = written(rows.mapInArrow(_vectors, f"vec_id long, label {kind}, raw binary, dim int").withColumn("row", F.monotonically_increasing_id()), "vectors")
    nodes = written(
        rows.where("raw IS NOT NULL").groupBy("label", "dim", "raw", "vec_id").agg(F.min("row").alias("row"))
        .groupBy("label", "dim", "raw").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies")), "nodes")
    indexes = spark.sparkContext.broadcast(_fit(nodes))
    coded = written(nodes.select("node", "label", "dim", "copies", "raw").mapInArrow(_coded(indexes, radius), CODED.format(label=kind)), "coded")

    group = ["label", "dim", "list"]
    asked = coded.select("node", "label", "dim", "raw", "copies", F.col("list").alias("own"), F.explode("probes").alias("list"))
    n_members = coded.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("member_tiles"))
    n_queries = asked.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("query_tiles"))
    tiles = written(n_members.join(n_queries, group), "tiles")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in its own tile row, and in all tiles that the other side adds to it."""
        placed = side.join(tiles, group)
        return placed.withColumn(own, F.pmod(F.xxhash64("node"), F.col(f"{own}s")).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))

    queries = dealt(asked, "query_tile", "member_tile").select(
        *(F.col(n).alias(n) for n in [*group, "query_tile", "member_tile", "node", "raw", "copies", "own"]))  # columns of its own
    members = dealt(coded, "member_tile", "query_tile").select(*group, "query_tile", "member_tile", "node", "raw", "codes", "error", "copies", "probes")
    keys = [*group, "query_tile", "member_tile"]
    found = written(
        queries.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(_tile(indexes, threshold, radius), "node long, n long, root long"), "links")

    linked = found.groupBy("node").agg(F.sum("n").alias("n"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of_node = nodes.join(linked, "node", "left").join(classes, "node", "left").select(
        "label", "dim", "raw", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    result = written(rows.join(of_node, ["label", "dim", "raw"], "left").select("vec_id", "label", "n_links", "component"), "classes")
    # Stored, so that the join with it is of two plain exchanges, whose hot partitions can be split.
    lowest = written(result.where("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("lowest")), "lowest")
    return result.join(lowest, "component", "left").select(
        "vec_id", "label", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("lowest", "vec_id").alias("component_id"), F.coalesce(F.col("vec_id") == F.coalesce("lowest", "vec_id"), F.lit(False)).alias("kept"),
    )
