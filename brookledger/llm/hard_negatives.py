"""Hard-negative mining: windows of inner products searched in cover trees over norm-augmented candidates."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookledger.llm.batches import column
from brookledger.llm.shared_folder import written

#: Positives of an anchor, negatives of each, and the window of a negative's score in percent of the positive's.
N_POSITIVES, N_NEGATIVES, LOW, HIGH = 5, 5, 80, 100
#: Vectors that the top level is picked from, and its centres, at most; vectors of a centre, about.
FIT_MOST, MAX_CENTRES, PER_CENTRE = 16_384, 1024, 8192
#: Members and anchors that meet in one task at most (about).
MEMBERS, ANCHORS = 16_384, 4096
#: Children of a node and members of a leaf at most, and how a level's radius shrinks to the next.
CHILDREN, LEAF, SHRINK = 16, 1024, 0.7
#: Whole numbers up to this are exact in double precision.
EXACT = float(1 << 53)
UNBOUNDED = 1 << 62


# ---- bounds --------------------------------------------------------------------
def augmented(x: np.ndarray, largest: float) -> np.ndarray:
    """Vectors with one more coordinate that gives all of them the norm ``largest``; an anchor's is 0, so products stay."""
    rest = np.sqrt(np.maximum(largest * largest - (x * x).sum(axis=1), 0.0))
    return np.column_stack([x, rest])


def product_bounds(q: np.ndarray, centres: np.ndarray, radii: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) product of each anchor with any candidate within ``radii`` of each centre.

    All candidates lie on a sphere, so their angle to the anchor differs from
    the centre's by no more than the covering radius spans there.
    """
    scale = np.sqrt((q * q).sum(axis=1))[:, None] * largest
    straight = q @ centres[:, :-1].T
    cosine = np.clip(np.divide(straight, scale, out=np.zeros_like(straight), where=scale > 0), -1.0, 1.0)
    angle = np.arccos(cosine)
    reach = 2 * np.arcsin(np.clip(radii / (2 * largest) if largest > 0 else np.zeros_like(radii), 0.0, 1.0)) + 1e-7
    slack = 1e-9 * scale + 1e-6
    return scale * np.cos(np.minimum(angle + reach, math.pi)) - slack, scale * np.cos(np.maximum(angle - reach, 0.0)) + slack


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered vectors with one, cut off at the ends of a long's range."""
    whole = [sum(int(a) * int(b) for a, b in zip(row, q)) for row in x.tolist()]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, v)) for v in whole], np.int64)


# ---- the tree ------------------------------------------------------------------
@dataclass
class Node:
    """Candidates within ``radius`` of a centre: a range of the tree's order, with children unless it is a leaf."""

    low: int
    high: int
    children: list["Node"]
    centres: np.ndarray | None = None  # of the children
    radii: np.ndarray | None = None
    label: object = None  # the label of all its candidates, or None


class CoverTree:
    """Levels of centres, each a candidate; those of a node lie further apart than its level's radius.

    Every candidate belongs to the nearest centre of its parent's children and
    radii are measured, so they cover whatever the fan-out. Equal vectors share
    a leaf.
    """

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, largest: float):
        self.largest = largest
        points = augmented(x, largest)
        self.order = np.arange(len(x))
        self.labels = labels
        self.root = self._build(points, 0, len(x), points[0] if len(x) else np.zeros(points.shape[1]))
        self.x, self.ids, self.labels = x[self.order], ids[self.order], labels[self.order]
        self.widest = float(np.abs(x).max()) * max(1, x.shape[1]) if x.size else 0.0

    def scores(self, node: Node, q: np.ndarray, exact: bool) -> np.ndarray:
        own = self.x[node.low : node.high]
        return own @ q if exact else products(own, q)

    def _build(self, points: np.ndarray, low: int, high: int, centre: np.ndarray) -> Node:
        own = self.order[low:high]
        labels = self.labels[own]
        node = Node(low, high, [], label=labels[0] if len(labels) and (labels == labels[0]).all() else None)
        if high - low <= LEAF:
            return node
        away = np.sqrt(((points[own] - centre) ** 2).sum(axis=1))
        radius = float(away.max()) * SHRINK
        if radius <= 0:
            return node
        # A net of the next level: the nearest to the parent's centre first, then always the one that is least covered.
        picked = [int(away.argmin())]
        nearest, owner = np.sqrt(((points[own] - points[own[picked[0]]]) ** 2).sum(axis=1)), np.zeros(len(own), np.int64)
        most = min(CHILDREN, 2 * -(-len(own) // LEAF))
        while len(picked) < most and nearest.max() > radius:
            picked.append(int(nearest.argmax()))
            d = np.sqrt(((points[own] - points[own[picked[-1]]]) ** 2).sum(axis=1))
            closer = d < nearest
            nearest[closer], owner[closer] = d[closer], len(picked) - 1
        if len(picked) == 1:
            return node
        by_owner = np.argsort(owner, kind="stable")
        centres = points[own[picked]]
        self.order[low:high] = own[by_owner]
        ends = np.searchsorted(owner[by_owner], np.arange(len(picked) + 1))
        node.centres, node.radii = centres, np.array([nearest[owner == k].max() for k in range(len(picked))])
        node.children = [self._build(points, low + a, low + b, c) for a, b, c in zip(ends[:-1].tolist(), ends[1:].tolist(), centres)]
        return node

    def search(self, q: np.ndarray, own_id: int, label, same: bool, windows: list["Best"]) -> None:
        """Offer to each window the candidates of the anchor's label (or of all others) that may be among its best.

        Best-first: the node with the greatest possible product in reach of a
        window comes next. A node is skipped when it has no candidate of a wanted
        label or its products lie outside what every window still takes.
        """
        top = max(w.high for w in windows)
        exact = self.widest * (float(np.abs(q).max()) if q.size else 0.0) < EXACT
        heap: list[tuple[float, int, Node]] = [(-float(top), 0, self.root)]
        pushed = 0
        least = min(w.least for w in windows)
        while heap:
            greatest, _, node = heapq.heappop(heap)
            if -greatest < least:
                break
            if node.label is not None and (node.label == label) != same:
                continue
            if node.children:
                low, high = product_bounds(q[None], node.centres, node.radii, self.largest)
                for child, a, b in zip(node.children, low[0].tolist(), high[0].tolist()):
                    if any(b >= w.least and a <= w.high for w in windows):
                        pushed += 1
                        heapq.heappush(heap, (-min(b, float(top)), pushed, child))
                continue
            scores = self.scores(node, q, exact)
            inside = np.flatnonzero((scores >= least) & (scores <= top))
            if not len(inside):
                continue
            at = node.low + inside
            inside = inside[((self.labels[at] == label) == same) & (self.ids[at] != own_id)]
            if not len(inside):
                continue
            found, ids = scores[inside].astype(np.int64), self.ids[node.low + inside]
            for w in windows:
                own = (found <= w.high) & (found >= w.least)
                if own.any():
                    w.offer(found[own], ids[own])
            least = min(w.least for w in windows)


class Best:
    """The best few (score, id) of a window: higher scores first, then smaller ids."""

    def __init__(self, low: int, high: int, n: int):
        self.least, self.high, self.n = low, high, n
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        best = np.lexsort((ids, ~scores))[: self.n]
        self.scores, self.ids = scores[best], ids[best]
        if len(best) == self.n:
            self.least = int(self.scores[-1])


# ---- rows ----------------------------------------------------------------------
def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part, with floor(256 * component) as bytes of doubles, and the square of the norm."""
    for batch in batches:
        keep, raw, dims, squares = [], [], [], []
        labels, ids = column(batch, "label"), column(batch, "vec_id")
        for k, v in enumerate(column(batch, "embedding")):
            values = v.values
            if values is None or values.null_count or not labels[k].is_valid or not ids[k].is_valid:
                continue
            x = values.to_numpy(zero_copy_only=False).astype("<f8")
            if not np.isfinite(x).all():
                continue
            x = np.floor(256.0 * x) + 0.0
            if not np.isfinite(x).all():
                continue
            keep.append(k)
            raw.append(x.tobytes())
            dims.append(len(x))
            squares.append(float(x @ x))
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(keep, pa.int64())), labels.take(pa.array(keep, pa.int64())), pa.array(raw, pa.binary()), pa.array(dims, pa.int32()), pa.array(squares, pa.float64())],
            ["vec_id", "label", "raw", "dim", "square"])


def _matrix(raw, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), dim)


@dataclass
class Top:
    """The top level of the tree of one dimension: centres from a bounded sample, and what they cover."""

    centres: np.ndarray  # augmented
    largest: float
    radii: np.ndarray | None = None


def _top(rows: DataFrame) -> dict[int, Top]:
    """Centres far apart from each other, picked from at most FIT_MOST vectors of each dimension."""
    sizes = {r["dim"]: (r["n"], math.sqrt(r["square"]) * (1 + 1e-12)) for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("square")).collect()}
    draw = F.pmod(F.xxhash64("vec_id", F.lit("top")), F.lit(1 << 52)) / float(1 << 52)
    total = sum(n for n, _ in sizes.values())
    sample = rows.where(draw < F.lit(FIT_MOST / max(1, total))).select("dim", "raw", "vec_id").orderBy("dim", "vec_id", "raw").toPandas()
    tops = {}
    for dim, (n, largest) in sizes.items():
        raw = sample.loc[sample["dim"] == dim, "raw"]
        points = augmented(_matrix(raw, dim) if len(raw) else np.zeros((1, dim)), largest)
        wanted = max(1, min(MAX_CENTRES, -(-n // PER_CENTRE), len(points)))
        picked, nearest = [0], ((points - points[0]) ** 2).sum(axis=1)
        while len(picked) < wanted and nearest.max() > 0:
            picked.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, ((points - points[picked[-1]]) ** 2).sum(axis=1))
        tops[dim] = Top(points[picked], largest)
    return tops


def _placed(shared):
    """Each candidate with its nearest centre and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = column(batch, "dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part, top = batch.filter(pa.array(dims == dim)), shared.value[dim]
                points = augmented(_matrix([r.as_buffer().to_pybytes() for r in column(part, "raw")], dim), top.largest)
                centre, away = np.zeros(len(points), np.int32), np.zeros(len(points))
                for at in range(0, len(points), 1024):
                    own = points[at : at + 1024]
                    centre[at : at + 1024] = ((top.centres**2).sum(axis=1) / 2 - own @ top.centres.T).argmin(axis=1)
                    away[at : at + 1024] = np.sqrt(((own - top.centres[centre[at : at + 1024]]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [*(column(part, n) for n in ("vec_id", "label", "raw", "dim")), pa.array(centre), pa.array(away)], ["vec_id", "label", "raw", "dim", "centre", "away"])

    return run


def _routed(shared, first: bool):
    """Each anchor with the centres to look into: the most promising one, or all others that its windows reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, centres = [], []
            windows = column(batch, "windows").to_pylist()
            for k, (dim, raw) in enumerate(zip(column(batch, "dim").to_pylist(), column(batch, "raw").to_pylist())):
                top = shared.value[dim]
                q = np.frombuffer(raw, "<f8")[None]
                promising = int((q @ top.centres[:, :-1].T)[0].argmax())
                if first:
                    chosen = [promising]
                else:
                    low, high = product_bounds(q, top.centres, top.radii, top.largest)
                    reached = np.zeros(len(top.centres), bool)
                    for w in windows[k]:
                        reached |= (high[0] >= w["least"]) & (low[0] <= w["high"])
                    reached[promising] = False
                    chosen = np.flatnonzero(reached).tolist()
                keep += [k] * len(chosen)
                centres += chosen
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(centres, pa.int32())], [*batch.schema.names, "centre"])

    return run


FOUND = "anchor_id long, label {label}, dim int, raw binary, k int, other_id long, score long"


def _cell(shared, same: bool, n: int):
    """The best of some candidates for each window of some anchors."""

    def run(anchors: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out = {name: [] for name in ("anchor_id", "label", "dim", "raw", "k", "other_id", "score")}
        if len(anchors) and len(members):
            dim = int(members["dim"].iloc[0])
            tree = CoverTree(_matrix(members["raw"], dim), members["vec_id"].to_numpy(), members["label"].to_numpy(), shared.value[dim].largest)
            for row in anchors.itertuples():
                windows = [Best(int(w["least"]), int(w["high"]), n) for w in row.windows]
                tree.search(np.frombuffer(row.raw, "<f8"), row.anchor_id, row.label, same, windows)
                for w, best in zip(row.windows, windows):
                    out["other_id"] += best.ids.tolist()
                    out["score"] += best.scores.tolist()
                    for name, value in (("anchor_id", row.anchor_id), ("label", row.label), ("dim", row.dim), ("raw", row.raw), ("k", w["k"])):
                        out[name] += [value] * len(best.ids)
        return pd.DataFrame(out)

    return run


def _search(anchors: DataFrame, placed: DataFrame, shared, same: bool, n: int, label: str) -> DataFrame:
    """The best ``n`` candidates of each window (anchor_id, label, dim, raw, k): with other_id, score and rank.

    anchors: anchor_id, label, dim, raw, windows array<struct<k, least, high>>.
    Each anchor first asks the centre that promises most; its worst find there
    is the least that the other centres have to offer it.
    """
    sizes = placed.groupBy("dim", "centre").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("members"))
    kind = FOUND.format(label=label)
    names = ["anchor_id", "label", "dim", "raw"]

    def asked(rows: DataFrame, first: bool) -> DataFrame:
        routed = written(rows.mapInArrow(_routed(shared, first), f"{_schema(rows)}, centre int"), "routed")
        loads = routed.groupBy("dim", "centre").agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("blocks"))
        cells = written(sizes.join(loads, ["dim", "centre"]), "cells")
        block, part = F.pmod(F.xxhash64("anchor_id"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("vec_id"), F.col("members")).cast("int")
        queries = routed.join(cells, ["dim", "centre"]).withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("members") - 1)))
        members = placed.join(cells, ["dim", "centre"]).withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        keys = ["dim", "centre", "block", "part"]
        queries = queries.select(*(F.col(c).alias(c) for c in [*keys, "anchor_id", "label", "raw", "windows"]))
        members = members.select(*(F.col(c).alias(c) for c in [*keys, "vec_id", "label", "raw"]))
        return queries.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(_cell(shared, same, n), kind)

    order = Window.partitionBy(*names, "k").orderBy(F.col("score").desc(), "other_id")
    found = written(asked(anchors, True), "found-first")
    worst = found.groupBy(*names, "k").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst")).where(F.col("n") >= n)
    open_windows = anchors.select(*names, F.inline("windows")).join(worst, [*names, "k"], "left").select(
        *names, F.struct("k", F.greatest("least", F.coalesce("worst", "least")).alias("least"), "high").alias("w"))
    still = open_windows.groupBy(*names).agg(F.sort_array(F.collect_list("w")).alias("windows"))
    ranked = found.unionByName(asked(still, False)).withColumn("rank", F.row_number().over(order))
    return written(ranked.where(F.col("rank") <= n), "found")


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product with the anchor of whole numbers, floor(256 *
    component); higher scores come first, ties by smaller id. An anchor's
    positives are its first ``n_positives`` other rows of its label; negatives
    of each are the first ``n_negatives`` rows of other labels with
    low * positive <= 100 * negative <= high * positive (fewer where there are
    no more, none where the positive score is negative).

    Rows whose id, label or vector is null, or with a null or non-finite
    component, take no part. Vectors of another length than the anchor's are
    not compared with it. Rows that repeat id, label and vector count once; rows
    of the anchor's own id are never its positive or negative. Scores outside
    the range of a long are cut off at its ends. ``is_anchor`` is a condition on
    ``vec_id``. Other columns are ignored.

    Candidates are dealt to the nearest centre of the tree's top level (bounded:
    at most MAX_CENTRES from FIT_MOST vectors); each task builds the tree below
    over at most about MEMBERS of them and answers at most about ANCHORS
    anchors, so neither a common vector nor a centre with a third of all rows
    is one task. Anchors meet only centres that their windows reach.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[label].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    rows = written(rows.mapInArrow(_whole, f"vec_id long, label {kind}, raw binary, dim int, square double").dropDuplicates(["vec_id", "label", "raw"]), "candidates")
    tops = _top(rows)
    placed = written(rows.mapInArrow(_placed(spark.sparkContext.broadcast(tops)), f"vec_id long, label {kind}, raw binary, dim int, centre int, away double"), "placed")
    for top in tops.values():
        top.radii = np.zeros(len(top.centres))
    for r in placed.groupBy("dim", "centre").agg(F.max("away").alias("away")).collect():  # at most MAX_CENTRES rows for each dimension
        tops[r["dim"]].radii[r["centre"]] = r["away"]
    shared = spark.sparkContext.broadcast(tops)

    whole = F.array(F.struct(F.lit(0).alias("k"), F.lit(-UNBOUNDED * 2).cast("long").alias("least"), F.lit(UNBOUNDED * 2 - 1).cast("long").alias("high")))
    anchors = placed.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "dim", "raw", whole.alias("windows"))
    positives = _search(anchors, placed, shared, True, n_positives, kind)
    # A division of longs cuts towards zero: right for scores from 0 on, and others have no window. The lower end is rounded up.
    window = F.struct(F.col("rank").cast("int").alias("k"), F.expr(f"({low} * wide + 99) div 100").alias("least"), F.expr(f"({high} * wide) div 100").alias("high"))
    windows = positives.where("score >= 0").withColumn("wide", F.col("score").cast("decimal(24,0)")).groupBy("anchor_id", "label", "dim", "raw").agg(F.sort_array(F.collect_list(window)).alias("windows"))
    negatives = _search(windows, placed, shared, False, n_negatives, kind)
    names = ["anchor_id", "label", "dim", "raw"]
    of = positives.select(*names, F.col("rank").alias("k"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.withColumnsRenamed({"other_id": "negative_id", "score": "negative_score"}).join(of, [*names, "k"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
