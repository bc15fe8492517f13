"""N-gram Jaccard join with set-relation skipping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookledger.llm import shared_grams as grams
from brookledger.llm.batches import NOT_SPACE, Hasher, Texts, column, mix, slices, small_batches
from brookledger.llm.components import components
from brookledger.llm.row_keys import rows_of_keys
from brookledger.llm.shared_folder import release_exchanges, written
from brookledger.llm.worker_memory import turn_of
from brookledger.sources.tables import new_folder, staged_copies_removed

WORDS = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: A list is crowded when it has more open pairs than this for each set outside its largest component.
CROWDED = 64
#: Hubs of a crowded list in a round.
HUBS = 32
PART = 1 << 14  # counters of a sketch that travel together

_HASH = Hasher(101)


# ---- sets ------------------------------------------------------------------
class Sets:
    """The shingle sets of some texts: sorted, without repeats, one after the other."""

    def __init__(self, texts: pa.Array, size: int, rarity: np.ndarray | None = None):
        words = Texts(texts, lower=True)
        words.split(NOT_SPACE)
        hashes = _HASH.words(words.text, words.starts, words.lengths)
        at, owner = words.places(size)
        values = _HASH.runs(hashes, at, size)
        # A text of fewer words is one shingle, of all its words.
        for k in np.flatnonzero((words.counts > 0) & (words.counts < size)):
            short = _HASH.runs(hashes, words.first[k : k + 1], int(words.counts[k]))
            values, owner = np.append(values, short), np.append(owner, k)
        order = np.argsort(values)
        if rarity is not None:
            order = order[np.argsort(rarity[values[order] & np.uint64(len(rarity) - 1)], kind="stable")]
        order = order[np.argsort(owner[order].astype(np.uint16), kind="stable")]
        values, owner = values[order], owner[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        self.values, self.owner = values[new], owner[new]
        self.bounds = np.searchsorted(self.owner, np.arange(len(texts) + 1))

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def digests(self) -> list[bytes]:
        """16 bytes for each set, which do not depend on the order."""
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (mix(self.values), mix(self.values ^ np.uint64(0xA5A5A5A5DEADBEEF)))]
        pairs = np.column_stack([mix(np.diff(s[self.bounds]) + self.sizes.astype(np.uint64)) for s in sums])
        return [p.tobytes() for p in pairs]


def _profiles(size: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_of("jaccard")
        sketch, seen = np.zeros(1 << bits, np.uint32), False
        for part, texts in slices(batches):
            sets = Sets(texts, size)
            np.add.at(sketch, sets.values & np.uint64(len(sketch) - 1), 1)
            n, seen = len(texts), True
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "doc_id"), column(part, "tie"), pa.array(sets.sizes), pa.array(sets.digests(), pa.binary()),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ],
                PROFILE_NAMES,
            )
        if seen:
            parts = sketch.reshape(-1, min(PART, len(sketch)))
            n = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64())] * 3 + [pa.nulls(n, pa.binary()), pa.array(np.arange(n, dtype=np.int32)), pa.array([x.tobytes() for x in parts], pa.binary())],
                PROFILE_NAMES,
            )

    return run


PROFILE = "doc_id long, tie long, n_shingles long, digest binary, part int, counters binary"
PROFILE_NAMES = ["doc_id", "tie", "n_shingles", "digest", "part", "counters"]


def _summed(rows: DataFrame, *group: str) -> DataFrame:
    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.uint64 if len(x) > PART * 4 else np.uint32).astype(np.uint64) for x in frame["counters"])
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "counters": [np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()]})

    return rows.groupBy(*group).applyInPandas(add, "part int, counters binary")


def _rarity(profiles: DataFrame, bits: int) -> np.ndarray:
    """A class for each hash value's counter: 0 for those at the noise of the sketch, more for frequent shingles.

    The counters cover all documents and have a fixed number (2 to the bits).
    They only order the shingles, so an error of the sketch cannot lose a link.
    """
    rows = profiles.where("part IS NOT NULL").select("part", "counters").withColumn("lane", F.pmod(F.monotonically_increasing_id(), F.lit(256)))
    first = _summed(rows, "part", "lane")
    found = {r["part"]: np.frombuffer(r["counters"], np.uint32) for r in _summed(first, "part").collect()}
    if not found:
        return np.zeros(1, np.uint8)
    counters = np.concatenate([found[k] for k in range(len(found))]).astype(np.float64)
    typical = float(np.median(counters))
    excess = (counters - typical) / np.sqrt(typical + 1)
    return np.where(excess > 5, np.minimum(250, 1 + 8 * np.log2(np.maximum(excess, 5) / 5)), 0).astype(np.uint8)


# ---- index -----------------------------------------------------------------
def _prefix(sizes: np.ndarray) -> np.ndarray:
    """How many of a set's first shingles it takes to share one with every set it links to."""
    return np.where(sizes > 0, sizes - -(-sizes * PERCENT // 100) + 1, 0)


def _postings(rows: DataFrame, rarity: np.ndarray, size: int) -> DataFrame:
    """(shingle, owner, tie, place, size) for shingles that are in the prefix of two sets or more.

    The sets of a slice that are equal count once. The first entry of a shingle
    in a slice stands for it; when it has company its size is sent negative.
    """
    n_buckets = grams.buckets(rows)
    shared = rows.sparkSession.sparkContext.broadcast(rarity)

    def in_company(entries: grams.Entries, first: np.ndarray, company: np.ndarray) -> np.ndarray:
        entries["extra"] = np.where(first & company, -entries["extra"], entries["extra"])
        return company & ~first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            sets = Sets(texts, size, shared.value)
            known: dict[bytes, int] = {}
            alone = np.array([known.setdefault(d, k) == k for k, d in enumerate(sets.digests())], bool)
            place = np.arange(len(sets.values)) - sets.bounds[:-1][sets.owner]
            chosen = (place < _prefix(sets.sizes)[sets.owner]) & alone[sets.owner]
            owner = sets.owner[chosen]
            ids, ties = (column(part, n).to_numpy(zero_copy_only=False) for n in ("owner", "tie"))
            entries = {
                "h1": sets.values[chosen] & grams.SHORT, "h2": np.zeros(len(owner), np.uint64), "owner": ids[owner], "tie": ties[owner],
                "place": place[chosen].astype(np.int32), "extra": sets.sizes[owner].astype(np.int32),
            }
            yield grams.to_batch(list(grams.deal(entries, n_buckets, in_company)))

    def keep(entries: grams.Entries, first: np.ndarray, company: np.ndarray) -> np.ndarray:
        return company | (entries["extra"] < 0)

    sent = rows.select("owner", "tie", "text").mapInArrow(run, grams.ROW)
    found = grams.meet(sent, keep, ["h1", "owner", "tie", "place", "extra"], "h1 long, owner long, tie long, place int, extra int")
    return found.select(F.col("h1").alias("shingle"), "owner", "tie", "place", F.abs("extra").alias("size"))


# ---- verification ----------------------------------------------------------
def _overlaps(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[int, np.ndarray] = {}
            for side in ("a", "b"):
                nodes = column(batch, side).to_numpy()
                new = [k for k in np.unique(nodes, return_index=True)[1].tolist() if nodes[k] not in sets]
                if new:
                    found = Sets(column(batch, f"text_{side}").take(pa.array(new)).fill_null(""), size)
                    for k, low, high in zip(new, found.bounds, found.bounds[1:]):
                        sets[nodes[k]] = found.values[low:high]
            shared, united = [], []
            for a, b in zip(column(batch, "a").to_pylist(), column(batch, "b").to_pylist()):
                n = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                shared.append(n)
                united.append(len(sets[a]) + len(sets[b]) - n)
            yield pa.RecordBatch.from_arrays([column(batch, "a"), column(batch, "b"), pa.array(shared, pa.int64()), pa.array(united, pa.int64())], ["a", "b", "shared", "united"])

    return run


def _measured(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, b, shared, united) of pairs of nodes, from their texts."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(_overlaps(size), "a long, b long, shared long, united long")


def _links(measured: DataFrame) -> DataFrame:
    return measured.where(100 * F.col("shared") >= PERCENT * F.col("united")).select("a", "b")


def _tried(answers: DataFrame) -> DataFrame:
    return answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _may_link(x: str, y: str) -> Column:
    """Whether the sizes of two sets, and the places of a common shingle, allow a link."""
    sizes, places = ([F.col(f"{side}.{name}") for side in (x, y)] for name in ("size", "place"))
    most = F.least(*(n - p for n, p in zip(sizes, places)))
    return (100 * F.least(*sizes) >= PERCENT * F.greatest(*sizes)) & ((100 + PERCENT) * most >= PERCENT * (sizes[0] + sizes[1]))


# ---- crowds ----------------------------------------------------------------
def _stars(found: DataFrame) -> DataFrame:
    """Components as edges: as few as there are nodes."""
    return found.select(F.col("component").alias("a"), F.col("node").alias("b"))


def _in_components(lists: DataFrame, found: DataFrame) -> DataFrame:
    return lists.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _mixed(grouped: DataFrame) -> DataFrame:
    """(shingle, outside, crossing) of lists with several components: sets outside the largest, and pairs of different components."""
    parts = grouped.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("n"))
    sums = parts.groupBy("shingle").agg(F.sum("n").alias("members"), F.max("n").alias("largest"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    return sums.select(
        "shingle", F.expr("members - largest").alias("outside"), F.expr("(members * members - squares) / 2").alias("crossing")).where("crossing > 0")


def _joined_by_hubs(lists: DataFrame, answers: DataFrame, first: DataFrame, texts: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The answers and components after comparing the sets of crowded lists with hubs of theirs.

    A crowd that the blocks' first sets left in several components would have all
    pairs across them compared. In each round every list that is crowded has up to
    HUBS hubs: its sets are dealt by hash, and of each lot the one with the most
    links that was no hub before is a hub. Sets of other components are compared
    with them. Rounds go on while crowded lists have more than four open pairs for
    each entry of all lists, and a round takes away a quarter; whatever stays open is left to the comparison of all pairs,
    so no link depends on the hubs.
    """
    used, before, turn, few = None, None, 0, 4 * lists.count()
    while True:
        grouped = written(_in_components(lists, first), "grouped")
        crowded = written(_mixed(grouped).where(F.col("crossing") > CROWDED * F.col("outside")), "crowded")
        left = crowded.agg(F.sum("crossing")).first()[0] or 0
        if left <= few or (before is not None and 4 * left > 3 * before):
            return answers, first
        before, turn = left, turn + 1
        links = _links(answers)
        degrees = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
        if used is not None:
            degrees = degrees.join(used, "node", "left_anti").unionAll(used.select("node", F.lit(-1).cast("long").alias("degree")))
        members = grouped.join(crowded.select("shingle").hint("rebalance"), "shingle", "left_semi")
        rank = F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), (-F.col("node")).alias("order"))
        lot = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(HUBS))
        hubs = written(
            members.join(degrees.hint("rebalance"), "node", "left").groupBy("shingle", lot.alias("lot"))
            .agg(F.max_by(F.struct("node", "component", "place", "size"), rank).alias("hub")).select("shingle", "hub.*"), "hubs")
        x, y = members.alias("x"), hubs.alias("y")
        pairs = x.join(y, F.col("x.shingle") == F.col("y.shingle")).where((F.col("x.component") != F.col("y.component")) & _may_link("x", "y"))
        new = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
        named = new.withColumns({"low": F.least("a", "b"), "high": F.greatest("a", "b")}).dropDuplicates(["low", "high"])
        tried = answers.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        met = written(_measured(named.join(tried, ["low", "high"], "left_anti").select("a", "b"), texts, size), "hub-answers")
        answers = written(answers.unionAll(met), "answers")
        first = components(_stars(first).unionAll(_links(met)))
        used = hubs.select("node").distinct() if used is None else written(used.unionAll(hubs.select("node")).distinct(), "used-hubs")
        release_exchanges(lists.sparkSession)


# ---- the join --------------------------------------------------------------
def _tie(docs: DataFrame, doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id).isNull(), F.col(text))


def _classes(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """One row per input row: doc_id, tie, n_shingles, node, component (a node; null without shingles)."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)).alias("owner"),
        _tie(docs, doc_id, text).alias("tie"), F.col(text).alias("text"),
    )
    bits = min(24, max(14, docs.count().bit_length() + 3))
    profiles = written(rows.select("doc_id", "tie", "text").mapInArrow(_profiles(size, bits), PROFILE).withColumn("row", F.monotonically_increasing_id()), "profiles")
    known = profiles.where("part IS NULL")

    # Grouped sides are dealt anew before they are joined: then both sides of the
    # join are plain exchanges, and adaptive execution can split a hot partition.
    # A node is a set; its name is the row of one of its documents.
    nodes = known.where("n_shingles > 0").groupBy("digest", "n_shingles").agg(F.min("row").alias("node")).hint("rebalance")
    owners = written(
        known.join(nodes, ["digest", "n_shingles"], "left").select(
            "doc_id", "tie", "n_shingles", "node", "row", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("owner")), "owners")
    ambiguous = not owners.groupBy("owner").count().where("count > 1").isEmpty()
    named = (owners if ambiguous else owners.withColumn("tie", F.lit(0).cast("long"))).where("node IS NOT NULL")
    keyed = rows if ambiguous else rows.withColumn("tie", F.lit(0).cast("long"))

    # Index lists, by position in the order of rarity.
    of_owner = named.select("owner", "tie", "node").distinct()
    lists = written(
        _postings(keyed, _rarity(profiles, bits), size).join(of_owner, ["owner", "tie"])
        .groupBy("shingle", "node").agg(F.min("place").alias("place"), F.min("size").alias("size"))
        .withColumn("band", F.floor(F.log("size") / F.log(F.lit(100 / PERCENT))).cast("int")), "lists")
    wanted = lists.select("node").distinct()
    spoken = named.where(F.col("node") == F.col("row")).join(wanted, "node", "left_semi").select("owner", "tie", "node")
    texts = written(keyed.join(spoken, ["owner", "tie"]).select("node", "text").dropDuplicates(["node"]) if ambiguous
                    else keyed.join(spoken, ["owner", "tie"]).select("node", "text"), "texts")

    # First answers: each set against the first set of its block (list and size band).
    leaders = lists.groupBy("shingle", "band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n").hint("rebalance")
    led = lists.join(leaders, ["shingle", "band"])
    answers = written(
        _measured(led.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), texts, size), "answers")
    release_exchanges(spark)  # the texts that were dealt by owner and for the pairs
    first = components(_links(answers))

    # A list whose sets are in one component by now is skipped whole. Where a crowd
    # is in several, each set is compared with hubs of the crowd before any two sets are.
    answers, first = _joined_by_hubs(lists, answers, first, texts, size)

    # What these answers do not settle. The distance 1 - J obeys the triangle inequality:
    # sets whose distances to a common leader differ by more than a link allows
    # are skipped too, and so are pairs whose places leave too few common shingles.
    distance = answers.select(F.col("a").alias("node"), F.col("b").alias("leader"), (1 - F.col("shared") / F.col("united")).alias("distance"))
    grouped = _in_components(lists, first)
    mixed = _mixed(grouped).select("shingle").hint("rebalance")
    open_lists = (
        grouped.join(mixed, "shingle", "left_semi").join(leaders, ["shingle", "band"], "left")
        .join(distance, ["node", "leader"], "left")
        .withColumn("distance", F.when(F.col("node") == F.col("leader"), 0.0).otherwise(F.col("distance")))
    )
    open_lists = written(open_lists, "open-lists")
    x, y = open_lists.alias("x"), open_lists.alias("y")
    derived = F.col("x.leader").eqNullSafe(F.col("y.leader")) & (F.abs(F.col("x.distance") - F.col("y.distance")) > (100 - PERCENT) / 100 + 1e-9)
    rest = (
        x.join(y, F.col("x.shingle") == F.col("y.shingle"))
        .where(
            (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
            & _may_link("x", "y") & ~F.coalesce(derived, F.lit(False))
        )
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    )
    later = _links(_measured(rest.join(_tried(answers), ["a", "b"], "left_anti"), texts, size))
    every = components(_stars(first).unionAll(later))
    return owners.join(every, "node", "left").select(
        "doc_id", "tie", "row", "n_shingles", "node", F.coalesce("component", "node").alias("component"))


def _stored_classes(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``_classes``, written; what was written on the way is deleted."""
    spark = docs.sparkSession
    path = new_folder(spark, "llm-classes")
    with staged_copies_removed(spark):
        found = _classes(docs, doc_id, text, size)
        found.write.parquet(path)
    schema = found.schema
    del found
    release_exchanges(spark)
    return spark.read.schema(schema).parquet(path)


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    A document's set: the different runs of ``size`` words (six blanks cut
    words, A-Z in lower case), or all its words as one, if it has fewer; null
    and empty texts have no set, link with nothing and are their own component.
    Sets link when 100 * intersection >= PERCENT * union. component_id is the
    smallest id reachable, null ids aside; it is null where all ids are.
    Repeated rows are documents of their own, in one component. Other columns
    are ignored.

    Equal sets are one set from the start. The others meet in lists of the
    shingles in their prefix: rare shingles first, so that a passage that many
    share is in few prefixes. In each block of a list (sizes of one band) every
    set is compared with the block's first, which costs as many comparisons as
    the list is long; copies with few changes are one component after that,
    and their lists are skipped from then on. Where a crowd is left in several
    components, its sets are compared with its hubs next. Only pairs that these
    answers leave open are compared further. No list is cut and no pair is left out
    that may reach the threshold.
    """
    found = _stored_classes(docs, doc_id, text, size)
    lowest = found.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("lowest")).hint("rebalance")
    return found.join(lowest, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"))


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS) -> DataFrame:
    """The rows, with their own columns, that are first in their component: smallest id, then hash of the text.

    Documents without words are groups of their own; repeated rows of such a
    document count as one.
    """
    found = _stored_classes(docs, doc_id, text, size)
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col("tie").alias("content"))
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(key).alias("k")).select("k.id", "k.content")
    empty = found.where("component IS NULL").select(F.col("doc_id").alias("id"), F.col("tie").alias("content")).distinct()
    return rows_of_keys(docs, doc_id, _tie(docs, doc_id, text), written(first.unionAll(empty), "first-of-group"))
