"""Near duplicates by a chosen-path set similarity join (operator 6).

A document's set is its distinct ``shingle``-word shingles. Equal sets are one class, entered once. Every
class has a sketch of ``SKETCH`` minwise values. In each of ``trees`` trees a class goes down by the minwise
values of randomly chosen coordinates, one at each level, the first without repetition among trees: classes that agree in a share j of
their shingles stay together with probability j. A node with at most ``leaf`` classes is compared exhaustively by
sketch; larger ones branch on, for at most ``DEPTH`` levels.

Branching sheds what only shares a passage; nodes that are still large after ``DEPTH`` levels are mostly clusters of
distinct near copies, met in most trees. Of these, nodes with the same least member (by hash) become one, so a cluster is
worked off a few times, not once a tree. ``PIVOTS`` random members of such a node are compared with all others, and the
candidates are confirmed in portions, each with all the pivots: a cluster falls into one component with one confirmation a class. From then on two classes of one component are never compared, in nodes of any level, and large nodes that
hold nothing else are dropped, so work grows with a cluster's size, not its square. Large nodes that are still mixed
are compared in full, as pairs of blocks of different components, so nothing is capped.

Candidates agree in at least ``least`` coordinates. ``least`` and the number of trees follow from the threshold
(``plan``): by the binomial the cut loses at most a tenth of ``MISS``, and cut and trees together, which share one
sketch, lose at most ``MISS`` of the pairs at the threshold whose nodes all stay large for ``DEPTH`` levels. At 0.85
that gives 20 trees and 38 coordinates (one pair in 710,000 is missed, in small nodes one in 6 million), at 0.80
27 and 33 (one in 570,000, in small nodes one in 12 million). Thresholds of about 0.65 and less would need more
trees than a sketch has coordinates; they get that many, and ``missed`` tells what these lose. Groups of classes connected by candidates, not pairs, go on: their full sets are built anew from
whole texts, all links among them are counted exactly, and each class is returned with the smallest one it is
connected with. Texts are taken from the table once, compressed, for all classes that share a node; what is known of components
is joined to classes, not to their places in trees. Groups of many or long texts are confirmed in portions of about ``SHINGLES`` shingles. So neither copies nor groups of near copies are expanded into pairs. Components come from
alternating large-star and small-star steps.

Edge cases: NULL or empty text has an empty set, links with nothing and is kept; a text shorter than a
shingle is one shingle; very long texts count whole, their sets are held one block at a time; extra columns are
ignored (``deduplicated`` returns them as they are); equal texts are one class, the smallest id of it stays; rows with a NULL id link with nothing, get a NULL component and are kept; rows that
share an id are one node, though each keeps its own set; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm import groups as grouped
from ticklake.llm import words
from ticklake.session import stored

SHINGLE = 5
SKETCH = 64
TREES = 14  # at least
MISS = 2e-6
LEAF = 512
DEPTH = 3
PIVOTS = 24  # expected in a large node
SHINGLES = 2_000_000  # in one confirmation, but for longer single texts

_rng = np.random.default_rng(6)
_MULTIPLY = _rng.integers(0, 1 << 63, SKETCH, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, SKETCH, dtype=np.uint64)


def shingles(column: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text (a-z and A-Z alike), and where each text's begin."""
    w = words.split(column, lower=True)
    n = len(column)
    h = words.rolling(w.hashes, width)
    inside = words.within(w.first, width, len(h))
    row, value = [w.doc()[: len(h)][inside]], [h[inside]]
    for i in np.flatnonzero((np.diff(w.first) > 0) & (np.diff(w.first) < width)):
        own = w.hashes[w.first[i] : w.first[i + 1]]
        row.append(np.array([i]))
        value.append(words.rolling(own, len(own), 2 * len(own) + 1))
    row, value = np.concatenate(row), np.concatenate(value)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return value[new], np.searchsorted(row[new], np.arange(n + 1))


def _features(piece: pa.RecordBatch, width: int) -> pa.RecordBatch:
    value, first = shingles(piece.column("text"), width)
    size = np.diff(first)
    full = np.flatnonzero(size)
    sketch = np.zeros((piece.num_rows, SKETCH), np.uint32)
    sums = np.zeros((piece.num_rows, 2), np.int64)
    if len(full):
        at = first[full]
        for k in range(SKETCH):
            mixed = (value ^ _ADD[k]) * _MULTIPLY[k]
            mixed ^= mixed >> np.uint64(32)
            mixed *= _MULTIPLY[k]
            sketch[full, k] = np.minimum.reduceat(mixed, at) >> np.uint64(32)
        sums[full, 0] = np.add.reduceat(words.mix(value), at).view(np.int64)
        sums[full, 1] = np.add.reduceat(words.mix(value ^ _ADD[0]), at).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [piece.column("doc_id"), pa.array(size), pa.array(sums[:, 0]), pa.array(sums[:, 1]), pa.array([x.tobytes() for x in sketch], pa.binary())],
        ["doc_id", "n_shingles", "one", "two", "sketch"],
    )


def missed(share: float, trees: int, least: int, depth: int = DEPTH) -> float:
    """Probability that a pair of similarity ``share`` is no candidate if its nodes stay large for ``depth`` levels."""
    out = 0.0
    for same in range(SKETCH + 1):
        here = comb(SKETCH, same) * share**same * (1 - share) ** (SKETCH - same)
        part = 1 - (same / SKETCH) ** (depth - 1)  # in a tree with one of the equal coordinates first
        firsts = range(max(0, trees - (SKETCH - same)), min(trees, same) + 1)
        lost = sum(comb(same, a) * comb(SKETCH - same, trees - a) * part**a for a in firsts) / comb(SKETCH, trees)
        out += here * (lost if same >= least else 1)
    return out


def plan(threshold: int, depth: int = DEPTH) -> tuple[int, int]:
    """(trees, least): numbers of trees and of equal coordinates that lose at most ``MISS`` at the threshold."""
    share, least, below = threshold / 100, 0, 0.0
    while least < SKETCH:
        below += comb(SKETCH, least) * share**least * (1 - share) ** (SKETCH - least)
        if below > MISS / 10:
            break
        least += 1
    return next((n for n in range(TREES, SKETCH) if missed(share, n, least, depth) <= MISS), SKETCH), least


def _paths(sketches: np.ndarray, path: np.ndarray, picks: int, salt: int) -> np.ndarray:
    """Children of nodes: (rows, picks) hashes of the path and the minwise value at a coordinate the path chooses.

    Up to ``SKETCH`` picks of a node are of different coordinates.
    """
    out = np.empty((len(path), picks), np.int64)
    row = np.arange(len(path))
    start = words.mix(path.view(np.uint64) ^ np.uint64(salt * 128))
    step = start >> np.uint64(32) | np.uint64(1)  # odd, so that steps go through all coordinates
    for i in range(picks):
        choice = words.mix(path.view(np.uint64) ^ np.uint64((salt * 64 + i) * 2 + 1))
        coordinate = (start + step * np.uint64(i)) % np.uint64(SKETCH)
        value = sketches[row, coordinate.astype(np.int64)].astype(np.uint64)
        out[:, i] = words.mix(choice ^ words.mix(value)).view(np.int64)
    return out


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), SKETCH)


def _branch(nodes: DataFrame, picks: int, salt: int) -> DataFrame:
    """One level down: a row for each child a class goes to, with size and sketch if there is one child."""
    carried = ["id", "size", "sketch"] if picks == 1 else ["id"]

    def run(batches):
        for b in batches:
            if b.num_rows:
                path = b.column("path").to_numpy()
                child = _paths(_sketches(b.column("sketch")), path, picks, salt)
                row = pa.array(np.repeat(np.arange(b.num_rows), picks))
                kept = [b.column(c).take(row) for c in carried]
                yield pa.RecordBatch.from_arrays([pa.array(child.ravel()), *kept], ["path", *carried])

    schema = "path long, id long, size long, sketch binary" if picks == 1 else "path long, id long"
    return nodes.select("path", "id", "size", "sketch").mapInArrow(run, schema)


def _agreeing(x: tuple, y: tuple, threshold: int, least: int) -> np.ndarray:
    """Which pairs of x and y, both (sketches, sizes, parts), are candidates: a matrix.

    Sizes allow the threshold, sketches agree, and parts differ.
    """
    same = np.zeros((len(x[1]), len(y[1])), np.uint8)
    for k in range(SKETCH):
        same += x[0][:, k, None] == np.ascontiguousarray(y[0][:, k])
    small, large = np.minimum(x[1][:, None], y[1]), np.maximum(x[1][:, None], y[1])
    return np.where((x[2][:, None] != y[2]) & (100 * small >= threshold * large) & (same >= least), same, 0)


def _portions(size: np.ndarray) -> list[np.ndarray]:
    """Places in portions that two at a time hold about ``SHINGLES``, but for a longer last text of each."""
    portion = (np.cumsum(size) - size) // max(1, SHINGLES // 2)
    return np.split(np.arange(len(size)), np.flatnonzero(np.diff(portion)) + 1)


def _candidates(nodes: DataFrame, threshold: int) -> DataFrame:
    """(group, id): within each node the classes that are connected by candidate pairs, compared exhaustively.

    Classes of one ``part`` are connected already and make no pair. A group's name is made of its members, so that the
    trees find it once; a group of many shingles goes on as all pairs of its portions.
    """
    _, least = plan(threshold)

    def work(table, cuts):
        size, ids, part = (table.column(c).to_numpy() for c in ("size", "id", "part"))
        sketches = _sketches(table.column("sketch").combine_chunks())
        groups, members = [], []
        for lo, hi in zip(cuts, [*cuts[1:], table.num_rows], strict=True):
            own = part[lo:hi]
            if (own == own[0]).all():
                continue
            node = sketches[lo:hi], size[lo:hi], own
            a, b = np.nonzero(np.triu(_agreeing(node, node, threshold, least), 1))
            if len(a):
                label = grouped.joined(hi - lo, a, b)
                for root in np.unique(label[a]):
                    own, first = np.unique(ids[lo:hi][label == root], return_index=True)
                    pieces = _portions(size[lo:hi][label == root][first])
                    for i, x in enumerate(pieces):
                        for y in pieces[i + 1 :] or ([x[:0]] if i == 0 else []):
                            both = own[np.concatenate([x, y])]
                            if len(both) > 1:
                                groups.append(np.full(len(both), xxhash.xxh3_64_intdigest(both.tobytes()), np.uint64).view(np.int64))
                                members.append(both)
        if groups:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(groups)), pa.array(np.concatenate(members))], ["group", "id"])

    return grouped.by_group(nodes.select("path", "id", "size", "sketch", "part"), "path", work, "group long, id long")


def _merged(nodes: DataFrame) -> DataFrame:
    """Nodes (path, id, size, sketch) with the same least member, by hash, as one; with the number of their classes (n)."""
    lead = nodes.groupBy("path").agg(F.min(F.xxhash64("id")).alias("lead"))
    placed = nodes.join(lead, "path").groupBy("lead", "id").agg(F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    placed = stored(placed.withColumnRenamed("lead", "path"), "merged")
    return placed.join(placed.groupBy("path").agg(F.count(F.lit(1)).alias("n")), "path")


def _stars(nodes: DataFrame, threshold: int) -> DataFrame:
    """(group, id): classes that are candidates of a pivot of their node, in portions of about half a leaf, each with all the pivots.

    Pivots are the classes whose hash is below a share of the node, so the nodes of a cluster choose alike. Members
    meet them in blocks of about a leaf, and each goes on in the node that has the pivot it resembles most.
    """
    _, least = plan(threshold)
    blocks = F.ceil(F.col("n") / LEAF).cast("int")
    share = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 32)) / float(1 << 32)
    pivots = nodes.filter(share < PIVOTS / F.col("n"))
    everywhere = pivots.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("pivot", F.lit(True))
    members = nodes.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("pivot", F.lit(False))
    met = members.unionByName(everywhere).withColumnRenamed("path", "node")
    met = met.select(F.xxhash64("node", "block").alias("path"), "node", "id", "size", "sketch", "part", "pivot")

    def work(table, cuts):
        size, ids, part, node = (table.column(c).to_numpy() for c in ("size", "id", "part", "node"))
        leads = table.column("pivot").to_numpy()
        sketches = _sketches(table.column("sketch").combine_chunks())
        out = [], [], [], []
        for lo, hi in zip(cuts, [*cuts[1:], table.num_rows], strict=True):
            lead = lo + np.flatnonzero(leads[lo:hi])
            follow = lo + np.flatnonzero(~leads[lo:hi])
            if len(lead) and len(follow):
                same = _agreeing(*((sketches[x], size[x], part[x]) for x in (follow, lead)), threshold, least).max(1)
                follow, same = follow[same > 0], same[same > 0].astype(np.int64)
                for column, values in zip(out, (ids[follow], node[follow], size[follow], same), strict=True):
                    column.append(values)
        if sum(map(len, out[0])):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["id", "node", "size", "same"])

    near = grouped.by_group(met, "path", work, "id long, node long, size long, same long")
    best = F.max_by("node", F.struct("same", "node")).alias("node")
    stars = stored(near.groupBy("id").agg(best, F.first("size").alias("size")), "stars")
    splits = F.greatest(F.ceil(2 * F.count(F.lit(1)) / LEAF), F.ceil(F.sum("size") / SHINGLES)).cast("int").alias("splits")
    split = stars.groupBy("node").agg(splits)
    dealt = stars.join(split, "node").withColumn("block", F.pmod(F.xxhash64("id"), "splits").cast("int"))
    shared = pivots.select(F.col("path").alias("node"), "id").join(split, "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    return dealt.select("node", "block", "id").unionByName(shared.select("node", "block", "id")).select(F.xxhash64("node", "block").alias("group"), "id")


def _parts(classes: DataFrame, known: DataFrame | None) -> DataFrame:
    """``classes``, one row each, with the component each is known to be in (``part``), its own id by default."""
    if known is None:
        return classes.withColumn("part", F.col("id"))
    reach = known.withColumnRenamed("component", "part")
    return classes.join(reach, "id", "left").withColumn("part", F.coalesce("part", "id"))


def _mixed(nodes: DataFrame) -> DataFrame:
    """The nodes that hold more than one component."""
    mixed = nodes.groupBy("path").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x < y").select("path")
    return nodes.join(mixed, "path", "left_semi")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes too large for one comparison as pairs of blocks of about half a leaf, by hashes of ids.

    A component with more classes than a block has its own blocks, which don't meet each other.
    """
    held = nodes.groupBy("path", "part").agg(F.count(F.lit(1)).alias("m"))
    held = held.withColumn("whole", F.when(2 * F.col("m") > LEAF, F.col("part")))
    blocks = held.groupBy(F.col("path").alias("node"), F.col("whole").alias("its")).agg(F.ceil(2 * F.sum("m") / LEAF).cast("int").alias("splits"))
    own = held.join(blocks, (F.col("path") == F.col("node")) & F.col("whole").eqNullSafe(F.col("its")))
    dealt = nodes.join(own.select("path", "part", "whole", "splits"), ["path", "part"])
    dealt = dealt.withColumn("own", F.xxhash64("whole", F.pmod(F.xxhash64("id"), "splits").cast("int")))
    # A row for each half leaf of a node.
    others = blocks.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    others = others.select(F.col("node").alias("path"), "its", F.xxhash64("its", "block").alias("other"))
    met = dealt.join(others, "path").filter("whole IS NULL OR its IS NULL OR whole != its")
    pair = F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other"))
    return met.select(pair.alias("path"), "id", "size", "sketch", "part")


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of n sets share."""
    doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    place = np.full(len(count), -1)
    place[shared] = np.arange(len(shared))
    column = place[column]
    doc, column = doc[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    out = np.zeros((len(sets), len(sets)))  # each summand is exact in single precision, the sum in double
    for lo in range(0, len(shared), 2048):
        i, j = np.searchsorted(column, [lo, lo + 2048])
        x = np.zeros((len(sets), 2048), np.float32)
        x[doc[i:j], column[i:j] - lo] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _texts(ends: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, z, crowded): different texts, compressed, of the ids in ``ends`` (id, crowded)."""

    def pack(batches):
        zip_ = zstandard.ZstdCompressor(level=1)
        for b in batches:
            packed = [zip_.compress((x or "").encode()) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(packed, pa.binary())], ["id", "z"])

    ends = ends.groupBy("id").agg(F.max("crowded").alias("crowded"))
    packed = docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(pack, "id long, z binary")
    # Never by broadcast: the plan is then the same at every size.
    return stored(packed.join(ends.hint("merge"), "id").distinct(), "texts")


def _confirmed(groups: DataFrame, texts: DataFrame, threshold: int, width: int) -> DataFrame:
    """Pairs (a, b): each class with the smallest id that it is connected with by links of full sets in a group."""
    groups = groups.distinct()
    texts = texts.select("id", "z")

    def work(table, cuts):
        unzip = zstandard.ZstdDecompressor()
        ids, z = table.column("id").to_numpy(), table.column("z").combine_chunks()
        out = [], []
        for lo, hi in zip(cuts, [*cuts[1:], table.num_rows], strict=True):
            if hi - lo < 2:
                continue
            # A slice of texts at a time: sets are kept, texts are not.
            sets, texts, held = [], [], 0
            for i in range(lo, hi):
                texts.append(unzip.decompress(z[i].as_py()).decode())
                held += len(texts[-1])
                if held >= words.SLICE_BYTES or i == hi - 1:
                    value, first = shingles(pa.array(texts, pa.large_string()), width)
                    sets += np.split(value, first[1:-1])
                    texts, held = [], 0
            size = np.array([len(x) for x in sets])
            both = common(sets)
            a, b = np.nonzero(np.triu((both > 0) & (100 * both >= threshold * (size[:, None] + size - both)), 1))
            if len(a):
                own = ids[lo:hi]
                least = own[grouped.joined(hi - lo, a, b)]  # rows are sorted by id
                out[0].append(least[least != own])
                out[1].append(own[least != own])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["a", "b"])

    return stored(grouped.by_group(groups.join(texts, "id"), "group", work, "a long, b long").distinct(), "links")


def classes_of(features: DataFrame) -> DataFrame:
    """One row for each different set: its sums, smallest id, size and sketch."""
    found = features.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("one", "two")
    return stored(found.agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch")), "classes")


def links(
    classes: DataFrame, docs: DataFrame, threshold: int, width: int, trees: int | None = None, leaf: int = LEAF, depth: int = DEPTH
) -> DataFrame:
    """Pairs (a, b) of ids of classes with different sets that confirmed links connect."""
    trees = trees or plan(threshold, depth)[0]
    nodes, small = _branch(classes.withColumn("path", F.lit(0).cast("long")), trees, 1), []
    for level in range(1, depth + 1):
        nodes = stored(nodes, "nodes")
        sizes = stored(nodes.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes")
        members = nodes.join(sizes, "path")
        if level == 1:
            members = stored(members, "members")  # most classes are alone in their nodes
        small.append(members.filter(F.col("n") <= leaf).select("path", "id"))
        large = members.filter(F.col("n") > leaf)
        large = stored(large if level > 1 else large.join(classes.select("id", "size", "sketch"), "id"), "large")
        if level == depth or large.isEmpty():
            break
        nodes = _branch(large, 1, level + 1)
    found = stored(reduce(DataFrame.unionByName, small), "small")
    crowd = stored(large.select("id").distinct(), "crowd")
    texts = _texts(found.select("id", F.lit(False).alias("crowded")).unionByName(crowd.withColumn("crowded", F.lit(True))), docs)

    sure, known, mixed = [], None, large
    if not large.isEmpty():
        mixed = stored(_merged(large).withColumn("part", F.col("id")), "crowded")
        sure.append(_confirmed(_stars(mixed, threshold), texts.filter("crowded"), threshold, width))
        known = grouped.components(sure[0])
        mixed = stored(_mixed(mixed.drop("part").join(_parts(crowd, known), "id")), "mixed")
    compared = found.join(_parts(classes.select("id", "size", "sketch"), known), "id").select("path", "id", "size", "sketch", "part")
    if not mixed.isEmpty():
        compared = compared.unionByName(_blocks(mixed))
    sure.append(_confirmed(_candidates(compared, threshold), texts, threshold, width))
    return reduce(DataFrame.unionByName, sure)


def near_duplicates(docs: DataFrame, threshold: int = 85, width: int = SHINGLE, trees: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and kept. ``threshold``: least similarity in percent."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def work(piece):
        return _features(piece, width)

    features = stored(words.by_slice(docs, work, "doc_id long, n_shingles long, one long, two long, sketch binary"), "features")
    classes = classes_of(features)
    same = classes.select("one", "two", "id")
    between = links(classes, docs, threshold, width, trees)
    # A copy is linked to its class by the row itself; ids that occur with several sets link their classes.
    rows = features.join(same, ["one", "two"], "left")
    shared = rows.filter("id < doc_id").groupBy("doc_id").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.countDistinct("one", "two").alias("n"))
    also = rows.filter("id IS NOT NULL").join(shared.filter("n > 1 OR x < y").select("doc_id"), "doc_id", "left_semi").filter("id < doc_id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    reach = grouped.components(between.unionByName(also))
    return (
        rows.join(reach, "id", "left")
        .withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "id", "doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def deduplicated(docs: DataFrame, threshold: int = 80, width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` but for near copies of a document with a smaller id; all columns as they are."""
    gone = near_duplicates(docs.select("doc_id", "text"), threshold, width).filter("NOT kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone.distinct(), docs["doc_id"] == F.col("_gone"), "left_anti")
