"""Exact and near duplicates and repeated passages against brute force."""

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import exact_dedup, groups as grouped, near_dedup, substrings

from .data import SCHEMA, documents, words


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(spark, keep):
    rows = documents()
    groups = collections.defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    expected = collections.Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known, default=None)
        left = 1
        for i in ids:
            kept = i == best and left == 1
            left -= kept
            expected[i, best, len(ids), kept, digest(text)] += 1
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit("clash")).withColumn("_text", F.lit(1))
    got = exact_dedup.groups(df, keep=keep)
    assert {"lang", "_text"} < set(got.columns)
    assert bag(got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == expected


def test_exact_hot_text_is_split_and_merged(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}") for i in range(900)]
    got = exact_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"))
    hot = got.filter("keep_id = 897")
    assert hot.count() == 300 and hot.filter("kept").count() == 1 and hot.filter("group_size = 300").count() == 300


def test_exact_deduplicated_keeps_columns_and_nulls(spark):
    df = spark.createDataFrame(documents(), SCHEMA)
    got = exact_dedup.deduplicated(df, keep="smallest")
    assert got.columns == df.columns
    texts = [r.text or "" for r in got.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, *_ in documents()})
    assert [r.text for r in got.filter("doc_id = 1").collect()] == [None]


def near_brute(rows, threshold):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        w = words((t or "").translate(low))
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and 100 * len(a & b) >= threshold * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return collections.Counter((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets)


def test_near_against_brute_force(spark):
    rows = [(i, t) for i, t, *_ in documents()]
    df = spark.createDataFrame(documents(), SCHEMA)
    assert bag(near_dedup.near_duplicates(df, 85).collect()) == near_brute(rows, 85)


def test_near_trees_start_at_different_coordinates():
    one = np.zeros((1, near_dedup.SKETCH), np.uint32)
    path = np.zeros(1, np.int64)
    for picks in (near_dedup.TREES, near_dedup.SKETCH):
        same = near_dedup._paths(one, path, picks, 1)
        for k in range(near_dedup.SKETCH):
            other = one.copy()
            other[0, k] = 1
            assert (near_dedup._paths(other, path, picks, 1) != same).sum() <= 1


def test_near_recall_follows_from_the_threshold():
    for threshold in (80, 85, 95):
        trees, least = near_dedup.plan(threshold)
        assert trees >= near_dedup.TREES and near_dedup.missed(threshold / 100, trees, least) <= near_dedup.MISS
    rng = np.random.default_rng(1)  # the same by trial, where misses are common enough to be seen
    equal = rng.random((4000, near_dedup.SKETCH)) < 0.6
    sketches = np.where(equal, 0, 1).astype(np.uint32)
    paths = [np.zeros(len(x), np.int64) for x in (sketches,)] * 2
    meet = np.zeros(len(equal), bool)
    for mine, base in zip(*(near_dedup._paths(s, p, 4, 1).T for s, p in zip((sketches, np.zeros_like(sketches)), paths, strict=True)), strict=True):
        mine, base = (near_dedup._paths(s, p.copy(), 1, 2)[:, 0] for s, p in ((sketches, mine), (np.zeros_like(sketches), base)))
        meet |= mine == base
    lost = 1 - (meet & (equal.sum(1) >= 36)).mean()
    assert abs(lost - near_dedup.missed(0.6, 4, 36, 2)) < 0.06


@pytest.mark.parametrize("leaf,depth", [(4, 1), (4, 3), (512, 3)])
def test_near_large_nodes_branch_and_are_compared_in_blocks(spark, leaf, depth, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEAF", leaf)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join([*base[:i], f"own{i}", *base[i + 1 :]])) for i in range(60)]
    rows += [(100 + i, " ".join([*base[: 60 + i], *(f"far{i}{k}" for k in range(40 - i))])) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    features = near_dedup.words.by_slice(df, lambda p: near_dedup._features(p, 5), "doc_id long, n_shingles long, one long, two long, sketch binary")
    links = near_dedup.links(near_dedup.classes_of(features), df, 85, 5, leaf=leaf, depth=depth)
    reach = {r.id: r.component for r in grouped.components(links).collect()}
    expected = near_brute(rows, 85)
    assert {(i, reach.get(i, i)) for i, _ in rows} == {(k[0], k[2]) for k in expected}


def near_links(spark, rows, **limits):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    features = near_dedup.words.by_slice(df, lambda p: near_dedup._features(p, 5), "doc_id long, n_shingles long, one long, two long, sketch binary")
    return near_dedup.links(near_dedup.classes_of(features), df, 85, 5, **limits)


def test_near_work_grows_with_a_cluster_not_its_square(spark, monkeypatch):
    """Rows compared and texts confirmed, for clusters of distinct near copies far above a leaf."""
    monkeypatch.setattr(near_dedup, "LEAF", 32)
    seen = {}
    candidates, confirmed = near_dedup._candidates, near_dedup._confirmed

    def count_rows(nodes, threshold):
        nodes = near_dedup.stored(nodes, "counted")
        seen["rows"] += nodes.count()
        return candidates(nodes, threshold)

    def count_texts(groups, *rest):
        groups = near_dedup.stored(groups.distinct(), "counted")
        seen["texts"] += groups.count()
        return confirmed(groups, *rest)

    monkeypatch.setattr(near_dedup, "_candidates", count_rows)
    monkeypatch.setattr(near_dedup, "_confirmed", count_texts)
    base, per = [f"b{i}" for i in range(120)], []
    for n in (150, 600):
        seen.update(rows=0, texts=0)
        rows = [(i, " ".join([*base[: i % 119], f"own{i}", *base[i % 119 + 1 :]])) for i in range(n)]
        reach = {r.id: r.component for r in grouped.components(near_links(spark, rows, leaf=32)).collect()}
        assert reach == dict.fromkeys(range(1, n), 0)
        per.append((seen["rows"] / n, seen["texts"] / n))
    assert per[1][0] < 1.5 * per[0][0] and per[1][1] < 1.5 * per[0][1] and per[1][1] < 8, per


def test_near_texts_are_read_once_and_parts_joined_to_classes(spark, monkeypatch):
    """Nodes that stay large and mixed on every level cost no further pass over texts and no join a place in a tree."""
    monkeypatch.setattr(near_dedup, "LEAF", 8)
    read, joined, parts = spark.sparkContext.accumulator(0), [], near_dedup._parts

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    def count_rows(classes, known):
        joined.append(classes.count())
        return parts(classes, known)

    monkeypatch.setattr(near_dedup, "_parts", count_rows)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join([*base[:i], f"own{i}", *base[i + 1 :]])) for i in range(40)]
    rows += [(100 + i, " ".join([*base[:80], *(f"far{i}x{k}" for k in range(20))])) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    features = near_dedup.words.by_slice(df, lambda p: near_dedup._features(p, 5), "doc_id long, n_shingles long, one long, two long, sketch binary")
    links = near_dedup.links(near_dedup.classes_of(features), df.mapInArrow(counted, df.schema), 85, 5, leaf=8)
    reach = {r.id: r.component for r in grouped.components(links).collect()}
    assert {(i, reach.get(i, i)) for i, _ in rows} == {(k[0], k[2]) for k in near_brute(rows, 85)}
    assert read.value == len(rows) and joined and max(joined) <= len(rows), (read.value, joined)


def test_near_only_merged_nodes_are_looked_at_for_several_components(spark, monkeypatch):
    """At the pipeline's threshold: fewer rows than half the classes' places in one level of all trees."""
    monkeypatch.setattr(near_dedup, "LEAF", 8)
    seen, mixed = [], near_dedup._mixed

    def count_rows(nodes):
        seen.append(nodes.count())
        return mixed(nodes)

    monkeypatch.setattr(near_dedup, "_mixed", count_rows)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join([*base[:i], f"own{i}", *base[i + 1 :]])) for i in range(40)]
    rows += [(100 + i, " ".join([*base[:75], *(f"far{i}x{k}" for k in range(25))])) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    features = near_dedup.words.by_slice(df, lambda p: near_dedup._features(p, 5), "doc_id long, n_shingles long, one long, two long, sketch binary")
    links = near_dedup.links(near_dedup.classes_of(features), df, 80, 5, leaf=8)
    reach = {r.id: r.component for r in grouped.components(links).collect()}
    assert {(i, reach.get(i, i)) for i, _ in rows} == {(k[0], k[2]) for k in near_brute(rows, 80)}
    assert seen and 2 * sum(seen) < near_dedup.plan(80)[0] * len(rows), seen


def test_near_clusters_that_one_text_connects(spark, monkeypatch):
    """Two clusters too unlike to be linked but for a text between them; long groups go on in portions."""
    monkeypatch.setattr(near_dedup, "LEAF", 8)
    monkeypatch.setattr(near_dedup, "SHINGLES", 400)
    base = [f"b{i}" for i in range(200)]
    other = [*base[:170], *(f"c{i}" for i in range(30))]
    between = [*base[:185], *(f"c{i}" for i in range(15, 30))]
    rows = [(i, " ".join([*base[:i], f"own{i}", *base[i + 1 :]])) for i in range(40)]
    rows += [(100 + i, " ".join([*other[:i], f"own{i}x", *other[i + 1 :]])) for i in range(40)]
    for extra in ([], [(50, " ".join(between))]):
        links = near_links(spark, rows + extra, leaf=8, depth=2)
        reach = {r.id: r.component for r in grouped.components(links).collect()}
        assert {(i, reach.get(i, i)) for i, _ in rows + extra} == {(k[0], k[2]) for k in near_brute(rows + extra, 85)}


def test_common_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (1, 50, 4000, 6000, 0, 300)]
    got = near_dedup.common(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(6) for j in range(6) if i != j)


def test_components_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(50, 60), (55, 60)], "a long, b long")
    got = {r.id: r.component for r in grouped.components(links).collect()}
    assert got == {i: 1 for i in range(2, 31)} | {55: 50, 60: 50}


def test_near_deduplicated_keeps_one_of_each_group(spark):
    df = spark.createDataFrame(documents(), SCHEMA)
    got = near_dedup.deduplicated(df, 85)
    assert got.columns == df.columns
    ids = [r.doc_id for r in got.collect()]
    assert 12 in ids and 13 not in ids and 14 not in ids and None in ids and 1 in ids and 2 in ids


def passages(rows, width):
    at = collections.Counter(tuple(w[k : k + width]) for _, t in rows for w in [words(t)] for k in range(len(w) - width + 1))
    out = collections.Counter()
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if at[tuple(w[k : k + width])] > 1:
                gone[k : k + width] = [True] * width
        out[i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)] += 1
    return out


@pytest.mark.parametrize("width,seed", [(35, 12), (8, 3)])
def test_passages_against_brute_force(spark, width, seed):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit("clash"))
    got = substrings.remove_repeats(df, width=width, seed=seed)
    assert {"lang", "source"} < set(got.columns)
    assert bag(got.select("doc_id", "n_words", "n_removed", "kept").collect()) == passages([(i, t) for i, t, *_ in rows], width)


def test_passages_small_vocabulary(spark):
    """Few different words: seeds repeat everywhere and most windows are at a border."""
    import random

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.remove_repeats(df, width=9, seed=3).select("doc_id", "n_words", "n_removed", "kept")
    assert bag(got.collect()) == passages(rows, 9)


@pytest.mark.parametrize("work", [exact_dedup.groups, exact_dedup.deduplicated, near_dedup.near_duplicates, near_dedup.deduplicated, substrings.remove_repeats])
def test_empty_tables(spark, work):
    assert work(spark.createDataFrame([], SCHEMA)).count() == 0
