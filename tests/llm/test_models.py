"""Classifier, chat formatting, neighbours and languages."""

import collections
import hashlib
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticklake.llm import chat, languages, neighbours, quality
from ticklake.llm.queries import op1_quality
from ticklake.llm.registry import QUERIES

from .data import SCHEMA, documents, sentence

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    got = {r.doc_id: r for r in op1_quality(spark, SF).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    held = [(got[i].score, y) for i, y in labels if got[i].held_out]
    ones, zeros = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    assert len(got) == 1000 and auc > 0.85
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())


def test_updates_against_a_plain_loop():
    s = quality.Settings(bits=4, alpha=0.5, beta=1.0, l1=0.01, l2=0.1)
    learner, rng = quality.Learner(s), random.Random(1)
    z, n = [0.0] * 16, [0.0] * 16
    weight = lambda i: 0.0 if abs(z[i]) <= s.l1 else -(z[i] - math.copysign(s.l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)
    for _ in range(50):
        at, x, y = rng.sample(range(16), 3), [rng.random() for _ in range(3)], rng.randrange(2)
        learner.update(np.array(at), np.array(x), y)
        w = [weight(i) for i in at]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x, strict=True))))
        for i, v, u in zip(at, x, w, strict=True):
            g = (p - y) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / s.alpha * u
            n[i] += g * g
    assert np.allclose(learner.weights(slice(None)), [weight(i) for i in range(16)])


def test_quality_edges(spark):
    df = spark.createDataFrame(documents(), SCHEMA).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(4, 1), (None, 1), (5, None), (11, 0), (999, 1)], "doc_id long, label int")
    model = quality.train(df, labels)
    got = quality.score(df, model)
    assert got.columns == df.columns
    rows = got.collect()
    assert len(rows) == len(documents()) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    none = quality.train(df, labels.limit(0))
    assert {r.score for r in quality.score(df, none).collect()} == {0.5}
    assert quality.score(df.limit(0), model).count() == 0


TURNS = [
    (1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "<\\|x <\\\\| <| é\n"), (1, 2, None, None),
    (2, None, "assistant", ""), (2, 5, "assistant", "b" * 9000), (2, 7, "we<|ird\nrole", "x"),
    (None, 0, "user", "no id"), (3, 0, "assistant", " <|im_sep|>"),
]


def test_chat_reads_back_what_went_in(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    tokens = chat.formatted(df.repartition(3))
    for r in tokens.collect():
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == len(r.loss) and [(ids == k).sum() for k in chat.MARKS] == [1, 1, 1]
    got = {r.conv_id: r for r in chat.digests(tokens).collect()}
    assert len(got) == 4
    for conv in {t[0] for t in TURNS}:
        turns = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0))
        everything = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in turns)
        loss = "".join(x or "" for _, _, r, x in turns if r == "assistant")
        chars = sum(33 + len(chat.escape(r or "")) + len(chat.escape(x or "")) for _, _, r, x in turns)
        r = got[conv]
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256(everything.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == chars
    assert chat.digests(chat.formatted(df.limit(0))).count() == 0


def test_escape_round_trip():
    rng = random.Random(2)
    for _ in range(5000):
        t = "".join(rng.choice("<\\|a") for _ in range(rng.randrange(12)))
        assert "<|" not in chat.escape(t) and chat.unescape(chat.escape(t)) == t


def nearest(rows, k, every):
    out = {}
    for q, v in rows:
        if q % every == 0:
            far = sorted((math.dist(v, w), i) for i, w in rows if i != q)
            out[q] = [(i, d) for d, i in far[:k]]
    return out


def test_neighbours_recall(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 24)) + 1.5 * rng.integers(0, 2, (1500, 1)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = collections.defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = nearest(rows, 10, 100)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
    exact = dict(rows)
    assert all(math.isclose(d, math.dist(exact[q], exact[i]), rel_tol=1e-12) for q, v in got.items() for i, d in v)


def test_neighbours_edges(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 2)
    rows = [(i * 100, [1.0, 2.0, 3.0]) for i in range(20)] + [(i, [1.0, 2.0, 3.0 + i]) for i in range(1, 5)]
    bad = [(2000, None), (2100, []), (2200, [0.0, 0.0, 0.0]), (2300, [1.0, None, 2.0]), (2400, [float("nan"), 1.0, 1.0]), (2500, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (2600, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("axis", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert got == nearest(rows, 10, 100)
    few = df.filter("vec_id < 4 OR vec_id = 100")
    got = [r.vec_id for r in neighbours.search(few, F.col("vec_id") % 100 == 0).filter("query_id = 100").orderBy("rank").collect()]
    assert got == [0, 1, 2, 3]
    assert neighbours.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_neighbours_recall_on_long_vectors(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(4).normal(size=(3000, 256)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in neighbours.search(df, F.col("vec_id") % 300 == 0).collect():
        got[r.query_id].add(r.vec_id)
    want = nearest(rows, 10, 300)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.95


def test_neighbours_of_repeated_ids(spark, monkeypatch):
    """Copies and further vectors of one id leave places for the others, in one block and in many."""
    schema = "vec_id long, embedding array<double>"
    rows = [(i, [1.0, 2.0, 3.0 + i]) for i in range(8)]
    copies = spark.createDataFrame(rows * 10, schema)
    others = spark.createDataFrame(rows + [(i, [1.0 + j, 2.0, 3.0 + i]) for i, _ in rows for j in range(1, 15)], schema)
    for block in (neighbours.BLOCK, 7):
        monkeypatch.setattr(neighbours, "BLOCK", block)
        for df, k in ((copies, 10), (others, 5)):
            found = neighbours.search(df, (F.col("vec_id") == 0) & (F.col("embedding")[0] == 1.0), k).orderBy("rank").collect()
            assert [(r.rank, r.vec_id, r.score) for r in found] == [(i, i, float(i)) for i in range(1, min(k, 7) + 1)]


def test_hadamard_keeps_lengths_and_mixes():
    v = np.eye(8)
    h = neighbours.hadamard(v)
    assert np.allclose(h @ h.T, v) and np.allclose(np.abs(h), 1 / np.sqrt(8))


def test_languages_of_pages(spark):
    """The path of most addresses names the language a page was made in."""
    rows = QUERIES["op8_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url"), "page_id").collect()
    told = [(r.lang, r.url.split("/")[3]) for r in rows if len(r.url.split("/")) > 3]
    told = [(a, b) for a, b in told if b in ("en", "de", "fr", "es")]
    assert len(told) > 200 and np.mean([a == b for a, b in told]) > 0.95


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang IS NOT NULL")
    names, model = languages.train(docs.filter("doc_id % 5 <> 0"))
    asked = docs.filter("doc_id % 5 = 0 AND n_chars > 100").select(F.col("doc_id").alias("page_id"), F.lit("").alias("url"), F.col("text").alias("html"), "lang")
    right = {r.page_id: r.lang for r in asked.collect()}
    got = languages.fuse(languages.evidence(asked, names, model), names).collect()
    assert np.mean([r.text_lang == right[r.page_id] for r in got]) > 0.97


def test_fusion_lets_hosts_and_declarations_decide(spark):
    rng = random.Random(5)
    docs = [(sentence(rng, 30), "aa") for _ in range(20)] + [(sentence(rng, 30).replace("w", "q"), "bb") for _ in range(20)]
    page = lambda i, url, text, lang="": (i, url, f'<html lang="{lang}"><script>w1 w2</script><p>{text}</p></html>' if lang else text)
    pages = [page(i, f"http://x.one.bb/{i}", sentence(rng, 20).replace("w", "q"), "bb") for i in range(20)]
    pages += [page(100 + i, f"http://y.two.aa/{i}", sentence(rng, 20), "aa") for i in range(20)]
    pages += [page(200, "http://x.one.bb/empty", ""), page(201, "http://y.two.aa/", ""), (202, None, None), (203, "http://[bad", "<html lang=aa>"), (None, "x", "y")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in languages.identify(df, spark.createDataFrame(docs, "text string, lang string")).collect()}
    assert all(got[i].lang == "bb" and got[100 + i].lang == "aa" for i in range(20))
    assert got[200].lang == "bb" and got[201].lang == "aa" and got[203].lang == "aa"
    assert len(got) == len(pages) and all(0 < r.confidence <= 1.0000001 for r in got.values())
    none = languages.identify(df, spark.createDataFrame([(None, "aa"), ("x", None)], "text string, lang string"))
    assert {r.lang for r in none.collect()} == {None}
    assert languages.identify(df.limit(0), spark.createDataFrame(docs, "text string, lang string")).count() == 0


def test_leave_one_out_prior_against_plain_arithmetic(spark):
    rows = [(1, "", "", "d", "h", [0.9, 0.1]), (2, "", "", "d", "h", [0.2, 0.8]), (3, "x", "", "d", "g", [0.5, 0.5])]
    df = spark.createDataFrame(rows, "page_id long, declared string, suffix string, domain string, host string, p array<double>")
    got = {r.page_id: r for r in languages.fuse(df, ["aa", "bb"]).collect()}
    scores = []
    for i in range(2):
        own, total = rows[0][5][i], sum(r[5][i] for r in rows)
        overall = (total - own + 1) / (3 - 1 + 2)
        domain = (total - own + languages.KAPPA * overall) / (3 - 1 + languages.KAPPA)
        host = (rows[1][5][i] + languages.KAPPA * domain) / (2 - 1 + languages.KAPPA)
        declared = (rows[1][5][i] + languages.WEAK * 2 / 3) / (total - own + languages.WEAK)
        suffix = (total - own + languages.WEAK) / (total - own + languages.WEAK)
        scores.append(own * host * declared * suffix)
    assert math.isclose(got[1].confidence, max(scores) / sum(scores), rel_tol=1e-9)


def test_trigrams_stay_inside_texts():
    row, place = languages.trigrams(pa.array(["abcd", None, "xy", "", "abc"]))
    assert row.tolist() == [0, 0, 4] and place[0] == place[2]
    with pytest.raises(IndexError):
        place[3]
