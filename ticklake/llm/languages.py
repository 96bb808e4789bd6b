"""Language of web pages by Bayesian evidence fusion (operator 8).

Four pieces of evidence are multiplied: the likelihood of the visible text under byte-trigram models learnt
from documents of known language; the language that the markup declares; the suffix of the address; and
a prior of the host. What a declaration or a suffix says about the language is itself learnt: grouped sums
of the text's posteriors, smoothed. A host's prior is smoothed towards its domain's and that towards the
overall one, leaving out the page that is judged.

Sums by declaration, suffix, domain and host are partial aggregates with one row per group; a host of any size
is one row. The model has ``2**BITS`` weights per language; it is what is collected and sent to tasks, and its
size follows from the number of languages only.

Edge cases: NULL or empty html or text has equal likelihoods, so the other evidence decides; NULL or odd
addresses have an empty host and suffix; documents without language or text are not learnt from; without any
model language the result has a NULL language; repeated rows are judged each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from functools import reduce
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm import words
from ticklake.session import stored

BITS = 14
SMOOTH = 0.5  # added to every trigram count
TRUST = 0.1  # exponent of the text's likelihood: trigrams of one text are far from independent
WEAK = 2.0  # pages' worth of smoothing of declarations and suffixes
KAPPA = 5.0  # pages' worth of a host's domain, and of a domain's overall share

_HIDDEN = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", re.I)


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every byte trigram of lower-cased texts that lies within one text."""
    data, off = words.texts_of(column)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = words._LOWER[data].astype(np.uint64)
    code = low[:-2] << np.uint64(16) | low[1:-1] << np.uint64(8) | low[2:]
    inside = words.within(off, 3, len(code))
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(code)]
    return row[inside], (words.mix(code[inside]) >> np.uint64(64 - BITS)).astype(np.int64)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and log likelihoods by place, from all documents with (text, lang)."""
    known = docs.select(F.col("text").cast("string").alias("text"), F.lower("lang").alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in words.slices(batch):
                row, place = trigrams(piece.column("text"))
                names = np.array(piece.column("lang").to_pylist())
                for lang in set(names.tolist()):
                    new = np.bincount(place[(names == lang)[row]], minlength=1 << BITS)
                    counts[lang] = counts.get(lang, 0) + new
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["lang", "place", "n"])

    total = known.mapInArrow(run, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(total["lang"].unique())
    table = np.full((len(languages), 1 << BITS), SMOOTH)
    for i, lang in enumerate(languages):
        own = total[total["lang"] == lang]
        table[i, own["place"]] += own["n"]
    return languages, np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def visible(page: str) -> str:
    return html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page)))


def address(url: str) -> tuple[str, str, str]:
    """Host, domain and suffix of an address, or empty strings."""
    try:
        host = (urlsplit(url).hostname or "").rstrip(".")
    except ValueError:
        host = ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1] if len(labels) > 1 else ""


def evidence(pages: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """page_id, declared, suffix, domain, host and ``p``: the text's posterior under equal priors."""
    schema = "page_id long, declared string, suffix string, domain string, host string, p array<double>"

    def work(piece):
        raw = [x or "" for x in piece.column("html").to_pylist()]
        declared = [m[1].lower() if (m := _DECLARED.search(x)) else "" for x in raw]
        places = [address(x or "") for x in piece.column("url").to_pylist()]
        row, place = trigrams(pa.array([visible(x) for x in raw], pa.large_string()))
        log = np.stack([np.bincount(row, m[place], len(raw)) for m in model], 1) * TRUST
        p = np.exp(log - log.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        host, domain, suffix = zip(*places, strict=True)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1) * len(languages), pa.int32()), pa.array(p.ravel()))
        return pa.RecordBatch.from_arrays(
            [piece.column("page_id"), *[pa.array(x, pa.string()) for x in (declared, suffix, domain, host)], lists],
            ["page_id", "declared", "suffix", "domain", "host", "p"],
        )

    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return words.by_slice(picked, work, schema, "html")


def fuse(seen: DataFrame, languages: list[str]) -> DataFrame:
    """``seen`` with lang, confidence and text_lang from all evidence."""
    n = len(languages)
    p = [F.col("p")[i] for i in range(n)]

    def sums(*by):
        return seen.groupBy(*by).agg(F.array(*[F.sum(x) for x in p]).alias("_".join(["sum", *by])), F.count(F.lit(1)).cast("double").alias("_".join(["n", *by])))

    total = seen.agg(F.array(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in p]).alias("sum_all"), F.count(F.lit(1)).cast("double").alias("n_all"))
    rows = seen.join(sums("host", "domain"), ["host", "domain"]).join(sums("domain"), "domain").join(sums("declared"), "declared").join(sums("suffix"), "suffix")
    # One row with two columns.
    rows = rows.join(F.broadcast(total), F.lit(True))
    scores = []
    for i in range(n):
        own = p[i]
        overall = (F.col("sum_all")[i] - own + 1.0) / (F.col("n_all") - 1 + n)
        domain = (F.col("sum_domain")[i] - own + KAPPA * overall) / (F.col("n_domain") - 1 + KAPPA)
        host = (F.col("sum_host_domain")[i] - own + KAPPA * domain) / (F.col("n_host_domain") - 1 + KAPPA)
        # How often this language comes with the declaration or suffix, towards how often any does.
        declared = (F.col("sum_declared")[i] - own + WEAK * F.col("n_declared") / F.col("n_all")) / (F.col("sum_all")[i] - own + WEAK)
        suffix = (F.col("sum_suffix")[i] - own + WEAK * F.col("n_suffix") / F.col("n_all")) / (F.col("sum_all")[i] - own + WEAK)
        scores.append(F.log(F.greatest(own, F.lit(1e-300))) + reduce(lambda a, b: a + b, [F.log(F.greatest(x, F.lit(1e-12))) for x in (host, declared, suffix)]))
    rows = rows.withColumn("scores", F.array(*scores))
    names = F.array(*[F.lit(x) for x in languages])
    best = F.array_max("scores")
    shares = F.aggregate("scores", F.lit(0.0), lambda acc, x: acc + F.exp(x - best))
    return rows.select(
        "page_id",
        F.element_at(names, F.array_position("scores", best).cast("int")).alias("lang"),
        (1 / shares).alias("confidence"),
        F.element_at(names, F.array_position("p", F.array_max("p")).cast("int")).alias("text_lang"),
        F.nullif("declared", F.lit("")).alias("declared"),
        F.nullif("host", F.lit("")).alias("host"),
    )


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, confidence, text_lang, declared and host of every page."""
    languages, model = train(docs)
    if not languages:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("confidence", "double"), ("text_lang", "string"), ("declared", "string"), ("host", "string"))]
        return pages.select(F.col("page_id").cast("long").alias("page_id"), *none)
    return fuse(stored(evidence(pages, languages, model), "evidence"), languages)
