"""Toxicity by a small convolutional text classifier, trained in numpy.

A word is the sum of three hashed embeddings (the word, its first four and its
first five letters); filters of widths 1, 2 and 3 slide over the words, each
keeps its maximum over the whole text, and a logistic layer turns the maxima
into a score.  The embeddings start from the buckets' smoothed log-odds in the
sample, everything is then trained by Adagrad.  Thresholds are calibrated by
language on all labelled texts.

The network is fitted on at most ``sample`` labelled texts; its size is fixed
(``2 ** BITS`` buckets).  Then all labelled texts are scored, and Spark counts
them by language, label and bin of the score's log-odds.  Scoring
reads every text whole, in one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, map_arrow, packs

BITS, DIM, WIDTHS, FILTERS = 20, 4, (1, 2, 3), 4
WORD = re.compile(r"[^\W\d_]+")
#: Bins of a score's log-odds: ``STEPS`` to each unit from -EDGE to EDGE.
EDGE, STEPS = 30, 16
#: Texts that the pooled threshold counts for against a language's own.
PRIOR = 20
#: Labelled ids that are broadcast to find their texts; more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
CACHE = 300_000
_ids: dict[str, int] = {}


def word_ids(text: str | None) -> np.ndarray:
    """Three bucket numbers of each word, packed into one."""
    words = WORD.findall((text or "").lower())
    got = list(map(_ids.get, words))
    if None in got:
        for i, found in enumerate(got):
            if found is None:
                w = words[i]
                raw = [zlib.crc32(b"w" + w.encode()), zlib.crc32(b"4" + w[:4].encode()), zlib.crc32(b"5" + w[:5].encode())]
                found = sum((x >> (32 - BITS)) << (BITS * j) for j, x in enumerate(raw))
                if len(_ids) < CACHE:
                    _ids[w] = found
                got[i] = found
    return np.array(got, np.int64)


@dataclass
class Model:
    emb: np.ndarray                       # buckets x DIM
    conv: list[np.ndarray]                # by width: width x DIM x FILTERS
    bias: np.ndarray                      # of all filters
    out: np.ndarray                       # of all filters, then the constant
    thresholds: dict[str, float] = field(default_factory=dict)
    default: float = 0.3

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        mask = (1 << BITS) - 1
        x = self.emb[ids & mask].astype(np.float32)
        x += self.emb[(ids >> BITS) & mask]
        x += self.emb[ids >> (2 * BITS)]
        return x

    def maps(self, x: np.ndarray) -> list[np.ndarray]:
        """Filter outputs; ``x`` ends with max(WIDTHS) - 1 rows of zeros, so every word starts a window."""
        n = len(x) - max(WIDTHS) + 1
        return [sum(x[j:n + j] @ w[j] for j in range(len(w))) for w in self.conv]

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """A wordless text is one window of zeros."""
        pad = max(WIDTHS) - 1
        x = np.zeros((sum(max(1, len(t)) + pad for t in texts) + pad, DIM), np.float32)
        start = np.cumsum([0] + [max(1, len(t)) + pad for t in texts[:-1]])
        if len(texts):
            ids = np.concatenate(texts)
            size = np.array([len(t) for t in texts])
            at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(len(ids))
            x[at] = self.vectors(ids)
        # windows that start on a pad would reach into the next text: every second stretch is left out
        ends = start + np.array([max(1, len(t)) for t in texts], np.int64)
        at = np.stack([start, ends], axis=1).reshape(-1)
        top = np.concatenate([np.maximum.reduceat(np.concatenate([m, np.zeros((pad + 1, m.shape[1]), m.dtype)]),
                                                  at, axis=0)[::2] for m in self.maps(x)], axis=1)
        z = np.maximum(top + self.bias, 0) @ self.out[:-1] + self.out[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(texts: list[np.ndarray], toxic: np.ndarray, epochs: int = 4, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    buckets = 1 << BITS
    seen = np.zeros((2, buckets))
    for t, y in zip(texts, toxic):
        every = np.concatenate([t & (buckets - 1), (t >> BITS) & (buckets - 1), t >> (2 * BITS)])
        seen[int(y), np.unique(every)] += 1
    n = np.bincount(toxic.astype(int), minlength=2)
    # log-odds with a prior that few sightings don't overcome
    odds = np.log((seen[1] + 1) / (n[1] + 2)) - np.log((seen[0] + 4 * n[0] / max(1, n[1]) * 0.5 + 1) / (n[0] + 2))
    emb = rng.normal(0, 0.02, (buckets, DIM)).astype(np.float32)
    emb[:, 0] += np.clip(odds, 0, 4) * (seen[1] > 1)
    conv = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for c in conv:
        c[:, 0, 0] += 1.0 / len(c)
    k = FILTERS * len(WIDTHS)
    model = Model(emb, conv, np.full(k, -0.5, np.float32), np.concatenate([np.full(k, 0.1), [-1.0]]).astype(np.float32))
    rate, eps = 0.1, 1e-6
    g_emb = np.full(buckets, 0.1, np.float32)
    g_conv = [np.full_like(c, 0.1) for c in conv]
    g_bias, g_out = np.full(k, 0.1, np.float32), np.full(k + 1, 0.1, np.float32)
    weight = np.where(toxic == 1, max(1.0, 0.5 * n[0] / max(1, n[1])), 1.0)
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            ids = texts[i]
            pad = max(WIDTHS) - 1
            x = np.zeros((max(1, len(ids)) + pad, DIM), np.float32)
            if len(ids):
                x[:len(ids)] = model.vectors(ids)
            maps = model.maps(x)
            where = np.concatenate([m.argmax(0) for m in maps])
            top = np.concatenate([m.max(0) for m in maps]) + model.bias
            act = np.maximum(top, 0)
            z = float(act @ model.out[:-1] + model.out[-1])
            err = weight[i] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic[i])
            if abs(err) < 1e-3:
                continue
            d_out = err * np.append(act, 1).astype(np.float32)
            d_top = (err * model.out[:-1] * (top > 0)).astype(np.float32)
            g_out += d_out ** 2
            model.out -= rate * d_out / np.sqrt(g_out + eps)
            g_bias += d_top ** 2
            model.bias -= rate * d_top / np.sqrt(g_bias + eps)
            for w, c in enumerate(model.conv):
                d = d_top[w * FILTERS:(w + 1) * FILTERS]
                p = where[w * FILTERS:(w + 1) * FILTERS]
                if not d.any():
                    continue
                for j in range(len(c)):
                    word = p + j
                    grad = x[word].T * d
                    back = (c[j] * d).T  # filters x DIM
                    g_conv[w][j] += grad ** 2
                    c[j] -= rate * grad / np.sqrt(g_conv[w][j] + eps)
                    for f in np.flatnonzero(d):
                        if word[f] < len(ids):
                            packed = int(ids[word[f]])
                            for b in {packed & (buckets - 1), (packed >> BITS) & (buckets - 1), packed >> (2 * BITS)}:
                                g_emb[b] += float(back[f] @ back[f])
                                model.emb[b] -= rate * back[f] / np.sqrt(g_emb[b] + eps)
    return model


def score_bins(scores: np.ndarray) -> np.ndarray:
    s = scores.astype(np.float64)
    with np.errstate(divide="ignore"):
        z = np.clip(np.log(s) - np.log1p(-s), -EDGE, EDGE)
    return np.minimum(np.floor((z + EDGE) * STEPS), 2 * EDGE * STEPS - 1).astype(np.int32)


def bin_score(edge: np.ndarray) -> np.ndarray:
    """The score at the lower edge of a bin."""
    return 1 / (1 + np.exp(EDGE - np.asarray(edge, np.float64) / STEPS))


def best_threshold(bins: np.ndarray, toxic: np.ndarray, clean: np.ndarray, default: float) -> float:
    """Middle of the gap between bins that maximises F1; the default where it lies in the gap or a class is missing."""
    if not toxic.sum() or not clean.sum():
        return default
    order = np.argsort(-bins, kind="stable")
    b, t, c = bins[order], toxic[order], clean[order]
    f1 = 2 * np.cumsum(t) / (np.cumsum(t + c) + t.sum())
    i = int(f1.argmax())
    high = bin_score(b[i])
    low = bin_score(b[i + 1] + 1) if i + 1 < len(b) else 0.0
    return float(default) if low < default <= high else float((high + low) / 2)


def language_thresholds(counts: dict[str, np.ndarray], default: float) -> dict[str, float]:
    """Thresholds from (bin, toxic, clean) counts by language, drawn towards the one of all languages together.

    A language weighs by its rarer class against ``PRIOR`` texts of the pooled
    threshold (in log-odds), so its own counts take over without a switch.
    """
    if not counts:
        return {}
    every = np.concatenate(list(counts.values()))
    bins, place = np.unique(every[:, 0], return_inverse=True)
    pooled = best_threshold(bins, np.bincount(place, every[:, 1]), np.bincount(place, every[:, 2]), default)
    odds = lambda p: math.log(max(p, 1e-6) / max(1 - p, 1e-6))
    out = {}
    for lang, c in counts.items():
        n = float(min(c[:, 1].sum(), c[:, 2].sum()))
        own = best_threshold(c[:, 0], c[:, 1], c[:, 2], pooled)
        z = (n * odds(own) + PRIOR * odds(pooled)) / (n + PRIOR)
        out[lang] = pooled if own == pooled else 1 / (1 + math.exp(-z))
    return out


def _bins(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows, np.int32)
            for lo, hi in packs(batch.column(2), 1 << 20):
                out[lo:hi] = score_bins(model.scores([word_ids(t.as_py()) for t in batch.column(2).slice(lo, hi - lo)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], ["toxic", "lang", "bin"])
    return run


def calibrate(texts: DataFrame, marked: DataFrame, model: Model, labels: int) -> dict[str, float]:
    """Thresholds by language from every row of ``texts(doc_id, lang, text)`` that ``marked(doc_id, toxic)`` labels.

    Only labelled rows are scored; ``labels`` is the number of rows of ``marked``.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)
    labelled = texts.where("lang is not null").join(bounded_broadcast(marked, labels, BROADCAST_LABELS), "doc_id")
    rows = map_arrow(labelled.select("toxic", "lang", "text"), _bins(shared), "toxic int, lang string, bin int")
    bad = (F.col("toxic") > 0).cast("long")
    count = rows.groupBy("lang", "bin").agg(F.sum(bad).alias("toxic"), F.sum(1 - bad).alias("clean"))
    of_lang = count.groupBy("lang").agg(F.collect_list(F.struct("bin", "toxic", "clean")).alias("bins"))
    # one row per language, of at most 2 * EDGE * STEPS bins
    return language_thresholds({r.lang: np.array([tuple(x) for x in r.bins], np.int64)
                                for r in of_lang.toLocalIterator()}, model.default)


def _sample_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([word_ids(t.as_py()).tobytes() for t in batch.column(2)],
                                                        pa.binary())], ["toxic", "lang", "ids"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6000, default: float = 0.3,
        thresholds: bool = True) -> Model:
    """A model from ``labels(doc_id, toxic)`` of ``docs(doc_id, text, lang)``.

    At most ``sample`` labelled documents are drawn, those least by a hash of
    doc_id, at most a third of them toxic; of several rows of a drawn doc_id
    one is taken (the least by a hash of its text), so no more rows than that
    reach the driver.  A document labelled twice counts as toxic if any label
    says so.  Without labels of both kinds every score is the prior's.
    ``thresholds`` by language come from all labelled rows.
    """
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    count = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    by = F.xxhash64("doc_id", F.lit(4))
    most = {1: sample // 3, 0: sample - sample // 3}
    drawn = None
    for kind, n in most.items():
        # twice the share that is wanted passes the first filter, so that few rows are sorted
        share = min(1.0, 2 * n / max(1, count.get(kind, 0)))
        few = marked.where((F.col("toxic") == kind) & (F.pmod(by, F.lit(1 << 20)) < share * (1 << 20))) \
            .orderBy(F.pmod(by, F.lit(1 << 20)), "doc_id").limit(n)
        drawn = few if drawn is None else drawn.unionByName(few)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    mine = docs.select("doc_id", lang.alias("lang"), F.col("text").cast("string").alias("text"))
    texts = mine.join(F.broadcast(drawn), "doc_id").select("doc_id", "toxic", "text")  # bounded by ``sample``
    one = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "toxic", "text")).alias("x"))
    rows = map_arrow(one.select("x.toxic", F.lit(None).cast("string").alias("lang"), "x.text"), _sample_ids,
                     "toxic int, lang string, ids binary").toPandas()
    rows["key"] = [zlib.crc32(x) for x in rows["ids"]]
    rows = rows.sort_values(["key", "toxic"], kind="stable")  # the same model whatever the order of the rows
    ids = [np.frombuffer(x, np.int64) for x in rows["ids"]]
    toxic = (rows["toxic"].to_numpy() > 0).astype(np.float64)
    model = train(ids, toxic)
    model.default = default
    model.emb = model.emb.astype(np.float16)
    if thresholds and "lang" in docs.columns and count.get(0) and count.get(1):
        model.thresholds = calibrate(mine, marked, model, sum(count.values()))
    return model


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for lo, hi in packs(batch.column(1), 1 << 20):
                out[lo:hi] = model.scores([word_ids(t.as_py()) for t in batch.column(1).slice(lo, hi - lo)])
            limit = np.array([model.thresholds.get(x.as_py(), model.default) for x in batch.column(2)], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), pa.array(limit.reshape(-1))],
                                             ["row", "score", "threshold"])
    return run


def score(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """(carried columns, score, threshold, rejected) for every row.

    ``score`` depends on the text alone; ``threshold`` is the calibrated one
    of the row's ``lang`` (the default where it is null, new or too rare).  A
    null or wordless text gets the score of no words.  Repeated rows and null
    ids are rows like any others; an empty table gives an empty result.
    """
    carry = carry or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.struct(*carry).alias("row"), F.col("text").cast("string").alias("text"), lang.alias("lang"))
    row_type = rows.schema["row"].dataType.simpleString()
    out = map_arrow(rows, _score(shared), f"row {row_type}, score double, threshold double")
    return out.select("row.*", "score", "threshold", (F.col("score") >= F.col("threshold")).alias("rejected"))
