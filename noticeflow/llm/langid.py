"""Language identification by a bit-sliced Bloom filter of byte n-grams.

Each position of the filter holds a mask with one bit per language: looking
up an n-gram ANDs the masks of its positions and so returns all languages
whose sample contains it at once.  A text's n-grams are counted by language
(popcounts of the masks), corrected for the filter's false positives, and the
language with the highest corrected count wins.

The filter is fitted on a sample of about ``rows_per_lang`` labelled texts per
language and has ``2 ** bits`` positions, however large the table; every text
is then read whole in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_bytes, map_arrow, packs, runs

HASHES = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def _alphabet() -> np.ndarray:
    """Letters and bytes beyond ASCII stay, A-Z is lower-cased, all else is a space."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    keep = np.zeros(256, bool)
    keep[97:123] = keep[65:91] = keep[128:] = True
    return np.where(keep, out, 32).astype(np.uint8)


ALPHABET = _alphabet()


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(4-byte n-grams, text of each); those with two spaces side by side are left out."""
    b = ALPHABET[data].astype(np.uint32)
    n = len(b) - 3
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    g = b[:n] | (b[1:n + 1] << np.uint32(8)) | (b[2:n + 2] << np.uint32(16)) | (b[3:n + 3] << np.uint32(24))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    gap = b == 32
    twice = gap[:-1] & gap[1:]
    ok = ~(twice[:n] | twice[1:n + 1] | twice[2:n + 2]) & (np.arange(n) + 4 <= offsets[doc + 1])
    return g[ok], doc[ok]


def places(g: np.ndarray, bits: int) -> list[np.ndarray]:
    shift = np.uint32(32 - bits)
    h = g ^ (g >> np.uint32(15))
    return [(h * m) >> shift for m in HASHES]


def _sample_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) -> (lang, gram, texts): in how many texts of the batch an n-gram occurs."""
    for batch in batches:
        for lo, hi in packs(batch.column(0)):
            data, offs = joined_bytes(batch.column(0).slice(lo, hi - lo))
            names, lang = np.unique(np.array(batch.column(1).slice(lo, hi - lo).to_pylist(), object).astype(str),
                                    return_inverse=True)
            g, doc = grams(data, offs)
            if not len(g):
                continue
            pair = np.unique((doc.astype(np.uint64) << np.uint64(32)) | g)  # once per text
            of = lang[(pair >> np.uint64(32)).astype(np.int64)].astype(np.uint64)
            key = np.sort((of << np.uint64(32)) | (pair & np.uint64(0xFFFFFFFF)))
            start = runs(key)
            count = np.diff(np.append(start, len(key)))
            key = key[start]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[(key >> np.uint64(32)).astype(np.int64)].astype(object), pa.string()),
                 pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(count.astype(np.int64))],
                ["lang", "gram", "texts"])


class Filter:
    """The bit-sliced filter: ``masks[plane, position]``, 64 languages to a plane (8, 16 or 32 if fewer)."""

    def __init__(self, langs: list[str], found: dict[str, np.ndarray], bits: int):
        self.langs, self.bits = langs, bits
        width = next(w for w in (8, 16, 32, 64) if len(langs) <= w or w == 64)
        kind = {8: np.uint8, 16: np.uint16, 32: np.uint32, 64: np.uint64}[width]
        self.width = width
        self.masks = np.zeros((max(1, -(-len(langs) // width)), 1 << bits), kind)
        self.wrong = np.zeros(len(langs))  # rate of false positives
        for i, name in enumerate(langs):
            plane, bit = divmod(i, width)
            for p in places(found.get(name, np.zeros(0, np.uint32)), bits):
                np.bitwise_or.at(self.masks[plane], p, kind(1 << bit))
            fill = ((self.masks[plane] >> kind(bit)) & kind(1)).mean()
            self.wrong[i] = min(0.99, fill ** len(HASHES))

    def hits(self, g: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Of each text (rows) and language (columns): n-grams that the language's sample contains."""
        at = places(g, self.bits)
        start = runs(doc)
        out = np.zeros((n, len(self.langs)))
        for i in range(len(self.langs)):
            plane, bit = divmod(i, self.width)
            if bit == 0:
                m = self.masks[plane]
                both = m[at[0]] & m[at[1]] & m[at[2]]
            if len(start):
                out[doc[start], i] = np.add.reduceat(((both >> both.dtype.type(bit)) & both.dtype.type(1))
                                                     .astype(np.int64), start)
        return out


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: Filter = shared.value
        names = np.array([*f.langs, "und"], object)
        for batch in batches:
            lang = np.full(batch.num_rows, len(f.langs))
            score = np.zeros(batch.num_rows)
            for lo, hi in packs(batch.column(1)):
                data, offs = joined_bytes(batch.column(1).slice(lo, hi - lo))
                g, doc = grams(data, offs)
                n = np.bincount(doc, minlength=hi - lo)[:, None]
                true = np.maximum(0, (f.hits(g, doc, hi - lo) - n * f.wrong) / (1 - f.wrong))
                if f.langs:
                    best = true.argmax(1)
                    ranked = np.sort(true, axis=1)
                    first, second = ranked[:, -1], ranked[:, -2] if len(f.langs) > 1 else 0.0
                    with np.errstate(invalid="ignore", divide="ignore"):
                        s = np.where(first > 0, first / (first + second), 0.0)
                    lang[lo:hi], score[lo:hi] = best, s
            wordless = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            lang[wordless], score[wordless] = len(f.langs), 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[lang], pa.string()), pa.array(score)], ["row", "lang_pred", "score"])
    return run


def fit(texts: DataFrame, rows_per_lang: int = 1500, min_share: float = 0.02, bits: int = 20) -> Filter:
    """A filter from ``texts(doc_id, text, lang)``: n-grams in at least two texts and ``min_share`` of a language's sample."""
    known = texts.where("lang is not null and text is not null")
    count = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}  # one row per language
    langs = sorted(count)
    if not langs:
        return Filter([], {}, bits)
    share = F.create_map(*[x for name in langs for x in (F.lit(name), F.lit(min(1.0, rows_per_lang / count[name])))])
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))
    least = F.create_map(*[x for name in langs for x in (
        F.lit(name), F.lit(max(1 if count[name] < 50 else 2, min_share * min(count[name], rows_per_lang))))])
    rows = (map_arrow(drawn.select("text", "lang"), _sample_grams, "lang string, gram long, texts long")
            .groupBy("lang", "gram").agg(F.sum("texts").alias("texts"))
            .where(F.col("texts") >= F.element_at(least, F.col("lang"))).toPandas())
    return Filter(langs, {name: part["gram"].to_numpy().astype(np.uint32) for name, part in rows.groupby("lang")}, bits)


def predict(docs: DataFrame, model: Filter, carry: list[str] | None = None) -> DataFrame:
    """(carried columns, lang_pred, score) for every row; ``und`` and 0 where text is null or has no letter.

    ``score`` is the winner's share of the two highest corrected counts (0.5
    to 1, 0 if no n-gram is known; then the first language stands).  Texts
    are read whole; repeated rows and null ids are rows like any others.
    """
    carry = carry or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*carry).alias("row"), text.alias("text"),
                       F.coalesce(~text.rlike("\\p{L}"), F.lit(True)).alias("wordless"))
    row_type = rows.schema["row"].dataType.simpleString()
    return map_arrow(rows, _predict(shared), f"row {row_type}, lang_pred string, score double").select(
        "row.*", "lang_pred", "score")
