"""Benchmark decontamination with DataFrame functions only.

For every benchmark item the documents' windows of the item's size (in words)
are compared: SimHash fingerprints within ``radius`` bits make a candidate,
and the weighted Jaccard similarity of the two multisets of shingles
(``sum of min / sum of max`` of their counts) must reach ``threshold``.

* **Windows.**  A window of n shingles with similarity >= t shares at least
  ``need = ceil(2 n t / (1 + t))`` occurrences with its item.  m words of the
  item that a window lacks cost it at least m shingles, so of any
  ``n - need + 1`` different words of the item (its *anchors*: the longest,
  which are rare) it holds at least one.  Only windows around an anchor get a
  fingerprint; all others provably miss the threshold.
* **Short texts.**  A text of fewer words than the item is one window, the
  whole of it.  With m < n shingles it must share
  ``ceil(t (m + n) / (1 + t))`` occurrences, at the least ``ceil(t n)``, so for
  such texts the item has ``n - ceil(t n) + 1`` anchors.
* **Multi-index.**  The 64 bits are cut into ``blocks`` blocks.  Two
  fingerprints within ``radius`` differ by at most ``radius // blocks`` bits in
  one block; the items' side lists every block value within that distance, so
  an equi-join on (block, value) returns all pairs within the radius.
* **Verification** is exact, on the shingle hashes of window and item.

The benchmark side (anchors, block values) depends on the benchmark table
alone.  It is counted first and broadcast only below a bound; beyond it Spark
shuffles.  Documents are read once and never shuffled: what moves is one row
per (document, item) found.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, bounded_broadcast, cut

#: Rows of a broadcast table of anchors or block values (some 32 bytes each).
BROADCAST_ROWS = 1_000_000


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    """Lower-cased words between ASCII white space; null gives an empty list."""
    line = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    return let(line, lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, SPACE_CLASS)))


def shingle_list(words: Column, k: int) -> Column:
    """Hashes of the k-word shingles; fewer words: one hash of them all; none: an empty list."""
    def rows(h: Column) -> Column:
        def at(i: Column | int, size: int) -> Column:
            return F.xxhash64(*[F.element_at(h, i + j) for j in range(size)])
        out = F.when(F.size(h) >= k, F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(h) - F.lit(k - 1))),
                                                 lambda i: at(i, k)))
        for few in range(1, k):
            out = out.when(F.size(h) == few, F.array(at(F.lit(1), few)))
        return out.otherwise(F.array().cast("array<bigint>"))
    return let(F.transform(words, lambda w: F.xxhash64(w)), rows)


def simhash(hashes: Column, lane: int) -> Column:
    """64-bit SimHash of a list of hashes; counts are summed in lanes of ``lane`` bits."""
    groups = lane  # bits g, g + lane, ... of a hash share the sum of group g
    mask = sum(1 << (lane * i) for i in range(64 // lane))
    mask = mask - (1 << 64) if mask >= 1 << 63 else mask
    zero = F.struct(*[F.lit(0).cast("long").alias(f"s{g}") for g in range(groups)])
    total = F.aggregate(hashes, zero, lambda acc, h: F.struct(
        *[(acc[f"s{g}"] + F.shiftrightunsigned(h, g).bitwiseAND(F.lit(mask))).alias(f"s{g}")
          for g in range(groups)]))
    full = F.lit((1 << lane) - 1).cast("long")

    def bits(s: Column, n: Column) -> Column:
        out = F.lit(0).cast("long")
        for g in range(groups):
            for i in range(64 // lane):
                count = F.shiftrightunsigned(s[f"s{g}"], lane * i).bitwiseAND(full)
                out = out.bitwiseOR(F.when(count * 2 > n, F.lit(_signed(1 << (g + lane * i)))).otherwise(F.lit(0)))
        return out
    return let(total, lambda s: bits(s, F.size(hashes)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def lane_for(longest: int) -> int:
    """Lanes that can't overflow for lists of up to ``longest`` hashes (the top lane is signed)."""
    return 8 if longest < 128 else 16 if longest < 1 << 15 else 32


def block_edges(blocks: int) -> list[tuple[int, int]]:
    at = [round(64 * b / blocks) for b in range(blocks + 1)]
    return list(zip(at[:-1], at[1:]))


def block_values(fp: Column, blocks: int) -> Column:
    """[(block, value)] of a fingerprint."""
    return F.array(*[F.struct(F.lit(b).alias("block"),
                              F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
                     for b, (lo, hi) in enumerate(block_edges(blocks))])


def near_values(fp: Column, blocks: int, radius: int) -> Column:
    """[(block, value)] of all block values within ``radius // blocks`` bits of the fingerprint's."""
    out = []
    for b, (lo, hi) in enumerate(block_edges(blocks)):
        flips = [sum(1 << i for i in c) for r in range(radius // blocks + 1)
                 for c in combinations(range(hi - lo), r)]
        own = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        out.append(F.transform(F.expr("array(" + ", ".join(f"{x}L" for x in flips) + ")"), _flipped(b, own)))
    return F.concat(*out)


def _flipped(block: int, own: Column):
    return lambda x: F.struct(F.lit(block).alias("block"), own.bitwiseXOR(x).alias("value"))


def benchmark_items(benchmark: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """(item_id, n_words, shingles, n, need, anchors, item_words); items without words are left out.

    The first ``n - need + 1`` anchors serve windows of the item's size, all of them texts shorter than the item.
    """
    words = benchmark.select(F.col("item_id"), word_list(F.col("text").cast("string")).alias("words"))
    rows = words.where(F.size("words") > 0).select(
        "item_id", "words", F.size("words").alias("n_words"), shingle_list(F.col("words"), shingle).alias("shingles"))
    n = F.size("shingles")
    # shared >= 2 n t / (1 + t); a hair is taken off so that rounding never asks for one too many
    need = F.greatest(F.lit(1), F.ceil(n * (2 * threshold / (1 + threshold)) - 1e-9)).cast("int")
    least = F.greatest(F.lit(1), F.ceil(n * threshold - 1e-9)).cast("int")  # of the shortest text that can match
    long_first = F.array_sort(F.transform(F.array_distinct("words"),
                                          lambda w: F.struct((-F.length(w)).alias("l"), w.alias("w"))))
    return rows.select("item_id", "n_words", "shingles", n.alias("n"), need.alias("need"),
                       F.transform(F.slice(long_first, 1, n - least + 1), lambda x: x["w"]).alias("anchors"),
                       F.array_distinct("words").alias("item_words"))


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8,
                 radius: int = 19, blocks: int = 5) -> DataFrame:
    """(doc_id, item_id, similarity, distance, first_word, n_windows) for each document and item it holds.

    ``similarity`` is the best window's, ``distance`` the least Hamming
    distance, ``first_word`` the (0-based) place of the first such window,
    ``n_windows`` how many there are.  A text of fewer words than the item is
    compared as a whole.  Null and empty texts and items without words match
    nothing; an item of fewer than ``shingle`` words is one shingle and is
    looked for as a whole.  Repeated documents with one doc_id count
    together; a null doc_id is a value like any other.  Empty tables give an
    empty result.
    """
    items = cut(benchmark_items(benchmark, shingle, threshold))
    size = items.agg(F.count("*"), F.coalesce(F.sum(F.size("anchors")), F.lit(0)),
                     F.coalesce(F.max("n"), F.lit(1))).first()
    n_items, n_anchors, longest = int(size[0]), int(size[1]), int(size[2])
    lane = lane_for(longest)
    short = [r.n_words for r in items.where(F.col("n_words") < shingle).select("n_words").distinct().collect()]

    anchors = items.select("n_words", "n", "need", "shingles", "anchors", "item_words",
                           F.posexplode("anchors").alias("nth", "word"))
    prints = cut(items.select("item_id", "n_words", simhash(F.col("shingles"), lane).alias("item_fp")))
    near = prints.select("item_id", "n_words", "item_fp", F.explode(near_values(F.col("item_fp"), blocks, radius)).alias("key")).select(
        "item_id", "n_words", "item_fp", "key.block", "key.value")
    n_near = n_items * sum(len(list(combinations(range(hi - lo), r))) for lo, hi in block_edges(blocks)
                           for r in range(radius // blocks + 1))

    # an outer explode: the inner one makes the optimizer filter on, and so build, the list twice
    words = docs.select("doc_id", word_list(F.col("text").cast("string")).alias("words"))
    hit = words.select("doc_id", "words", F.posexplode_outer("words").alias("pos", "word")).join(
        bounded_broadcast(anchors, n_anchors, BROADCAST_ROWS), "word")
    # a text shorter than the item is one window; what it must share follows from both sizes
    whole = F.size("words") < F.col("n_words")
    hit = hit.where(whole | (F.col("nth") <= F.col("n") - F.col("need")))
    m = F.greatest(F.lit(1), F.size("words") - F.lit(shingle - 1))
    less = F.greatest(F.lit(1), F.ceil((m + F.col("n")) * (threshold / (1 + threshold)) - 1e-9)).cast("int")
    hit = hit.select("doc_id", "words", "pos", "n_words", "n", "shingles", "item_words", whole.alias("whole"),
                     F.when(whole, less).otherwise(F.col("need")).alias("need"),
                     F.when(whole, F.col("anchors")).otherwise(
                         F.slice("anchors", F.lit(1), F.col("n") - F.col("need") + 1)).alias("anchors"))
    # the words around the anchor: every window of the item's size that holds it
    lo = F.greatest(F.lit(0), F.col("pos") - F.col("n_words") + 1)
    around = hit.select("doc_id", "n", "n_words", "need", "shingles", "anchors", "item_words", "whole", lo.alias("lo"),
                        (F.col("pos") - lo).alias("r"),
                        F.slice("words", lo + 1, F.col("pos") - lo + F.col("n_words")).alias("near_words"))
    # each word of the item that is nowhere near costs a window at least one shingle
    around = around.where(F.size(F.array_intersect("item_words", "near_words"))
                          >= F.size("item_words") - (F.col("n") - F.col("need")))
    near_shingles = F.when(F.col("n_words") >= shingle, shingle_list(F.col("near_words"), shingle))
    for size in short:  # at most shingle - 1 sizes; usually none
        near_shingles = near_shingles.when(F.col("n_words") == size, shingle_list(F.col("near_words"), size))
    around = around.select("*", near_shingles.alias("near"))
    # a window is taken at its first anchor only, and if enough of its shingles are the item's
    before = F.transform(F.slice("near_words", 1, F.col("r")), lambda x: F.array_contains("anchors", x))
    nearest = F.coalesce(F.array_position(F.reverse(before), True), F.lit(0))
    earliest = F.when(nearest > 0, F.col("r") - nearest + 1).otherwise(F.lit(0)).cast("int")
    latest = F.when(F.col("whole"), 0).otherwise(F.least(F.col("r"), F.size("near") - F.col("n")))
    marked = around.select("*", earliest.alias("earliest"), latest.alias("latest"),
                           F.transform("near", lambda x: F.array_contains("shingles", x).cast("int")).alias("shared"))
    enough = F.when(F.col("earliest") <= F.col("latest"), let(
        F.col("shared"), lambda f: F.filter(
            F.sequence(F.col("earliest"), F.col("latest")),
            lambda s: F.aggregate(F.slice(f, s + 1, F.col("n")), F.lit(0), lambda a, x: a + x) >= F.col("need"))))
    windows = marked.select("doc_id", "n_words", "n", "lo", "near", F.explode_outer(enough).alias("s")).where(
        F.col("s").isNotNull()).select("doc_id", "n_words", (F.col("lo") + F.col("s")).alias("first_word"),
                                       F.slice("near", F.col("s") + 1, F.col("n")).alias("window"))
    windows = windows.select("*", simhash(F.col("window"), lane).alias("fp"))
    keyed = windows.select("*", F.explode_outer(block_values(F.col("fp"), blocks)).alias("key")).select(
        "doc_id", "n_words", "first_word", "window", "fp", "key.block", "key.value")
    pair = keyed.join(bounded_broadcast(near, n_near, BROADCAST_ROWS), ["block", "value", "n_words"]).where(
        F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    told = items.select("item_id", F.col("shingles").alias("item_shingles"))
    pair = pair.join(bounded_broadcast(told, n_anchors, BROADCAST_ROWS), "item_id")
    # sum of min = shared, sum of max = both sizes less shared
    shared = F.aggregate(
        F.array_distinct("item_shingles"), F.lit(0),
        lambda acc, x: acc + F.least(F.size(F.filter("window", lambda y: y == x)),
                                     F.size(F.filter("item_shingles", lambda y: y == x))))
    scored = pair.select("doc_id", "item_id", "first_word",
                         F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).alias("distance"),
                         (shared / (F.size("window") + F.size("item_shingles") - shared)).alias("similarity"))
    kept = scored.where(F.col("similarity") >= threshold)
    once = kept.groupBy("doc_id", "item_id", "first_word").agg(
        F.max("similarity").alias("similarity"), F.min("distance").alias("distance"))
    return once.groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"), F.min("distance").cast("int").alias("distance"),
        F.min("first_word").cast("long").alias("first_word"), F.count("*").alias("n_windows"))
