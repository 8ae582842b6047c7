"""Operators against brute force on small fixtures: nulls, empty and long texts, ties, repeats, empty tables."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noticeflow.llm import (common, components, decontaminate, hash_ring, knn_join, langid, mixing_lm, packing,
                            simhash_dedup, suffix_dedup, token_counts, tokens, toxicity)

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PASSAGE = " ".join(f"shared{i} passage{i}" for i in range(30))
ITEM = " ".join(f"question{i} answer{i % 7}" for i in range(12))


def texts():
    rng = np.random.default_rng(5)
    vocab = [f"w{i}x" for i in range(300)]
    out = {i: " ".join(rng.choice(vocab, rng.integers(3, 120))) for i in range(40)}
    out[40] = out[3]
    out[41] = "Before\tthis " + PASSAGE + " and after."
    out[42] = "Other words " + PASSAGE.replace("shared20", "changed") + "\nend"
    out[43], out[44], out[45] = None, "", "   \n\t "
    out[46] = "été " * 200 + PASSAGE
    out[47] = out[5] + " one more word"
    out[48] = "intro words here " + ITEM.upper() + " and more text"
    out[49] = "x" * 30000
    out[50] = "<|endoftext|> a  b\n\n\nc <|startoftext|>"
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, "clash") for i, t in texts().items()] + [(7, texts()[7], None, None, None, None),
                                                                            (None, "a null id", "en", "s", 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_simhash_near_dedup(docs, none):
    got = simhash_dedup.near_duplicates(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = np.array([simhash_dedup.fingerprint(t) for _, t in rows], np.uint64)
    least = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            k = todo.pop()
            for j in np.flatnonzero(np.bitwise_count(fps[k] ^ fps) <= 4):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least[i] = min(ids) if ids else None
    want = sorted(((str(r[0]), f"{int(f):016x}", str(least[i])) for i, (r, f) in enumerate(zip(rows, fps))))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert simhash_dedup.near_duplicates(none).count() == 0


def test_simhash_cells_split_and_finer_groups_find_the_same(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 64, 6, dtype=np.uint64))
                                            ^ (np.uint64(1) << rng.integers(0, 64, 6, dtype=np.uint64)) for _ in range(40)]]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")

    def groups(**kw):
        roots = {r.node: r.root for r in components.components(simhash_dedup.fingerprint_links(df, 4, **kw)).collect()}
        return sorted(collections.Counter(roots.values()).values())
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 4)
    node, root = components.forest(fps[a[a < b]].view(np.int64), fps[b[a < b]].view(np.int64))
    want = sorted((collections.Counter(root.tolist())[r] + 1) for r in set(root.tolist()))
    assert groups() == groups(cell_rows=3) == groups(groups=2) == want


def test_suffix_dedup(docs, none):
    got = {(r.doc_id, r.text_hash): r for r in suffix_dedup.repeated_passages(
        docs.withColumn("text_hash", F.xxhash64("text")), carry=["text_hash"]).collect()}
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    first = {}
    for r in rows:
        b = (r.text or "").encode()
        for p in range(len(b) - 49):
            if r.doc_id is not None:
                first[b[p:p + 50]] = min(r.doc_id, first.get(b[p:p + 50], r.doc_id))
    for r in rows:
        b = (r.text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if r.doc_id is not None and first[b[p:p + 50]] < r.doc_id:
                gone[p:p + 50] = b"\1" * 50
        x = got[(r.doc_id, r.h)]
        assert bytes(x.kept) == bytes(c for c, g in zip(b, gone) if not g)
        assert (x.n_bytes, x.n_removed) == (len(b), sum(gone))
        assert x.n_spans == sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
    assert suffix_dedup.repeated_passages(none).count() == 0


def test_suffix_corpus_order_is_lexicographic():
    data = np.frombuffer(b"abracadabra abracadabra abracadabrx", np.uint8)
    starts = np.arange(len(data) - 11)
    order, group = suffix_dedup.corpus_order(data, starts, 11)
    keys = [bytes(data[s:s + 11]) for s in starts[order]]
    assert keys == sorted(keys)
    assert [a == b for a, b in zip(keys, keys[1:])] == [a == b for a, b in zip(group, group[1:])]


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame([(1, ITEM, "z"), (2, None, "z"), (3, "", "z"), (4, "w1x nowhere to be found at all", "z"),
                                   (5, "one more word", "z")], "item_id long, text string, doc_id string")
    got = decontaminate.contaminated(docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.similarity, r.distance) for r in sorted(got)] == [(47, 5, 1.0, 0), (48, 1, 1.0, 0)]
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0


def shingles_of(words, k=5):
    return collections.Counter(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else {}


def similar(a, b):
    least = sum(min(c, b[x]) for x, c in a.items())
    return least / (sum(a.values()) + sum(b.values()) - least) if a else 0.0


def test_decontamination_of_near_copies_and_texts_shorter_than_the_item(spark):
    rng = np.random.default_rng(8)
    vocab = [f"v{i}" * int(rng.integers(1, 4)) for i in range(400)]
    items = {i: [str(w) for w in rng.choice(vocab, n)] for i, n in enumerate((16, 23, 30, 42, 42, 59, 3, 5, 6))}
    items[9] = ["again"] * 20 + items[3][:20]  # repeated words and shingles
    texts, pad = [], lambda n: [str(w) for w in rng.choice(vocab, n)]
    for words in items.values():
        texts.append(words)
        for drop in range(1, 10):
            if drop < len(words):
                kept = words[drop // 2:len(words) - (drop - drop // 2)]
                inner = int(rng.integers(0, len(words) - drop + 1))
                texts += [words[drop:], words[:-drop], kept, words[:inner] + words[inner + drop:],
                          pad(7) + words[:-drop], words[drop:] + pad(7), pad(40) + words[:inner] + words[inner + drop:] + pad(40)]
        for changed in (1, 2, 3):
            other = list(words)
            for at in rng.choice(len(words), min(changed, len(words)), replace=False):
                other[at] = "changed"
            texts += [other, other[1:], other[:-2], pad(30) + other + pad(30)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    want, short = {}, 0
    for d, text in enumerate(texts):
        for i, words in items.items():
            own, n = shingles_of(words), len(words)
            size = 5 if n >= 5 else n
            windows = [shingles_of(text[s:s + n], size) for s in range(max(1, len(text) - n + 1))]
            score = [similar(w, own) for w in windows]
            if max(score) >= 0.8:
                best = [s >= 0.8 for s in score]
                want[d, i] = (round(max(score), 9), best.index(True), sum(best))
                short += len(text) < n
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.first_word, r.n_windows)
           for r in decontaminate.contaminated(docs, bench, radius=19).collect()}
    assert short > 50 and got == want


def test_decontamination_block_values_cover_the_radius(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        x = int(rng.integers(0, 1 << 63))
        y = x
        for b in rng.choice(63, int(rng.integers(0, 20)), replace=False):
            y ^= 1 << int(b)
        rows.append((i, x, y))
    df = spark.createDataFrame(rows, "i int, x long, y long")
    a = df.select("i", F.explode(decontaminate.block_values(F.col("x"), 5)).alias("k"))
    b = df.select("i", F.explode(decontaminate.near_values(F.col("y"), 5, 19)).alias("k"))
    assert a.join(b, ["i", "k"]).select("i").distinct().count() == 60


def test_language_id(spark, none):
    rows = [(i, t, g) for i in range(60) for t, g in (("the quick brown fox and the dog %d" % i, "en"),
                                                      ("der schnelle braune fuchs und ein hund %d" % i, "de"))]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(known)
    ask = spark.createDataFrame([(1, "the brown dog"), (2, "ein brauner hund und der"), (3, None), (4, "12 !?"), (5, "")],
                                "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(ask, model).collect()}
    assert [got[i][0] for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= s <= 1 for _, s in got.values()) and got[3][1] == 0
    assert langid.predict(none, model).count() == 0
    assert {r.lang_pred for r in langid.predict(ask, langid.fit(known.where("false"))).collect()} == {"und"}


def test_language_filter_returns_all_languages_of_a_gram():
    g = np.arange(1000, dtype=np.uint32) * np.uint32(2654435761)
    f = langid.Filter([f"l{i:02}" for i in range(70)], {"l03": g, "l69": g[:500]}, 16)
    hits = f.hits(g, np.zeros(1000, np.int64), 1)[0]
    assert hits[3] == 1000 and 500 <= hits[69] < 520 and hits[5] == 0


def test_toxicity(spark, none):
    rng = np.random.default_rng(2)
    vocab = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = []
    for i in range(400):
        words = list(rng.choice(vocab, 30))
        if i % 5 == 0:
            words[int(rng.integers(0, 30))] = "scum"
        rows.append((i, " ".join(words), "en", int(i % 5 == 0)))
    full = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.fit(full.select("doc_id", "text", "lang").where("doc_id < 300"), full.select("doc_id", "toxic"))
    got = toxicity.score(full, model, ["doc_id", "toxic"]).where("doc_id >= 300").collect()
    assert all((r.score >= 0.3) == bool(r.toxic) == r.rejected for r in got)
    odd = spark.createDataFrame([(1, None, None), (2, "", "xx")], "doc_id long, text string, lang string")
    assert all(0 <= r.score < 0.3 and not r.rejected for r in toxicity.score(odd, model).collect())
    assert toxicity.score(none, model).count() == 0
    assert toxicity.fit(full.where("false"), full.where("false")).scores([np.zeros(0, np.int64)]).shape == (1,)


def test_toxicity_thresholds_use_all_labelled_rows(spark):
    rng = np.random.default_rng(12)
    vocab = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = []
    for i in range(1500):
        words, toxic = list(rng.choice(vocab, 20)), int(i % 3 == 0)
        if toxic or i % 20 == 1:  # some clean texts hold the word too
            words[int(rng.integers(0, 20))] = "scum"
        rows.append((i, " ".join(words), "aa" if i % 10 else "bb", toxic))
    full = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.fit(full.select("doc_id", "text", "lang"), full.select("doc_id", "toxic"), sample=150, default=0.999999)
    got = toxicity.score(full, model, ["lang", "toxic"]).collect()
    for lang in ("aa", "bb"):  # 50 toxic and 100 clean rows of bb; the sample has some 5 and 10
        mine = [r for r in got if r.lang == lang]

        def f1(limit):
            hit = [r.toxic for r in mine if r.score >= limit]
            return 2 * sum(hit) / (len(hit) + sum(r.toxic for r in mine))
        assert f1(model.thresholds[lang]) >= max(f1(r.score) for r in mine) - 0.02


def test_toxicity_scores_dont_depend_on_the_batch():
    model = toxicity.train([toxicity.word_ids(t) for t in ("a b scum", "a b c", "d scum", "d e f")], np.array([1., 0, 1, 0]))
    some = [toxicity.word_ids(t) for t in ("scum x y", "", "a", "b scum", "c d e f g")]
    together = model.scores(some)
    assert np.allclose(together, [model.scores([t])[0] for t in some])


def test_top_k(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 8)).astype(np.float32)
    v[200:] = v[0]  # a third of all rows are one vector: ties go to the smaller id
    rows = [(i, [float(x) for x in v[i]], 0) for i in range(300)]
    rows += [(1000, None, 0), (1100, [None] * 8, 0), (1200, [float("nan")] * 8, 0), (1300, [0.0] * 8, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = knn_join.top_k(df, df.where("vec_id % 100 = 0"), 10, pivots=4).collect()
    q = {i: np.floor(np.array(e, np.float32).astype(float) * 1024) for i, e, _ in rows if i < 300 or i == 1300}
    for qid in (0, 100, 200, 1300):
        want = sorted(((-int(q[qid] @ x), i) for i, x in q.items() if i != qid))[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == qid)
        assert mine == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]
    assert {r.query_id for r in got} == {0, 100, 200, 1300}
    assert knn_join.top_k(df.where("false"), df.where("false")).count() == 0


def test_top_k_of_a_query_whose_vec_id_repeats(spark):
    rng = np.random.default_rng(9)
    far = rng.integers(-5, 6, size=(12, 4)).astype(float)  # so few that every vector is one of 16 pivots
    hot = np.array([50.0, 50, 50, 50])
    rows = [(i + 1, x.tolist()) for i, x in enumerate(far)] + [(100, hot.tolist())] * 20 + [(100, (-hot).tolist())] * 15
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for pivots in (1, 4, 16):
        asked = df.where("vec_id = 100 and embedding[0] > 0")
        got = [(r.rank, r.vec_id, r.score) for r in knn_join.top_k(df, asked, 10, 1.0, pivots).collect()]
        want = sorted((-int(hot @ x), i + 1) for i, x in enumerate(far))[:10]
        assert sorted(got) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]


def test_hash_ring(spark, docs, none):
    got = hash_ring.shard_rows(docs, "doc_id", shards=7, vnodes=16).collect()
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == docs.count() and set(slots) == set(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert hash_ring.shard_rows(none, "doc_id").count() == 0


def test_hash_ring_walk_equals_key_by_key():
    points = hash_ring.ring(5, 8)
    owners = [s for _, s in points] + [points[0][1]]
    counts = np.random.default_rng(0).integers(0, 9, len(owners)).tolist()
    plan = hash_ring.walk(counts, owners, 5)
    total = sum(counts)
    assert [p[0] for p in plan] == [0, *[p[1] for p in plan[:-1]]] and plan[-1][1] == total
    sizes = collections.Counter()
    for lo, hi, s, _ in plan:
        sizes[s] += hi - lo
    assert max(sizes.values()) - min(sizes.values()) <= 1
    home = np.repeat(owners, counts)
    stay = sum(int((home[lo:hi] == s).sum()) for lo, hi, s, _ in plan)
    share = [total // 5 + (i < total % 5) for i in range(5)]
    assert stay >= sum(min(int((home == s).sum()), share[s]) for s in range(5))  # only overflow moves


def test_token_counts(docs, none):
    lib = tokens.tokenizer(WORD)
    got = collections.Counter((r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, WORD, 100).collect())
    want = collections.Counter()
    for r in docs.collect():
        n = len(lib.encode(r.text or "", add_special_tokens=False).ids)
        want[(len((r.text or "").encode()), n, n > 100)] += 1
    assert got == want
    assert token_counts.token_counts(none, WORD).count() == 0


@pytest.mark.parametrize("text", ["a  b", "a\n\nb\n\n\nc", " a", "a ", "a\tb", "x<|endoftext|>y", "\n", "é b", "don't 'll I'm\nx",
                                  "a \nb", "a\n b", "ΑΣ ΟΣ İ ſt", "<|startoftext|> Abc", "x\x1cy z", "a b  c", "é ﬁ"])
def test_tokenizers_agree_with_the_library(text):
    pairs, count = tokens.byte_pairs(BYTE), token_counts.counter(WORD)
    for _ in range(2):  # from the cache too
        assert pairs.ids(text) == pairs.whole(text)
        assert count.count(text) == len(count.library.encode(text, add_special_tokens=False).ids)


def test_packing(docs, none):
    lib = tokens.tokenizer(BYTE)
    got = packing.packed_documents(docs, BYTE, size=64).collect()
    want = collections.Counter()
    for r in docs.collect():
        ids = np.array([*lib.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for s in range(0, len(ids), 64):
            part = ids[s:s + 64]
            want[(r.doc_id, s, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.packed_documents(none, BYTE).count() == 0


def test_shortest_pack_first_places_everything():
    rng = np.random.default_rng(6)
    histogram = {int(n): int(c) for n, c in zip(range(1, 129), rng.integers(0, 50, 128))}
    packs = packing.shortest_pack_first(histogram, 128)
    placed = collections.Counter()
    for count, lengths in packs:
        assert count > 0 and sum(lengths) <= 128
        for n in lengths:
            placed[n] += count
    assert placed == collections.Counter({n: c for n, c in histogram.items() if c})
    used = sum(n * c for n, c in histogram.items())
    assert used / (128 * sum(c for c, _ in packs)) > 0.97


def test_lm_scores(docs, none):
    rows = docs.withColumn("held_out", common.held_out("doc_id", 7))
    got = mixing_lm.score(rows).collect()
    count = collections.Counter()
    words = lambda t: [*(t or "").encode().lower().split(), b" "]
    for r in rows.collect():
        if not r.held_out:
            count.update(words(r.text))
    n, v = sum(count.values()), len(count)
    want = sorted((len(w := words(r.text)), sum(count[x] > 0 for x in w),
                   round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)) for r in rows.collect())
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert all(r.train_tokens == n and r.score <= 0 for r in got)
    assert mixing_lm.score(rows.where("false")).count() == 0


def random_mixer(code):
    rng = np.random.default_rng(0)
    tables = [rng.integers(0, 256, mixing_lm.COLUMNS * n).astype(np.uint8) for n in (8192, 4096, 12288)]
    return mixing_lm.Mixer(code, tables, rng.uniform(0, 0.6, (3, mixing_lm.GATES)).astype(np.float32), 100.0)


def plain_log10(model, text):
    """The mixing model one decision after another, with Python's numbers."""
    code, mask = model.code, (1 << 64) - 1
    syms = [int(code.symbol[b]) for b in text.lower()] + [mixing_lm.END]
    past, word = [0] * mixing_lm.PAD, []
    edges, total = [0, 32, 64, 128, *range(256, len(syms) + 256, 256)], 0.0
    change, curve = [0.0] * 3, [0.0] * 3
    slope, bend = [0.0] * 3, [0.0] * 3
    for t, s in enumerate(syms):
        if t in edges and t:
            for i in range(3):
                curve[i] += bend[i]
                change[i] += slope[i] / (3 * curve[i] + model.damping)
            slope, bend = [0.0] * 3, [0.0] * 3
        rows = []
        for order, size in zip(mixing_lm.ORDERS, model.rows):
            if order:
                c = sum(past[-1 - i] << (6 * i) for i in range(order))
                c = ((c * 0x9E3779B1) & 0xFFFFFFFF) ^ (c >> 15)
                c = (c * 0x85EBCA6B) & 0xFFFFFFFF
            else:  # the gap before the word is part of it
                h = sum((x + 1) * pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i, x in enumerate(word)) & mask
                c = (((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9) & mask) >> 32
            rows.append(c * size >> 32)
        path = range(int(code.first[s]), int(code.first[s] + code.length[s]))
        for k in path:
            node, bit = int(code.node[k]), int(code.bit[k])
            cells = [int(tab[r * mixing_lm.COLUMNS + node]) for tab, r in zip(model.tables, rows)]
            x = [((c >> 2) - 31.5) / 4 for c in cells]
            gate = (k > path[0]) + 2 * (cells[1] & 3) + 8 * (cells[2] & 3)
            z = sum((float(model.weights[i][gate]) + change[i]) * x[i] for i in range(3))
            p = 1 / (1 + math.exp(-z))
            total += math.log(p if bit else 1 - p)
            for i in range(3):
                slope[i] += (bit - p) * x[i]
                bend[i] += p * (1 - p) * x[i] * x[i]
        if s == mixing_lm.ESCAPE:
            total -= code.raw
        past.append(s)
        word = [] if code.space[s] else [*word, s]
    return total / math.log(10)


def test_lm_mixer_equals_the_plain_one():
    train = b"the cat sat on the mat, and a dog ran off with 7 hats " * 20
    model = random_mixer(mixing_lm.Code(np.bincount(np.frombuffer(train, np.uint8), minlength=256), 3))
    parts = [b"", b"The cat", "caf\u00e9 \u0416 q".encode(), b"a dog ran off with the mat " * 40, b"x" * 256, b"y" * 31,
             b"on\ttop\n" * 100]
    got = model.log10(np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in parts])]))
    assert np.allclose(got, [plain_log10(model, t) for t in parts], rtol=1e-4)


def test_lm_looks_equal_lookups_up_once(monkeypatch):
    """A symbol in rows seen before makes the same decisions: repeats of a text cost no further lookups."""
    model = random_mixer(mixing_lm.Code(np.bincount(np.frombuffer(b"the cat sat on the mat " * 20, np.uint8), minlength=256), 1))
    looked_up, paths = [], mixing_lm.Mixer.paths

    def counted(self, lookups):
        looked_up.append(len(lookups))
        return paths(self, lookups)
    monkeypatch.setattr(mixing_lm.Mixer, "paths", counted)
    text = "the cat sat, caf\u00e9 on the mat ".encode()
    once, often = ([text * n, b"", text * n] for n in (2, 60))
    got = [model.log10(np.frombuffer(b"".join(t), np.uint8), np.cumsum([0, *map(len, t)])) for t in (once, often)]
    assert len(looked_up) == 2 and looked_up[0] == looked_up[1] <= 2 * len(text) + 2
    assert np.allclose(got[1], [plain_log10(model, t) for t in often], rtol=1e-4)
    # in the order of the texts, the keys are those of one decision after another
    data, offs = np.frombuffer(once[0], np.uint8), np.array([0, len(once[0])])
    sym, at, _ = mixing_lm.symbols(model.code, data, offs)
    size = model.code.length[sym[at]]
    want = np.zeros(size.sum(), np.uint32)
    for where, key in model.decisions(sym, at, np.cumsum(size) - size):
        want[where] = key
    lookups = model.lookups(sym[at], mixing_lm.context_rows(model.code, sym, at, model.rows))
    keys, ends = model.keys(sym[at], lookups, np.arange(len(at)))
    assert (keys == want).all() and (ends == np.cumsum(size)).all()


def test_lm_words_are_split_as_bytes_are():
    texts = ["", None, " ", "A b\tC\x0b\x0cd\r\ne  f ", "\x1cq\x1f \u00a0x\u0085 \u0130\u00c4Z", "a", "b a\x00 b"]
    word, doc, size, index = mixing_lm._words(pa.array(["left out", *texts])[1:])
    for i, t in enumerate(texts):
        want = [*(t or "").encode().lower().split(), mixing_lm.END_WORD]
        assert [index[w] for w in word[doc == i]] == want and size[i] == len(want)
    assert len(set(index)) == len(index)


def test_lm_weights_are_learned_from_the_training_fold_alone(spark):
    rng = np.random.default_rng(3)
    vocab = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(150)]
    rows = [(i, " ".join(rng.choice(vocab, 60)), i % 7 == 2) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(5)
    got = mixing_lm.score(df).collect()
    held = [r for r in got if r.held_out]
    # words are drawn independently, so the word counts are the source itself: spelling comes near, not above
    assert sum(r.score for r in held) > 1.03 * sum(r.base_score for r in held)
    # other held-out texts change no other score, and ids may be strings
    other = df.where("held_out = false or doc_id < 700").withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    want = {f"d{r.doc_id}": r.score for r in got}
    assert all(math.isclose(r.score, want[r.doc_id], rel_tol=1e-6) for r in mixing_lm.score(other).collect())


def test_lm_weights_come_from_every_training_text(spark):
    """More texts than any sample and some long ones: each is looked up in the tables of the other half."""
    rng = np.random.default_rng(5)
    vocab = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(200)]
    texts = [" ".join(rng.choice(vocab, n)) for n in [*rng.integers(1, 40, 600), 2500, 3000, 4000, 5000]]
    texts += [texts[0]] * 30 + [None, ""]
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    code = mixing_lm.Code(np.bincount(np.frombuffer("".join(filter(None, texts)).encode(), np.uint8), minlength=256), len(texts))
    histogram = np.bincount(np.frombuffer("".join(filter(None, texts)).encode(), np.uint8), minlength=256)
    got = mixing_lm.fit(train, histogram, len(texts), max_rows=8192)
    half = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(
        F.pmod(F.xxhash64("text"), F.lit(2))).collect()]
    rows, coded, total = got.rows, [], []
    for which in (0, 1):
        data = [(t or "").encode() for t, h in zip(texts, half) if h == which]
        coded.append(mixing_lm.symbols(code, np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])))
        sym, at, _ = coded[which]
        total.append([np.bincount(r * mixing_lm.COLUMNS + sym[at], minlength=n * mixing_lm.COLUMNS).reshape(n, -1)
                      for r, n in zip(mixing_lm.context_rows(code, sym, at, rows), rows)])
    values = lambda ts: [mixing_lm.cell_values(t @ code.through, t @ code.ones).ravel() for t in ts]
    assert all((a == b).all() for a, b in zip(got.tables, values([a + b for a, b in zip(*total)])))
    keys = []
    for which in (0, 1):
        sym, at, _ = coded[which]
        other = mixing_lm.Mixer(code, values(total[1 - which]), got.weights, 1.0)
        keys += [key for _, key in other.decisions(sym, at, np.zeros(len(at), np.int64))]
    keys = np.concatenate(keys).astype(np.int64)
    assert len(keys) == sum(int(code.length[sym[at]].sum()) for sym, at, _ in coded)
    gate = (keys >> 22) | (keys >> 6 & 3) << 1 | (keys >> 14 & 3) << 3
    x = np.stack([((keys >> 8 * i) & 63) / 4 - 31.5 / 4 for i in range(3)])
    curve = 0
    for g in np.unique(gate):
        weights, bend = mixing_lm.fit_weights(x[:, gate == g], np.ones((gate == g).sum()))
        assert np.allclose(got.weights[:, g], weights, atol=1e-4)
        curve = curve + bend
    symbols = sum(len(at) for _, at, _ in coded)
    assert math.isclose(got.damping, mixing_lm.damping(curve, symbols), rel_tol=1e-4)
    assert not np.allclose(got.weights, 1 / 3)


def test_lm_long_training_texts_count(spark):
    """Texts of more than 8,192 bytes alone: weights are learned from them, too."""
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["abc", "de", "fghi", "jk"], 3000)) for _ in range(4)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    model = mixing_lm.fit(train, np.bincount(data, minlength=256), len(texts), max_rows=4096)
    assert not np.allclose(model.weights, 1 / 3)


def test_lm_is_a_distribution_and_ignores_the_batch():
    code = mixing_lm.Code(np.bincount(np.frombuffer(b"the cat sat on the mat " * 20, np.uint8), minlength=256), 1)
    model = random_mixer(code)

    def logs(texts):
        data = np.frombuffer(b"".join(texts), np.uint8)
        return model.log10(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    # one decision tree: over all next symbols after a prefix the probabilities sum to one
    shared = logs([b"th"])
    assert shared.shape == (1,)
    parts = [b"the cat", b"", b"q\xffz", b"sat on the mat " * 60]
    assert np.allclose(logs(parts), [logs([p])[0] for p in parts])
    total = sum(10 ** logs([bytes([b])])[0] * 1 for b in range(256) if not 65 <= b <= 90)
    assert 0 < total + 10 ** logs([b""])[0] <= 1 + 1e-6


def test_repeated_passages_tell_rows_of_one_id_apart(spark, tmp_dir):
    """Rows under one doc_id keep what is theirs alone; a hot doc_id is compared with brute force."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefgh "))
    unique = lambda n: "".join(rng.choice(letters, n))
    a = unique(96)
    rows = [(1, a), (2, a), (2, unique(96)), (2, unique(60) + a[10:80] + unique(30))]
    rows += [(3, unique(55) if i % 3 else a[i % 40:i % 40 + 52]) for i in range(3000)] + [(4, rows[3][1]), (None, a)]
    path = tmp_dir + "/docs"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(path)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept))
                              for r in suffix_dedup.repeated_passages(spark.read.parquet(path)).collect())
    first = {}
    for d, t in rows:
        for i in range(len(t) - 49 if d is not None else 0):
            first[t[i:i + 50]] = min(first.get(t[i:i + 50], d), d)
    want = collections.Counter()
    for d, t in rows:
        gone = [False] * len(t)
        for i in range(len(t) - 49 if d is not None else 0):
            if first[t[i:i + 50]] < d:
                gone[i:i + 50] = [True] * 50
        want[d, len(t), sum(gone), "".join(c for c, g in zip(t, gone) if not g).encode()] += 1
    assert got == want


def test_toxicity_draw_is_bounded_whatever_the_repeats(spark, monkeypatch):
    docs = spark.range(4000).selectExpr("IF(id < 3000, 7, id) AS doc_id", "concat('word', id, ' scum') AS text", "'en' AS lang")
    labels = docs.select("doc_id").distinct().selectExpr("doc_id", "CAST(doc_id % 2 = 1 AS INT) AS toxic")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda ids, toxic, old=toxicity.train: seen.append(len(ids)) or old(ids[:5], toxic[:5]))
    toxicity.fit(docs, labels, sample=60)
    assert seen == [60]


def test_language_thresholds_move_smoothly_from_the_pooled_one():
    big = np.array([[700, 400, 0], [500, 10, 30], [300, 0, 900]])
    pooled = toxicity.language_thresholds({"a": big}, 0.3)["a"]
    def of(n):
        rare = np.array([[620, n, 0], [610, 0, n]])
        return toxicity.language_thresholds({"a": big, "rare": rare, "none": np.array([[400, 0, 9]])}, 0.3)
    assert toxicity.language_thresholds({}, 0.3) == {}
    got = [of(n)["rare"] for n in (1, 5, 19, 20, 21, 400)]
    assert got == sorted(got) or got == sorted(got, reverse=True)
    assert max(abs(b - a) for a, b in zip(got[2:4], got[3:5])) < 0.05
    own = toxicity.best_threshold(np.array([620, 610]), np.array([400, 0]), np.array([0, 400]), pooled)
    assert abs(of(10 ** 6)["rare"] - own) < 0.01
    assert of(5)["none"] == toxicity.language_thresholds({"all": np.concatenate([
        big, np.array([[620, 5, 0], [610, 0, 5]]), np.array([[400, 0, 9]])])[np.argsort([2, 0, 5, 1, 6, 3])]}, 0.3)["all"]
