"""Id files, vector codes and the prefix trie against plain versions written on their own."""

import collections
import hashlib
import itertools
import math
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from noticeflow.llm import id_files, prefix_trie, queries, range_coder, tokens, vector_codes
from noticeflow.llm.common import attach
from noticeflow.llm.ranks import rank_in_group

BYTE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- op11
@pytest.mark.parametrize("n,kinds", [(1, 1), (2, 5), (64, 3), (65, 70000), (5000, 300), (3000, 1 << 31), (20000, 2)])
def test_range_coder_round_trip(n, kinds):
    rng = np.random.default_rng(n)
    ids = (rng.integers(0, kinds, n) // rng.integers(1, 50, n)).astype(np.uint32)
    block = range_coder.block_length(n)
    symbols, count, words, sizes = range_coder.encode(ids, block)
    assert len(sizes) == -(-n // block)
    assert (range_coder.decode(symbols, count, words, sizes, n, block) == ids).all()
    # any single block is decoded without the others
    ends = np.cumsum(sizes)
    k = len(sizes) // 2
    got = range_coder.decode(symbols, count, words[ends[k] - sizes[k]:ends[k]], sizes[k:k + 1],
                             min(block, n - k * block), block)
    assert (got == ids[k * block:(k + 1) * block]).all()


def test_range_coder_learns_contexts():
    """Text that repeats costs less than its order-0 entropy; random ids cost about that entropy."""
    rng = np.random.default_rng(1)
    cycle = np.tile(rng.integers(0, 40000, 100), 200).astype(np.uint32)
    noise = rng.integers(0, 256, 20000).astype(np.uint32)
    for ids, most in ((cycle, 4.5), (noise, 8.7)):
        _, _, words, _ = range_coder.encode(ids, 1024)
        assert 16 * len(words) / len(ids) < most


def test_long_run_of_sure_ids_crosses_word_borders():
    ids = np.concatenate([np.zeros(30000), np.arange(300), np.zeros(30000), np.full(9000, 7)]).astype(np.uint32)
    for block in (64, 1000, 4096):
        s, c, w, z = range_coder.encode(ids, block)
        assert (range_coder.decode(s, c, w, z, len(ids), block) == ids).all()


def test_contexts_of_all_lanes_lie_together():
    """Lanes in one context touch neighbouring places, so that frequent contexts stay in the processor's cache."""
    lanes = range_coder._Lanes(40, range_coder.frequencies(np.array([5, 3, 2])))
    one = two = np.zeros(40, np.int32)
    lanes.step(40, one, two, np.full(40, 2, np.int32))
    for touched in (np.flatnonzero(lanes.slots), np.flatnonzero(lanes.odds != 1 << 14)):
        assert len(touched) and len(touched) % 40 == 0
        assert (np.diff(touched.reshape(-1, 40), axis=1) == 1).all()


def test_one_lane_needs_far_more_room():
    ids = np.zeros(20 * 1024 + 5, np.uint32)
    ids[7 * 1024:8 * 1024] = np.random.default_rng(5).permutation(40000)[:1024]
    s, c, w, z = range_coder.encode(ids, 1024)
    assert z[7] > 10 * z[6]
    assert (range_coder.decode(s, c, w, z, len(ids), 1024) == ids).all()


def test_segment_checksums():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 500, 4000).astype(np.uint32)
    lengths = np.array([0, 1, 1999, 0, 2000])
    data = id_files.pack_segment(pa.array([1, 1, None, 5, 6], pa.int64()), lengths, ids)
    index, got = id_files.unpack_segment(data)
    assert index.column(0).to_pylist() == [1, 1, None, 5, 6] and (got == ids).all()
    for at in (0, 9, 60, len(data) // 2, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 16
        with pytest.raises(ValueError):
            id_files.unpack_segment(bytes(broken))
    with pytest.raises(ValueError):
        id_files.unpack_segment(data[:-3])
    index, got = id_files.unpack_segment(id_files.pack_segment(pa.array(["a"]), np.array([0]), np.zeros(0, np.uint32)))
    assert index.num_rows == 1 and len(got) == 0


TEXTS = ["", " ", "a", " a", "a  b", "a\nb", "a \nb", "\n", "a\n", "x <|endoftext|> y", "tab\tb", "é ü z", "it's we're",
         "1234 56", None, "日本 語", "a b", "a\x00b", "!!! ??", "word " * 3000 + "end", "Ünïcode sp ace"]


def library_ids(text):
    return tokens.tokenizer(BYTE).encode(text or "", add_special_tokens=False).ids


def test_array_ids_equal_the_library():
    find = tokens.array_ids(BYTE)
    for bytes_of in (find.bytes_of, None):
        find.bytes_of, kept = bytes_of, find.bytes_of
        find.forget()
        flat, size = find(pa.array(TEXTS), 7)
        ends = np.cumsum(size)
        assert [flat[e - n:e].tolist() for e, n in zip(ends, size)] == [library_ids(t) + [7] for t in TEXTS]
        find.bytes_of = kept
    flat, size = find(pa.array([], pa.string()), 7)
    assert len(flat) == len(size) == 0


def test_array_ids_look_pieces_up_as_a_column(monkeypatch):
    """New pieces are merged once, with their bytes counted by Arrow; slots of known ones come back in any order."""
    find = tokens.array_ids(BYTE)
    find.forget()
    merged, fresh = [], tokens.ArrayIds.fresh

    def counted(self, pieces, size):
        assert [len(p.encode()) for p in pieces] == size.tolist()
        merged.extend(pieces)
        return fresh(self, pieces, size)
    monkeypatch.setattr(tokens.ArrayIds, "fresh", counted)
    pieces = [" word", "\nline", " Ünïcode", " 日本", " x\x00", " 😀", " unforeseeably"]
    first = find.slots(pa.array(pieces[:4], pa.large_string()))
    again = find.slots(pa.array([*reversed(pieces[1:]), pieces[0]], pa.large_string()))
    assert merged == [*pieces[:4], *reversed(pieces[4:])]
    assert again.tolist() == [*again[:3], first[3], first[2], first[1], first[0]]
    for piece, slot in zip([*reversed(pieces[1:]), pieces[0]], again):
        ids = find.table[find.start[slot]:find.start[slot] + find.length[slot]]
        assert ids.tolist() == library_ids(piece)


def test_known_pieces_are_an_arrow_column(monkeypatch):
    """No Python object for a known piece; a full table is forgotten and filled again."""
    find = tokens.array_ids(BYTE)
    find.forget()
    find(pa.array(["so many words", "many more words"]), 7)
    assert isinstance(find.slot, pa.Array)
    assert sorted(find.slot.to_pylist()) == [" many", " more", " so", " words"]
    monkeypatch.setattr(tokens, "CACHE", 2)
    for text in ("a b c", "c d e f g", "g a b", "g a c"):
        flat, size = find(pa.array([text, None, text]), 7)
        assert flat.tolist() == [*library_ids(text), 7, 7, *library_ids(text), 7]
        assert size.tolist() == [len(library_ids(text)) + 1, 1, len(library_ids(text)) + 1]
    for texts in (["", None], ["  "], [" ", "", "a"]):
        flat, size = find(pa.array(texts))
        assert flat.tolist() == [i for t in texts for i in library_ids(t)]
        assert size.tolist() == [len(library_ids(t)) for t in texts]
    find.forget()


def test_id_files(spark, tmp_dir):
    rows = [(i % 9 if i % 5 else None, t, "clash", i) for i, t in enumerate(TEXTS)] + [(4, "same", "", 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string, part int")
    for segment, file_bytes in ((id_files.SEGMENT, id_files.FILE_BYTES), (5, 100), (3000, 1 << 30)):
        folder = os.path.join(tmp_dir, f"{segment}")
        id_files.write_ids(docs, folder, BYTE, end_id=0, segment=segment, file_bytes=file_bytes)
        got = sorted(id_files.read_ids(spark, folder).collect(), key=lambda r: r.start)
        at = 0
        for r in got:
            assert r.start == at
            at += r.n_tokens
        assert [r.doc_id for r in got] == sorted([r[0] for r in rows], key=lambda x: (x is None, x))
        told = collections.Counter((r[0], np.array(library_ids(r[1]) + [0], "<u4").tobytes()) for r in rows)
        assert collections.Counter((r.doc_id, bytes(r.ids)) for r in got) == told
        assert all(len(r.ids) == 4 * r.n_tokens for r in got)


def test_id_files_empty_table_and_string_ids(spark, tmp_dir):
    none = spark.createDataFrame([], "doc_id long, text string")
    id_files.write_ids(none, tmp_dir + "/none", BYTE)
    assert id_files.read_ids(spark, tmp_dir + "/none").collect() == []
    docs = spark.createDataFrame([("b", "two"), ("a", "one"), ("c", None)], "doc_id string, text string")
    id_files.write_ids(docs, tmp_dir + "/text", BYTE)
    got = id_files.read_ids(spark, tmp_dir + "/text", "string").orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens) for r in got] == [("a", 2), ("b", 2), ("c", 1)]


def test_hot_doc_id_is_spread(spark, tmp_dir):
    docs = spark.range(3000).selectExpr("7L AS doc_id", "concat('text number ', id) AS text")
    id_files.write_ids(docs, tmp_dir, BYTE, file_bytes=8000)
    manifest = spark.read.parquet(tmp_dir + "/manifest").collect()
    assert len({r.part for r in manifest}) >= 3 and max(r.documents for r in manifest) < 2000
    assert id_files.read_ids(spark, tmp_dir).count() == 3000


def test_op11_query(spark):
    got = {r.doc_id: r for r in queries.op11_id_files(spark, SF).collect()}
    at = 0
    for r in spark.read.parquet(SF + "/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(library_ids(r.text) + [0], "<u4")
        assert tuple(got[r.doc_id]) == (r.doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


# ---------------------------------------------------------------- op12
def test_exact_products():
    rng = np.random.default_rng(0)
    for d, top in itertools.product((1, 3, 8, 64, 700), (1, 4096, 1 << 26, 1 << 27)):
        if top > vector_codes.largest(d):
            continue
        a, b = (rng.integers(-top, top + 1, (n, d)) for n in (9, 5))
        a[0], b[0] = top, -top
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert vector_codes.exact_products(a, b).tolist() == want


def plain_codes(rows, scale, parts, entries, rounds):
    """Product codes by the definition, with Python's integers; rows of one vector length."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    n = len(kept[0][1])
    width = -(-n // parts)
    cut = lambda v: [(v + [0] * (width * parts - n))[p * width:(p + 1) * width] for p in range(parts)]
    kept = [(i, cut(v), label) for i, v, label in kept]
    books = [[v[p] for _, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]] for p in range(parts)]

    def assign(v, p):
        far = [sum((a - b) ** 2 for a, b in zip(v[p], e)) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            mine = collections.defaultdict(list)
            for _, v, _ in kept:
                mine[assign(v, p)[0]].append(v[p])
            for e, vs in mine.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    out = [(i, [assign(v, p) for p in range(parts)], label) for i, v, label in kept]
    by_label = collections.Counter()
    for _, a, label in out:
        by_label[label] += sum(d for _, d in a)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for k, _ in a), sum(d for _, d in a), by_label[label], sha) for i, a, label in out]


def as_rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_product_codes(spark):
    rng = random.Random(4)
    rows = [(i // 2, [round(rng.gauss(0, 2), 2) for _ in range(10)], rng.choice([1, 2, None])) for i in range(300)]
    rows += [(5, [0.5] * 10, 1)] * 40 + [(None, [1.0] * 10, 3), (900, None, 1), (901, [1.0] * 9 + [None], 1),
                                         (902, [float("nan")] * 10, 2), (903, [1.0] * 9 + [float("inf")], 2)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, label int, n string")
    want = collections.Counter(plain_codes(rows, 64.0, 4, 5, 3))
    assert as_rows(vector_codes.product_codes(df, 64.0, 4, 5, 3)) == want


def test_product_codes_few_rows_other_lengths_and_none(spark):
    rows = [(1, [0.25, -1.0], 7), (2, [0.5, 3.0], 7), (3, [1.0, 1.0, 1.0], 7), (4, [], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vector_codes.product_codes(df, 4096.0, 8, 16, 6).collect()}
    assert got[1].code == "00" + "00" * 7 and got[2].code == "0101" + "00" * 6
    assert [got[i].error for i in (1, 2, 3, 4)] == [0, 0, 0, 0] and got[1].label_error == 0
    assert got[1].codebooks_sha256 == got[2].codebooks_sha256 != got[3].codebooks_sha256
    assert vector_codes.product_codes(df.where("false")).collect() == []
    with pytest.raises(Exception, match="must lie within"):
        vector_codes.product_codes(spark.createDataFrame([(1, [1e30], 1)], "vec_id long, embedding array<float>, label int"))


def test_op12_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(SF + "/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert as_rows(queries.op12_vector_codes(spark, SF)) == collections.Counter(plain_codes(rows, 4096.0, 8, 16, 6))


def test_attach_keeps_every_row(spark):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN -1 ELSE id END AS k")
    totals = rows.groupBy("k").agg({"*": "count"}).withColumnRenamed("count(1)", "n").selectExpr("k", "n", "n * 2 AS twice")
    got = attach(rows, totals, "k", "n", share=100).collect()
    assert len(got) == 5000
    assert all(r.twice == (3334 if r.k is None else 3334 if r.k == -1 else 2) for r in got)


# ---------------------------------------------------------------- op13
def plain_trie(rows):
    """The trie by the definition: a dictionary of prefixes."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    child, parent, last = {}, [None], [""]
    members, ends = [[]], [[]]
    for c in sorted(built):
        node = 0
        members[0].append(c)
        for turn in built[c]:
            if (node, turn) not in child:
                child[node, turn] = len(parent)
                parent.append(node)
                last.append(turn[1])
                members.append([])
                ends.append([])
            node = child[node, turn]
            members[node].append(c)
        ends[node].append(c)
    if not built:
        return collections.Counter()
    n = len(parent)  # children come after their parents
    depth, children, leaves = [0] * n, collections.Counter(parent[1:]), [0] * n
    saved = [(len(m) - 1) * len(t) for m, t in zip(members, last)]
    for v in range(1, n):
        depth[v] = depth[parent[v]] + 1
    for v in range(n - 1, -1, -1):
        leaves[v] += children[v] == 0
        if v:
            leaves[parent[v]] += leaves[v]
            saved[parent[v]] += saved[v]
    return collections.Counter(
        (members[v][0], depth[v], members[parent[v]][0] if v else None, len(members[v]), children[v], leaves[v],
         saved[v], hashlib.sha256(",".join(map(str, ends[v])).encode()).hexdigest()) for v in range(n))


def trie_rows(seed, convs, depth, words):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]), rng.choice(words)) for c in convs for t in range(rng.randint(1, depth))]


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("rows", [
    trie_rows(1, range(0, 230), 9, ["", "a", "bé"]),
    trie_rows(2, [*range(100, 140), *range(205, 215), 5, 300], 3, ["x", "yy"]),
    trie_rows(3, [0, 1, 2, 100, 101], 700, ["same"]) + [(7, t, "user", "same") for t in range(4200)],
    [(1, None, None, None), (1, None, "user", "a"), (1, 2, "user", "b"), (1, 2, "user", "b"), (1, 1, "", "c"),
     (None, 1, "user", "lost"), (-150, 1, "u", "n"), (-151, 1, "u", "n")],
    [(c, 0, "user", "hello") for c in range(3000)],
], ids=["short", "absent bases", "deep", "nulls and ties", "one hot node"])
def test_prefix_trie(spark, rows):
    assert as_rows(prefix_trie.prefix_trie(spark.createDataFrame(rows, CONV))) == plain_trie(rows)


def test_prefix_trie_empty_and_clashing_columns(spark):
    df = spark.createDataFrame(trie_rows(4, range(50), 6, ["a", "b"]), CONV)
    assert prefix_trie.prefix_trie(df.where("false")).collect() == []
    extra = df.selectExpr("*", "1 AS name", "'x' AS depth", "2 AS pos", "3 AS conv", "4 AS chain")
    assert as_rows(prefix_trie.prefix_trie(extra)) == as_rows(prefix_trie.prefix_trie(df))


def test_id_digests_over_many_partitions(spark):
    """A list that spans partitions and pieces has the digest of the whole."""
    old = prefix_trie.PIECE
    rows = spark.range(20000).selectExpr("CASE WHEN id % 10 = 0 THEN X'01' ELSE X'02' END AS name", "id AS conv")
    got = {bytes(r.name): r.ends_sha256 for r in prefix_trie.id_digests(rows).collect()}
    assert prefix_trie.PIECE == old
    for name, rest in ((b"\x01", True), (b"\x02", False)):
        ids = [i for i in range(20000) if (i % 10 == 0) == rest]
        assert got[name] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_op13_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(SF + "/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(queries.op13_prefix_trie(spark, SF)) == plain_trie(rows)


def test_rank_in_group(spark):
    rows = [(g, i) for g, n in ((-5, 3), (0, 1), (1, 4000), (2, 7)) for i in range(n)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "g long, i int")
    assert sorted((r.g, r.i, r.at) for r in rank_in_group(df, "g", [df.i.desc()], ["g", "i"], "at").collect()) == sorted(
        (g, i, {-5: 3, 0: 1, 1: 4000, 2: 7}[g] - 1 - i) for g, i in rows)
    assert rank_in_group(df.where("false"), "g", [df.i], ["g"], "at").collect() == []
