"""Trie of the prefixes of turn sequences, by van Emde Boas recursion.

A sequence is cut at half its depth: the name of the cut prefix is the root of
the lower part, and both halves are cut again.  A prefix of d turns is thus
named from the binary digits of d: the name of the prefix without its last
aligned block, and the name of that block (a binary tree over its turns), each
a 128-bit hash of the two.  The lowest six levels of the recursion run inside
groups of 64 consecutive turns, all groups in parallel; the levels above see
one name per group, again 64 at a time, so a sequence of any length is never
gathered whole.

Nodes are the distinct names.  Totals are grafted upward level by level, the
outermost cut first: what lies in a lower half is summed under the name of its
cut prefix and added to that node, which is a leaf of the upper half.  After
the last level each node holds the total of its subtree.  A round is one
partial aggregate by name, so a node that all sequences pass is summed inside
the tasks first; no walk up the tree is ever made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, map_arrow, written
from .ranks import rank_in_group

ROOT = bytes(16)
#: Turns (or names of the level below) in a group: six levels of the recursion.
GROUP = 64
#: Rows of one conversation that share a key in the join with its attributes.
SPREAD = 4096
#: Bytes of joined ids in one row, where a node's list spans partitions.
PIECE = 1 << 20


def pair(a: bytes, b: bytes) -> bytes:
    return hashlib.blake2b(a + b, digest_size=16).digest()


def blocks(names: list[bytes]) -> list[list[bytes]]:
    """Names of the full aligned blocks of 1, 2, 4, ... of ``names``."""
    out = [names]
    while len(out[-1]) > 1:
        low = out[-1]
        out.append([pair(low[i], low[i + 1]) for i in range(0, len(low) - 1, 2)])
    return out


def prefixes(start: bytes, names: list[bytes]) -> list[bytes]:
    """Names of the prefixes ``start`` + 0, 1, ... len(names) of ``names`` (GROUP of them at most)."""
    levels, out = blocks(names), [start]
    for d in range(1, len(names) + 1):
        k = (d & -d).bit_length() - 1  # the last aligned block of d has 2^k names
        out.append(pair(out[d - (1 << k)], levels[k][(d >> k) - 1]))
    return out


def cuts(r: int) -> list[int]:
    """r and what is left of it when its low bits are cleared one by one, down to 0."""
    out = [r]
    while r:
        r &= r - 1
        out.append(r)
    return out


def _full_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, i, names) -> (conv, i, name of the group, null if it is not full)."""
    for batch in batches:
        names = [blocks(n)[-1][0] if len(n) == GROUP and None not in n else None for n in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.binary())],
                                         ["conv", "i", "name"])


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, i, names, chain, end) of an upper group -> (conv, i, chain, end) of the groups below it.

    ``chain``: the name of the prefix where the group starts and those of its
    cut prefixes, ending with the root; ``end``: the name where a full group ends.
    """
    for batch in batches:
        out = []
        for conv, i, names, chain, end in zip(*(c.to_pylist() for c in batch.columns)):
            full = [n for n in names if n is not None]  # only the last can be missing
            known = prefixes(chain[0], full)
            if end is not None and len(known) > GROUP:
                known[GROUP] = end
            for r in range(len(names)):
                mine = [known[c] for c in cuts(r)[:-1]] + chain
                out.append((conv, i * GROUP + r, mine, known[r + 1] if r < len(full) else None))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[k] for o in out], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.binary()))], ["conv", "i", "chain", "end"])


def _turn_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, i, names, sizes, chain, end) of a group of turns -> one row per turn: the node it reaches."""
    for batch in batches:
        out = []
        for conv, i, names, sizes, chain, end in zip(*(c.to_pylist() for c in batch.columns)):
            chain = chain or [ROOT]
            known = prefixes(chain[0], names)
            if end is not None and len(names) == GROUP:
                known[GROUP] = end
            for r, size in enumerate(sizes):
                out.append((known[r + 1], i * GROUP + r + 1, conv, size, [known[c] for c in cuts(r)[:-1]] + chain))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[k] for o in out], t) for k, t in enumerate(
                (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary())))],
            ["name", "depth", "conv", "size", "chain"])


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations' ids ``conv``; turns ``conv, pos, name, size`` of the rebuilt conversations).

    Conversation c starts with the first h turns of c - c % 100 (the remainder
    has c's sign) and goes on with its own turns after the first h; h is
    crc32 of c in decimal, modulo 6.  ``name`` is a 128-bit hash of role and
    text, ``size`` the code points of the text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    named = told.withColumns({"name": F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32)),
                              "size": F.char_length("text").cast("long")})
    own = written(rank_in_group(named, "conv", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")],
                                ["conv", "name", "size"], "pos"))
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(6))
    convs = own.groupBy("conv").agg((F.max("pos") + 1).alias("turns")).withColumns(
        {"base": F.col("conv") - F.col("conv") % 100, "taken": taken})
    convs = written(convs.join(convs.select(F.col("conv").alias("base"), F.col("turns").alias("_has")), "base", "left")
                    .withColumn("short", F.col("taken") - F.least("taken", F.coalesce("_has", F.lit(0)))).drop("_has"))
    # five turns of a base at most, for a hundred conversations at most
    first = convs.join(own.where("pos < 5").select(F.col("conv").alias("base"), "pos", "name", "size"), "base") \
        .where("pos < taken").select("conv", "pos", "name", "size")
    # only conversations whose base is shorter than h move up; their attribute is spread like their rows
    moved = convs.where("short > 0").select(
        "conv", "short", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("turns") - 1) / SPREAD))).alias("at"))
    after = own.where(F.col("pos") >= taken).withColumn("at", F.floor(F.col("pos") / SPREAD))
    rest = after.join(moved, ["conv", "at"], "left").select(
        "conv", (F.col("pos") - F.coalesce("short", F.lit(0))).alias("pos"), "name", "size")
    return convs.select("conv"), first.unionByName(rest)


def _gather(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows (conv, pos, columns) in groups of GROUP consecutive positions: conv, i, one array per column."""
    packed = rows.groupBy("conv", F.floor(F.col("pos") / GROUP).alias("i")).agg(
        F.sort_array(F.collect_list(F.struct("pos", *columns))).alias("_g"))
    return packed.select("conv", "i", *[F.col("_g")[c].alias(c + "s") for c in columns])


def prefix_names(turns: DataFrame) -> DataFrame:
    """(name, depth, conv, size, chain) for every turn of ``turns(conv, pos, name, size)``.

    ``name`` is the node of the prefix that ends with the turn; ``chain`` holds
    the names of the cut prefixes above it, its parent first, the root last.
    """
    groups = written(_gather(turns, "name", "size"))
    levels, level = [], groups.select("conv", "i", "names")
    # each level has one row for 64 of the level below; sequences within one group need no more
    while True:
        longer = level.where("i > 0").select("conv").distinct()
        upper = level.join(longer, "conv", "left_semi")
        upper = map_arrow(upper, _full_names, "conv long, i long, name binary")
        level = written(_gather_names(upper))
        if level.isEmpty():
            break
        levels.append(level)
    none = F.lit(None).cast("binary")
    starts = None
    for level in reversed(levels):
        if starts is None:
            top = level.withColumns({"chain": F.array(F.lit(ROOT)), "end": none})
        else:
            top = level.join(starts, ["conv", "i"], "left").withColumn(
                "chain", F.coalesce("chain", F.array(F.lit(ROOT))))
        starts = map_arrow(top.select("conv", "i", "names", "chain", "end"), _starts,
                           "conv long, i long, chain array<binary>, end binary")
    if starts is None:
        whole = groups.withColumns({"chain": F.lit(None).cast("array<binary>"), "end": none})
    else:
        whole = groups.join(starts, ["conv", "i"], "left")
    return map_arrow(whole.select("conv", "i", "names", "sizes", "chain", "end"), _turn_nodes,
                     "name binary, depth long, conv long, size long, chain array<binary>")


def _gather_names(rows: DataFrame) -> DataFrame:
    """Rows (conv, i, name) in groups of GROUP consecutive i, a missing name (the last one's) kept."""
    packed = rows.groupBy("conv", F.floor(F.col("i") / GROUP).alias("g")).agg(
        F.sort_array(F.collect_list(F.struct("i", "name"))).alias("_g"))
    return packed.select("conv", F.col("g").alias("i"), F.col("_g")["name"].alias("names"))


def grafted(nodes: DataFrame, deepest: int, values: list[str]) -> DataFrame:
    """(name, values): totals over each node's subtree, of ``nodes(name, depth, chain, values)`` without the root."""
    state = nodes.select("name", "depth", "chain", *values)
    above = F.col("depth") - 1
    for k in range(max(0, deepest - 1).bit_length(), 0, -1):
        bit = 1 << (k - 1)
        cut_at = F.get("chain", F.bit_count(above.bitwiseAND(F.lit(bit - 1))))
        lower = (state.where(above.bitwiseAND(F.lit(bit)) != 0).groupBy(cut_at.alias("name"))
                 .agg(*[F.sum(v).alias(f"_{v}") for v in values]))
        is_cut = F.col("depth").bitwiseAND(F.lit(2 * bit - 1)) == bit
        added = state.where(is_cut).join(lower, "name", "left").select(
            "name", "depth", "chain", *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values])
        state = written(state.where(~is_cut).unionByName(added))
    return state.select("name", "depth", *values)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, conv, _part) sorted within a partition -> the digest of each list that lies within it.

    The first and the last list may go on in a neighbour: they leave as pieces
    (part, seq, text) instead, and their digest is made from all pieces.
    """
    name, text, size, first, part, seq, out = None, [], 0, True, 0, 0, []

    def close(last: bool):
        nonlocal text, size, first, seq
        joined = ",".join(text)
        if first or last:
            out.append((name, None, part, seq, joined))
            seq += 1
        else:
            out.append((name, hashlib.sha256(joined.encode()).hexdigest(), part, 0, None))
        text, size = [], 0

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.string()))], ["name", "sha", "part", "seq", "text"])

    for batch in batches:
        for node, conv, at in zip(*(c.to_pylist() for c in batch.columns)):
            if node != name:
                if name is not None:
                    close(False)
                    first = False
                name, part = node, at
            elif size > PIECE:
                # a list too long to hold: all its pieces leave, whether it ends here or not
                first = True
                close(False)
            piece = str(conv)
            text.append(piece)
            size += len(piece) + 1
        if out:
            yield batch_of(out)
            out = []
    if name is not None:
        close(True)
    yield batch_of(out)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (name, text) in order -> (name, digest); one hash state at a time."""
    name, state, out = None, None, []
    for batch in batches:
        for node, text in zip(*(c.to_pylist() for c in batch.columns)):
            if node == name:
                state.update(b"," + text.encode())
            else:
                if name is not None:
                    out.append((name, state.hexdigest()))
                name, state = node, hashlib.sha256(text.encode())
    if name is not None:
        out.append((name, state.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()),
                                      pa.array([r[1] for r in out], pa.string())], ["name", "sha"])


def id_digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256): SHA-256 of each name's ascending, comma-joined ``conv`` ids.

    Ids are range-partitioned by (name, conv), so a name that a third of all
    ids share is spread; only its joined pieces meet, one after the other, in a
    task that holds a hash state and one piece.
    """
    n = max(1, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = (ends.select("name", "conv").repartitionByRange(n, "name", "conv").sortWithinPartitions("name", "conv")
              .withColumn("_part", F.spark_partition_id().cast("long")))
    found = written(map_arrow(placed, _joined, "name binary, sha string, part long, seq long, text string"))
    pieces = found.where("sha IS NULL").repartition(n, "name").sortWithinPartitions("name", "part", "seq")
    spanning = map_arrow(pieces.select("name", "text"), _digests, "name binary, sha string")
    return found.where("sha IS NOT NULL").select("name", "sha").unionByName(spanning) \
        .select("name", F.col("sha").alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (``conv_id, turn, role, text``).

    conv_id (smallest member), depth, parent_conv_id (null for the root),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  Rows without a
    conv_id are left out; a null turn comes first, equal turns go by role and
    text, repeated rows are turns of their own; a null role or text is empty.
    A conversation without turns is a member of the root alone.  An empty
    table gives an empty result.
    """
    convs, turns = rebuilt(conversations)
    rows = written(prefix_names(turns))
    ends = rows.groupBy("conv").agg(F.max_by("name", "depth").alias("name"))
    ends = written(convs.join(ends, "conv", "left").select("conv", F.coalesce("name", F.lit(ROOT)).alias("name")))
    nodes = written(rows.groupBy("name").agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("depth").alias("depth"),
        F.max("size").alias("size"), F.any_value("chain").alias("chain")))
    about = nodes.agg(F.max("depth").alias("deepest")).first()
    parent = F.get("chain", F.lit(0))
    children = nodes.groupBy(parent.alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    top = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("name"), "conv_id", "n_convs", F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("size"), F.lit(None).cast("array<binary>").alias("chain"))
    every = nodes.unionByName(top).join(children, "name", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    every = written(every.select(
        "name", "depth", "chain", "conv_id", "n_convs", "n_children", parent.alias("parent"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")))
    values = ["n_leaves", "saved_tokens"]
    totals = grafted(every.where("depth > 0"), about.deepest or 0, values)
    root = every.where("depth = 0").select("name", "depth", *values)
    trunk = totals.where("depth = 1").select(F.lit(ROOT).alias("name"), "depth", *values)
    root = root.unionByName(trunk).groupBy("name").agg(*[F.sum(v).alias(v) for v in values])
    totals = totals.select("name", *values).unionByName(root)
    full = (every.drop(*values).join(totals, "name").join(id_digests(ends), "name", "left"))
    up = every.where("n_children > 0").select(F.col("name").alias("parent"), F.col("n_children").alias("_rows"),
                                              F.col("conv_id").alias("parent_conv_id"))
    return attach(full, up, "parent", "_rows").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
