"""Cached tokenizers of public vocabulary files for use in Spark tasks."""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np

#: Pieces kept in a task's cache; beyond that, pieces are worked out anew.
CACHE = 300_000


@functools.cache
def tokenizer(path: str):
    """The library's tokenizer of a .json file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@functools.cache
def byte_pairs(path: str) -> "BytePairs":
    return BytePairs(path)


class BytePairs:
    """Ids of a byte-level BPE file (.json), equal to the library's, with a cache of pieces between spaces.

    A token never spans a space that stands before another character, so a
    text with single spaces and single line feeds between its words is dealt
    with piece by piece; any other text goes to the library whole.
    """

    def __init__(self, path: str):
        import json

        self.library = tokenizer(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.cache: dict[str, bytes | None] = {}
        self.ranks = None
        twin = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(twin):  # the same vocabulary as ranks, for a faster merge of single pieces
            import public_tokenizers
            import tiktoken

            with open(twin, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranks = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                           special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes | None:
        """Ids of a piece and the space before it (none before a line feed); None: not to be cut here."""
        space = re.search(r"\s", piece)
        if piece == "" or (space and (space.start() > 0 or piece[0] != "\n" or len(piece) == 1
                                      or re.search(r"\s", piece[1:]))) or any(s in piece for s in self.special):
            return None
        text = piece if piece[0] == "\n" else " " + piece
        ids = self.ranks.encode_ordinary(text) if self.ranks else self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text."""
        if not text:
            return b""
        head, *pieces = text.replace("\n", " \n").split(" ")
        cache = self.cache
        got = list(map(cache.get, pieces))
        if None in got:
            for i, found in enumerate(got):
                if found is None:
                    found = cache.get(pieces[i])
                    if found is None:
                        found = self.piece(pieces[i])
                        if found is None:
                            return self.whole(text)
                        if len(cache) < CACHE:
                            cache[pieces[i]] = found
                    got[i] = found
        if head == "" or re.search(r"\s", head) or any(s in head for s in self.special):
            return self.whole(text)
        first = self.ranks.encode_ordinary(head) if self.ranks else self.library.encode(head, add_special_tokens=False).ids
        return np.array(first, "<u4").tobytes() + b"".join(got)


#: White space and special strings that keep a text from being cut at its single spaces and line feeds.
_UNCUT = (r"[ \n]{2}|^[ \n]|[ \n]$|[\x{09}\x{0B}-\x{0D}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
          r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


@functools.cache
def array_ids(path: str) -> "ArrayIds":
    return ArrayIds(path)


class ArrayIds:
    """Ids of a byte-level BPE file (.json) for whole columns of texts, equal to the library's.

    As in ``BytePairs`` a text is cut at single spaces and line feeds, here by
    Arrow for all texts at once; only pieces not seen before are merged, all in
    one call.  A text with other white space, or with a special string, goes
    to the library whole.
    """

    def __init__(self, path: str):
        self.pairs = byte_pairs(path)
        self.library = self.pairs.library
        self.uncut = "|".join([_UNCUT, *(re.escape(s) for s in self.pairs.special)])
        self.bytes_of = None
        if self.pairs.ranks:  # length of each id's bytes
            values = self.pairs.ranks.token_byte_values()
            self.bytes_of = np.zeros(self.pairs.ranks.n_vocab, np.int64)
            for v in values:
                self.bytes_of[self.pairs.ranks.encode_single_token(v)] = len(v)
        self.forget()

    def forget(self) -> None:
        import pyarrow as pa

        self.slot = pa.array([], pa.large_string())  # pieces in the order of their slots
        self.table, self.used = np.zeros(1 << 16, np.uint32), 0  # ids of all slots, end to end
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def fresh(self, pieces: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, ids of each) of pieces, ``size`` bytes each, that begin with a space or line feed: one call for all."""
        if self.bytes_of is None:
            ids = self.whole(pieces)
            return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)
        ids = np.array(self.pairs.ranks.encode_ordinary("".join(pieces)), np.uint32)
        stop = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(size)) + 1
        return ids, np.diff(stop, prepend=0)

    def slots(self, column) -> np.ndarray:
        """Places in the table of distinct pieces that begin with a space or line feed; the table's size is bounded."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.slot) + len(column) > 2 * CACHE and len(self.slot):
            self.forget()
        got = pc.index_in(column, value_set=self.slot).fill_null(-1).to_numpy().astype(np.int64)
        at = np.flatnonzero(got < 0)
        if len(at):
            new = column if len(at) == len(column) else column.take(pa.array(at))
            pieces = new.to_numpy(zero_copy_only=False).tolist()
            ids, size = self.fresh(pieces, pc.binary_length(new).to_numpy().astype(np.int64))
            first, last = len(self.slot), len(self.slot) + len(new)
            while self.used + len(ids) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            while last > len(self.start):
                self.start = np.concatenate([self.start, np.zeros_like(self.start)])
                self.length = np.concatenate([self.length, np.zeros_like(self.length)])
            self.table[self.used:self.used + len(ids)] = ids
            self.start[first:last] = self.used + np.cumsum(size) - size
            self.length[first:last] = size
            self.used += len(ids)
            got[at] = np.arange(first, last)
            self.slot = pa.concat_arrays([self.slot, new])
        return got

    def __call__(self, column, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, ids of each); a null text is empty; ``end_id`` follows each text."""
        import pyarrow as pa
        import pyarrow.compute as pc

        column = column.fill_null("")
        n = len(column)
        odd = pc.match_substring_regex(column, self.uncut).to_numpy(zero_copy_only=False)
        if not odd.any():
            flat, size = self.cut(column, end_id)
            return flat, size
        plain, plain_size = self.cut(column.filter(pa.array(~odd)), end_id)
        whole = self.whole(column.filter(pa.array(odd)).to_pylist())
        tail = [] if end_id is None else [np.array([end_id], np.uint32)]
        whole = [np.concatenate([w, *tail]) for w in whole]
        size = np.zeros(n, np.int64)
        size[~odd], size[odd] = plain_size, [len(w) for w in whole]
        ends = np.concatenate(([0], np.cumsum(plain_size)))
        before = np.cumsum(~odd)
        parts, done = [], 0
        for i, w in zip(np.flatnonzero(odd), whole):
            parts += [plain[ends[done]:ends[before[i]]], w]
            done = before[i]
        return np.concatenate([*parts, plain[ends[done]:]]), size

    def cut(self, column, end_id: int | None):
        import pyarrow as pa
        import pyarrow.compute as pc

        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        n = len(column)
        words = pc.split_pattern(pc.replace_substring(column.cast(pa.large_string()), "\n", " \n"), " ")
        offsets = words.offsets.to_numpy() - words.offsets[0].as_py() if n else np.zeros(1, np.int64)
        flat = words.flatten()
        named = flat.dictionary_encode()
        own_table = []
        if n:
            none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
            before = pc.if_else(pc.starts_with(named.dictionary, "\n"), none, space)
            code = self.slots(pc.binary_join_element_wise(before, named.dictionary, none))[named.indices.to_numpy()]
            # the first piece of a text has no space before it: worked out anew, after the table's end
            heads = flat.take(pa.array(offsets[:-1])).dictionary_encode()
            ranks = self.pairs.ranks
            own_table = [np.array(ranks.encode_ordinary(h) if ranks else
                                  self.library.encode(h, add_special_tokens=False).ids, np.uint32)
                         for h in heads.dictionary.to_pylist()]
            code[offsets[:-1]] = len(self.slot) + heads.indices.to_numpy()
        else:
            code = np.zeros(0, np.int64)
        if end_id is not None:
            code = np.insert(code, offsets[1:], len(self.slot) + len(own_table))
            offsets = offsets + np.arange(n + 1)
            own_table.append(np.array([end_id], np.uint32))
        # slots lie end to end in the table, so they are a binary column, and a take copies each piece's ids at once
        own_length = np.array([len(x) for x in own_table], np.int64)
        bounds = np.concatenate([self.start[:len(self.slot)], [self.used], self.used + np.cumsum(own_length)]) * 4
        table = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [
            None, pa.py_buffer(bounds), pa.py_buffer(np.concatenate([self.table[:self.used], *own_table]))])
        _, ends, flat = table.take(pa.array(code)).buffers()
        ends = np.frombuffer(ends, np.int64, len(code) + 1) >> 2
        return np.frombuffer(flat, np.uint32, int(ends[-1])), ends[offsets[1:]] - ends[offsets[:-1]]
