"""Token counts with a whole-token shortcut.

Offline proof: every vocabulary string is given to the library by itself; the
strings that come back as exactly one token are known to be one wherever they
stand as a pre-token, because merges never leave a pre-token.  Counting then
needs the pre-tokens only: those in the proven set count one, all others are
merged by the library, once per task and distinct string.  Texts with
characters outside a plain range, or with special strings in them, go to the
library whole.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .tokens import CACHE, tokenizer

#: White space and letters on which the library's and Python's rules are known to agree.
PLAIN = re.compile("[\\x00-\\x08\\x0e-\\x1f\\x7f-\\xbf\\xd7\\xf7İ-ıŉſ-\U0010ffff]")


@functools.cache
def whole_tokens(path: str) -> frozenset[str]:
    """Strings that the library encodes alone as one token (found by trying every vocabulary string)."""
    lib = tokenizer(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    suffix = spec["model"].get("end_of_word_suffix") or ""
    back = {c: b for b, c in byte_alphabet().items()}
    strings = []
    for token in spec["model"]["vocab"]:
        if suffix and token.endswith(suffix):
            token = token[:-len(suffix)]
            if token and all(c in back for c in token):
                raw = bytes(back[c] for c in token)
                try:
                    strings.append(raw.decode())
                except UnicodeDecodeError:
                    pass  # part of a character: never a pre-token
    found = lib.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, found) if len(e.ids) == 1)


def byte_alphabet() -> dict[int, str]:
    """The usual printable stand-ins of byte-level vocabularies: printable Latin-1 as is, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Counter:
    """Counts tokens of a word-level BPE file whose normalizer drops white space and lower-cases."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))
        self.one = whole_tokens(path)
        self.words: dict[str, int] = {}   # merged pre-tokens
        self.chunks: dict[str, int] = {}  # what stands between white space

    def merged(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            n = len(self.library.encode(word, add_special_tokens=False).ids)
            if len(self.words) < CACHE:
                self.words[word] = n
        return n

    def chunk(self, chunk: str) -> int:
        n = 0
        for word in self.pattern.findall(chunk.lower()):
            n += 1 if word in self.one else self.merged(word)
        if len(self.chunks) < CACHE:
            self.chunks[chunk] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if PLAIN.search(text) or any(s in text for s in self.special):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        parts = text.split()
        got = list(map(self.chunks.get, parts))
        if None in got:
            known = self.chunks
            for i, n in enumerate(got):
                if n is None:
                    n = known.get(parts[i])
                    got[i] = self.chunk(parts[i]) if n is None else n
        return sum(got)


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            n = np.fromiter((c.count(t.as_py() or "") for t in batch.column(1)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n)],
                                             ["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row; a null text is empty.

    Repeated rows and null ids are rows like any others; empty input gives an
    empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return map_arrow(rows, _counts(path), f"doc_id {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
