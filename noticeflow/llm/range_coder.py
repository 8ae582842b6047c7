"""Adaptive context-mixing range coder for token ids, many blocks side by side.

A segment's ids are cut into blocks that are coded independently: every block
starts from the same model and has its own coder, words and checksum.  All
blocks of a segment advance together, one id a step, as numpy lanes.

Three orders predict the next id.  Orders 2 and 1 name the id that last
followed their context in the block, with a count of how often it held; order
0 knows how frequent each id is in the segment (its header lists the ids by
falling count).  The guess is order 2's, or order 1's where that has none.
Whether the guess comes is a bit: each order estimates it adaptively from its
own context (order 2 by its count, order 1 by its count and whether it agrees,
order 0 by how frequent the guess is), and a logistic mix with weights learned
online gives the probability.  An id that was not foreseen is coded by its
order-0 frequency.

The coder keeps 64-bit ``low`` and ``span`` and puts out 16-bit words; it has
no carry (a span that grows too small across a word border is cut at it).
All arithmetic is on integers, so any machine decodes what another encoded.
"""

from __future__ import annotations

import math

import numpy as np

BLOCK = 1024
#: Blocks are shorter in a small segment, so that at least this many advance together.
LANES = 2048
SHORTEST = 64

_TOP = np.uint64(1 << 48)
_SMALL = np.uint64(1 << 32)
_ONE, _U12, _U16, _U32, _U48 = (np.uint64(x) for x in (1, 12, 16, 32, 48))
_U32_MOST = np.uint64((1 << 32) - 1)
_MIX_ONE, _MIX_TWO = np.int32(40503), np.int32(24593)
_SLOTS = 512  # context slots of each order in a block
_MOST = 15  # largest count of a context slot


def _stretch_table() -> np.ndarray:
    p = [(i + 0.5) / 4096 for i in range(4096)]
    return np.array([max(-2047, min(2047, round(256 * math.log(x / (1 - x))))) for x in p], np.int32)


def _squash_table() -> np.ndarray:
    return np.array([max(1, min(4095, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-2047, 2048)], np.uint64)


STRETCH, SQUASH = _stretch_table(), _squash_table()


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Shares of a power of two, at least one each, for counts in falling order."""
    total = 1 << max(16, len(counts).bit_length() + 2)
    share = 1 + (counts.astype(np.int64) * (total - len(counts))) // max(1, int(counts.sum()))
    share[0] += total - share.sum()
    return share


class _Lanes:
    """Model and coder of all blocks of a segment; ``words`` is None when encoding."""

    def __init__(self, lanes: int, share: np.ndarray, words: np.ndarray | None = None, starts: np.ndarray | None = None):
        self.n = lanes
        self.low = np.zeros(lanes, np.uint64)
        self.span = np.full(lanes, (1 << 64) - 1, np.uint64)
        self.total = int(share.sum())
        self.bits = np.uint64(self.total.bit_length() - 1)
        # where each rank's share starts, and the share: the halves of one number
        self.shares = ((np.cumsum(share) - share).astype(np.uint64) << _U32) | share.astype(np.uint64)
        self.words = words
        if words is None:
            self.room, self.most = 64, 0  # words of a lane that there is room for, and that it may have by now
            self.out = np.zeros(lanes * self.room, np.uint16)
            self.used = np.arange(lanes) * self.room  # place of each lane's next word
        else:
            self.rank_at = np.repeat(np.arange(len(share), dtype=np.int32), share)
            self.at = starts.copy()
            self.code = np.zeros(lanes, np.uint64)
            for _ in range(4):
                self.code = (self.code << _U16) | words[self.at].astype(np.uint64)
                self.at += 1
        # the log of an id's rank, in 32 kinds: order 0's context
        self.kind = np.minimum(np.log2(np.arange(1, len(share) + 1)).astype(np.int8), 31)
        # one context of all lanes lies together: the frequent ones stay in the processor's cache
        # orders 1 and 2: a slot holds rank << 4 | count
        self.slots = np.zeros(2 * _SLOTS * lanes, np.int32)
        self.slot_base = np.arange(2)[:, None] * (_SLOTS * lanes) + np.arange(lanes)
        # orders 0, 1 and 2: 16-bit probabilities that the guess comes, by context
        self.odds = np.full(3 * 32 * lanes, 1 << 14, np.int32)
        self.odds_base = np.arange(3)[:, None] * (32 * lanes) + np.arange(lanes)
        self.weight = np.full((3, lanes), 26000, np.int32)

    def settle(self, n: int) -> None:
        """Puts out (or takes in) words until all spans are wide enough."""
        low, span = self.low[:n], self.span[:n]
        end = low + span
        end ^= low
        j = np.flatnonzero((end < _TOP) | (span < _SMALL))
        while len(j):
            low, span = self.low.take(j, mode="clip"), self.span.take(j, mode="clip")
            done = ((low + span) ^ low) < _TOP
            if not done.all():
                span = np.where(done, span, (~low + _ONE) & (_SMALL - _ONE))
            if self.words is None:
                self.most += 1
                if self.most > self.room:
                    self.widen()
                at = self.used.take(j, mode="clip")
                self.out[at] = (low >> _U48).astype(np.uint16)
                at += 1
                self.used[j] = at
            else:
                at = self.at.take(j, mode="clip")
                code = self.code.take(j, mode="clip")
                code <<= _U16
                code |= self.words.take(at, mode="clip")
                self.code[j] = code
                at += 1
                self.at[j] = at
            low <<= _U16
            span <<= _U16
            self.low[j], self.span[j] = low, span
            again = np.flatnonzero(span < _TOP)  # no other span can be too small by now
            if not len(again):
                return
            j, low, span = j.take(again), low.take(again), span.take(again)
            j = j[((low ^ (low + span)) < _TOP) | (span < _SMALL)]

    def widen(self) -> None:
        """Counts each lane's words and makes room for one more at least."""
        count = self.used - np.arange(self.n) * self.room
        self.most = int(count.max()) + 1
        if self.most > self.room:
            rows = self.out.reshape(self.n, self.room)
            self.out = np.concatenate([rows, np.zeros_like(rows)], axis=1).reshape(-1)
            self.room *= 2
            self.used = count + np.arange(self.n) * self.room

    def step(self, n: int, one: np.ndarray, two: np.ndarray, rank: np.ndarray | None) -> np.ndarray:
        """One id in each of the first ``n`` lanes; ``one``, ``two``: the last rank plus 1 and the one before."""
        at = np.empty((2, n), np.int64)
        at[0] = one & (_SLOTS - 1)
        mingled = one * _MIX_ONE  # 32 bits are enough: the bits taken are low ones
        mingled += two * _MIX_TWO
        mingled >>= 5
        mingled &= _SLOTS - 1
        at[1] = mingled
        at *= self.n
        at += self.slot_base[:, :n]
        slot = self.slots.take(at, mode="clip")  # nothing to clip: the mode that needs no copy
        count = slot & 15
        named = slot >> 4
        guess = named[1] - named[0]
        guess *= count[1] > 0
        guess += named[0]
        cell = np.empty((3, n), np.int64)
        cell[0] = self.kind.take(guess, mode="clip")
        cell[1] = named[0] == guess
        cell[1] <<= 4
        cell[1] += count[0]
        cell[2] = count[1]
        cell *= self.n
        cell += self.odds_base[:, :n]
        odds = self.odds.take(cell, mode="clip")
        say = STRETCH.take(odds >> 4, mode="clip")
        weight = self.weight[:, :n]
        dot = weight * say
        dot = dot[0] + dot[1] + dot[2]
        dot >>= 16
        dot += 2047
        mixed = SQUASH.take(dot, mode="clip")  # the mode keeps what lies outside at the table's ends
        low, span = self.low[:n], self.span[:n]
        part = (span >> _U12) * mixed
        hit = (rank == guess) if rank is not None else (self.code[:n] - low) < part
        goal = hit.astype(np.int32)
        error = (goal << 12) - mixed.astype(np.int32)
        goal *= 65535
        say *= error
        say += 8192
        say >>= 14
        weight += say
        goal = goal - odds
        goal >>= 4
        odds += goal
        self.odds[cell] = odds
        missed = hit.astype(np.uint64) - _ONE  # all bits where the guess did not come, else none
        span -= part
        span &= missed
        low += part & missed
        span |= part & ~missed
        if self.bits > 18:  # a long share needs a whole span
            self.settle(n)
        unit = span >> self.bits
        if rank is not None:
            found = rank
        else:
            value = (self.code[:n] - low) // unit
            found = self.rank_at.take(value.view(np.int64), mode="clip")
            found -= guess
            found *= ~hit
            found += guess
        share = self.shares.take(found, mode="clip")
        start = share >> _U32
        share &= _U32_MOST
        start *= unit
        start &= missed
        low += start
        share *= unit
        share ^= span
        share &= missed
        span ^= share
        self.settle(n)
        # the same id counts on, another begins anew; an empty slot reads as id 0, never seen
        slot += count < _MOST
        slot -= (new := (found << 4) + 1)
        slot *= named == found
        slot += new
        self.slots[at] = slot
        return found

    def run(self, ids: np.ndarray | None, length: int, block: int) -> np.ndarray:
        """Codes ``length`` ranks; lane i holds block i, only the last may be shorter."""
        table = np.zeros((block, self.n), np.int32)
        if ids is not None:
            full = np.zeros(self.n * block, np.int32)
            full[:length] = ids
            table[:] = full.reshape(self.n, block).T
            del full
        short = length - (self.n - 1) * block
        one = two = np.zeros(self.n, np.int32)
        for t in range(block):
            n = self.n if t < short else self.n - 1
            if not n:
                break
            got = self.step(n, one[:n], two[:n], table[t, :n] if ids is not None else None)
            if ids is None:
                table[t, :n] = got
            one, two = got + 1, one
        return table.T.reshape(-1)[:length]

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """(all words, lane after lane; words of each lane)."""
        tail = np.stack([(self.low >> np.uint64(48 - 16 * k)).astype(np.uint16) for k in range(4)], axis=1)
        used = self.used - np.arange(self.n) * self.room
        sizes = used + 4
        rows = self.out.reshape(self.n, self.room)
        out = [w for i in range(self.n) for w in (rows[i, :used[i]], tail[i])]
        return np.concatenate(out), sizes


def block_length(n: int, block: int = BLOCK) -> int:
    return int(min(block, max(SHORTEST, -(-n // LANES))))


def encode(ids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(the segment's ids by falling count; their counts; words of all blocks; words of each block); ids: not empty."""
    top = int(ids.max())
    if top < 1 << 22:
        count = np.bincount(ids, minlength=top + 1)
        symbols = np.flatnonzero(count)
        count = count[symbols]
    else:
        symbols, count = np.unique(ids, return_counts=True)
    order = np.lexsort((symbols, -count))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    if top < 1 << 22:
        at = np.zeros(top + 1, np.int32)
        at[symbols] = rank
        ranks = at[ids]
    else:
        ranks = rank[np.searchsorted(symbols, ids)]
    lanes = _Lanes(-(-len(ids) // block), frequencies(count[order]))
    lanes.run(ranks, len(ids), block)
    words, sizes = lanes.finish()
    return symbols[order], count[order], words, sizes


def decode(symbols: np.ndarray, count: np.ndarray, words: np.ndarray, sizes: np.ndarray, length: int,
           block: int) -> np.ndarray:
    """Ids of consecutive blocks of a segment (``sizes`` words each, only the last block may be short)."""
    starts = (np.cumsum(sizes) - sizes).astype(np.int64)
    padded = np.append(words, np.zeros(8, words.dtype))
    lanes = _Lanes(len(sizes), frequencies(count), padded, starts)
    return symbols[lanes.run(None, length, block)]
