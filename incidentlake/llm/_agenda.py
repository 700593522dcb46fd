"""The merge agenda of ``piece_codec`` for many parts of words at once.

A row is a part of a word, a column one of its symbols. Each step takes the next
candidate of every row: the adjacent pair of least rank, leftmost among equals.
It is merged, or closed if its number is among the row's skips.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np

BLOCK_SYMBOLS = 1 << 16  # rows times columns of a step


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one range after the other."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


class Pairs:
    """Numbers of pairs of symbols. A pair stands at its left symbol's base plus
    its right symbol, where no other pair does: a look-up reads one place."""

    def __init__(self, left: np.ndarray, right: np.ndarray, symbols: int):
        self.none = np.int32(len(left))  # the number of a pair that is not there
        self.base = np.ones(symbols + 1, np.int32)  # the last is for the symbol -1
        self.holder = np.full(1 << max(16 * len(left), 2 * symbols, 16).bit_length(), -2, np.int32)
        self.number = np.full(len(self.holder), self.none, np.int32)
        order = np.argsort(left, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(left[order])) + 1) if len(order) else []
        draw = np.random.default_rng(0)
        for group in sorted(groups, key=len, reverse=True):
            base, tries = 1, 0
            while (self.holder[base + right[group]] != -2).any():
                tries += 1
                if tries % 1000 == 0:
                    self.number = np.append(self.number, np.full(len(self.number), self.none))
                    self.holder = np.append(self.holder, np.full(len(self.holder), np.int32(-2)))
                base = int(draw.integers(1, len(self.holder) - symbols))
            self.base[left[group[0]]] = base
            self.holder[base + right[group]] = left[group]
            self.number[base + right[group]] = group

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of each pair; -1 stands for no symbol and is in none."""
        at = self.base[left] + right
        return np.where(self.holder[at] == left, self.number[at], self.none)


class Agenda:
    """Merges of the pieces of a model: ``rank`` gives each piece its level (the
    order of merging) and its id."""

    def __init__(self, rank: Mapping[str, tuple[int, int]]):
        # characters that are no piece are symbols too, as parts of pieces
        chars = sorted({c for piece in rank for c in piece}.difference(rank))
        self.symbol = {s: k for k, s in enumerate([*rank, *chars])}
        self.piece_id = np.array([rank[s][1] if s in rank else -1 for s in self.symbol], np.int32)
        level = np.array([rank[s][0] if s in rank else -1 for s in self.symbol], np.int32)
        self.none = np.int32(len(rank))
        found = [(self.symbol[p[:i]], self.symbol[p[i:]], self.symbol[p]) for p in rank for i in range(1, len(p)) if p[:i] in self.symbol and p[i:] in self.symbol]
        left, right, self.made = np.array(found, np.int32).reshape(-1, 3).T.copy()
        self.pairs = Pairs(left, right, len(self.symbol))
        self.level = np.append(level[self.made], self.none)
        self.char = np.full(0x110000, -1, np.int32)
        for s, k in self.symbol.items():
            if len(s) == 1:
                self.char[ord(s)] = k

    def segment(self, code: np.ndarray, start: np.ndarray, size: np.ndarray, skips: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the parts of ``code`` (code points) with these starts and sizes, the
        ids of all their pieces, for each part where in them its own start and how
        many they are, and how many candidates were taken (-1 for a part with a
        character that is in no piece); bit k of ``skips`` skips the candidate k."""
        at, count, taken = (np.zeros(len(start), np.int64) for _ in range(3))
        order = np.argsort(size, kind="stable")
        every, before, a = [np.zeros(0, np.int32)], 0, 0
        while a < len(order):
            b = a + max(1, BLOCK_SYMBOLS // max(1, int(size[order[a]])))
            while b > a + 1 and (min(b, len(order)) - a) * int(size[order[min(b, len(order)) - 1]]) > 2 * BLOCK_SYMBOLS:
                b = a + (b - a + 1) // 2
            rows = order[a:b]
            a += len(rows)
            ids, count[rows], taken[rows] = self._block(code, start[rows], size[rows], skips[rows])
            at[rows] = before + np.cumsum(count[rows]) - count[rows]
            every.append(ids)
            before += len(ids)
        return np.concatenate(every), at, count, taken

    def _block(self, code: np.ndarray, start: np.ndarray, size: np.ndarray, skips: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, width = len(start), int(size.max()) + 1  # the last column has no symbol
        column = np.arange(width, dtype=np.int32)
        inside = column < size[:, None]
        symbol = np.full((n, width), -1, np.int32)
        symbol[inside] = self.char[code[ranges(start, size)]]
        unknown = ((symbol < 0) & inside).any(axis=1)
        after = np.where(column + 1 < size[:, None], column + 1, width - 1).astype(np.int32)
        before = np.broadcast_to(column - 1, (n, width)).copy()
        place = np.full((n, width), self.pairs.none, np.int32)
        place[:, :-1] = self.pairs.find(symbol[:, :-1], symbol[:, 1:])
        rank = self.level[place]
        taken = np.zeros(n, np.int64)
        alive = inside.copy()
        # the same arrays, flat: a cell's number is its row's first one and its column
        symbol_, after_, before_, place_, rank_, alive_ = (x.reshape(-1) for x in (symbol, after, before, place, rank, alive))
        open_ = np.flatnonzero(~unknown)
        while len(open_):
            base = open_ * width
            at = base + rank[open_].argmin(axis=1)
            going = rank_[at] < self.none
            open_, base, at = open_[going], base[going], at[going]
            number = taken[open_]
            skipped = (skips[open_] >> number.astype(np.uint64)) & np.uint64(1) == 1
            taken[open_] = number + 1
            rank_[at[skipped]] = self.none
            at, base = at[~skipped], base[~skipped]
            gone = base + after_[at]
            made = self.made[place_[at]]
            following = after_[gone]
            symbol_[at], symbol_[gone], alive_[gone], rank_[gone] = made, -1, False, self.none
            after_[at] = following
            more = following < width - 1
            before_[(base + following)[more]] = (at - base)[more]
            place_[at] = found = self.pairs.find(made, symbol_[base + following])
            rank_[at] = self.level[found]
            former = before_[at]
            left = former >= 0
            cell = (base + former)[left]
            place_[cell] = found = self.pairs.find(symbol_[cell], made[left])
            rank_[cell] = self.level[found]
        ids = self.piece_id[symbol]
        unknown |= ((ids < 0) & alive).any(axis=1)  # a character that is only a part of pieces
        taken[unknown] = -1
        return ids[alive], alive.sum(axis=1), taken
