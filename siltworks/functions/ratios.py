"""Ratios of matching blocks of many pairs of texts at once.

The ratio is that of ``difflib.SequenceMatcher(None, a, b).ratio()``, character by character, with its
skipping of popular characters. The places where a and b share a character that is not popular
are found once for each pair; then the longest matching blocks of all pairs and of all stretches left and
right of them are taken in rounds, one numpy call for all of them. In texts b under 200 characters
nothing is popular and shared places are many: there only shared pairs of characters are looked up, and a
stretch without one holds blocks of single characters, which one walk through it takes in their order.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np

ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789 "
#: About how many shared places are held at once, and pairs whose tables of characters are. A pair that has more places by itself
#: than the third number, or a text longer than the fourth, goes to difflib, which is slower and holds less.
PLACES, PAIRS, MOST_PLACES, LONGEST, _BITS = 100_000, 10_000, 2_000_000, 10_000, 20
#: Texts from this length on have popular characters.
_LONG, _N = 200, len(ALPHABET)


def _equal(x: np.ndarray) -> np.ndarray:
    """How many of the lower bytes of 8-byte words are 0."""
    low = (x & (~x + np.uint64(1))).astype(np.float64)
    return np.where(x == 0, 8, ((low.view(np.int64) >> 52) - 1023) >> 3)


class Texts:
    """Texts over ``ALPHABET``, laid out for comparing."""

    def __init__(self, texts: list[str]):
        self.texts, self.size = texts, np.asarray([len(t) for t in texts], np.int64)
        laid = np.where(self.size > LONGEST, 0, self.size)
        code = np.zeros(128, np.uint8)
        code[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(_N)
        coded = lambda t: code[np.frombuffer(t.encode("ascii"), np.uint8)]
        chars = coded("".join(t for t in texts if len(t) <= LONGEST))
        self.start = np.cumsum(laid) - laid
        # words of the next and of the last 8 characters from each place on, the place itself first
        n, wide = len(chars), np.concatenate([np.zeros(8, np.uint8), chars, np.zeros(8, np.uint8)]).astype(np.uint64)
        self.onward, self.back = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        for k in range(8):
            self.onward |= wide[8 + k : 9 + k + n] << np.uint64(8 * k)
            self.back |= wide[8 - k : 9 - k + n] << np.uint64(8 * k)
        owner = np.repeat(np.arange(len(texts)), laid)
        cell = owner * _N + chars
        self.hist = np.bincount(cell, minlength=len(texts) * _N).reshape(-1, _N).astype(np.int32)
        self.places = np.argsort(cell, kind="stable") - np.repeat(self.start, laid)
        self.first = (np.cumsum(self.hist.ravel()) - self.hist.ravel()).reshape(self.hist.shape)
        for k in np.flatnonzero(self.size > LONGEST):
            self.hist[k] = np.bincount(coded(texts[k]), minlength=_N)
        self.rare = np.where((self.size[:, None] >= _LONG) & (self.hist > self.size[:, None] // 100 + 1), 0, self.hist)
        # how many places in a row hold characters that are not popular, up to each place
        popular = self.rare.ravel()[cell] == 0
        at = np.arange(n)
        last = np.maximum.accumulate(np.where(popular, at, -1)) if n else at
        inside = at - np.repeat(self.start, laid)
        self.run = np.minimum(at - last, inside + 1)
        self.chars = chars
        # of short texts: the next place of each character, and the places of each pair of characters, told by its second
        short = self.size < _LONG
        self.nth_short, many = np.cumsum(short) - 1, int(short.sum())
        self.next = np.full((_LONG + 1, many, _N), _LONG, np.int16)
        place, row, col = inside[short[owner]], self.nth_short[owner[short[owner]]], chars[short[owner]]
        order = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[order], np.arange(_LONG + 1))
        for p in range(_LONG - 1, -1, -1):
            self.next[p] = self.next[p + 1]
            these = order[bounds[p] : bounds[p + 1]]
            self.next[p, row[these], col[these]] = p
        self.two = np.where(inside > 0, np.concatenate([[0], chars[:-1]]) * np.int64(_N) + chars, -1) if n else at
        ends = np.flatnonzero(short[owner] & (inside > 0))
        cell = self.nth_short[owner[ends]] * _N * _N + self.two[ends]
        self.twos = np.bincount(cell, minlength=many * _N * _N)
        self.first_two = np.cumsum(self.twos) - self.twos
        self.two_places = inside[ends[np.argsort(cell, kind="stable")]]

    def bound(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What the ratios of texts a to texts b cannot exceed, in any order, by their characters."""
        total = self.size[a] + self.size[b]
        return np.where(total == 0, 1.0, 2.0 * np.minimum(self.hist[a], self.hist[b]).sum(1) / np.maximum(total, 1))

    def _alike(self, words: np.ndarray, p: np.ndarray, q: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """Equal characters from places p and q on, in steps of 1 or -1, at most so many."""
        got = np.zeros(len(p), np.int64)
        open_ = np.flatnonzero(most > 0)
        while len(open_):
            at = step * got[open_]
            new = _equal(words[p[open_] + at] ^ words[q[open_] + at])
            got[open_] += new
            open_ = open_[(new == 8) & (got[open_] < most[open_])]
        return np.minimum(got, np.maximum(most, 0))

    def ratios(self, a: np.ndarray, b: np.ndarray, least: float = 0.0) -> np.ndarray:
        """Ratio of each text a to its text b; -1 where it is below ``least``."""
        a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
        out = np.full(len(a), -1.0)
        # a slice of pairs at a time, so that the tables of characters stay small too
        for k in range(0, len(a), PAIRS):
            x, y = a[k : k + PAIRS], b[k : k + PAIRS]
            places = (self.hist[x].astype(np.int64) * self.rare[y]).sum(1)
            apart = (places > MOST_PLACES) | (np.maximum(self.size[x], self.size[y]) > LONGEST)
            for p in np.flatnonzero(apart):
                r = SequenceMatcher(None, self.texts[x[p]], self.texts[y[p]]).ratio()
                out[k + p] = r if r >= least else -1.0
            short = self.size[y] < _LONG
            for whole in (False, True):
                some = np.flatnonzero(~apart & (short == whole))
                # of the places of characters in short texts, about one in eight is that of a pair
                cuts = np.flatnonzero(np.diff(np.cumsum((places[some] // 8 if whole else places[some]) + 1) // PLACES)) + 1
                for part in np.split(some, cuts):
                    if len(part):
                        out[k + part] = self._some(x[part], y[part], least, whole)
        return out

    def _shared(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, i, j) of all places of characters that a and b share and that are not popular."""
        na, nb = self.hist[a], self.rare[b]
        pair, char = np.nonzero(na * nb)
        kb = nb[pair, char]
        each = na[pair, char] * kb
        item = np.repeat(np.arange(len(each)), each)
        nth = np.arange(len(item)) - np.repeat(np.cumsum(each) - each, each)
        wide = kb[item]
        return pair[item], self.places[self.first[a[pair], char][item] + nth // wide], self.places[self.first[b[pair], char][item] + nth % wide]

    def _shared_twos(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, i, j) of the second places of all pairs of characters that a and short texts b share."""
        most = np.maximum(self.size[a] - 1, 0)
        pair = np.repeat(np.arange(len(a)), most)
        i = np.arange(len(pair)) - np.repeat(np.cumsum(most) - most, most) + 1
        cell = self.nth_short[b][pair] * (_N * _N) + self.two[self.start[a][pair] + i]
        each = self.twos[cell]
        item = np.repeat(np.arange(len(each)), each)
        nth = np.arange(len(item)) - np.repeat(np.cumsum(each) - each, each)
        return pair[item], i[item], self.two_places[self.first_two[cell[item]] + nth]

    def _singles(self, pa: np.ndarray, ends: np.ndarray, row: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> np.ndarray:
        """Blocks of one character in stretches that share no two in a row: from places pa to ends, in short texts' rows from blo to bhi."""
        got, pa, blo = np.zeros(len(pa), np.int64), pa.copy(), blo.copy()
        open_ = np.arange(len(pa))
        while len(open_ := open_[(pa[open_] < ends[open_]) & (blo[open_] < bhi[open_])]):
            at = self.next[blo[open_], row[open_], self.chars[pa[open_]]]
            hit = at < bhi[open_]
            got[open_] += hit
            blo[open_] = np.where(hit, at + 1, blo[open_])
            pa[open_] += 1
        return got

    def _some(self, a: np.ndarray, b: np.ndarray, least: float, whole: bool) -> np.ndarray:
        total, matched = self.size[a] + self.size[b], np.zeros(len(a), np.int64)
        of, i, j = self._shared_twos(a, b) if whole else self._shared(a, b)
        p, q = self.start[a][of] + i, self.start[b][of] + j
        k = np.minimum(self._alike(self.back, p, q, np.minimum(np.minimum(i, j) + 1, self.run[q]), -1), self.run[q])
        # stretches (pair, alo, ahi, blo, bhi) in which blocks are still sought; of says the stretch of each place, in order
        who, alo, ahi, blo, bhi = np.arange(len(a)), np.zeros(len(a), np.int64), self.size[a], np.zeros(len(a), np.int64), self.size[b]
        low = (1 << _BITS) - 1
        gone = np.zeros(len(a), bool)
        while len(who):
            n = np.bincount(of, minlength=len(who))
            full = n > 0
            bi, bj, size = alo.copy(), blo.copy(), np.zeros(len(who), np.int64)
            if len(of):
                # the longest block, of these the one that ends first in a, then in b
                clipped = np.minimum(k, np.minimum(i - alo[of], j - blo[of]) + 1)
                key = (clipped << (2 * _BITS)) | ((low - i) << _BITS) | (low - j)
                best = np.maximum.reduceat(key, (np.cumsum(n) - n)[full])
                size[full] = best >> (2 * _BITS)
                full &= size > whole
                best = best[size[np.flatnonzero(n)] > whole]
                size[~full] = 0
                bi[full] = low - ((best >> _BITS) & low) - size[full] + 1
                bj[full] = low - (best & low) - size[full] + 1
            sa, sb = self.start[a[who]], self.start[b[who]]
            ei, ej = bi + size, bj + size
            if whole:
                rest = np.flatnonzero(~full)
                size[rest] = self._singles((sa + alo)[rest], (sa + ahi)[rest], self.nth_short[b[who[rest]]], blo[rest], bhi[rest])
            else:
                before = self._alike(self.back, sa + bi - 1, sb + bj - 1, np.minimum(bi - alo, bj - blo), -1)
                after = self._alike(self.onward, sa + ei, sb + ej, np.minimum(ahi - ei, bhi - ej), 1)
                bi, bj, ei, ej, size = bi - before, bj - before, ei + after, ej + after, size + before + after
            matched += np.bincount(who, size, len(a)).astype(np.int64)
            # without a shared place there is nothing right of what a stretch begins with
            left, right = full & (bi > alo) & (bj > blo), full & (ei < ahi) & (ej < bhi)
            rest = np.bincount(who, left * np.minimum(bi - alo, bj - blo) + right * np.minimum(ahi - ei, bhi - ej), len(a))
            gone |= 2.0 * (matched + rest) < least * total - 1e-6
            left &= ~gone[who]
            right &= ~gone[who]
            to_left, to_right = np.cumsum(left) - 1, np.cumsum(right) - 1 + left.sum()
            is_left = left[of] & (i < bi[of]) & (j < bj[of])
            is_right = right[of] & (i >= ei[of]) & (j >= ej[of])
            i, j, k, of = (np.concatenate([v[is_left], w[is_right]]) for v, w in ((i, i), (j, j), (k, k), (to_left[of], to_right[of])))
            who, alo, ahi, blo, bhi = (np.concatenate([v[left], w[right]]) for v, w in ((who, who), (alo, ei), (bi, ahi), (blo, ej), (bj, bhi)))
        ratio = np.where(total == 0, 1.0, 2.0 * matched / np.maximum(total, 1))
        return np.where(gone | (ratio < least), -1.0, ratio)
