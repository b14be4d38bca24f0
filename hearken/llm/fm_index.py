"""A compressed FM-index over word sequences: backward search over a wavelet matrix, many queries side by side."""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)


class Bits:
    """A bit vector of packed words, with counts before each 512 bits, and from there before each word: 1.31 bits a bit."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 512 + 1) * 512, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        before = np.cumsum(counts) - counts
        self.far = before[::8].astype(np.uint32)
        self.near = (before - np.repeat(before[::8], 8)).astype(np.uint16)
        self.zeros = len(bits) - int(counts.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        within = np.bitwise_count(self.words[word] & ((ONE << (at & 63).astype(np.uint64)) - ONE))
        return self.far[word >> 3].astype(np.int64) + self.near[word] + within


class Least:
    """Least values of ranges: whole blocks by a table of doubling steps over blocks, the ends by running minima."""

    def __init__(self, values: np.ndarray, bits: int = 5):
        self.bits, size = bits, 1 << bits
        blocks = len(values) // size + 1
        padded = np.full(blocks * size, np.iinfo(values.dtype).max, values.dtype)
        padded[: len(values)] = values
        grid = padded.reshape(blocks, size)
        self.values = padded
        self.before = np.minimum.accumulate(grid, axis=1).reshape(-1)
        self.after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.steps, step = [grid.min(axis=1)], 1
        while step * 2 <= blocks:
            last = self.steps[-1]
            self.steps.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of the values from low to high - 1 (of non-empty ranges)."""
        first, last = low >> self.bits, high - 1 >> self.bits
        out = np.minimum(self.after[low], self.before[high - 1])
        inner = np.flatnonzero(last - first > 1)
        if len(inner):
            a, n = first[inner] + 1, (last - first)[inner] - 1
            k = np.frexp(n.astype(float))[1] - 1
            for level in np.unique(k).tolist():
                at = np.flatnonzero(k == level)
                table = self.steps[level]
                own = inner[at]
                out[own] = np.minimum(out[own], np.minimum(table[a[at]], table[a[at] + n[at] - (1 << level)]))
        same = np.flatnonzero(first == last)
        if len(same):
            place = low[same, None] + np.arange(1 << self.bits)
            inside = place < high[same, None]
            found = self.values.take(place, mode="clip")
            out[same] = np.where(inside, found, np.iinfo(found.dtype).max).min(axis=1)
        return out


class FMIndex:
    """Of sequences of symbols (64-bit words), each owned by a document number. Rows are sorted by their first `depth`
    words at least, so patterns of up to `depth` words are found."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray, depth: int):
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences)) + 1
        self.alphabet, inverse = np.unique(np.concatenate(sequences), return_inverse=True)
        n = int(sizes.sum())
        text = np.zeros(n, np.int64)  # 0 ends each sequence
        inside = np.ones(n, bool)
        inside[np.cumsum(sizes) - 1] = False
        text[inside] = inverse + 1
        self.n = n
        ranks, order, have = [text], None, 1
        while have < depth or order is None:
            following = np.zeros(n, np.int64)
            following[:-have] = ranks[-1][have:] + 1
            key = ranks[-1] * (n + len(self.alphabet) + 2) + following
            order = np.argsort(key)
            ordered = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            ranks.append(new)
            have *= 2
        lcp = np.zeros(n + 1, np.int64)
        left, right, shared = order[:-1], order[1:], np.zeros(n - 1, np.int64)
        for k in range(len(ranks) - 2, -1, -1):
            a, b = np.minimum(left + shared, n - 1), np.minimum(right + shared, n - 1)
            shared += np.where((ranks[k][a] == ranks[k][b]) & (left + shared < n) & (right + shared < n), 1 << k, 0)
        lcp[1:n] = shared
        lcp = np.minimum(lcp, depth).astype(np.uint8 if depth < 256 else np.int64)  # patterns never grow past `depth`
        bwt = text[order - 1]
        self.levels = max(1, int(len(self.alphabet)).bit_length())
        self.wavelet, row = [], bwt
        for level in range(self.levels - 1, -1, -1):
            bit = (row >> level & 1).astype(np.uint8)
            self.wavelet.append(Bits(bit))
            row = np.concatenate((row[bit == 0], row[bit == 1]))
        symbols = np.arange(len(self.alphabet) + 1)
        self.shift = np.searchsorted(np.sort(text), symbols) - self._descend(np.zeros(len(symbols), np.int64), symbols)
        owner = np.repeat(owners, sizes)[order].astype(np.int32)
        self.least = Least(owner)
        self.low = [lcp]
        step = 1
        while step * 2 <= n:
            self.low.append(np.minimum(self.low[-1][:-step], self.low[-1][step:]))
            step *= 2
        self.lcp = lcp

    def _descend(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for k, bits in enumerate(self.wavelet):
            ones = bits.rank(at)
            at = np.where(symbol >> (self.levels - 1 - k) & 1, bits.zeros + ones, at - ones)
        return at

    def codes(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.alphabet, words) + 1

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the rows of symbol + pattern."""
        both = self._descend(np.concatenate((low, high)), np.concatenate((symbol, symbol)))
        shift = self.shift[symbol]
        return both[: len(low)] + shift, both[len(low) :] + shift

    def widen(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that share the first `depth` words with the rows given."""
        low, high = low.copy(), high.copy()
        for k in range(len(self.low) - 1, -1, -1):
            step, table = 1 << k, self.low[k]
            begin = low - step + 1
            go = begin > 0
            go[go] = table[begin[go]] >= depth[go]
            low[go] -= step
            go = (high < self.n) & (high + step <= self.n)
            go[go] = table[high[go]] >= depth[go]
            high[go] += step
        return low, high

    def matches(self, queries: np.ndarray, sizes: np.ndarray, owners: np.ndarray, window: int) -> np.ndarray:
        """For codes of queries one after the other: whether `window` symbols from each place on occur in a sequence of a
        smaller owner. Matching statistics from right to left: a query's interval is extended by its next symbol while
        some row of a smaller owner is left, else widened to its parent and tried again; it never grows past `window`."""
        found = np.zeros(len(queries), bool)
        begin = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        low, high, length = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.n), np.zeros(len(sizes), np.int64)
        lives = np.searchsorted(-sizes[order], -np.arange(int(sizes.max()) if len(sizes) else 0), side="left").tolist()
        ends = (begin + sizes)[order]
        owners = owners[order]
        for t, live in enumerate(lives):
            at = ends[:live] - 1 - t
            symbol = queries[at]
            full = np.flatnonzero(length[:live] == window)
            if len(full):
                length[full] = window - 1
                low[full], high[full] = self.widen(low[full], high[full], length[full])
            todo = np.arange(live)
            while len(todo):
                a, b = self.extend(low[todo], high[todo], symbol[todo])
                good = b > a
                good[good] = self.least.of(a[good], b[good]) < owners[todo[good]]
                on = todo[good]
                low[on], high[on] = a[good], b[good]
                length[on] += 1
                todo = todo[~good]
                lost = todo[length[todo] == 0]
                low[lost], high[lost] = 0, self.n
                todo = todo[length[todo] > 0]
                parent = np.maximum(self.lcp[low[todo]], self.lcp[high[todo]]).astype(np.int64)
                low[todo], high[todo] = self.widen(low[todo], high[todo], parent)
                root = todo[parent == 0]
                low[root], high[root] = 0, self.n
                length[todo] = parent
            found[at[length[:live] == window]] = True
        return found
