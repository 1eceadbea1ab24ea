"""A bidirectional FM-index over a set of words, in numpy, for many searches at a time.

The text is that of all words, each with an end of its own behind it, so a suffix is sorted by
its letters up to the end and then by its word; prefix doubling sorts all suffixes in as many
rounds as the longest word has binary digits. The same is held of the words written backwards.
A search begins at an end and extends a pattern leftwards in the first index, or from a
word's beginning rightwards in the second; the suffixes that begin with the pattern are
an interval of ranks.

One binary search extends an interval: the Burrows-Wheeler transform is held as sorted
numbers ``letter * n + row``, and the place of such a number among them counts the smaller
letters as well as those of the same letter above the row.
"""

from __future__ import annotations

import numpy as np

#: Searches made at a time.
SEARCHES = 1 << 14


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All words' code points back to back, and the words' bounds in them."""
    data = "".join(words).encode("utf-32-le")
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer(data, np.uint32).astype(np.int64), np.append(0, np.cumsum(sizes))


def ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes: each member's group, and its place in it."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def backwards(letters: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    group, place = ragged(np.diff(bounds))
    return letters[bounds[1:][group] - 1 - place]


class Index:
    """One direction: patterns grow from the words' ends towards their beginnings.

    Symbols are 1, 2, ...; 0 stands before a word's beginning.
    """

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, width: int):
        sizes = np.diff(bounds)
        group, place = ragged(sizes + 1)
        self.n, self.words, self.width = len(group), len(sizes), width
        text = np.zeros(self.n, np.int64)
        text[place < sizes[group]] = symbols
        order = _suffix_order(text + self.words, place == sizes[group])
        #: The word of each row, and the symbol before its suffix.
        self.word = group[order]
        self.before = np.where(place[order] > 0, text[order - 1], 0)
        self.keys = np.sort(self.before * self.n + np.arange(self.n))

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray):
        """The intervals with ``symbol`` put before each pattern."""
        at = symbol * self.n
        return np.searchsorted(self.keys, at + low), np.searchsorted(self.keys, at + high)

    def symbols_before(self, low: np.ndarray, high: np.ndarray):
        """(search, symbol) of the different symbols that stand before each pattern.

        A narrow interval is read; a wide one is asked for every symbol.
        """
        size = high - low
        wide = np.flatnonzero(size > self.width)
        search = np.repeat(wide, self.width)
        symbol = np.tile(np.arange(1, self.width + 1), len(wide))
        first, last = self.extend(low[search], high[search], symbol)
        found = search[last > first], symbol[last > first]
        narrow = np.flatnonzero(size <= self.width)
        which, place = ragged(size[narrow])
        search = narrow[which]
        pair = search * (self.width + 1) + self.before[low[search] + place]
        pair = np.unique(pair[pair % (self.width + 1) > 0])
        return (
            np.concatenate([found[0], pair // (self.width + 1)]),
            np.concatenate([found[1], pair % (self.width + 1)]),
        )

    def whole(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(search, word) for the searches whose pattern is a whole word."""
        first, last = np.searchsorted(self.keys, low), np.searchsorted(self.keys, high)
        found = np.flatnonzero(last > first)
        return found, self.word[self.keys[first[found]]]


def _suffix_order(rank: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; every end is a symbol of its own."""
    n, at, step = len(rank), np.arange(len(rank)), 1
    rank[ends] = np.arange(np.count_nonzero(ends))
    while True:
        # A suffix that has met its end is alone already; what lies behind doesn't count.
        second = rank[np.minimum(at + step, n - 1)]
        order = np.argsort(rank * (int(rank.max()) + 1) + second, kind="stable")
        fresh = np.ones(n, bool)
        fresh[1:] = (np.diff(rank[order]) != 0) | (np.diff(second[order]) != 0)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        if fresh.all():
            return order
        step *= 2


class Bidirectional:
    """Both directions over distinct words of one letter or more."""

    def __init__(self, words: list[str]):
        letters, bounds = letters_of(words)
        self.alphabet, symbols = np.unique(letters, return_inverse=True)
        symbols = symbols + 1
        width = len(self.alphabet)
        self.leftward = Index(symbols, bounds, width)
        self.rightward = Index(backwards(symbols, bounds), bounds, width)

    def symbols(self, letters: np.ndarray) -> np.ndarray:
        """As symbols of the index; a letter that it lacks is one that nothing has."""
        at = np.searchsorted(self.alphabet, letters)
        there = at < len(self.alphabet)
        there[there] = self.alphabet[at[there]] == letters[there]
        return np.where(there, at + 1, len(self.alphabet) + 1)

    def one_error(self, queries: list[str], first_half: bool):
        """(query, word) pairs that differ by one letter put in, left out or replaced.

        The search scheme: the first (or the second) half of the query is matched
        exactly, then the pattern is extended over the other half with one error. The first half
        has ``len // 2`` letters. Each pair comes once; a word is not near itself.
        """
        found = [np.empty((2, 0), np.int64)]
        for at in range(0, len(queries), SEARCHES):
            letters, bounds = letters_of(queries[at : at + SEARCHES])
            symbols, sizes = self.symbols(letters), np.diff(bounds)
            if first_half:
                index, exact = self.rightward, sizes // 2
            else:
                index, exact = self.leftward, sizes - sizes // 2
                symbols = backwards(symbols, bounds)
            pairs = _one_error(index, symbols, bounds, exact)
            found.append(pairs + np.array([[at], [0]]))
        return np.concatenate(found, 1)


def _one_error(index: Index, symbols: np.ndarray, bounds: np.ndarray, exact: np.ndarray):
    """Searches side by side: (query, next letter, interval) without and with an error."""
    sizes = np.diff(bounds)
    query = np.arange(len(sizes))
    low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), index.words)
    done = np.zeros(len(sizes), np.int64)
    wrong = [np.empty((4, 0), np.int64)]
    found = [np.empty((2, 0), np.int64)]
    while len(query) or sum(w.shape[1] for w in wrong):
        # Those with an error go on by one letter, or end in a whole word.
        q, d, lo, hi = np.concatenate(wrong, 1)
        wrong = []
        ended = d == sizes[q]
        at, word = index.whole(lo[ended], hi[ended])
        found.append(np.stack([q[ended][at], word]))
        q, d, lo, hi = q[~ended], d[~ended], lo[~ended], hi[~ended]
        lo, hi = index.extend(lo, hi, symbols[bounds[q] + d])
        wrong.append(np.stack([q, d + 1, lo, hi])[:, hi > lo])

        # Behind the exact half, every kind of error branches off.
        may = np.flatnonzero(done >= exact[query])
        if len(may):
            q, d, lo, hi = query[may], done[may], low[may], high[may]
            more = d < sizes[q]
            wrong.append(np.stack([q, d + 1, lo, hi])[:, more])
            search, symbol = index.symbols_before(lo, hi)
            q, d, more = q[search], d[search], more[search]
            lo, hi = index.extend(lo[search], hi[search], symbol)
            wrong.append(np.stack([q, d, lo, hi]))
            wanted = symbols[np.minimum(bounds[q] + d, len(symbols) - 1)]
            wrong.append(np.stack([q, d + 1, lo, hi])[:, more & (symbol != wanted)])

        on = done < sizes[query]
        query, done, low, high = query[on], done[on], low[on], high[on]
        low, high = index.extend(low, high, symbols[bounds[query] + done])
        on = high > low
        query, done, low, high = query[on], done[on] + 1, low[on], high[on]
    pairs = np.concatenate(found, 1)
    return np.unique(pairs, axis=1)
