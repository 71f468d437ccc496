"""A compressed full-text index of word sequences, searched for many sequences at once.

The Burrows-Wheeler transform of the sequences is kept in a wavelet tree whose codes are
shorter for commoner words (Shannon codes), as one bit vector with counts of the ones
before each block. Backward search extends a match by one word to the left with two rank
queries. Sequences belong to owners, and a match counts only where it lies in a sequence
of a smaller owner than that of the sequence which is searched for.
"""

import numpy as np

_WORD = 64


class Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits):
        padded = np.zeros((len(bits) // _WORD + 1) * _WORD, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at):
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletTree:
    """How often a symbol occurs before a place, for arrays of symbols and places."""

    def __init__(self, symbols, size):
        counts = np.bincount(symbols, minlength=size)
        present = np.flatnonzero(counts)
        self.depth = np.zeros(size, np.int64)
        self.depth[present] = np.maximum(
            1, np.ceil(np.log2(len(symbols) / counts[present]))).astype(np.int64)
        levels = int(self.depth.max(initial=1))
        # Codes in the order of their lengths, written from the top of `levels` bits.
        order = present[np.argsort(self.depth[present], kind="stable")]
        room = np.int64(1) << (levels - self.depth[order])
        self.code = np.zeros(size, np.int64)
        self.code[order] = np.cumsum(room) - room
        self.levels = levels
        self.start = np.zeros((levels, size), np.int64)
        parts, passed, row = [], 0, symbols
        for level in range(levels):
            row = row[self.depth[row] > level]
            node = self.code[row] >> (levels - level)
            by_node = np.argsort(node, kind="stable")
            row, node = row[by_node], node[by_node]
            self.start[level] = passed + np.searchsorted(node, self.code >> (levels - level))
            parts.append((self.code[row] >> (levels - 1 - level)) & 1)
            passed += len(row)
        self.bits = Bits(np.concatenate(parts))
        self.skipped = self.bits.ones(self.start)

    def rank(self, symbols, places):
        places = places.copy()
        live = np.arange(len(symbols))
        for level in range(self.levels):
            live = live[self.depth[symbols[live]] > level]
            if not len(live):
                break
            mine = symbols[live]
            at = places[live]
            ones = self.bits.ones(self.start[level, mine] + at) - self.skipped[level, mine]
            bit = (self.code[mine] >> (self.levels - 1 - level)) & 1
            places[live] = np.where(bit == 1, ones, at - ones)
        return places


class RangeMin:
    """Minima of runs of an array whose lengths are powers of two."""

    def __init__(self, values):
        self.rows = [values]
        while len(self.rows[-1]) > 1 << (len(self.rows) - 1):
            half, last = 1 << (len(self.rows) - 1), self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def least(self, low, high):
        """Minima of values[low:high], none of them empty."""
        out = np.empty(len(low), self.rows[0].dtype)
        power = np.frexp((high - low).astype(np.float64))[1] - 1
        for p in np.unique(power).tolist():
            at = np.flatnonzero(power == p)
            out[at] = np.minimum(self.rows[p][low[at]], self.rows[p][high[at] - (1 << p)])
        return out

    def left_below(self, at, bound):
        """The last place up to `at` whose value is below the bound; there must be one."""
        at = at.copy()
        for p in range(len(self.rows) - 1, -1, -1):
            first = at - (1 << p) + 1
            ok = first >= 0
            ok[ok] = self.rows[p][first[ok]] >= bound[ok]
            at[ok] -= 1 << p
        return at

    def right_below(self, at, bound):
        """The first place from `at` on whose value is below the bound; there must be one."""
        at = at.copy()
        for p in range(len(self.rows) - 1, -1, -1):
            ok = at < len(self.rows[p])
            ok[ok] = self.rows[p][at[ok]] >= bound[ok]
            at[ok] += 1 << p
        return at


def suffix_order(symbols):
    """Places of the suffixes in their order, and how many symbols each shares with the
    one before. The last symbol must occur once."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    ranks, step = [rank], 1
    while rank.max() < n - 1:  # by twice as many symbols each time
        following = np.zeros(n, np.int64)
        following[:-step] = rank[step:] + 1
        pair = rank * (n + 1) + following
        order = np.argsort(pair)
        pair = pair[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(pair[1:] != pair[:-1])))
        ranks.append(rank)
        step *= 2
    places = np.empty(n, np.int64)
    places[rank] = np.arange(n)
    one, two = places[:-1].copy(), places[1:].copy()
    shared = np.zeros(n + 1, np.int32)
    shared[0] = shared[n] = -1
    for power in range(len(ranks) - 2, -1, -1):
        end = np.maximum(one, two) >= n
        same = ranks[power][np.minimum(one, n - 1)] == ranks[power][np.minimum(two, n - 1)]
        same &= ~end
        shared[1:n][same] += 1 << power
        one[same] += 1 << power
        two[same] += 1 << power
    return places, shared


class FMIndex:
    """Index of word sequences (lists of hashable words) with their owners' numbers."""

    def __init__(self, sequences, owners):
        count = len(sequences)
        order = sorted(range(count), key=owners.__getitem__)
        numbers = {}
        self.words = [
            np.array([numbers.setdefault(w, len(numbers)) for w in s], np.int64)
            for s in sequences]
        self.numbers = numbers
        # Each sequence ends with a symbol of its own, below all words.
        text = np.concatenate([
            part for at, n in enumerate(order) for part in (self.words[n] + count, [at])])
        sizes = [len(self.words[n]) + 1 for n in order]
        owner = np.repeat(np.array([owners[n] for n in order], np.int64), sizes)
        places, shared = suffix_order(text)
        before = text[places - 1]
        before = np.where(before < count, 0, before - count + 1)
        self.size, self.alphabet = len(text), len(numbers) + 1
        self.tree = WaveletTree(before, self.alphabet)
        self.first = np.zeros(self.alphabet, np.int64)
        self.first[1:] = count + np.concatenate(
            ([0], np.cumsum(np.bincount(before, minlength=self.alphabet)[1:])))[:-1]
        self.owner = RangeMin(owner[places])
        self.shared = RangeMin(shared)

    def extend(self, words, low, high):
        """Rows of the matches (low, high) with a word before them; empty where none is."""
        both = self.tree.rank(np.concatenate((words, words)), np.concatenate((low, high)))
        return self.first[words] + both[:len(low)], self.first[words] + both[len(low):]

    def shorten(self, low, high):
        """Rows and lengths of the longest starts of matches that have more rows."""
        length = np.maximum(self.shared.rows[0][low], self.shared.rows[0][high])
        length = np.maximum(length, 0)
        return (np.where(length, self.shared.left_below(low, length), 0),
                np.where(length, self.shared.right_below(high, length), self.size), length)

    def matches(self, sequences, owners, least):
        """(number of the sequence, start, end) of the longest match with smaller owners at
        each place where it has `least` words, contained ones left out.

        Matching statistics from right to left: a match is extended while rows of smaller
        owners are left, else cut short at its end. A sequence is done when no match that
        is long enough can come.
        """
        words = [np.array([self.numbers.get(w, -1) + 1 for w in s], np.int64)
                 for s in sequences]
        sizes = np.array([len(w) for w in words], np.int64)
        base = np.cumsum(sizes) - sizes
        flat = np.concatenate(words)
        query = np.flatnonzero(sizes >= least)
        start = base[query]
        at, end = start + sizes[query], start + sizes[query]
        owner = np.array(owners, np.int64)[query]
        low, high = np.zeros(len(query), np.int64), np.full(len(query), self.size)
        found = []
        while len(query):
            word = flat[at - 1]
            known = word > 0
            new_low, new_high = self.extend(word, low, high)
            ok = known & (new_low < new_high)
            ok[ok] = self.owner.least(new_low[ok], new_high[ok]) < owner[ok]
            low[ok], high[ok] = new_low[ok], new_high[ok]
            at[ok] -= 1
            long = ok & (end - at >= least)
            found.append(np.stack((query[long], (at - start)[long], (end - start)[long])))
            failed = np.flatnonzero(~ok)
            empty = failed[end[failed] == at[failed]]
            at[empty] -= 1
            end[empty] = at[empty]
            cut = failed[~np.isin(failed, empty)]
            low[cut], high[cut], length = self.shorten(low[cut], high[cut])
            end[cut] = at[cut] + length
            more = (at > start) & (end - start >= least)
            query, start, at, end, owner, low, high = (
                a[more] for a in (query, start, at, end, owner, low, high))
        found = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
        # Of matches with one end the last found is the longest.
        last = {(q, e): s for q, s, e in found.T.tolist()}
        return [(q, s, e) for (q, e), s in last.items()]
