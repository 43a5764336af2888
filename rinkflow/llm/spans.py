"""Words of UTF-8 text by one finite-state pass over its bytes, and a verified hash table of their spans.

Both work on all texts of a batch at once: the state after a byte follows from
the byte alone, so a table lookup per byte runs the machine over every text.
"""

import hashlib

import numpy as np

from rinkflow.llm import words as W

BETWEEN, WORD = 0, 1
#: What a transition says: a word starts or has ended, and the kind of the byte that was read.
START, END, CAPITAL, SYMBOL, CONTINUES = 1, 2, 4, 8, 16
#: The low 0 to 8 bytes of a 64-bit number.
_LOW = np.array([0] + [(1 << 8 * k) - 1 for k in range(1, 9)], np.uint64)
#: Words beyond this many bytes are hashed and compared whole, one at a time.
LONG = 64


class Machine:
    """Transitions by state and byte; ``apart`` are the bytes between words."""

    def __init__(self, apart, symbols=b""):
        self.after = np.full(256, WORD, np.uint16)
        self.after[list(apart)] = BETWEEN
        self.says = np.zeros((2, 256), np.uint8)
        self.says[BETWEEN, self.after == WORD] |= START
        self.says[WORD, self.after == BETWEEN] |= END
        self.says[:, 65:91] |= CAPITAL
        self.says[:, list(symbols)] |= SYMBOL
        self.says[:, 128:192] |= CONTINUES
        self.says = self.says.ravel()

    def run(self, data, offsets):
        """What the transitions say at each byte; every text begins between words."""
        state = np.empty(len(data), np.uint16)
        state[1:] = self.after[data[:-1]]
        state[offsets[:-1][offsets[:-1] < len(data)]] = BETWEEN
        state <<= 8
        state |= data
        return self.says[state]

    def words(self, data, offsets, said):
        """(first byte of each word, its length, the text it is in)."""
        starts = np.flatnonzero(said & START)
        last = offsets[1:][np.diff(offsets) > 0]
        open_ends = last[self.after[data[last - 1]] == WORD]
        ends = np.concatenate([np.flatnonzero(said & END), open_ends])
        ends.sort(kind="stable")
        return starts, ends - starts, np.searchsorted(offsets, starts, "right") - 1


def per_text(flags, offsets):
    """How many flagged bytes each text has."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets))


class Table:
    """Open addressing over spans of ``data``: equal spans of one group share an entry.

    Spans with the same hash are told apart by their bytes, so the entries are
    exact. ``owner`` gives for each span the one that holds its entry.
    """

    def __init__(self, data, starts, lengths, group):
        self.starts, self.lengths, self.group = starts, lengths, np.asarray(group, np.uint64)
        self.data = data
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        # The eight bytes from any byte on.
        self.eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        self.first = self._piece(np.arange(len(starts)), 0)
        #: Hashes of the bytes alone, the same in every batch.
        self.hashes = self._hashes()
        with np.errstate(over="ignore"):
            self.owner = self._insert(W.mix(self.hashes + self.group))

    def _piece(self, spans, k):
        """Bytes 8k to 8k + 7 of the spans, zeros behind their ends."""
        left = np.clip(self.lengths[spans] - 8 * k, 0, 8)
        return self.eights[self.starts[spans] + np.where(left > 0, 8 * k, 0)] & _LOW[left]

    def _bytes(self, span):
        return self.data[self.starts[span] : self.starts[span] + self.lengths[span]].tobytes()

    def _hashes(self):
        with np.errstate(over="ignore"):
            hashes = W.mix(self.first + W.mix(self.lengths.astype(np.uint64)))
            for k in range(1, LONG // 8):
                longer = np.flatnonzero(self.lengths > 8 * k)
                if not len(longer):
                    break
                hashes[longer] = W.mix(hashes[longer] + self._piece(longer, k))
        for span in np.flatnonzero(self.lengths > LONG):
            digest = hashlib.blake2b(self._bytes(span), digest_size=8).digest()
            hashes[span] ^= np.uint64(int.from_bytes(digest, "little"))
        return hashes

    def _same(self, a, b):
        same = (self.first[a] == self.first[b]) & (self.lengths[a] == self.lengths[b]) & (self.group[a] == self.group[b])
        for k in range(1, LONG // 8):
            longer = np.flatnonzero(same & (self.lengths[a] > 8 * k))
            if not len(longer):
                return same
            same[longer] = self._piece(a[longer], k) == self._piece(b[longer], k)
        for i in np.flatnonzero(same & (self.lengths[a] > LONG)):
            same[i] = a[i] == b[i] or self._bytes(a[i]) == self._bytes(b[i])
        return same

    def _insert(self, hashes):
        n = len(hashes)
        size = 1 << max(4, (2 * n).bit_length())
        table = np.full(size, -1, np.int64)
        slot = (hashes & np.uint64(size - 1)).astype(np.int64)
        owner = np.empty(n, np.int64)
        pending = np.arange(n)
        while len(pending):
            at = slot[pending]
            free = table[at] < 0
            table[at[free]] = pending[free]
            holder = table[at]
            same = self._same(holder, pending)
            owner[pending[same]] = holder[same]
            pending = pending[~same]
            slot[pending] = (slot[pending] + 1) & (size - 1)
        return owner

    def entries(self):
        """(the owners in order, the number of each span's owner among them)."""
        holds = self.owner == np.arange(len(self.owner))
        number = np.cumsum(holds) - 1
        return np.flatnonzero(holds), number[self.owner]
