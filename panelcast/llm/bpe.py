"""Token ids of whole batches of texts by a byte-level BPE file of the tokenizers library.

Each text falls into the pieces of the library's own split (contractions, words, numbers, punctuation, white space), found for a
whole batch at once with numpy; each different piece is encoded by the library once per Python worker and looked up after that.
Pieces are independent of each other in this model, so the ids equal those of encoding the whole text (tested on all tables and on
random text). The character classes come from the library, one code point at a time, when a code point is first met.
"""

from __future__ import annotations

import os

import numpy as np

from panelcast.llm.shared import U64, joined_rows, span_hashes

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = range(5)
#: longer pieces are encoded each time
LONGEST = 48
#: pieces that the library encodes at once (its results are large objects)
AT_ONCE = 4096


class PieceEncoder:
    def __init__(self, path: str, most_pieces: int = 1_000_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for each task
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.model = Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.split = ByteLevel(add_prefix_space=False, use_regex=True)
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self.most = most_pieces
        self.clear()

    def clear(self) -> None:
        """Forget the pieces; the memory of a worker stays bounded."""
        self.largest = 1 << int(np.ceil(np.log2(2 * self.most)))
        self._resize(min(1 << 12, self.largest))
        self.at = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _resize(self, slots: int) -> None:
        """An empty table of so many slots."""
        self.slots = slots
        self.keys = np.zeros(slots, U64)
        self.places = np.zeros(slots, np.int32)

    def _classify(self, points: np.ndarray) -> None:
        pieces = lambda s: len(self.split.pre_tokenize_str(s))
        for p in points.tolist():
            c = chr(p)
            self.kinds[p] = LETTER if pieces("a" + c) == 1 else NUMBER if pieces("1" + c) == 1 else OTHER if pieces("!" + c) == 1 else SPACE

    def _starts(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces begin."""
        n = len(points)
        kind = self.kinds[points]
        if (new := kind == UNKNOWN).any():
            self._classify(np.unique(points[new]))
            kind = self.kinds[points]
        head = np.zeros(n + 1, bool)
        head[offsets] = True
        start = np.empty(n, bool)
        start[0] = True
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        start |= head[:n]
        # the last space before something else goes with it, other white space stands alone
        after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~head[1:n]) + 1
        start[after - 1] = True
        start[after] = points[after - 1] != 32
        quote = np.flatnonzero((points == 39) & start)
        if len(quote):
            inside = np.append(points, [0, 0, 0])
            heads = np.append(head, [True, True, True])
            one, two = inside[quote + 1], inside[quote + 2]
            short = ~heads[quote + 1] & np.isin(one, [ord(c) for c in "stmd"])
            long = ~heads[quote + 1] & ~heads[quote + 2]
            long &= ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
            for hit, width in ((quote[short], 1), (quote[long], 2)):
                start[hit + 1] = False
                end = hit + 1 + width
                start[end[end < n]] = True
        return np.flatnonzero(start)

    def _find(self, h: np.ndarray) -> np.ndarray:
        mask = U64(self.slots - 1)
        place = np.full(len(h), -1, np.int32)
        left = np.arange(len(h))
        slot = (h & mask).astype(np.int64)
        while len(left):
            key = self.keys[slot]
            hit = key == h[left]
            place[left[hit]] = self.places[slot[hit]]
            on = ~hit & (key != 0)
            left, slot = left[on], (slot[on] + 1) & (self.slots - 1)
        return place

    def _add(self, h: np.ndarray, texts: list[str]) -> None:
        ids = [e.ids for k in range(0, len(texts), AT_ONCE) for e in self.model.encode_batch_fast(texts[k : k + AT_ONCE], add_special_tokens=False)]
        places = np.arange(len(self.at) - 1, len(self.at) - 1 + len(ids), dtype=np.int32)
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum([len(x) for x in ids])])
        self.pool = np.concatenate([self.pool, np.array([i for x in ids for i in x], np.uint32)])
        # the table grows with the pieces: it is half full at most, until it has its largest size
        needed = min(1 << (2 * len(self.at)).bit_length(), self.largest)
        if needed > self.slots:
            held = self.keys != 0
            keys, kept = self.keys[held], self.places[held]
            self._resize(needed)
            self._insert(keys, kept)
        self._insert(h, places)

    def _insert(self, h: np.ndarray, places: np.ndarray) -> None:
        left = np.arange(len(h))
        slot = (h & U64(self.slots - 1)).astype(np.int64)
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = h[left[free]]
            done = (self.keys[slot] == h[left]) & free
            self.places[slot[done]] = places[left[done]]
            left, slot = left[~done], (slot[~done] + 1) & (self.slots - 1)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some rows end to end, and the n + 1 offsets of the rows in them."""
        text = data.tobytes().decode("utf-8")
        if any(s in text for s in self.special):  # such strings are tokens of their own, as the library has it by default
            ids = [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast([data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])], add_special_tokens=False)]
            return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        if not text:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lead = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
        rows = lead[offsets]
        first = self._starts(points, rows)
        last = np.append(first[1:], len(points))
        h = span_hashes(points, first, last)
        h[h == 0] = 1
        if len(self.at) > self.most:
            self.clear()
        place = self._find(h)
        extra: list[np.ndarray] = []
        new = np.flatnonzero(place < 0)
        if len(new):
            small = new[last[new] - first[new] <= LONGEST]
            fresh, where = np.unique(h[small], return_index=True)
            room = self.most + self.largest // 4 - len(self.at)  # the table never fills up
            if len(fresh) > room:
                self.clear()
                return self._plain(text, rows)
            if len(fresh):
                self._add(fresh, [text[first[i] : last[i]] for i in small[where]])
                place[small] = self._find(h[small])
            large = new[last[new] - first[new] > LONGEST]
            if len(large):
                ids = [e.ids for e in self.model.encode_batch_fast([text[first[i] : last[i]] for i in large], add_special_tokens=False)]
                extra = [np.array(x, np.uint32) for x in ids]
                place[large] = -2 - np.arange(len(large), dtype=np.int32)
        pool, at = self.pool, self.at
        known = np.maximum(place, 0)
        begin, count = at[known], at[known + 1] - at[known] if len(at) > 1 else np.zeros(len(place), np.int64)
        if extra:
            ends = len(pool) + np.cumsum([len(x) for x in extra])
            far = place < -1
            index = -2 - place[far]
            sizes = np.array([len(x) for x in extra], np.int64)
            count[far] = sizes[index]
            begin[far] = (ends - sizes)[index]
            pool = np.concatenate([pool, *extra])
        out = pool[np.repeat(begin, count) + joined_rows(count)]
        total = np.concatenate([[0], np.cumsum(count)])
        return out, total[np.searchsorted(first, rows)]

    def _plain(self, text: str, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast([text[a:b] for a, b in zip(rows, rows[1:])], add_special_tokens=False)]
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker; workers are reused from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encoded_rows(column, path: str, end_id: int):
    """For each slice of a text column: the first row, then ids with the end id behind every document, and their offsets."""
    from panelcast.llm.shared import slices, utf8

    data, offsets = utf8(column)
    model = encoder(path)
    for a, b in slices(offsets):
        ids, rows = model.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        yield a, np.insert(ids, rows[1:], np.uint32(end_id)).astype("<u4", copy=False), rows + np.arange(len(rows))
