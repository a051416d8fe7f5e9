"""Token ids of whole texts by a public tokenizer, computed unit by unit in arrays.

The tokenizer of ``word_bpe_49k.json`` never joins characters across white space, folds case letter by
letter and parts a letter from the punctuation after it. So a text's ids are those of its units one after
another: words (runs without ASCII white space) in lower case, and apart from them the ASCII punctuation
at their ends where a letter stands before it. Words that could hold a special token stay as they are.

Units of up to 15 bytes are two integers, their bytes and length, and are looked up all at once in a hash
table of arrays that each worker keeps; longer ones go by a bounded dictionary. Only new units reach the
tokenizer itself, many in one call.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

from attesta.llm.runtime import worker_cache

#: Units a worker keeps, in some 40 MB of tables.
UNITS_KEPT = 300_000
#: A document ends with this id.
END = 1
#: Bytes of text handled at once, unless one text is longer.
AT_ONCE = 1 << 18
#: Longer units are not kept; units of more punctuation at the end are not parted.
LONG, MARKS = 64, 8

_U = np.uint64
_SPACE, _PUNCT, _STOP = (np.zeros(256, dtype=bool) for _ in range(3))
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_STOP[[*b".!?:;"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FIRST = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=_U)


def path_of(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Table:
    """Open addressing: two integers -> where a unit's ids start, and how many they are."""

    def __init__(self, kept: int):
        self.kept = kept
        self._room(kept)
        self.entries = np.zeros((1 << 12, 3), dtype=_U)
        self.filled = 0

    def _size(self, n: int) -> int:
        return 1 << max(10, (2 * n).bit_length())

    def _room(self, n: int) -> None:
        """Empty rows for ``n`` units, which fill at most half of them."""
        self.size = self._size(n)
        self.shift = _U(64 - self.size.bit_length() + 1)
        self.rows = np.zeros((self.size, 3), dtype=_U)  # second integer 0: free, as it holds the length

    def _at(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = (a ^ (a >> _U(29)) ^ (b * _U(0xC2B2AE3D27D4EB4F))) * _U(0x9E3779B97F4A7C15)
        return ((h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, places of those not held)."""
        out = np.zeros(len(a), dtype=_U)
        at, left = self._at(a, b), np.arange(len(a))
        missing = []
        while len(left):
            row = self.rows.take(at, axis=0)
            hit = (row[:, 0] == a[left]) & (row[:, 1] == b[left])
            out[left[hit]] = row[hit, 2]
            free = row[:, 1] == 0
            missing.append(left[free])
            on = ~hit & ~free
            left, at = left[on], (at[on] + 1) & (self.size - 1)
        return out, np.concatenate(missing) if missing else np.zeros(0, np.int64)

    def put(self, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> None:
        """New, distinct units."""
        n = self.filled + len(a)
        while n > len(self.entries):
            self.entries = np.concatenate([self.entries, np.zeros_like(self.entries)])
        self.entries[self.filled : n] = np.stack([a, b, value], axis=1)
        if 4 * n > 3 * self.size:  # one long text may bring more units than are kept
            self._room(n)
            self.filled = 0
        self._place(self.entries[self.filled : n])
        self.filled = n

    def _place(self, rows: np.ndarray) -> None:
        at = self._at(rows[:, 0], rows[:, 1])
        while len(rows):
            free = self.rows[at, 1] == 0
            self.rows[at[free]] = rows[free]  # of several for one place, one is written
            held = (self.rows[at, 0] == rows[:, 0]) & (self.rows[at, 1] == rows[:, 1])
            rows, at = rows[~held], (at[~held] + 1) & (self.size - 1)

    def trim(self) -> None:
        """The first half stays, being the frequent units."""
        self.filled = self.kept // 2
        if self.size == self._size(self.kept):
            self.rows[:] = 0
        else:
            self._room(self.kept)
            self.entries = self.entries[: max(1 << 12, self.size)].copy()
        self._place(self.entries[: self.filled])


class WordTokenizer:
    def __init__(self, path: str, kept: int = UNITS_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.kept = Tokenizer.from_file(path), kept
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.uint16 if len(vocabulary) <= 1 << 16 else np.uint32
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, i in vocabulary.items():
            self.last[i] = token.endswith("</w>")
        self._clear()

    def _clear(self) -> None:
        self.table, self.long, self.turns = _Table(self.kept), {}, 0
        self.flat, self.used = np.zeros(1 << 16, dtype=self.dtype), 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of ids, ids) of units, in their order."""
        words = [u.decode("utf-8", "replace") for u in units]
        lengths = np.zeros(len(words), dtype=np.int64)
        plain = np.array([w.isalpha() and (w.isascii() or unicodedata.is_normalized("NFC", w)) for w in words], dtype=bool)
        order, parts = [], []
        # words of letters only, many at once: each ends at a token that ends a word
        among = np.flatnonzero(plain)
        for lo in range(0, len(among), 500):
            some = among[lo : lo + 500]
            ids = np.array(self._encode([" ".join([words[i] for i in some.tolist()])])[0], dtype=self.dtype)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some):
                plain[some] = False
                continue
            lengths[some] = np.diff(ends, prepend=0)
            order.append(some)
            parts.append(ids)
        others = np.flatnonzero(~plain)
        for i, ids in zip(others.tolist(), self._encode([words[i] for i in others.tolist()]), strict=True):
            lengths[i] = len(ids)
            parts.append(np.array(ids, dtype=self.dtype))
        order = np.concatenate([*order, others])
        if not parts:
            return lengths, np.zeros(0, dtype=self.dtype)
        start = np.zeros(len(words), dtype=np.int64)
        start[order] = np.cumsum(lengths[order]) - lengths[order]
        return lengths, _gather(np.concatenate(parts), start, lengths)[0]

    def _keep(self, ids: np.ndarray, used: int) -> int:
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[used : used + len(ids)] = ids
        return used + len(ids)

    def _values(self, low: np.ndarray, text: bytes, start: np.ndarray, end: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of the units begin, and how many they are. raw: units that keep their case."""
        n = end - start
        eight = np.ndarray((len(low) - 7,), "<u8", low, strides=(1,))
        a = eight[start] & _FIRST[np.minimum(n, 8)]
        b = eight[start + 8] & _FIRST[np.clip(n - 8, 0, 7)] | n.astype(_U) << _U(56)
        wide = np.flatnonzero((n > 15) | raw)
        a[wide], b[wide] = 0, 0  # no unit: ends at the first free row
        value, missing = self.table.find(a, b)
        missing = missing[b[missing] != 0]
        folded = None
        if len(missing):
            folded = low.tobytes()
            by = missing[np.lexsort((a[missing], b[missing]))]
            new = np.concatenate([[True], (a[by[1:]] != a[by[:-1]]) | (b[by[1:]] != b[by[:-1]])])
            first = by[new]
            lengths, ids = self._ids([folded[i:j] for i, j in zip(start[first].tolist(), end[first].tolist(), strict=True)])
            fresh = (self.used + np.cumsum(lengths) - lengths).astype(_U) << _U(12) | lengths.astype(_U)
            self.used = self._keep(ids, self.used)
            self.table.put(a[first], b[first], fresh)
            value[by] = fresh[np.cumsum(new) - 1]
        begin, length = (value >> _U(12)).astype(np.int64), (value & _U(4095)).astype(np.int64)
        if len(wide):
            folded = low.tobytes() if folded is None else folded
            units = [(text if r else folded)[i:j] for i, j, r in zip(start[wide].tolist(), end[wide].tolist(), raw[wide].tolist(), strict=True)]
            new = list(dict.fromkeys(u for u in units if u not in self.long))
            new.sort(key=lambda u: len(u) > LONG)  # those that are not kept come last
            lengths, ids = self._ids(new)
            at = self.used
            passing = {}
            for u, k in zip(new, lengths.tolist(), strict=True):
                (self.long if len(u) <= LONG else passing)[u] = at, k
                at += k
                if len(u) <= LONG:
                    kept = at
            self._keep(ids, self.used)
            if new and len(new[0]) <= LONG:
                self.used = kept
            found = [self.long.get(u) or passing[u] for u in units]
            begin[wide], length[wide] = np.array([f[0] for f in found]), np.array([f[1] for f in found])
        return begin, length

    def _trim(self) -> None:
        if self.table.filled <= self.kept and len(self.long) <= self.kept // 4:
            return
        self.turns += 1
        if self.turns > 40:  # the words have changed: start anew
            self._clear()
            return
        self.long = {}
        if self.table.filled > self.kept // 2:
            self.table.trim()
        if self.table.filled:
            value = int(self.table.entries[self.table.filled - 1, 2])
            self.used = (value >> 12) + (value & 4095)

    def many(self, texts):
        """For each text (an Arrow array of strings or bytes, or a list) its ids, and the numbers of ids after
        which a sentence ends."""
        if not isinstance(texts, pa.Array):
            texts = pa.array([None if t is None else t.encode("utf-8", "surrogatepass") for t in texts], pa.large_binary())
        if texts.null_count:
            texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
        if not len(texts):
            return
        wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + AT_ONCE)))
            yield from self._chunk(data[offsets[lo] : offsets[hi if hi <= len(texts) else len(texts)]], offsets[lo : min(hi, len(texts)) + 1] - offsets[lo])
            lo = hi

    def _chunk(self, raw: np.ndarray, bounds: np.ndarray):
        n = len(raw)
        low = np.zeros(n + 24, dtype=np.uint8)
        low[:n] = _LOWER[raw]
        space = _SPACE[raw]
        edge = np.zeros(n + 1, dtype=bool)
        edge[bounds] = True
        begins, stops = edge[:-1].copy(), edge[1:].copy()
        begins[1:] |= space[:-1]
        stops[:-1] |= space[1:]
        start, end = np.flatnonzero(begins & ~space), np.flatnonzero(stops & ~space) + 1
        special = np.zeros(len(start), dtype=bool)
        at = np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124))  # <|
        special[np.searchsorted(start, at, "right") - 1] = len(at) > 0
        # only a letter is sure to part from the marks that follow it
        core = end.copy()
        left = np.flatnonzero(_PUNCT[raw[end - 1]] & ~special)
        for _ in range(MARKS):
            core[left] -= 1
            left = left[(core[left] > start[left])]
            left = left[_PUNCT[raw[core[left] - 1]]]
            if not len(left):
                break
        letter = low[core - 1]
        core = np.where((core > start) & (letter >= 97) & (letter <= 122), core, end)
        units, upto = np.stack([start, core], axis=1).ravel(), np.stack([core, end], axis=1).ravel()
        full = units < upto
        units, upto = units[full], upto[full]
        text = raw.tobytes() if special.any() else b""
        begin, length = self._values(low, text, units, upto, np.repeat(special, 2)[full])
        ids, sums = _gather(self.flat, begin, length)
        self._trim()
        sums = np.concatenate([[0], sums])
        ends = sums[np.cumsum(full)[1::2][_STOP[raw[end - 1]]]]
        stop_at = start[_STOP[raw[end - 1]]]
        of_doc, of_stop = sums[np.searchsorted(units, bounds)], np.searchsorted(stop_at, bounds)
        for i in range(len(bounds) - 1):
            a, b = of_doc[i], of_doc[i + 1]
            yield ids[a:b], ends[of_stop[i] : of_stop[i + 1]] - a


def _gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` one after another, and where each ends."""
    upto = np.cumsum(length)
    total = int(upto[-1]) if len(upto) else 0
    return flat[np.arange(total) + np.repeat(start - (upto - length), length)], upto


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for this file."""
    held = worker_cache("tokens")
    if path not in held:
        held[path] = WordTokenizer(path)
    return held[path]
