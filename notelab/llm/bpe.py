"""Byte-level BPE ids of whole text columns.

The pre-tokens of a slab (``public_tokenizers.PATTERN``: contractions, runs of
letters, digits or other characters with one leading blank, white space) are
found with numpy over code points, and each distinct pre-token is encoded once
per Python worker; its ids are then gathered.  Texts with an apostrophe, with
a code point from U+0250 on or with the string of a special token go through
``tokenizers`` whole.  The table of known pre-tokens is emptied when it
reaches ``MOST_KNOWN`` entries, which bounds a worker's memory.
"""

from __future__ import annotations

import base64
import unicodedata

import numpy as np

from notelab.llm import bytewords as bw

LIMIT = 0x250
MOST_KNOWN = 1 << 21
SLOTS = 1 << 21
_LETTER, _NUMBER, _OTHER, _BLANK = 1, 2, 0, 3

_CLASS = np.zeros(LIMIT + 1, np.uint8)
for _c in range(LIMIT):
    _kind = unicodedata.category(chr(_c))[0]
    _CLASS[_c] = {"L": _LETTER, "N": _NUMBER}.get(_kind, _OTHER)
_CLASS[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0]] = _BLANK  # Unicode White_Space below the limit
_POINT = np.random.default_rng(7).integers(1, 1 << 63, LIMIT + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Encoder:
    def __init__(self, json_path: str, ranks_path: str | None = None) -> None:
        """ranks_path: the same vocabulary as ranks; speeds up new pre-tokens."""
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(json_path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [x.content for x in added]
        self.ranks = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.newline = ranks[b"\n"]
        self._forget()

    def _forget(self) -> None:
        # known pre-tokens: sorted hashes and their numbers; ids by number; a
        # table by the low bits of the hash that answers most look-ups
        self.known, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.slot_key, self.slot_at = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32)
        self.begin, self.length = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.ids, self.n_ids = np.zeros(1 << 14, np.uint32), 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _append(self, ids: np.ndarray) -> int:
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.n_ids: self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)
        return self.n_ids - len(ids)

    def _learn(self, tokens: list[str]) -> np.ndarray:
        """Encode new pre-tokens; their numbers."""
        begin, length = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
        # a newline between two pre-tokens is a pre-token of its own, unless one
        # of them is white space
        safe = [i for i, t in enumerate(tokens) if t.strip()] if self.ranks else []
        if safe:
            ids = np.array(self.ranks.encode_ordinary("\n".join([tokens[i] for i in safe])), np.uint32)
            cut = np.flatnonzero(ids == self.newline)
            if len(cut) != len(safe) - 1:
                safe = []
            else:
                at = self._append(ids)
                starts = np.concatenate([[0], cut + 1])
                begin[safe], length[safe] = at + starts, np.append(cut, len(ids)) - starts
        for i in np.flatnonzero(length == 0).tolist():
            ids = self.whole(tokens[i])
            begin[i], length[i] = self._append(ids), len(ids)
        numbers = len(self.begin) + np.arange(len(tokens))
        self.begin, self.length = np.concatenate([self.begin, begin]), np.concatenate([self.length, length])
        return numbers

    def _numbers(self, keys: np.ndarray, token) -> np.ndarray:
        """Numbers of distinct sorted hashes; token(i): the text of keys[i]."""
        at = np.searchsorted(self.known, keys)
        there = self.known[np.minimum(at, len(self.known) - 1)] == keys if len(self.known) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~there)
        if len(new):
            numbers = self._learn([token(i) for i in new.tolist()])
            self.known = np.insert(self.known, at[new], keys[new])
            self.number = np.insert(self.number, at[new], numbers)
            at = np.searchsorted(self.known, keys)
        return self.number[at]

    def slab_ids(self, slab: bw.Slab) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slab, one after the other, and the offsets."""
        if len(self.known) >= MOST_KNOWN:
            self._forget()
        text = slab.data.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        chars = np.concatenate([[0], np.cumsum((slab.data & 0xC0) != 0x80)])[slab.offsets]
        odd = bw.per_text((points >= LIMIT) | (points == 0x27), chars) > 0
        for i in np.flatnonzero([any(s in text for s in self.special)] * slab.n):
            odd[i] |= any(s in text[chars[i]: chars[i + 1]] for s in self.special)

        starts = pretoken_starts(points, chars)
        first = np.searchsorted(starts, chars)
        ends = np.append(starts[1:], len(points))
        n = len(points)
        up, down = bw._POWERS.upto(n)
        with np.errstate(over="ignore"):
            h = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_POINT[np.minimum(points, LIMIT)] * up[:n])])
            key = bw.mix((h[ends] - h[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        slot = (key & np.uint64(SLOTS - 1)).astype(np.int64)
        at = self.slot_at[slot].astype(np.int64)
        miss = np.flatnonzero((self.slot_key[slot] != key) & ~np.repeat(odd, np.diff(first)))
        if len(miss):
            new, where, back = np.unique(key[miss], return_index=True, return_inverse=True)
            where = miss[where]
            found = self._numbers(new, lambda i: text[starts[where[i]]: ends[where[i]]])
            at[miss] = found[back]
            self.slot_key[slot[where]], self.slot_at[slot[where]] = new, found
        at[np.repeat(odd, np.diff(first))] = 0
        length = self.length[at]
        length[np.repeat(odd, np.diff(first))] = 0
        total = int(length.sum())
        offsets = np.concatenate([[0], np.cumsum(length)])
        ids = self.ids[np.repeat(self.begin[at] - offsets[:-1], length) + np.arange(total)]
        offsets = offsets[first]
        if odd.any():
            parts = [self.whole(text[chars[i]: chars[i + 1]]) if odd[i] else ids[offsets[i]: offsets[i + 1]]
                     for i in range(slab.n)]
            ids = np.concatenate(parts)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, offsets


def pretoken_starts(points: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """First code points of the pre-tokens; chars: where each text begins (n + 1).
    Right for texts below LIMIT without apostrophes."""
    kind = _CLASS[np.minimum(points, LIMIT)]
    edge = np.zeros(len(points) + 1, bool)
    edge[chars] = True
    run = edge.copy()
    run[1:-1] |= kind[1:] != kind[:-1]
    blank = kind == _BLANK
    after_space = np.zeros(len(points), bool)
    after_space[1:] = (points[:-1] == 0x20) & ~edge[1:-1]
    # the last blank before other characters begins a pre-token: a space joins
    # them, anything else stands alone
    last_blank = blank & run[1:] & ~edge[1:]
    return np.flatnonzero((run[:-1] & (blank | ~after_space)) | last_blank)
