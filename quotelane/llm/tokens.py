"""Byte-level BPE ids of many texts at once, equal to the tokenizers library's.

The library is asked for each distinct piece of text once per worker: texts are cut into the
pieces that the byte-level pre-tokenizer makes (by array operations over the code points of many
texts), the pieces are counted by hash, and only unseen ones are encoded. Texts that hold a special
token's string, and vocabularies with another pre-tokenizer, are encoded whole by the library.
"""

from __future__ import annotations

import json

import numpy as np

from quotelane.llm.common import worker_state

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
CHUNK = 1 << 20
_END = 0x110000
_OTHER, _LETTER, _NUMBER, _SPACE, _STOP = range(5)


def _classes() -> np.ndarray:
    """Class of every code point, as the pre-tokenizer's pattern sees it."""
    import regex

    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, _END)))
    table = np.zeros(_END + 1, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        found = "".join(regex.findall(pattern, every))
        table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    table[_END] = _STOP
    return table


def _starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where pieces begin. Every text must end with the stop mark.

    Runs of letters, of numbers and of other signs, each with one blank before it; white space, all
    but the blank that goes to the next run; a few endings after an apostrophe that begins a piece.
    """
    first = np.empty(len(points), bool)
    first[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=first[1:])
    first[kinds == _STOP] = True
    space = kinds == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & (kinds[1:] != _STOP))
    first[last] = True
    first[last[points[last] == 32] + 1] = False
    marks = np.flatnonzero((points[:-1] == 39) & first[:-1] & (kinds[1:] == _LETTER))
    if len(marks):
        one, two = points[marks + 1], points[np.minimum(marks + 2, len(points) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pairs = [(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")]
        long = ~short & np.logical_or.reduce(pairs)
        first[marks[short | long] + 1] = False
        first[marks[short] + 2] = True
        first[marks[long] + 3] = True
    return np.flatnonzero(first)


class Encoder:
    """Encodes texts; keeps the ids of pieces that it has seen, at most ``most`` of them."""

    def __init__(self, vocabulary: str = VOCABULARY, most: int = 1_500_000):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.cuttable = (
            before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and not spec.get("normalizer")
            and not spec["model"].get("dropout")
        )
        self.newline = self._encode(["\n"])[0]
        self.cuttable = self.cuttable and len(self.newline) == 1
        self.size = self.library.get_vocab_size()
        self.classes = _classes() if self.cuttable else None
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.known = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32))] * 2
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, texts: list[str], blank: np.ndarray) -> list[list[int]]:
        """Ids of pieces; those that aren't white space are encoded many at a time, a line each."""
        out: list = [None] * len(texts)
        lines = [i for i in range(len(texts)) if not blank[i]]
        for at in range(0, len(lines), 512):
            group = lines[at : at + 512]
            ids = np.array(self._encode(["\n".join(texts[i] for i in group)])[0], np.uint32)
            cuts = np.flatnonzero(ids == self.newline[0])
            if len(cuts) == len(group) - 1:
                for i, part in zip(group, np.split(ids, cuts), strict=True):
                    out[i] = part if i == group[0] else part[1:]
            else:
                for i, part in zip(group, self._encode([texts[i] for i in group]), strict=True):
                    out[i] = part
        rest = [i for i in range(len(texts)) if blank[i]]
        for i, part in zip(rest, self._encode([texts[i] for i in rest]), strict=True):
            out[i] = part
        return out

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        start, length = np.zeros(len(keys), np.int64), np.full(len(keys), -1, np.int32)
        for known, starts, lengths in self.known:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                start[hit], length[hit] = starts[at[hit]], lengths[at[hit]]
        return start, length, length < 0

    def _learn(self, keys: np.ndarray, ids: list) -> None:
        lengths = np.fromiter(map(len, ids), np.int32, len(ids))
        end = self.used + int(lengths.sum())
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(end, len(self.flat)), np.uint32)])
        self.flat[self.used : end] = np.concatenate([np.asarray(p, np.uint32) for p in ids])
        starts = self.used + np.cumsum(lengths) - lengths
        self.used = end
        # a large and a small sorted table; the small one is merged when it has grown
        merged = [np.concatenate(x) for x in zip(self.known[1], (keys, starts, lengths), strict=True)]
        if 4 * len(merged[0]) > len(self.known[0][0]):
            merged = [np.concatenate(x) for x in zip(self.known[0], merged, strict=True)]
            self.known = [self.known[1], self.known[1]]
            place = 0
        else:
            place = 1
        order = np.argsort(merged[0], kind="stable")
        self.known[place] = tuple(x[order] for x in merged)
        if place == 0:
            self.known[1] = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, the end id after each text, and the end of each text among them. Null is empty."""
        whole = {}
        if not self.cuttable:
            whole = {i: t for i, t in enumerate(texts) if t}
        elif self.special:
            whole = {i: t for i, t in enumerate(texts) if t and any(s in t for s in self.special)}
        parts, ends, chunk, size, base = [], [], [], 0, 0
        for i, text in enumerate([*texts, None]):
            if i == len(texts) or size >= CHUNK or i in whole:
                if chunk:
                    ids, stops = self._chunk(chunk)
                    parts.append(ids)
                    ends.append(base + stops)
                    base += len(ids)
                chunk, size = [], 0
            if i in whole:
                ids = np.array([*self._encode([whole[i]])[0], END_ID], np.uint32)
                parts.append(ids)
                base += len(ids)
                ends.append(np.array([base], np.int64))
            elif i < len(texts):
                chunk.append(text or "")
                size += len(chunk[-1])
        if not parts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        return np.concatenate(parts), np.concatenate(ends)

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        stop = _END.to_bytes(4, "little")
        raw = b"".join(x for t in texts for x in (t.encode("utf-32-le"), stop))
        points = np.frombuffer(raw, "<u4")
        kinds = self.classes[points]
        starts = _starts(points, kinds)
        lengths = np.diff(starts, append=len(points))
        place = np.arange(1, len(points) + 1, dtype=np.uint64)
        place -= np.repeat(starts.astype(np.uint64), lengths)
        # a 64-bit sum of mixed (code point, place) pairs stands for a piece
        mixed = points * np.uint64(0x9E3779B97F4A7C15) + place * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        keys, seen, which = np.unique(np.add.reduceat(mixed, starts), return_index=True, return_inverse=True)
        start, length, new = self._find(keys)
        if new.any():
            if len(self.known[0][0]) > self.most:
                self._forget()
                start, length, new = self._find(keys)
            at = starts[seen[new]]
            to = at + lengths[seen[new]]
            stops = kinds[at] == _STOP
            ids: list = [[END_ID] if s else None for s in stops]
            rest = np.flatnonzero(~stops)
            found = [raw[4 * a : 4 * b].decode("utf-32-le") for a, b in zip(at[rest].tolist(), to[rest].tolist(), strict=True)]
            for i, part in zip(rest, self._pieces(found, kinds[to[rest] - 1] == _SPACE), strict=True):
                ids[i] = part
            self._learn(keys[new], ids)
            start, length, _ = self._find(keys)
        length = length[which].astype(np.int64)
        end = np.cumsum(length)
        total = int(end[-1])
        gather = np.arange(total, dtype=np.int64) + np.repeat(start[which] - (end - length), length)
        return self.flat[gather], end[kinds[starts] == _STOP]


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The worker's encoder."""
    return worker_state(f"encoder:{vocabulary}", lambda: Encoder(vocabulary))
