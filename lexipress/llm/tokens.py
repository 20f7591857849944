"""Tokenising whole texts with a public vocabulary, one library call per distinct piece.

A byte-pair vocabulary encodes the pieces of its pre-tokenisation apart, so the ids of a
text are the ids of its pieces in a row.  Pieces are cut in numpy, over the code points of
a batch, by the classes letter, number, white space and other; their 64-bit hashes are
looked up in an open-addressing table that names each known piece's place in a pool of
ids.  Only pieces that a worker has not met go through the tokenizers library.  A hit must
also agree in a second hash of 32 bits.

Where a rule of the vocabulary cannot be told from single characters, the library encodes
the text whole: texts with the literal of an added token, with characters that Unicode
had not assigned in this Python or that change their number in lower case, and, for
vocabularies that normalise, texts that are not in composed form.  So it does with all
texts if the vocabulary has another layout than the two known ones.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np

from .textkernel import mix

#: White space of Unicode: fixed values, as the pre-tokenizers' ``\\s`` takes them.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Code points whose class and lower case are tabled; later ones are left to the library.
TABLED = 0x20000
LETTER, NUMBER, SPACE, OTHER, UNSURE = range(5)
#: Characters cut at once; longer texts are cut before a single space, which begins a piece.
SLICE = 1 << 18
#: Pieces, and ids of pieces, that a worker remembers before it starts anew (about 100 MB).
REMEMBERED = 1 << 20
POOLED = 1 << 23
#: New pieces that the library gets in one string.
TOGETHER = 24
END_ID = 0
#: Letters that go with an apostrophe before them.
_ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
#: The pattern by which the word vocabulary splits.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_U = np.uint64
_CUT = re.compile(f"(?<=[^{SPACES}]) (?=[^{SPACES}])")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def classes(lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Class and (if ``lower``) lower case of each code point; the last entry stands for all later ones."""
    of = np.full(TABLED + 1, UNSURE, dtype=np.uint8)
    low = np.arange(TABLED + 1, dtype=np.uint32)
    for c in range(TABLED):
        kind = unicodedata.category(x := chr(c))
        if kind in ("Cn", "Cs"):
            continue
        of[c] = SPACE if x in SPACES else LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER
        if lower and (y := x.lower()) != x:
            if len(y) > 1 or ord(y) >= TABLED:
                of[c] = UNSURE
            else:
                low[c] = ord(y)
    if lower:
        of = np.where(of == UNSURE, UNSURE, of[low]).astype(np.uint8)
    return of, low


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, base, dtype=_U), np.full(n + 1, pow(base, -1, 1 << 64), dtype=_U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _hash(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    up, down = _powers(base, max(4 * SLICE, 1 << int(len(points)).bit_length()))
    run = np.zeros(len(points) + 1, dtype=_U)
    np.cumsum((points + _U(1)) * up[: len(points)], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(_U))


class _Pieces:
    """Open-addressing table from the hashes of a piece to the place and number of its ids."""

    def __init__(self, dtype):
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.known = self.used = 0
        self.pool = np.zeros(1 << 16, dtype=self.dtype)
        self._size(1 << 16)

    def _size(self, n: int) -> None:
        self.keys, self.checks, self.places = np.zeros(n, dtype=_U), np.zeros(n, dtype=np.uint32), np.zeros(n, dtype=np.int64)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (start in the pool << 24 | number of ids) and which keys are known."""
        mask = _U(len(self.keys) - 1)
        slot = (keys & mask).astype(np.int64)
        there = self.keys[slot]
        ok = there == keys
        left = np.flatnonzero(~ok & (there != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & int(mask)
            there = self.keys[slot[left]]
            ok[left] = there == keys[left]
            left = left[(there != keys[left]) & (there != 0)]
        ok &= self.checks[slot] == checks
        return self.places[slot], ok

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Different keys that are not known yet, and their ids in a row."""
        at = self.used + np.cumsum(counts) - counts
        if self.used + len(ids) > len(self.pool):
            more = np.zeros(1 << int(self.used + len(ids)).bit_length(), dtype=self.dtype)
            more[: self.used] = self.pool[: self.used]
            self.pool = more
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        places = (at << 24) | counts
        if 2 * (self.known + len(keys)) > len(self.keys):
            old = np.flatnonzero(self.keys)
            before = self.keys[old], self.checks[old], self.places[old]
            self._size(1 << int(2 * (self.known + len(keys))).bit_length())
            self._put(*before)
        self._put(keys, checks, places)
        self.known += len(keys)

    def _put(self, keys: np.ndarray, checks: np.ndarray, places: np.ndarray) -> None:
        mask = len(self.keys) - 1
        left, slot = np.arange(len(keys)), (keys & _U(mask)).astype(np.int64)
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = keys[free]  # of several for one slot, one stays
            mine = free[self.keys[slot[free]] == keys[free]]
            self.checks[slot[mine]], self.places[slot[mine]] = checks[mine], places[mine]
            done = np.zeros(len(keys), dtype=bool)
            done[mine] = True
            left = left[~done[left]]
            slot[left] = (slot[left] + 1) & mask


class PieceEncoder:
    """``encode_bytes(texts)``: for each text its ids and END_ID, as little-endian bytes of ``dtype``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            layout = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = _layout(layout)
        self.added = [t["content"] for t in layout["added_tokens"]]
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.end = np.array([END_ID], dtype=self.dtype).tobytes()
        self.pieces = _Pieces(self.dtype)
        # A piece's first id begins with a space (byte-level), or its last one ends a word.
        self.edge = np.zeros(size, dtype=bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.edge[i] = token.startswith("Ġ") if self.kind == "bytes" else token.endswith("</w>")

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts as the library alone gives them."""
        return [np.array(e.ids, dtype=self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(b, dtype=self.dtype).astype("<u4") for b in self.encode_bytes(texts)]

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        odd = [] if self.kind else list(range(len(texts)))
        group: list[int] = []
        held = 0
        for k, text in enumerate(texts if self.kind else ()):
            if any(x in text for x in self.added) or self.kind == "words" and not unicodedata.is_normalized("NFC", text):
                odd.append(k)
                continue
            if len(text) > 2 * SLICE:
                odd += self._long(texts, k, out)
                continue
            group.append(k)
            held += len(text)
            if held >= SLICE:
                odd += self._cut(texts, group, out)
                group, held = [], 0
        if group:
            odd += self._cut(texts, group, out)
        for k, ids in zip(odd, self.whole([texts[k] for k in odd]) if odd else (), strict=True):
            out[k] = ids.tobytes() + self.end
        return out

    def _cut(self, texts: list[str], group: list[int], out: list) -> list[int]:
        """Ids of the texts of a group into ``out``; returns those that the library must encode whole."""
        odd = []
        flat, ends, sure = self._ids([texts[k] for k in group])
        data, width, at = flat.tobytes(), self.dtype.itemsize, 0
        for k, end, ok in zip(group, ends.tolist(), sure.tolist(), strict=True):
            if ok:
                out[k] = data[at * width : end * width] + self.end
            else:
                odd.append(k)
            at = end
        return odd

    def _long(self, texts: list[str], k: int, out: list) -> list[int]:
        found = []
        for part in _parts(texts[k]):
            flat, ends, sure = self._ids([part])
            if not sure[0]:
                return [k]
            found.append(flat[: ends[0]].tobytes())
        out[k] = b"".join([*found, self.end])
        return []

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, where each text's end, and which texts could be cut."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        text_ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
        table, low = classes(self.kind == "words")
        tabled = np.minimum(points, TABLED)
        of = table[tabled]
        sure = np.ones(len(texts), dtype=bool)
        sure[np.searchsorted(text_ends, np.flatnonzero(of == UNSURE), side="right")] = False
        if self.kind == "words":
            points = low[tabled]
        starts, ends = _boundaries(points, of, text_ends, self.kind == "bytes")
        wide = points.astype(_U)
        keys = np.maximum(_hash(wide, starts, ends, 0x9E3779B97F4A7C15), _U(1))
        checks = (_hash(wide, starts, ends, 0xC2B2AE3D27D4EB4F) >> _U(32)).astype(np.uint32)
        if self.pieces.known > REMEMBERED or self.pieces.used > POOLED:
            self.pieces.clear()
        places, ok = self.pieces.find(keys, checks)
        if not ok.all():
            new = np.flatnonzero(~ok)
            _, first = np.unique(keys[new], return_index=True)
            new = new[first]
            self._learn(joined, keys[new], checks[new], starts[new].tolist(), ends[new].tolist())
            places, ok = self.pieces.find(keys, checks)
            if not ok.all():  # two pieces of one key: no text with such a piece is cut
                sure[np.searchsorted(text_ends, starts[~ok], side="right")] = False
                places[~ok] = 0
        at, counts = places >> 24, places & 0xFFFFFF
        to = np.cumsum(counts)
        total = int(to[-1]) if len(to) else 0
        flat = self.pieces.pool[np.repeat(at - (to - counts), counts) + np.arange(total)]
        last = np.searchsorted(starts, text_ends)  # pieces before each text's end
        return flat, np.concatenate(([0], to))[last], sure

    def _learn(self, joined: str, keys: np.ndarray, checks: np.ndarray, starts: list[int], ends: list[int]) -> None:
        texts = [joined[a:b] for a, b in zip(starts, ends, strict=True)]
        if self.kind == "bytes":
            together = [k for k, x in enumerate(texts) if x[0] == " " and len(x) > 1]
            apart = [k for k, x in enumerate(texts) if x[0] != " " or len(x) == 1]
        else:
            together, apart = list(range(len(texts))), []
        order: list[int] = []
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        groups = [together[k : k + TOGETHER] for k in range(0, len(together), TOGETHER)]
        between = "" if self.kind == "bytes" else " "
        for group, got in zip(groups, self.whole([between.join([texts[k] for k in g]) for g in groups]), strict=True):
            at = np.flatnonzero(self.edge[got])
            if len(at) == len(group):
                order += group
                ids.append(got)
                counts.append(np.diff(np.append(at, len(got))) if self.kind == "bytes" else np.diff(at, prepend=-1))
            else:
                apart += group
        for k, got in zip(apart, self.whole([texts[k] for k in apart]), strict=True):
            if len(got) <= 0xFFFFFF:
                order.append(k)
                ids.append(got)
                counts.append(np.array([len(got)]))
        if order:
            self.pieces.add(keys[order], checks[order], np.concatenate(ids), np.concatenate(counts))


def _layout(layout: dict) -> str | None:
    """``bytes`` or ``words``, for the two layouts whose pieces are known; None otherwise."""
    model, pre, norm = layout["model"], layout["pre_tokenizer"] or {}, layout["normalizer"]
    if model.get("type") != "BPE" or model.get("dropout") or layout["post_processor"] or any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in layout["added_tokens"]):
        return None
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "bytes"
    inner = pre.get("pretokenizers") or [{}, {}]
    named = [x["type"] for x in (norm or {}).get("normalizers", [])]
    split = inner[0].get("type") == "Split" and inner[0]["pattern"].get("Regex") == _WORD_SPLIT and inner[0].get("invert")
    if named == ["NFC", "Replace", "Lowercase"] and split and len(inner) == 2 and inner[1].get("type") == "ByteLevel" and not inner[1].get("use_regex") and model.get("end_of_word_suffix") == "</w>":
        return "words"
    return None


def _parts(text: str):
    """Stretches of a long text; every cut is before a single space."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + SLICE) if at + SLICE < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _boundaries(points: np.ndarray, of: np.ndarray, text_ends: np.ndarray, spaces: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all pieces.

    With ``spaces`` white space belongs to pieces: a single space to what follows it, and
    the last of several characters likewise, the others make a piece.  Without, it parts
    them only, and numbers are pieces by the digit.
    """
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    opens = np.zeros(n + 1, dtype=bool)  # a text starts here
    opens[0] = opens[n] = True
    opens[text_ends] = True
    start = opens.copy()
    start[1:n] |= of[1:] != of[:-1]
    blank = of == SPACE
    if spaces:
        last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~opens[1:n])
        start[last] = True
        start[last[points[last] == 0x20] + 1] = False
    else:
        start[:n] |= of == NUMBER
    marks = np.flatnonzero((points == 0x27) & start[:n])
    marks = marks[~opens[marks + 1]]
    if len(marks):
        after = points[marks + 1]
        more = np.where(opens[marks + 2], 0, points[np.minimum(marks + 2, n - 1)])
        for ending in _ENDINGS:
            fits = marks[(after == ord(ending[0])) & ((more == ord(ending[1])) if len(ending) > 1 else True)]
            start[fits + 1] = False
            start[fits + 1 + len(ending)] = True
    at = np.flatnonzero(start)
    starts, ends = at[:-1], at[1:]
    if not spaces:
        kept = ~blank[starts]
        starts, ends = starts[kept], ends[kept]
    return starts, ends


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each vocabulary and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Drop all encoders and what they remember."""
    _ENCODERS.clear()
