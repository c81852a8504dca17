"""Token ids of whole texts, with a bounded per-process memory of pieces.

The public byte-level BPE never joins bytes across a single space or newline
that stands between two non-space characters, so a text may be cut before
every such byte: its ids are the ids of its pieces one after another. Cuts
are found on the bytes of many texts at once; Arrow numbers the different
pieces of a run, each is looked up once, and ids are gathered from one flat
array. Only pieces not seen before reach the tokenizers library, many per
call. White space of any other kind stays inside a piece, whole.
"""

from __future__ import annotations

import os

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
RUN = 1 << 24  # bytes of text encoded at a time
GROUP = 256
MOST_PIECES = 900_000
MOST_BYTES = 48 << 20  # of remembered pieces, in all
_loaded: dict[str, Encoder] = {}

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True  # first bytes of other white space in UTF-8
_MARKS = ".,;:!?"


def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space, beyond ASCII too."""
    out = _SPACE[data]
    at = np.flatnonzero(_LEAD[data])
    if len(at):
        d = np.concatenate([data, np.zeros(2, np.uint8)])
        a, b, c = d[at], d[at + 1], d[at + 2]
        two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        e2 = (a == 0xE2) & (((b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
        three = e2 | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        for k, which in ((0, two | three), (1, two | three), (2, three)):
            out[at[which] + k] = True
    return out


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the pieces of all texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    space = _spaces(data)
    gap = np.zeros(n, bool)
    gap[1:-1] = ((data[1:-1] == 32) | (data[1:-1] == 10)) & ~space[:-2] & ~space[2:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    gap[inner - 1] = False  # the last byte of a text has nothing after it
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    gap[first] = True
    return np.flatnonzero(gap)


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        width = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if width <= 1 << 16 else "<u4")
        self.newline = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.marks = {m: self.tokenizer.encode(m, add_special_tokens=False).ids for m in _MARKS}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0  # bytes of the known pieces
        self.flat, self.start, self.count, self.uses = np.zeros(1 << 16, self.dtype), *(np.zeros(1 << 14, np.int64) for _ in range(3))
        self.used = self.entries = 0

    def _store(self, pieces: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        for name, more in (("flat", self.used + len(ids)), ("start", self.entries + len(counts)), ("count", self.entries + len(counts)), ("uses", self.entries + len(counts))):
            array = getattr(self, name)
            if more > len(array):
                grown = np.zeros(max(more, 2 * len(array)), array.dtype)
                grown[:len(array)] = array
                setattr(self, name, grown)
        a, b = self.entries, self.entries + len(counts)
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[a:b] = self.used + np.cumsum(counts) - counts
        self.count[a:b], self.uses[a:b] = counts, 0
        self.known.update(zip(pieces, range(a, b), strict=True))
        self.held += sum(map(len, pieces))
        self.used, self.entries = self.used + len(ids), b

    def _drop_half(self) -> None:
        """Keeps the half of the pieces that most runs used, the newer first."""
        names, flat, start, count, uses = list(self.known), self.flat, self.start, self.count, self.uses
        at = np.sort(np.lexsort((np.arange(len(names)), uses[:len(names)]))[len(names) // 2:])
        self._forget()
        self._store([names[i] for i in at.tolist()], _gather(flat, start[at], count[at]), count[at])
        self.uses[:len(at)] = uses[at] // 2

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> list[int]:
        """Stores new pieces and returns the order in which it did. Many go in
        one call: a newline between two words is an id of its own, so it marks
        where a word's ids end; a mark after a letter at the end of a word is
        an id of its own too, so only the stem is encoded."""
        stems: dict[str, int] = {}
        plan, odd = [], []  # parallel lists of plain values: nothing for the garbage collector to walk
        newline, which, mark = [], [], []
        for k, p in enumerate(pieces):
            text = p.decode("utf-8", "replace")
            lead = text[0]
            word = text[1:] if lead == " " or lead == "\n" else text
            if not word or word[0].isspace() or word[-1].isspace():
                odd.append(k)
                continue
            stem, m = (word if lead == "\n" else text), 0
            if word[-1] in _MARKS and word[-2:-1].isalpha():
                stem, m = stem[:-1], 1 + _MARKS.index(word[-1])
            plan.append(k)
            newline.append(lead == "\n")
            mark.append(m)
            which.append(stems.setdefault(stem, len(stems)))
        names = list(stems)
        flat, start, count = self._ids_of(names)
        which, newline, mark = np.array(which, np.int64), np.array(newline, bool), np.array(mark, np.int64)
        # newline, stem, mark: three entries of one table per piece
        marks = [np.array(m, self.dtype) for m in ([], *self.marks.values())]
        table = np.concatenate([flat, [self.newline], *marks]).astype(self.dtype)
        at = len(flat) + 1 + np.cumsum([0, *map(len, marks)])[:-1]
        sizes = np.array([len(m) for m in marks])
        three = np.stack([np.full(len(plan), len(flat)), start[which], at[mark]], axis=1).ravel(), np.stack([newline.astype(np.int64), count[which], sizes[mark]], axis=1).ravel()
        ids, counts = _gather(table, *three), three[1].reshape(-1, 3).sum(axis=1)
        rest = self._encode([pieces[k].decode("utf-8", "replace") for k in odd])
        ids = np.concatenate([ids, np.array([i for x in rest for i in x], self.dtype)])
        order = plan + odd
        self._store([pieces[k] for k in order], ids, np.concatenate([counts, np.array([len(x) for x in rest], np.int64)]))
        return order

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, number) of words, ``GROUP`` of them in a call's text."""
        first, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        parts, done = [], 0
        for a in range(0, len(words), 64 * GROUP):
            groups = [words[b:b + GROUP] for b in range(a, min(a + 64 * GROUP, len(words)), GROUP)]
            for k, (group, got) in enumerate(zip(groups, self._encode(["\n".join(g) + "\n" for g in groups]), strict=True)):
                ids = np.array(got, self.dtype)
                ends = np.flatnonzero(ids == self.newline)
                if len(ends) != len(group):  # a newline inside a word
                    each = self._encode(group)
                    ids = np.array([i for x in each for i in (*x, self.newline)], self.dtype)
                    ends = np.cumsum([len(x) + 1 for x in each]) - 1
                begin = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
                at = slice(a + k * GROUP, a + k * GROUP + len(group))
                first[at], number[at] = done + begin, ends - begin
                parts.append(ids)
                done += len(ids)
        return np.concatenate([np.zeros(0, self.dtype), *parts]), first, number

    def encode_run(self, data: np.ndarray, offsets: np.ndarray, most: int = MOST_PIECES) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of texts one after another, and where each
        text's begin; ``data`` and ``offsets`` are a run of ``text_runs``. Over
        ``most`` remembered pieces half of them are dropped first."""
        import pyarrow as pa

        first = cuts(data, offsets)
        if not len(first):
            return np.zeros(0, self.dtype), np.zeros(len(offsets), np.int64)
        ends = np.append(first, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        names = pieces.dictionary.to_pylist()
        if self.entries + len(names) > most or self.held > MOST_BYTES:
            self._drop_half()
        entry = list(map(self.known.get, names))
        if None in entry:
            new = [i for i, e in enumerate(entry) if e is None]
            at = self.entries
            order = self._learn([names[i] for i in new])
            for k, i in enumerate(order):
                entry[new[i]] = at + k
        entry = np.array(entry, np.int64)
        self.uses[entry] += 1
        entry = entry[pieces.indices.to_numpy()]
        counts = self.count[entry]
        done = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        return _gather(self.flat, self.start[entry], counts), done[np.searchsorted(first, offsets)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian bytes of ``dtype``."""
        raw = [t.encode() for t in texts]
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(r) for r in raw], dtype=np.int64)])
        ids, bounds = self.encode_run(np.frombuffer(b"".join(raw), np.uint8), offsets)
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def _gather(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[start:start + count] of every entry, joined."""
    before = np.cumsum(count) - count
    return flat[np.repeat(start - before, count) + np.arange(int(count.sum()))]


def encoder(path: str | None = None) -> Encoder:
    """The encoder of a vocabulary file, loaded once per worker process; by
    default the public one that is installed where the task runs."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
