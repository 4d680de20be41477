"""Exact token ids of whole texts by the public tokenizers' libraries, by cached chunks.

A byte-level BPE with the usual pattern never joins a non-space character and
the white space after it in one pre-token, so a text is split there: a chunk is
a run of ASCII white space and the run of other characters after it. Chunks
repeat like words do: of a batch, each different one is encoded once by the
library and then looked up by a 64-bit hash of its bytes. Texts holding other
white space, where such a split could fall inside one pre-token, are split only
between an ASCII letter or digit and a space that another follows. Letters,
digits and punctuation of ASCII are different pre-tokens too, but for what
follows an apostrophe; so they are split as well, in texts without the strings
of special tokens.
"""

from __future__ import annotations

import base64
import json
import os

import numpy as np
import pyarrow as pa

from newsloom.llm import kernels as K

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ALNUM = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
#: Classes of bytes (1 letter, 2 digit, 3 punctuation, 4 apostrophe, 0 others), and of which two neighbours there is a split.
_CLASS = np.array([0 if b <= 32 or b >= 127 else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 4 if chr(b) == "'" else 3 for b in range(256)], np.uint8)
_PART = np.zeros(25, bool)
_PART[[5 * a + b for a, b in ((1, 2), (1, 3), (1, 4), (2, 1), (2, 3), (2, 4), (3, 1), (3, 2))]] = True
#: Bytes that may begin white space outside ASCII.
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True


def splits_at_spaces(path: str) -> bool:
    """Whether a tokenizers ``.json`` may be given chunks: no normaliser, byte-level with the library's own pattern, plain added tokens."""
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    way = held.get("pre_tokenizer") or {}
    usual = way.get("type") == "ByteLevel" and way.get("use_regex") is True and way.get("add_prefix_space") is False
    plain = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")) and not any(c.isspace() for c in t["content"]) for t in held.get("added_tokens") or ())
    return usual and plain and not held.get("normalizer") and not held.get("post_processor") and held["model"]["type"] == "BPE" and not held["model"].get("dropout")


def _other_space(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each text, whether it holds white space outside ASCII, a separator control or a zero-width character."""
    found = [np.flatnonzero((data >= 0x1C) & (data <= 0x1F))]
    at = np.flatnonzero(_LEAD[data])
    if len(at):
        a, b, c = data[at], data[np.minimum(at + 1, len(data) - 1)], data[np.minimum(at + 2, len(data) - 1)]
        odd = (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & ((b == 0x9A) | (b == 0xA0)) | (a == 0xE3) & (b == 0x80) & (c == 0x80) | (a == 0xEF) & (b == 0xBB)
        odd |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8F) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & ((c == 0x9F) | (c == 0xA0)))
        found.append(at[odd])
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, np.concatenate(found), "right") - 1] = True
    return out


def _holding(data: np.ndarray, offsets: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """Of each text, whether it holds one of the strings."""
    out, whole = np.zeros(len(offsets) - 1, bool), data.tobytes()
    for x in strings:
        at = whole.find(x)
        while at >= 0:
            out[np.searchsorted(offsets, at, "right") - 1] = True
            at = whole.find(x, at + 1)
    return out


def chunks(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of all texts, and n + 1 places of the texts' first ones."""
    n = len(data)
    begins = np.zeros(n + 1, bool)
    space = _SPACE[data]
    begins[1:n] = space[1:] & ~space[:-1]
    odd = _other_space(data, offsets)
    if odd.any():
        inside = np.repeat(odd, np.diff(offsets))
        plain = np.zeros(n, bool)
        plain[1:-1] = _ALNUM[data[:-2]] & (data[1:-1] == 0x20) & _ALNUM[data[2:]]
        begins[:n] = np.where(inside, plain, begins[:n])
    kind = _CLASS[data]
    parts = _PART[kind[:-1] * np.uint8(5) + kind[1:]]
    held = _holding(data, offsets, special)
    if held.any():
        parts &= ~np.repeat(held, np.diff(offsets))[1:]
    begins[1:n] |= parts
    begins[offsets[:-1]] = True  # an empty text begins where the next one does
    start = np.flatnonzero(begins[:n])
    return start, np.append(start[1:], n), np.searchsorted(start, offsets)


class Encoder:
    """The library's ids of texts, without begin, end or padding tokens and without truncation.

    name: a file of ``public_tokenizers``: a ``.json`` (library tokenizers), a
    ``.tiktoken`` or a sentencepiece ``.model``. Special strings inside texts
    are taken as the library's default has it. Chunks are used for such
    ``.json`` files as ``splits_at_spaces`` accepts; other kinds encode whole
    texts. The cache is dropped when it holds ``cached`` chunks or 16 million
    ids (some 40 bytes a chunk); chunks of more than ``longest`` bytes are not
    kept in it.
    """

    def __init__(self, name: str, cached: int = 1_000_000, longest: int = 48, path: str | None = None):
        if not path:
            import public_tokenizers

            path = public_tokenizers.path(name)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.cached, self.longest = cached, longest
        self._clear()
        self.by_chunk = False
        if name.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.by_chunk = splits_at_spaces(path)
            self.special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
            self.encode = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        elif name.endswith(".tiktoken"):
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            tokenizer = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [tokenizer.encode_ordinary(t) for t in texts]
        else:
            import sentencepiece

            tokenizer = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: tokenizer.encode(texts, num_threads=1)

    def _clear(self) -> None:
        self.keys, self.entry = np.zeros(0, K.U), np.zeros(0, np.int64)  # hashes of cached chunks in order, and their entries
        self.held = np.zeros(1 << 16, np.uint32)  # ids of all entries, one after another
        self.at = np.zeros(1, np.int64)  # n + 1 places

    def _learn(self, texts: list[str]) -> int:
        """Encode texts, in batches balanced by bytes, and append their ids; the number of the first."""
        first, found, batch, size = len(self.at) - 1, [], [], 0
        for t in texts:
            batch.append(t)
            size += len(t)
            if size >= 1_000_000:
                found += self.encode(batch)
                batch, size = [], 0
        found += self.encode(batch) if batch else []
        ends = self.at[-1] + np.cumsum([len(x) for x in found], dtype=np.int64)
        if len(ends) and ends[-1] > len(self.held):
            self.held = np.resize(self.held, max(2 * len(self.held), int(ends[-1])))
        for x, a, b in zip(found, [int(self.at[-1]), *ends[:-1].tolist()], ends.tolist(), strict=True):
            self.held[a:b] = x
        self.at = np.concatenate([self.at, ends])
        return first

    def _entries(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each chunk."""
        if len(self.keys) > self.cached or self.at[-1] > 1 << 24:
            self._clear()
        key, first, back = np.unique(K.span_hashes(data, start, end), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, key)
        entry = np.full(len(key), -1, np.int64)
        there = np.flatnonzero(place < len(self.keys))
        there = there[self.keys[place[there]] == key[there]]
        entry[there] = self.entry[place[there]]
        new = np.flatnonzero(entry < 0)
        if len(new):
            a, b = start[first[new]], end[first[new]]
            whole = data.tobytes()
            at = self._learn([whole[x:y].decode(errors="replace") for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            entry[new] = at + np.arange(len(new))
            short = new[b - a <= self.longest]
            self.keys, self.entry = np.insert(self.keys, place[short], key[short]), np.insert(self.entry, place[short], entry[short])
        return entry[back]

    def _encoded(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Entries of all chunks of a string column, null texts empty, and n + 1 places by text."""
        if self.by_chunk:
            data, offsets = K.strings(column)
            start, end, by_text = chunks(data, offsets, self.special)
            return (self._entries(data, start, end) if len(start) else np.zeros(0, np.int64)), by_text
        self._clear()
        texts = [t or "" for t in column.to_pylist()]
        self._learn(texts)
        return np.arange(len(texts)), np.arange(len(texts) + 1)

    def lengths(self, column: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        entry, by_text = self._encoded(column)
        total = np.concatenate([[0], np.cumsum(self.at[entry + 1] - self.at[entry])])
        return total[by_text[1:]] - total[by_text[:-1]]

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as uint32, n + 1 places by text)."""
        entry, by_text = self._encoded(column)
        size = self.at[entry + 1] - self.at[entry]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.held[np.repeat(self.at[entry] - total[:-1], size) + np.arange(total[-1])], total[by_text]


_encoders: dict[tuple, Encoder] = {}


def encoder(name: str, path: str | None = None) -> Encoder:
    """One per worker process, its cache kept between batches."""
    if (name, path) not in _encoders:
        _encoders[name, path] = Encoder(name, path=path)
    return _encoders[name, path]
