"""Token ids by a public tokenizer file, exact, with a bounded cache of words.

A byte-level BPE never joins across a single space between two non-space characters:
the space begins the next word. So many texts are cut at their spaces by Arrow at once, and each
different piece is cut once into words by the scheme's own pattern, where that is certain
(``CERTAIN``); other pieces stay as they are. Each different word is looked up once; new ones go through
the library in few calls. Arrow then puts the words' ids together in the texts' order.
A text that holds an added token of the file ("<|endoftext|>") is encoded in one call.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACED = re.compile("[\\s\u180e]")
CACHE_PIECES = 600_000  # words of a generation at most; beyond half of them the next batch begins a new one
LONGEST_CACHED = 64
JOINED = 64  # words without white space that one call encodes as the lines of a text
# Texts that are encoded together, and their bytes (one text may be longer): each word of theirs is looked up once.
BATCH_ROWS, BATCH_CHARS = 5_000, 8_000_000
# The pattern's classes (letter, digit, white space, other) are beyond doubt for these characters.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ώЀ-ҁ"
KNOWN = f"!-~{LETTERS}–—‘’“”…"
CERTAIN = f"\\A[{KNOWN}](?:[{KNOWN}\n]*[{KNOWN}])?\\z"  # for Arrow
WORD = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[0-9]+| ?[^\\s{LETTERS}0-9]+|\\s+(?!\\S)|\\s+")

ONE_WORD = re.compile(f"[{LETTERS}]+|[0-9]+|[!-/:-@[-`{{-~–—‘’“”…]+")  # also behind a space


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


CHARACTERS = byte_characters()


class Encoder:
    """Encodes whole texts to little-endian id arrays, as the library's plain call does."""

    def __init__(self, path: str) -> None:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split
        self.tokenizer = Tokenizer.from_file(path)
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if wide else "<u2")
        self.recent: dict[str, bytes] = {}  # word, with the space that precedes it -> ids
        self.older: dict[str, bytes] = {}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Cutting at spaces is proven for the byte-level scheme only; line ends join pieces.
        self.cuts = type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" \
            and self.tokenizer.normalizer is None and not any("\n" in a for a in self.added)
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids[0] \
            if self.cuts else None
        # The pattern that words end by is part of the scheme unless the file turns it off.
        scheme = json.loads(self.tokenizer.to_str())["pre_tokenizer"] if self.cuts else {}
        self.splits = self.cuts and scheme.get("use_regex", True) and not scheme.get("add_prefix_space")
        # The file's model by itself, for words that the pattern has cut, one a line.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = Split(CHARACTERS[ord("\n")], "isolated")

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def encode(self, texts: pa.Array | Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text (null: none); whole texts, of any length."""
        return [np.frombuffer(b, self.dtype) for b in self.encode_bytes(texts)]

    def encode_bytes(self, texts: pa.Array | Sequence[str | None], end: bytes = b"") -> list[bytes]:
        """The same ids as bytes, each text's followed by ``end``."""
        column = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) \
            else pa.array(texts, pa.large_string())
        column = pc.fill_null(column, "")
        if not len(column):
            return []
        if not self.cuts:
            return [b + end for b in self._ids(column.to_pylist())]
        whole = np.zeros(len(column), dtype=bool)  # texts that are encoded in one
        for a in self.added:
            whole |= pc.match_substring(column, a).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(whole), "", column) if whole.any() else column, " ")
        starts = lists.offsets.to_numpy()
        pieces, at = _distinct(lists.values)
        heads, head_at = _distinct(lists.values.take(pa.array(starts[:-1])))
        heads = _strings(heads)
        at[starts[:-1]] = len(pieces) + head_at
        ids = pa.concat_arrays([self._behind_spaces(pieces), pa.array(self._lines(heads, ""), pa.large_binary())])
        if ids.null_count:  # white space beside a cut
            whole |= np.logical_or.reduceat(ids.is_null().to_numpy(zero_copy_only=False)[at], starts[:-1])
        offsets, data = _buffers(ids.take(pa.array(at)))
        cuts = offsets[starts].tolist()
        out = [b"".join((data[a:b], end)) for a, b in zip(cuts, cuts[1:])]
        for k in np.flatnonzero(whole).tolist():
            out[k] = self._ids([column[k].as_py()])[0] + end
        return out

    def _behind_spaces(self, pieces: pa.Array) -> pa.Array:
        """Ids of each piece behind a space; null if white space stands at an end of it."""
        certain = pc.match_substring_regex(pieces, CERTAIN).to_numpy(zero_copy_only=False) if self.splits \
            else np.zeros(len(pieces), dtype=bool)
        units = WORD.findall(" " + " ".join(_strings(pieces.filter(pa.array(certain))))) if certain.any() else []
        units += [f" {p}" for p in _strings(pieces.filter(pa.array(~certain)))]
        units, at = _distinct(pa.array(units, pa.large_string()))
        first = np.flatnonzero(pc.starts_with(units, " ").to_numpy(zero_copy_only=False)[at])  # a piece begins
        ids = self._remembered(_strings(units)).take(pa.array(at))
        offsets, data = _buffers(ids)
        known = ids.is_valid().to_numpy(zero_copy_only=False)[first]  # no other word of a certain piece is unknown
        joined = pa.Array.from_buffers(
            pa.large_binary(), len(first),
            [pa.array(known).buffers()[1], pa.py_buffer(np.append(offsets[first], offsets[-1])), pa.py_buffer(data)])
        place = np.empty(len(pieces), dtype=np.int64)
        place[np.append(np.flatnonzero(certain), np.flatnonzero(~certain))] = np.arange(len(pieces))
        return joined.take(pa.array(place))

    def _remembered(self, words: list[str]) -> pa.Array:
        """Ids of different words; null for white space beside a space."""
        if len(self.recent) > CACHE_PIECES // 2:  # words in use come back from the older half
            self.older, self.recent = self.recent, {}
        ids = list(map(self.recent.get, words))
        places = [k for k, b in enumerate(ids) if b is None]
        missed = [words[k] for k in places]
        found = list(map(self.older.get, missed))
        new = [k for k, b in enumerate(found) if b is None]
        for k, b in zip(new, self._new([missed[k] for k in new]), strict=True):
            found[k] = b
        room = CACHE_PIECES - len(self.recent)
        for k, w, b in zip(places, missed, found, strict=True):
            ids[k] = b
            if room > 0 and b is not None and len(w) <= LONGEST_CACHED:
                self.recent[w] = b
                room -= 1
        return pa.array(ids, pa.large_binary())

    def _new(self, words: list[str]) -> list[bytes | None]:
        """Ids of words that aren't remembered."""
        spaced = iter(self._lines([w[1:] for w in words if w[0] == " "], " "))
        bare = iter(self._lines([w for w in words if w[0] != " "], ""))
        out = [next(spaced if w[0] == " " else bare) for w in words]
        for k, w in enumerate(words):
            if out[k] is None and w[0] != " ":  # line ends within a piece
                out[k] = self._ids([w])[0]
        return out

    def _lines(self, pieces: list[str], before: str) -> list[bytes | None]:
        """Ids of each piece behind ``before``; None if white space stands at an end of it.

        A line end never joins with what stands around it, so pieces without white space
        are encoded as the lines of few texts.
        """
        out: list[bytes | None] = [None] * len(pieces)
        words, simple, inside = [], [], []
        for k, p in enumerate(pieces):
            if not p:
                continue
            if not SPACED.search(p):
                (words if self.splits and ONE_WORD.fullmatch(p) else simple).append(k)
            elif not SPACED.match(p[0]) and not SPACED.match(p[-1]):
                inside.append(k)
        for k, ids in zip(inside, self._ids([before + pieces[k] for k in inside]), strict=True):
            out[k] = ids
        for places, library in ((words, self.model), (simple, self.tokenizer)):
            groups = [places[a:a + JOINED] for a in range(0, len(places), JOINED)]
            texts = [before + f"\n{before}".join([pieces[k] for k in g]) for g in groups]
            if library is self.model:
                texts = [t.encode().decode("latin-1").translate(CHARACTERS) for t in texts]
            for g, e in zip(groups, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(e.ids, dtype=self.dtype)
                raw, size = ids.tobytes(), self.dtype.itemsize
                begin = 0
                for k, end in zip(g, [*np.flatnonzero(ids == self.line_end).tolist(), len(ids)],
                                  strict=True):
                    out[k] = raw[begin * size:end * size]
                    begin = end + 1
        return out


def _distinct(strings: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different strings, and the place of each row's among them."""
    coded = strings.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _buffers(column: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Offsets (one more than rows) and bytes of a new large_binary column."""
    _, offsets, data = column.buffers()
    return np.frombuffer(offsets, np.int64, len(column) + 1), memoryview(b"" if data is None else data)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The Python worker's encoder for a tokenizer file (loaded once a worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def batches(table, size: int = 128, chars: int = 4_000_000):
    """Slices of an Arrow batch of at most ``size`` rows, fewer where texts are long."""
    at, n = 0, table.num_rows
    while at < n:
        part = table.slice(at, size)
        while part.num_rows > 1 and part.nbytes > chars:
            part = part.slice(0, max(1, part.num_rows // 2))
        yield part
        at += part.num_rows
