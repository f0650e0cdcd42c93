"""Tokenizer access for executors: exact ids, with a bounded cache of text units.

A unit is a stretch of text that the tokenizer is certain to treat apart from its
neighbours, so the ids of a text are the ids of its units in order. Repeated
units are encoded once; new ones are encoded many at a time. Plain ones are joined as
running text and told apart by the tokens that begin (byte level) or end (word level) a
word; others are joined by a special token that the library splits off before
anything else. A mark behind a letter is a token boundary, so it's cut off first.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np

_SAFE = re.compile(f"(?<=[^\\s᠎]) (?=[^\\s᠎])")
_WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_FIRST = "\0"
#: Letters of which no Unicode version, normal form or lower case makes anything but one letter.
_LETTERS = frozenset(c for c in map(chr, range(0x130)) if c.isalpha())
#: Marks that are a token by themselves behind a letter and before white space.
_MARKS = ",.;:!?"


def mode_of(spec: dict) -> str:
    """byte, word or plain: which unit boundaries a tokenizer file guarantees."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    added = [a for a in spec.get("added_tokens") or []]
    if any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") or not a.get("special") or re.search(r"\s", a["content"]) for a in added) or not added:
        return "plain"
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"):
        return "byte"
    if pre.get("type") == "Sequence" and norm and norm.get("type") == "Sequence":
        first = (pre.get("pretokenizers") or [{}])[0]
        if first.get("type") == "Split" and first.get("pattern", {}).get("Regex") == _WORD_SPLIT and first.get("invert") and first.get("behavior") == "Removed":
            kinds = [n.get("type") for n in norm.get("normalizers", [])]
            if set(kinds) <= {"NFC", "Replace", "Lowercase"}:
                return "word"
    return "plain"


class UnitEncoder:
    """ids of texts as little-endian bytes; memory is bounded by ``keep`` units."""

    def __init__(self, tokenizer_json: str, dtype: str = "<u4", keep: int = 1_000_000, chunk_chars: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.mode = mode_of(spec)
        self.dtype, self.keep, self.chunk_chars = np.dtype(dtype), keep, chunk_chars
        self.special = [a["content"] for a in spec.get("added_tokens") or []]
        if self.special:
            self.sep, self.sep_id = self.special[-1], self.tok.token_to_id(self.special[-1])
        # Units met lately and those of the time before, which move up when met again.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks = {m: self._bytes(self.tok.encode(m, add_special_tokens=False).ids) for m in _MARKS}
        # Which ids begin a word with white space (byte level) or end a word (word level).
        vocab = self.tok.get_vocab()
        self.edge = np.zeros(max(vocab.values()) + 1, bool)
        word_end = (spec.get("model") or {}).get("end_of_word_suffix") or None
        if self.mode == "byte":
            self.edge[[i for t, i in vocab.items() if t[0] in "\u0120\u010a"]] = True
        elif self.mode == "word" and word_end:
            self.edge[[i for t, i in vocab.items() if t.endswith(word_end)]] = True

    def _bytes(self, ids) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _units(self, text: str) -> list[str]:
        if self.mode == "word":
            return text.replace("\n", " ").split(" ")
        # The library cuts a run of white space before its last character, so single
        # spaces and newlines, and pairs of them before a word, are certain cuts.
        if any(s in text for s in self.special):
            return [_FIRST + text]
        flat = text.replace("\n", " ")
        if flat.isprintable() and "   " not in flat and not flat.endswith("  "):
            parts = text.replace("\n", " \n").split(" ")
        else:
            parts = _SAFE.split(text)
        parts[0] = _FIRST + parts[0]
        return parts

    def _text(self, unit: str) -> str:
        if self.mode == "word":
            return unit
        if unit[:1] == _FIRST:
            return unit[1:]
        return unit if unit[:1] == "\n" else " " + unit

    def _encode(self, units: list[str]) -> None:
        """Put ids of units none of which is encoded yet into the cache."""
        if any(s in "\n".join(units) for s in self.special):
            self.cache.update(self._apart(units))
            return
        lines: list[str] = []
        if self.mode == "byte":
            plain = [u for u in units if u and u.isprintable() and " " not in u]
            lines = [u for u in units if u[:1] == "\n" and len(u) > 1 and u[1:].isprintable() and " " not in u]
        else:
            plain = [u for u in units if u.isalpha() and _LETTERS.issuperset(u)]
        if self._running(plain, " ") + self._running(lines, "") < len(units):
            self.cache.update(self._apart([u for u in units if u not in self.cache]))

    def _running(self, units: list[str], gap: str, step: int = 512) -> int:
        """Encode units as they stand in running text, one edge token to a unit; how many went into the cache."""
        done, groups = 0, [units[i : i + step] for i in range(0, len(units), step)]
        before, after = (gap, "") if self.mode == "byte" else ("", gap)
        joined = [before + gap.join(g) + after for g in groups]
        for group, e in zip(groups, self.tok.encode_batch_fast(joined, add_special_tokens=False) if joined else [], strict=True):
            ids = np.array(e.ids, np.int64)
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) != len(group):  # left to the caller
                continue
            raw = ids.astype(self.dtype).tobytes()
            cuts = ((np.append(edges, len(ids)) if self.mode == "byte" else np.append(0, edges + 1)) * self.dtype.itemsize).tolist()
            self.cache.update(zip(group, map(raw.__getitem__, map(slice, cuts[:-1], cuts[1:])), strict=True))
            done += len(group)
        return done

    def _apart(self, units: list[str]) -> dict[str, bytes]:
        """ids of any units, joined by a special token where there is one."""
        out: dict[str, bytes] = {}
        joint, alone = [], []
        for u in units:
            (alone if not self.special or any(s in u for s in self.special) else joint).append(u)
        texts = [self.sep.join(map(self._text, joint[i : i + 256])) for i in range(0, len(joint), 256)]
        for i, e in enumerate(self.tok.encode_batch_fast(texts, add_special_tokens=False) if texts else []):
            group = joint[256 * i : 256 * i + 256]
            ids = np.array(e.ids, dtype=np.int64)
            cuts = np.flatnonzero(ids == self.sep_id)
            raw, width = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            starts = np.concatenate(([0], cuts + 1)).tolist()
            ends = np.concatenate((cuts, [len(ids)])).tolist()
            for u, a, b in zip(group, starts, ends, strict=True):
                out[u] = raw[a * width : b * width]
        for u in alone:
            out[u] = self._bytes(self.tok.encode(self._text(u), add_special_tokens=False).ids)
        return out

    def _learn(self, new: set[str]) -> None:
        """Put units into the cache; those that end in a mark by way of what stands before it."""
        cache, marks = self.cache, self.marks
        ending = [u for u in new if u[-1:] in marks and u[-2:-1] in _LETTERS]
        new.difference_update(ending)
        new.update([u[:-1] for u in ending])
        self._encode([u for u in new if u not in cache])
        cache.update([(u, cache[u[:-1]] + marks[u[-1]]) for u in ending])

    def encode(self, texts: list[str]):
        """Yield the ids of each text as bytes, in order."""
        from .common import chunks

        for a, b in chunks([len(t) for t in texts], self.chunk_chars):
            if self.mode == "plain":
                for e in self.tok.encode_batch(texts[a:b], add_special_tokens=False):
                    yield self._bytes(e.ids)
                continue
            if 2 * len(self.cache) > self.keep:
                self.cache, self.older = {}, self.cache
            parts = [self._units(t) for t in texts[a:b]]
            cache, older = self.cache, self.older
            new = set(chain.from_iterable(parts)).difference(cache)
            if new and older:
                again = [u for u in new if u in older]
                cache.update(zip(again, map(older.__getitem__, again), strict=True))
                new.difference_update(again)
            if new:
                self._learn(new)
            ids = cache.__getitem__
            for p in parts:
                yield b"".join(map(ids, p))


_encoders: dict[tuple, UnitEncoder] = {}


def encoder(tokenizer_json: str, dtype: str = "<u4", **bounds: int) -> UnitEncoder:
    """One encoder for each worker process and tokenizer, kept from task to task."""
    key = (hash(tokenizer_json), len(tokenizer_json), dtype, *bounds.values())
    if key not in _encoders:
        _encoders[key] = UnitEncoder(tokenizer_json, dtype, **bounds)
    return _encoders[key]


def load(spark, path: str):
    """The tokenizer file, read once by the driver and broadcast (a few MB at most)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())
