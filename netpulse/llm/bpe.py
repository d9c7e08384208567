"""Byte-level BPE encoding and decoding through a pair occurrence index.

A tokenizer file is read once on the driver and shipped with the tasks.  Inside a
task the texts of an Arrow batch are cut into pre-tokens, and all pre-tokens not
met before are laid out in one symbol array.  An index maps each mergeable pair
to all its positions in that array; the active ranks are applied in ascending
order, each to all its positions at once, and the lists of the pairs that appear
beside a merge are updated.  Results are held per word in a bounded cache, so a
common word is merged once per worker.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from .common import pick

#: The pre-token pattern of byte-level BPE (a fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words and their characters held per worker; beyond either the cache starts anew, which costs time only.
CACHE_WORDS = 250_000
CACHE_CHARS = 1 << 24


@lru_cache(maxsize=1)
def character_classes() -> tuple[str, str, str]:
    """Letters and numbers as the tokenizer library knows them, and the characters the pattern matcher here sees otherwise.

    Each is the inside of a character class.  The two hold tables of different Unicode versions.
    """
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))

    def spans(members: np.ndarray) -> str:
        edges = np.flatnonzero(np.diff(np.concatenate(([0], members.astype(np.int8), [0]))))
        return "".join(f"\\U{ord(text[lo]):08X}-\\U{ord(text[hi - 1]):08X}" for lo, hi in edges.reshape(-1, 2))

    def marked(found) -> np.ndarray:
        members = np.zeros(len(text), bool)
        for lo, hi in found:
            members[lo:hi] = True
        return members

    odd, classes = np.zeros(len(text), bool), []
    for name in (r"[\p{L}]+", r"[\p{N}]+"):
        theirs = marked(span for _, span in Split(Regex(name), "removed", invert=True).pre_tokenize_str(text))
        odd |= theirs != marked(m.span() for m in regex.finditer(name, text))
        classes.append(spans(theirs))
    return classes[0], classes[1], spans(odd)


class Cutter:
    """The pre-tokens of a text by a pattern over ``\\p{L}`` and ``\\p{N}``, with the library's own classes where they matter."""

    def __init__(self, pattern: str, classes: tuple[str, str, str]):
        letters, numbers, odd = classes
        self._plain = regex.compile(pattern).findall
        self._exact = regex.compile(pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers)).findall
        self._odd = regex.compile(f"[{odd}]").search if odd else lambda text: None

    def findall(self, text: str) -> list[str]:
        return self._plain(text) if text.isascii() or not self._odd(text) else self._exact(text)


def byte_alphabet() -> dict[str, int]:
    """The format's stand-in character of each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(0x100 + i): b for i, b in enumerate(hidden)}}


class PairTable:
    """Merge ranks and results by pair of ids, looked up for whole arrays."""

    def __init__(self, merges: list[tuple[int, int, int]], width: int):
        self.left, self.right, self.result = np.array(merges, np.int64).reshape(-1, 3).T.copy()
        self.none = len(merges)
        keys = self.left * width + self.right
        # a repeated pair keeps its last rank, as in a map filled in file order
        order = np.argsort(keys, kind="stable")
        last = np.append(keys[order][1:] != keys[order][:-1], True) if len(keys) else np.empty(0, bool)
        self.width = width
        self.keys = np.append(keys[order][last], np.iinfo(np.int64).max)
        self.ranks = np.append(order[last], self.none)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``none`` where it cannot be merged."""
        key = a * self.width + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)


def merge_by_pair_index(symbols: np.ndarray, starts: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge all words laid out in ``symbols`` (word ``i`` from ``starts[i]``): merged ids, ids per word."""
    n = len(symbols)
    sym = np.append(symbols.astype(np.int64), -1)  # slot n stands for "no neighbour"
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[n] = n
    after[np.append(starts[1:], n) - 1] = n
    before[starts] = n
    before = np.append(before, n)

    occurrences: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def index(at: np.ndarray) -> None:
        rank = table.rank(sym[at], sym[after[at]])
        known = rank < table.none
        at, rank = at[known], rank[known]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(at)]
        for r, lo, hi in zip(rank[bounds[:-1]].tolist(), bounds, bounds[1:]):
            if r in occurrences:
                occurrences[r].append(at[lo:hi])
            else:
                occurrences[r] = [at[lo:hi]]
                heapq.heappush(active, r)

    index(np.flatnonzero(after[:n] != n))
    while active:
        rank = heapq.heappop(active)
        lists = occurrences.pop(rank)
        a, b, new = int(table.left[rank]), int(table.right[rank]), int(table.result[rank])
        p = lists[0] if len(lists) == 1 else np.concatenate(lists)
        p = p[(sym[p] == a) & (sym[after[p]] == b)]
        if a == b and len(p) > 1:  # in a run of equal symbols every second position, from the left
            p = np.unique(p)
            run = np.concatenate(([True], after[p[:-1]] != p[1:]))
            first = np.maximum.accumulate(np.where(run, np.arange(len(p)), 0))
            p = p[(np.arange(len(p)) - first) % 2 == 0]
        if not len(p):
            continue
        gone = after[p]
        follow = after[gone]
        sym[p], sym[gone] = new, -2
        after[p], before[follow] = follow, p
        left = before[p]
        near = np.concatenate((left, p))
        if len(p) > 1 and (sym[left] == new).any():  # neighbours merged together: name them once
            near = np.unique(near)
        index(near[near != n])
    alive = sym[:n] >= 0
    return sym[:n][alive], np.add.reduceat(alive, starts, dtype=np.int64) if len(starts) else np.empty(0, np.int64)


class ByteBpe:
    """Encoder and decoder of a byte-level BPE tokenizer file (``.json``)."""

    def __init__(self, file: bytes, classes: tuple[str, str, str] | None = None):
        spec = json.loads(file)
        model, added = spec["model"], spec.get("added_tokens", [])
        pre = spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or \
                not pre.get("use_regex", True) or spec.get("normalizer") or model.get("end_of_word_suffix") or \
                any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("not a plain byte-level BPE tokenizer file")
        letters, vocab = byte_alphabet(), model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        width = max(vocab.values()) + 1
        self.table = PairTable([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], width)
        self.byte_id = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        size = max([width, *(t["id"] + 1 for t in added)])
        self.id_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.id_bytes[i] = bytes(letters[c] for c in token)
        for t in added:
            self.id_bytes[t["id"]] = t["content"].encode()
        self.special = {t["content"]: t["id"] for t in added}
        self._cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) \
            if self.special else None
        self._pattern = Cutter(PATTERN, classes or character_classes())
        self._held = 0
        self._words: dict[str, bytes] = {}
        self._pieces: dict[str, bytes | None] = {}

    # -- encoding; ids are held as little-endian unsigned 32-bit integers

    def _merge(self, words: list[str]) -> None:
        """Put the ids of new pre-tokens into the cache."""
        raw = [w.encode() for w in words]
        if not raw:
            return
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        ids, counts = merge_by_pair_index(symbols, np.cumsum(sizes) - sizes, self.table)
        packed, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        lo = 0
        for w, hi in zip(words, ends):
            self._words[w] = packed[lo:hi]
            lo = hi

    def _segments(self, text: str) -> list[str]:
        """Stretches of ordinary text; a special string stands between two of them."""
        return self._cut.split(text) if self._cut else [text]

    def _cut_piece(self, piece: str) -> list[str]:
        """The pre-tokens of a piece that follows a single space."""
        if piece < "\u0250" and max(piece) < "\u0250":  # plain words need no pattern
            if piece.isalpha():
                return [" " + piece]
            if piece[-1] in ".,;:!?" and piece[:-1].isalpha():
                return [" " + piece[:-1], piece[-1]]
        return self._pattern.findall(" " + piece)

    def _learn(self, segments: list[str]) -> None:
        """Merge every pre-token of the segments that is not cached.

        A single space between two non-space characters always starts a pre-token,
        so the pieces between such spaces are looked up as a whole.  Pieces at other
        white space are marked, and their segments are cut by the full pattern.
        """
        met: set[str] = set()
        for s in segments:
            met.update(s.split(" ")[1:])
        fresh = met.difference(self._pieces)
        odd = {x for x in fresh if not x or x[0].isspace() or x[-1].isspace()}
        cut = {x: self._cut_piece(x) for x in fresh - odd}
        odd.update(x for x in met - fresh if self._pieces[x] is None)
        words: set[str] = set().union(*cut.values())
        for s in segments:
            words.update(self._pattern.findall(s if self._is_odd(s, odd) else s.split(" ", 1)[0]))
        self._merge([w for w in words if w not in self._words])
        word = self._words.__getitem__
        for x, parts in cut.items():
            self._pieces[x] = word(parts[0]) if len(parts) == 1 else b"".join(map(word, parts))
        self._pieces.update(dict.fromkeys(odd))
        self._held += sum(map(len, fresh)) + sum(map(len, words))

    @staticmethod
    def _is_odd(segment: str, odd: set[str]) -> bool:
        first, *rest = segment.split(" ")
        return not first or first[-1].isspace() or bool(odd) and not odd.isdisjoint(rest)

    def _ids(self, segment: str) -> bytes:
        first, *rest = segment.split(" ")
        if first and not first[-1].isspace():
            found = list(map(self._pieces.__getitem__, rest))
            if None not in found:
                return b"".join([self._words[w] for w in self._pattern.findall(first)] + found)
        return b"".join([self._words[w] for w in self._pattern.findall(segment)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; special strings inside a text become their ids."""
        if max(len(self._pieces), len(self._words)) > CACHE_WORDS or self._held > CACHE_CHARS:
            self.forget()
        self._learn([s for t in texts for s in self._segments(t)])
        out = []
        for t in texts:
            if self._cut and (marks := self._cut.findall(t)):
                ids = [self._ids(s) for s in self._cut.split(t)]
                out.append(ids[0] + b"".join(self.special[m].to_bytes(4, "little") + x for m, x in zip(marks, ids[1:])))
            else:
                out.append(self._ids(t))
        return out

    def forget(self) -> None:
        """Empty the caches."""
        self._pieces, self._words, self._held = {}, {}, 0

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.id_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_LOADED: dict[bytes, ByteBpe] = {}


def loaded(file: bytes, classes: tuple[str, str, str] | None = None) -> ByteBpe:
    """The tokenizer of a file's content, built once per Python worker."""
    key = hashlib.sha256(file).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBpe(file, classes)
    return _LOADED[key]


def portions(texts: list[str], chars: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``chars`` characters; a longer text is a run of its own."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def tokenizer_file(path: str) -> bytes:
    """A tokenizer file's content; read on the driver, shipped with the tasks (a few MB)."""
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, tokenizer: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, ids, decoded)``: each text's ids (little-endian unsigned 32-bit) and their decoded text.

    Equals the tokenizer library's ``encode(text, add_special_tokens=False)`` and
    ``decode(ids, skip_special_tokens=False)``: special strings inside a text become
    their ids.  Null counts as empty and gives no ids; whole texts of any length are
    encoded; repeated rows give repeated results; an empty table an empty result.
    """
    file, classes = tokenizer_file(tokenizer), character_classes()
    source = pick(docs, doc_id=id_col, text=text_col)
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType),
                           T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(file, classes)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in portions(texts):
                ids = model.encode(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(ids, pa.binary()), pa.array(map(model.decode, ids), pa.string())],
                    names=["doc_id", "ids", "decoded"])

    return source.mapInArrow(run, schema)
