"""Token counts of a word-end BPE tokenizer by rank-synchronous array merging.

Pre-tokens not met before are held as one ragged numpy array of symbols.  In each
round every sequence finds its own lowest-ranked pair, all sequences merge theirs
at the same time (every occurrence, from the left), and the array is compacted;
only pairs beside a merge are ranked anew.  A sequence without a mergeable pair
leaves, and its surviving symbols are its count.  A sequence of more than
``LONG_SEQUENCE`` bytes would need a round for nearly every merge; it goes to the
codec's pair index.  Counts are held per word in a bounded cache.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers.normalizers import NFC, Lowercase, Sequence

from .bpe import Cutter, PairTable, byte_alphabet, character_classes, merge_by_pair_index, portions, tokenizer_file
from .common import pick

#: Words and their characters held per worker; beyond either the cache starts anew, which costs time only.
CACHE_WORDS = 400_000
CACHE_CHARS = 1 << 24
LONG_SEQUENCE = 1 << 12
#: Separators that Python strips as space but the tokenizer's pattern keeps as symbols.
ODD_SPACES = "\x1c\x1d\x1e\x1f"
WHITE_SPACE = regex.compile(r"[\t-\r\x20\x85\xa0  -     　]+")


def surviving_symbols(symbols: np.ndarray, sizes: np.ndarray, table: PairTable) -> np.ndarray:
    """Symbols left of each sequence after all merges."""
    counts = sizes.copy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    sym = symbols.astype(np.int64)

    def ranked(at):
        """Ranks of the pairs that begin at ``at``; none across the end of a sequence."""
        inside = at + 1 < len(sym)
        to = np.where(inside, at + 1, at)
        inside &= owner[to] == owner[at]
        return np.where(inside, table.rank(sym[at], sym[to]), table.none)

    rank = ranked(np.arange(len(sym)))
    while len(sym):
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        lengths = np.diff(np.append(starts, len(sym)))
        least = np.minimum.reduceat(rank, starts)
        counts[owner[starts]] = lengths
        going = np.repeat(least < table.none, lengths)
        hit = (rank == np.repeat(least, lengths)) & going
        p = np.flatnonzero(hit)
        if not len(p):
            break
        # in a run of overlapping hits (equal symbols) every second one, from the left
        run = np.concatenate(([True], p[1:] != p[:-1] + 1))
        first = np.maximum.accumulate(np.where(run, np.arange(len(p)), 0))
        p = p[(np.arange(len(p)) - first) % 2 == 0]
        sym[p] = table.result[rank[p]]
        keep = going
        keep[p + 1] = False
        place = np.cumsum(keep) - 1
        sym, owner, rank = sym[keep], owner[keep], rank[keep]
        at = place[p]
        near = np.concatenate((at, at[at > 0] - 1))
        rank[near] = ranked(near)
    return counts


class WordBpe:
    """Token counter of a lower-casing BPE tokenizer file with word ends (``.json``)."""

    def __init__(self, file: bytes, classes: tuple[str, str, str] | None = None):
        spec = json.loads(file)
        model, added = spec["model"], spec.get("added_tokens", [])
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        cutter, mapper = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}, {}])
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or \
                spec["normalizer"]["normalizers"][1]["pattern"] != {"Regex": r"\s+"} or cutter.get("type") != "Split" or \
                cutter["behavior"] != "Removed" or not cutter["invert"] or mapper.get("type") != "ByteLevel" or \
                mapper["use_regex"] or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("not a lower-casing word-end BPE tokenizer file")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.table = PairTable([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], max(vocab.values()) + 1)
        letters = [c for c, _ in sorted(byte_alphabet().items(), key=lambda x: x[1])]
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + end] for c in letters], np.int64)
        # white space is never part of a token, so the pattern may see one piece at a time
        pattern = cutter["pattern"]["Regex"].replace(r"\s", WHITE_SPACE.pattern[1:-2])
        self._find = Cutter(pattern, classes or character_classes()).findall
        self._lower = Sequence([NFC(), Lowercase()]).normalize_str  # the library's tables of letters
        self._special = regex.compile("|".join(regex.escape(t["content"]) for t in added)) if added else None
        self._held = 0
        self._words: dict[str, int] = {}
        self._pieces: dict[str, int] = {}

    def _cut(self, piece: str) -> tuple[int, list[str]]:
        """Special strings in a piece, and the pre-tokens of the rest."""
        marks, parts = 0, [piece]
        if self._special and "<" in piece:
            parts = self._special.split(piece)
            marks = len(parts) - 1
        words = []
        for part in parts:
            if part.isascii():
                part = part.lower()
                if part.isalpha():
                    words.append(part)
                    continue
            else:
                part = self._lower(part)
            words += self._find(part)
        return marks, words

    def _learn(self, pieces: set[str]) -> None:
        cut = {x: self._cut(x) for x in pieces}
        new = list({w for _, words in cut.values() for w in words}.difference(self._words))
        if new:
            raw = [w.encode() for w in new]
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            data = np.frombuffer(b"".join(raw), np.uint8)
            symbols, last = self.inner[data], np.cumsum(sizes) - 1
            symbols[last] = self.final[data[last]]
            long = sizes > LONG_SEQUENCE
            of_long = np.repeat(long, sizes)
            left = np.empty(len(new), np.int64)
            left[~long] = surviving_symbols(symbols[~of_long], sizes[~long], self.table)
            if long.any():
                _, left[long] = merge_by_pair_index(symbols[of_long], np.cumsum(sizes[long]) - sizes[long], self.table)
            self._words.update(zip(new, left.tolist()))
            self._held += sum(map(len, new))
        self._held += sum(map(len, cut))
        for x, (marks, words) in cut.items():
            self._pieces[x] = marks + sum([self._words[w] for w in words])

    @staticmethod
    def _split(text: str) -> list[str]:
        return WHITE_SPACE.split(text) if any(c in text for c in ODD_SPACES) else text.split()

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        if max(len(self._pieces), len(self._words)) > CACHE_WORDS or self._held > CACHE_CHARS:
            self._pieces, self._words, self._held = {}, {}, 0
        met: set[str] = set()
        for t in texts:
            met.update(self._split(t))
        self._learn(met.difference(self._pieces))
        of = self._pieces.__getitem__
        return [sum(map(of, self._split(t))) for t in texts]


_LOADED: dict[bytes, WordBpe] = {}


def loaded(file: bytes, classes: tuple[str, str, str] | None = None) -> WordBpe:
    """The counter of a file's content, built once per Python worker."""
    key = hashlib.sha256(file).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBpe(file, classes)
    return _LOADED[key]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    Equals the tokenizer library's ``encode(text, add_special_tokens=False)``; special
    strings inside a text count one token each.  Null counts as empty: no bytes, no
    tokens.  Whole texts of any length are counted; repeated rows give repeated
    results; an empty table gives an empty result.
    """
    file, classes = tokenizer_file(tokenizer), character_classes()
    source = pick(docs, doc_id=id_col, text=text_col)
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(file, classes)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in portions(texts):
                part = texts[lo:hi]
                n = model.count(part)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([len(t.encode()) for t in part], pa.int64()),
                     pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(run, schema)
