"""Small fixtures and brute-force versions for the text operators."""

import re

import numpy as np
import xxhash
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
WORD = re.compile(r"[^\x20\x09-\x0D]+")

ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "two words", "a  b \n\n c", "<|endoftext|>x <|endoftext|> <|startoftext|>", "\x1c \x1d a\x1eb",
    "\x85 a\xa0b　 c", "ΑΣ ΟΔΟΣ ß ẞ İstanbul ǅ Å é", "I'll we've 'S can't O'RE don't''s", "aaaa aaaaa aaaaaaa hahahahaha",
    "é è ñ 中文 字 ١٢٣ ½ ² 1234", " lead", "trail ", "a \n b", "🎉 🎉🎉 é", "한국어 가", "foo_bar-baz...!!!", "x\ty\rz\x0bw",
    "word " * 3000, "z" * 50_000, "The quick brown fox jumps over the lazy dog. " * 4,
]


def documents(spark, texts, langs=None, sources=None, first=0):
    rows = [(first + i, t, (langs or ["en"] * len(texts))[i], (sources or ["src0"] * len(texts))[i], len(t or ""))
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text, words=4):
    w = WORD.findall(lower(text))
    shingles = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes_of(links, n):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_classes(fps, max_bits=4):
    """Smallest index reachable by links, by comparing every pair."""
    f = np.array(fps, np.uint64)
    links = [(i, j) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= max_bits) if j > i]
    return classes_of(links, len(f))


def rule_counts(text):
    text = text or ""
    w = WORD.findall(text)
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
