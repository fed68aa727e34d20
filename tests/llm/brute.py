"""Plain versions of the operators, and documents with every odd case, for small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, shard string, "
    "score string, window string, node string, component_id string, bucket string, place string, id string, "
    "check string, doc string, rest string, spans string, lettered string, kept_text string, label string"
)


def odd_documents():
    """Rows of SCHEMA without nulls in doc_id and without repeats: copies, near copies, shared passages."""
    draw = random.Random(7)
    words = ["".join(draw.choice("abcdefghij é") for _ in range(draw.randint(1, 7))).strip() or "q" for _ in range(400)]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    base, passage = prose(120), prose(40)
    near = base.split()
    near[60] = "changed"
    texts = [
        None, "", " \n\t ", "a", "This.", "42 !!", base, base, " ".join(near), base.upper(), passage,
        prose(60) + " " + passage + " " + prose(30), passage + " " + prose(20), prose(3000), "ab" * 900,
        "x" * 99, "x" * 100, "x" * 101, "x" * 350, prose(3), prose(4), prose(5), "naïve café – “quotes” 🙂 " * 9,
        prose(12).replace(" ", "\n"), "  two  blanks   and\ttabs ", "<|endoftext|> <s> ▁mark\u0000end",
    ]
    texts += [prose(draw.randint(1, 80)) for _ in range(14)]
    extra = len(SCHEMA.split(",")) - 5
    return [
        (3 * i, t, "en" if i % 2 else None, None if i % 3 else "src", len(t) if t else None, *[f"x{i}"] * extra)
        for i, t in enumerate(texts)
    ]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


class Union:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def repeats(texts: dict, length: int) -> dict:
    """id -> bytes, removed bytes, removed runs, rest; by looking at every string of ``length`` bytes."""
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            string = data[s : s + length]
            if string in seen:
                covered[s : s + length] = b"\1" * length
            seen.add(string)
        runs = len(re.findall(b"\1+", bytes(covered)))
        rest = bytes(b for b, c in zip(data, covered) if not c)
        out[i] = (len(data), sum(covered), runs, rest)
    return out


def shingle_set(text, size):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def near_groups(texts: dict, size: int, threshold: int) -> dict:
    """id -> size of its set, smallest id that links reach; by comparing every pair that shares a shingle."""
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    holders, common, groups = defaultdict(list), defaultdict(int), Union(sets)
    for i in sorted(sets):
        for s in sets[i]:
            for j in holders[s]:
                common[j, i] += 1
            holders[s].append(i)
    for (a, b), n in common.items():
        if 100 * n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            groups.join(a, b)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


def sha256(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def plain_sketch(text, words=5, scale=16):
    """Hashes of runs of words below the threshold; a run is hashed word by word, each with the hash before as seed."""
    import xxhash

    parts = [w for w in re.split("[ \t\n\x0b\f\r]+", (text or "").lower()) if w]
    found = set()
    for i in range(max(1, len(parts) - words + 1) if parts else 0):
        h = 42
        for w in parts[i : i + words]:
            h = xxhash.xxh64(w.encode(), seed=h).intdigest()
        h = h - (1 << 64) if h >> 63 else h
        if h < -(1 << 63) + (1 << 64) // scale:
            found.add(h)
    return sorted(found)


def plain_print(sketch):
    import base64

    return base64.b64encode(b"".join((h & 0xFFFFFFFF).to_bytes(4) for h in sketch)).decode()


def plain_near(one, two, same):
    union = len(set(one) | set(two))
    return len(set(one) & set(two)) / union if union else float(same)
