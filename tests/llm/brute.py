"""Plain versions of what the queries must return, written without Spark and without the operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SF = "/root/testdata/sf0.001"
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def simhash(text: str | None) -> int:
    words = SPACE_WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs: list[tuple[int, str | None]]) -> dict[int, tuple[str, int]]:
    prints = np.array([simhash(t) for _, t in docs], np.uint64)
    parent = list(range(len(docs)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in range(len(docs)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= 3):
            parent[find(i)] = find(int(j))
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(docs):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return {doc: (f"{int(prints[i]):016x}", least[find(i)]) for i, (doc, _) in enumerate(docs)}


def leaks(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]]) -> dict[int, tuple]:
    windows: dict[tuple, set] = defaultdict(set)
    for item, text in items:
        words = ITEM_WORD.findall(lower_ascii(text or ""))
        for i in range(max(len(words) - 10, 0) + 1 if words else 0):
            windows[tuple(words[i : i + 10])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        words = ITEM_WORD.findall(lower_ascii(text or ""))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (key := tuple(words[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        out[doc] = (len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def repeats(docs: list[tuple[int, str | None]], size: int = 35) -> dict[int, tuple]:
    split = [(doc, SPACE_WORD.findall(text or "")) for doc, text in docs]
    count = Counter(tuple(w[i : i + size]) for _, w in split for i in range(len(w) - size + 1))
    out = {}
    for doc, w in split:
        gone = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out[doc] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))
