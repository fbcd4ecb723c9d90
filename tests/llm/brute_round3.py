"""Plain versions of alignment, Merkle manifest and token counts, without Spark and without the operators."""

from __future__ import annotations

import json
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
import tokenizers
from brute import sha

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
B_FILE = public_tokenizers.path("piece_bpe_32k.model")


def gpt_bytes() -> dict[str, int]:
    """Byte-level characters by a walk over all bytes: visible ones keep their place, others follow 255."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def alignments(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    a_side = tokenizers.Tokenizer.from_file(A_FILE)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    alphabet = gpt_bytes()

    def piece(i: int) -> bytes:
        name = b_side.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b_side.is_byte(i) else name.replace("▁", " ").encode()

    found, counts = {}, Counter()
    for doc, text in docs:
        a, b, groups, linked = [], [], [], []
        if text:
            raw = b" " + text.encode()
            enc = a_side.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(alphabet[c] for c in t)) for i, t in zip(enc.ids, enc.tokens, strict=True)]
            b = [(i, piece(i)) for i in b_side.encode(text)]
            if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
                a, b = [], []
        ends_a, ends_b, at = {}, {}, 0
        for i, x in a:
            at += len(x)
            ends_a[at] = i
        at = 0
        for i, x in b:
            at += len(x)
            ends_b[at] = i
        left, right = [], []
        for end in sorted(ends_a.keys() | ends_b.keys()):
            left += [ends_a[end]] if end in ends_a else []
            right += [ends_b[end]] if end in ends_b else []
            if end in ends_a and end in ends_b:
                linked.append((ends_a[end], ends_b[end]))
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
        counts.update(linked)
        found[doc] = (len(a), len(b), groups, linked)
    highest: dict[int, int] = defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return {
        doc: (
            n_a,
            n_b,
            len(groups),
            len(linked),
            sum(counts[p] == highest[p[1]] for p in linked),
            sum(counts[p] for p in linked),
            sha(";".join(groups)) if groups else "",
        )
        for doc, (n_a, n_b, groups, linked) in found.items()
    }


def _leaf(row: tuple) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(leaves: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each leaf the digests left and right of its way, level by level."""
    level, proofs = leaves, [[] for _ in leaves]
    above = list(range(len(leaves)))
    while len(level) > 1:
        for i, proof in enumerate(proofs):
            start = above[i] // fanout * fanout
            run = level[start : start + fanout]
            own = above[i] - start
            proof.append(("".join(run[:own]), "".join(run[own + 1 :])))
            above[i] //= fanout
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], proofs


def merkle(rows: list[tuple], fanout: int = 16) -> list[tuple]:
    """For rows (doc_id, source, lang, n_chars, text): the columns that the query returns, sorted."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, _leaf(row), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    parts = [sorted(by_source[s], key=lambda x: x[:3]) for s in names]
    trees = [_tree([x[2] for x in part], fanout) for part in parts]
    root, tops = _tree([t[0] for t in trees], fanout) if trees else ("", [])
    out = []
    for part, (subroot, proofs), top in zip(parts, trees, tops, strict=True):
        for (_, _, leaf, row), proof in zip(part, proofs, strict=True):
            way = proof + top
            changed = leaf
            if zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 5 == 0:
                changed = _leaf((*row[:4], row[4] and row[4].translate(lower)))
            for left, right in way:
                changed = sha(left + changed + right)
            out.append((row[0], leaf, subroot, root, sha("".join(a + b for a, b in way)), changed, changed == root))
    return sorted(out, key=lambda x: (x[0] is not None, x))


def token_counts(texts: list[str | None]) -> list[tuple[int, int, bool]]:
    with open(A_FILE, encoding="utf-8") as file:
        tokenizer = tokenizers.Tokenizer.from_str(json.dumps(json.load(file)))
    out = []
    for text in texts:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        out.append((len((text or "").encode()), n, n > 512))
    return out
