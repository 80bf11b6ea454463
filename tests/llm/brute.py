"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def bag(text: str | None) -> Counter:
    w = words((text or "").lower())
    if not w:
        return Counter()
    if len(w) < 5:
        return Counter([tuple(w)])
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def similarity(x: Counter, y: Counter) -> float:
    shared = sum((x & y).values())
    total = sum(x.values()) + sum(y.values()) - shared
    return shared / total if total else 0.0


class Union:
    def __init__(self, nodes) -> None:
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y) -> None:
        x, y = sorted((self.find(x), self.find(y)))
        self.up[y] = x


def classes(texts: dict[int, str | None], least: float = 0.8) -> dict[int, int]:
    """Least id of each document's class of near copies."""
    bags = {i: bag(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, b in bags.items():
        for shingle in b:
            holders[shingle].append(i)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    union = Union(texts)
    for a, b in pairs:
        if similarity(bags[a], bags[b]) >= least:
            union.join(a, b)
    return {i: union.find(i) for i in texts}


def repeats(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    """n_words, n_removed and the SHA-256 of the kept words."""
    every = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in every for i in range(len(w) - window + 1))
    out = []
    for w in every:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def item_words(text: str | None) -> list[bytes]:
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())


def least_edits(item: list, text: list) -> int:
    """Edits between the item and the nearest stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)


def base_secrets(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, place of the kind, kind, end) in order."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def redacted(text: str | None) -> str | None:
    if text is None:
        return None
    runs: list[list] = []
    for start, _, kind, end in base_secrets(text):
        if runs and start < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end, kind])
    out, at = "", 0
    for start, end, kind in runs:
        out += text[at:start] + f"[{kind}]"
        at = end
    return out + text[at:]


def mixed(rows: list[tuple], weights=(5, 2, 1), share=1.5, passes=2, seed="mix") -> list[tuple]:
    """rows (doc_id, text, source) -> (doc_id, size, source_size, target, taken)."""
    def key(doc_id, text):
        digest = hashlib.md5(text.encode()).hexdigest() if text is not None else ""
        return hashlib.md5(f"{seed}|{'' if doc_id is None else doc_id}|{digest}".encode()).hexdigest()

    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        by_source[source].append((key(doc_id, text), doc_id, len(words(text))))
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(x[2] for x in by_source[s]) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, rest = set(names), {}, share * sum(size.values())
    while left:
        level = rest / sum(weight[s] for s in left)
        full = {s for s in left if passes * size[s] <= level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in left}
            break
        target |= {s: float(passes * size[s]) for s in full}
        rest -= sum(passes * size[s] for s in full)
        left -= full
    out = []
    for s in names:
        budget = math.floor(target[s] + 1e-9)
        whole = budget // size[s] if size[s] else 0
        rest = budget - whole * size[s]
        for _, doc_id, n in sorted(by_source[s], key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2])):
            part = max(0, min(n, rest))
            rest -= part
            out.append((doc_id, n, size[s], target[s], whole * n + part))
    return out
