"""Plain Python versions of the operators, slow and simple, to hold results against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    repeated = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "base_failed": n < 50 or 100 * len(repeated) > 50 * n,
    }


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def components(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """doc_id: (set size, smallest id reachable), by an index over all shingles."""
    sets = {k: shingles(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def union(a, b):
        a, b = sorted((find(a), find(b)))
        parent[b] = a

    by_set = {}
    for k in sorted(sets):
        if sets[k]:
            union(by_set.setdefault(sets[k], k), k)
    holders, common = defaultdict(list), Counter()
    for s, k in sorted(by_set.items(), key=lambda x: x[1]):
        common.clear()
        for gram in s:
            for other in holders[gram]:
                common[other] += 1
            holders[gram].append(k)
        for other, shared in common.items():
            if 100 * shared >= 80 * (len(s) + len(sets[other]) - shared):
                union(other, k)
    return {k: (len(sets[k]), find(k)) for k in texts}


def decontaminate(texts: dict[int, str | None], items: dict[str, str]) -> dict[int, tuple]:
    windows = defaultdict(set)
    for item, text in items.items():
        words = TERM.findall((text or "").translate(LOWER))
        for i in range(max(len(words) - 12, 1) if words else 0):
            windows[tuple(words[i : i + 13])].add(item)
    lengths = {len(w) for w in windows}
    found = {}
    for key, text in texts.items():
        words = TERM.findall((text or "").translate(LOWER))
        hit, seen = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if items_of := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    seen |= items_of
        bad = bool(hit) and 20 * len(hit) >= len(words)
        found[key] = (len(words), len(hit), len(seen), sha(",".join(sorted(seen))), bad)
    return found


def dedup_lines(texts: dict[int, str | None], least_docs: int = 10, least_chars: int = 1) -> dict:
    white = " \t\n\x0b\x0c\r"
    key = lambda line: line.strip(white).translate(LOWER)
    docs = defaultdict(set)
    for k, text in texts.items():
        for line in (text or "").split("\n"):
            docs[key(line)].add(k)
    gone = {x for x, ids in docs.items() if len(ids) >= least_docs and len(x) >= least_chars}
    result = {}
    for k, text in texts.items():
        lines = (text or "").split("\n")
        kept = [line for line in lines if key(line) not in gone]
        result[k] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return result


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Share, clamp, share again, until no source is above twice its size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    order += [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, held = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return {**held, **share}
        held |= {s: 2.0 * sizes[s] for s in over}


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def windows_of(text: str | None) -> set[tuple]:
    words = TERM.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 13]) for i in range(max(len(words) - 12, 1) if words else 0)}


def hits_of(text: str | None, items: list[tuple[str, set[tuple]]]) -> tuple:
    words = TERM.findall((text or "").translate(LOWER))
    hit, seen = set(), set()
    for item, windows in items:
        for window in windows:
            n = len(window)
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == window:
                    hit.update(range(i, i + n))
                    seen.add(item)
    return len(words), len(hit), sorted(seen), bool(hit) and 20 * len(hit) >= len(words)


TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fill_in_middle(key, text: str | None) -> tuple:
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    x, y = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(t) for t in (tokens[:x], tokens[x:y], tokens[y:]))
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def trie(conversations: dict) -> set[tuple]:
    """Of lists of (role, text) by conversation: the nodes, with sums over whole subtrees."""
    paths = {c: [tuple(turns[:d]) for d in range(len(turns) + 1)] for c, turns in conversations.items()}
    members: dict[tuple, list] = defaultdict(list)
    for c, nodes in paths.items():
        for node in nodes:
            members[node].append(c)
    children = Counter(node[:-1] for node in members if node)
    saved, leaves = Counter(), Counter()
    for node, held in members.items():
        worth = (len(held) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += not children[node]
    found = set()
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(conversations[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        found.add(
            (min(held), len(node), parent, len(held), children[node], leaves[node], saved[node], sha(ends))
        )
    return found


PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def personal(text: str | None) -> list[tuple[str, int, int]]:
    """The rules' spans, by the patterns as they are stated."""

    def holds(kind: str, found: str) -> bool:
        digits = [int(c) for c in found if c in "0123456789"]
        if kind == "ip":
            return all(int(part) <= 255 for part in found.split("."))
        if kind == "card":
            doubled = [2 * d if i % 2 else d for i, d in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [
        (kind, *m.span())
        for kind, pattern in PERSONAL.items()
        for m in pattern.finditer(text or "")
        if holds(kind, m.group())
    ]
