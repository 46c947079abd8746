"""Plain answers of the contracts, one document or pair at a time."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(["lo", "ra", "mi", "ten", "sol"]) + draw.choice(["ka", "do", "fe", "nu"]) + draw.choice("xyz")
                    for _ in range(n))


def texts():
    a, b = prose(1, 120), prose(2, 90)
    return [
        a, a, a.replace("ka", "KA", 1), b, None, None, "", "", "  \n\t ", "one", "one two three", a + " " + b,
        prose(3, 60) + " " + b, "x" * 50_000, prose(4, 6_000), "same line here\n" * 40,
        "Write to ann@mail.example.org or 10.0.0.1, card 4111 1111 1111 1111, phone +1 555 123 4567.\n" + prose(5, 60),
        "éàü ñ 中文 😀 " * 30, "1 " * 3_000, "a@b" * 2_000, "token = \"8f3a0c9d1b7e4f6a8c2d5e9f0a1b3c4d5e6f7a8b\" " + prose(6, 60),
        "the quick line with some words 1\nthe quick line with some words 2\nanother thing altogether\n" + prose(7, 55),
        "the quick line with some words 3\nnothing alike\n" + prose(8, 55), b + ".",
    ]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text, n=4):
    w = words(fold(text))
    shingles = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def classes(keys, linked):
    """Least key reachable, by a search over all pairs."""
    keys = list(keys)
    out = {}
    for start in range(len(keys)):
        if start in out:
            continue
        group, todo = {start}, [start]
        while todo:
            x = todo.pop()
            for y in range(len(keys)):
                if y not in group and linked(x, y):
                    group.add(y)
                    todo.append(y)
        for x in group:
            out[x] = min((keys[y] for y in group if keys[y] is not None), default=None)
    return [out[i] for i in range(len(keys))]


def edit_distance(a, b):
    row = np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        best = np.minimum(row[1:] + 1, row[:-1] + np.array([x != y for y in b], int)) if b else row[1:]
        new = [i]
        for j, v in enumerate(best):
            new.append(min(v, new[-1] + 1))
        row = np.array(new)
    return int(row[-1])


def repeat_words(text):
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    return len({i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)})


def duplicate_lines(text):
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(lines) - len(set(lines))


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def removed_windows(rows, size=50):
    """Per row (id, text): which words go."""
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        out.append((w, gone))
    return out


def merkle(rows):
    """Per row (doc_id, source, lang, n_chars, text) the columns of the manifest."""
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def climb(nodes):
        """Root, and per node its (run, slot) on every level."""
        paths, at, hashes = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
        while len(hashes) > 1:
            runs = [hashes[i:i + 3] for i in range(0, len(hashes), 3)]
            for i, k in enumerate(at):
                paths[i].append((runs[k // 3], k % 3))
            at, hashes = [k // 3 for k in at], [sha("".join(r)) for r in runs]
        return hashes[0], paths

    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in order:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built[s] = climb([leaf(r) for r in trees[s]])
    root, tops = climb([built[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        subroot, paths = built[s]
        for row, path in zip(trees[s], paths):
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                changed = (*row[:4], row[4].replace("\n", ""))
            value, others = leaf(changed), ""
            for run, slot in path + top:
                others += "".join(run[:slot] + run[slot + 1:])
                value = sha("".join([*run[:slot], value, *run[slot + 1:]]))
            out.append((row[0], leaf(row), subroot, root, sha(others), value, value == root))
    return out


def prefix_trie(rows):
    """The trie's nodes from rows (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = {}
    for c in sorted(own):
        skipped = zlib.crc32(str(c).encode()) % 6
        path = own.get(c - c % 100, [])[:skipped] + own[c][skipped:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append((c, d == len(path)))
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return [(m[0][0], len(p), members[p[:-1]][0][0] if p else None, len(m), children[p], leaves[p], saved[p],
             sha(",".join(str(c) for c, end in m if end))) for p, m in members.items()]


def shingle_set(text, n=2):
    w = words(fold(text))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def similar_sets(rows):
    """Per row (doc_id, text): doc_id, size of its shingle set, least id reachable over pairs at 0.8 or more."""
    distinct = {}
    for i, text in rows:
        distinct.setdefault(frozenset(shingle_set(text)), []).append(i)
    sets = [s for s in distinct if s]
    lists = {}
    for k, s in enumerate(sets):
        for x in s:
            lists.setdefault(x, []).append(k)
    over = list(range(len(sets)))

    def top(k):
        while over[k] != k:
            k = over[k]
        return k

    for k, s in enumerate(sets):
        for other, both in Counter(m for x in s for m in lists[x] if m < k).items():
            if 100 * both >= 80 * (len(s) + len(sets[other]) - both):
                over[top(k)] = top(other)
    least = {}
    for k, s in enumerate(sets):
        ids = [i for i in distinct[s] if i is not None]
        least[top(k)] = min([*ids, *([least[top(k)]] if least.get(top(k)) is not None else [])], default=None)
    component = {s: least[top(k)] for k, s in enumerate(sets)}
    out = []
    for i, text in rows:
        s = frozenset(shingle_set(text))
        c = component[s] if s else i
        out.append((i, len(s), c, i == c))
    return out
