"""Plain, slow versions of the operators' rules, for comparison."""

import hashlib
import re
from collections import Counter, defaultdict
from math import floor, isfinite, log10
from zlib import crc32

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(identifier):
    return crc32(("" if identifier is None else str(identifier)).encode())


def words(text):
    return WORD.findall(text or "")


def base_rules(text):
    text = text or ""
    found = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    covered = {p for i in range(len(found) - 7) if windows[tuple(found[i : i + 8])] > 1 for p in range(i, i + 8)}
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def line_dedup(rows):
    """rows: (doc_id, text); returns (doc_id, n_lines, n_dropped, kept text) of each."""
    keys = lambda text: [(line, line.strip(" \t\n\r\x0b\x0c").translate(LOW)) for line in (text or "").split("\n")]
    holders = defaultdict(set)
    for doc, text in rows:
        for _, key in keys(text):
            if len(key) >= 10:
                holders[key].add(doc)
    out = []
    for doc, text in rows:
        lines = keys(text)
        kept = [line for line, key in lines if key not in holders or len(holders[key]) < 2 or min(holders[key]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text):
    found = words((text or "").translate(LOW))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def components(rows):
    """rows: (doc_id, text); returns (doc_id, size, component) of each."""
    sets = [(doc, shingles(text)) for doc, text in rows]
    parent = {doc: doc for doc, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, (_, own) in enumerate(sets):
        for s in own:
            index[s].append(i)
    for i, (doc, own) in enumerate(sets):
        for j, n in Counter(j for s in own for j in index[s] if j < i).items():
            if 100 * n >= 80 * (len(own) + len(sets[j][1]) - n):
                a, b = root(doc), root(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return [(doc, len(own), root(doc)) for doc, own in sets]


def contamination(text, items):
    """items: (item_id, text); returns words, hits, item ids as sorted strings, contaminated."""
    found = ALNUM.findall((text or "").translate(LOW))
    hit, ids = set(), set()
    for item, body in items:
        test = ALNUM.findall((body or "").translate(LOW))
        n = min(13, len(test))
        windows = {tuple(test[i : i + n]) for i in range(len(test) - n + 1)} if n else set()
        for i in range(len(found) - n + 1) if n else ():
            if tuple(found[i : i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add(str(item))
    return len(found), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(found)


def unigram(rows):
    """rows: (doc_id, text); returns (doc_id, held_out, n_tokens, n_known, N, base) of each."""
    tokens = [(doc, [*words((text or "").translate(LOW)), ""]) for doc, text in rows]
    counts = Counter(t for doc, own in tokens if crc(doc) % 10 for t in own)
    total, kinds = sum(counts.values()), len(counts)
    return [
        (doc, crc(doc) % 10 == 0, len(own), sum(t in counts for t in own), total, sum(log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in own))
        for doc, own in tokens
    ]


def cluster(rows, size=64, clusters=8, rounds=10):
    """rows: (vec_id, vector); returns (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of the kept ones."""
    kept = [(i, [floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (sha(f"3:{'' if r[0] is None else r[0]}"), r[1]))
    centres = [q for _, q in first[:clusters]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, q in kept:
            members[near(q)[1]].append(q)
        centres = [[sum(x) // len(members[n]) for x in zip(*members[n], strict=True)] if n in members else c for n, c in enumerate(centres)]
    found = [(i, *near(q)) for i, q in kept]
    inertia = Counter()
    for _, distance, n in found:
        inertia[n] += distance
    return [(i, n, distance, inertia[n], sum(inertia.values()), sha(",".join(map(str, centres[n])))) for i, distance, n in found]
