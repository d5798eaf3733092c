"""The trie of rebuilt conversations, node by node."""

import hashlib
from collections import defaultdict
from zlib import crc32


def rebuilt(rows):
    """rows: (conv_id, turn, role, text); no two of one conversation have the same turn."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    turns = {conv: [turn[2] for turn in sorted(found, key=lambda x: x[:2])] for conv, found in convs.items()}
    out = {}
    for conv, own in turns.items():
        h = crc32(str(conv).encode()) % 6
        base = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        out[conv] = tuple(turns.get(base, [])[:h] + own[h:])
    return out


def nodes(rows):
    convs = rebuilt(rows)
    if not convs:
        return []
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, found in members.items():
        weight = (len(found) - 1) * len(prefix[-1][1]) if prefix else 0
        for d in range(len(prefix) + 1):
            saved[prefix[:d]] += weight
            leaves[prefix[:d]] += not children[prefix]
    out = []
    for prefix, found in members.items():
        ends = sorted(conv for conv in found if convs[conv] == prefix)
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(found), len(prefix), parent, len(found), len(children[prefix]), leaves[prefix], saved[prefix], digest))
    return out
