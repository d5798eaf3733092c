"""The quality classifier and language identification with plain loops."""

import math
from bisect import bisect_right
from collections import Counter, defaultdict

from brute import base_rules, crc, words

MASK = (1 << 64) - 1


def statistics(text):
    text = text or ""
    data, found = text.encode(), words(text)
    some, size = max(1, len(found)), max(1, len(data))
    share = lambda signs: math.sqrt(sum(b in signs for b in data) / size)
    return [
        math.log1p(len(found)), math.log1p(len(data) / some), math.log1p(len(found) / len(text.split("\n"))), share(b"#*$%&|<>"),
        math.sqrt(base_rules(text)[4] / some), math.sqrt((len(found) - len(set(found))) / some),
        share(range(65, 91)), share(range(48, 58)), share(b"."), share(b"!?"), share(b"|"), share(range(128, 256)), share(b","),
    ]


def solve(matrix, vector):
    """Solution and determinant by elimination with pivots."""
    n = len(vector)
    rows = [[*row, x] for row, x in zip(matrix, vector, strict=True)]
    determinant = 1.0
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(rows[r][i]))
        if pivot != i:
            rows[i], rows[pivot] = rows[pivot], rows[i]
            determinant = -determinant
        determinant *= rows[i][i]
        for r in range(i + 1, n):
            factor = rows[r][i] / rows[i][i]
            rows[r] = [a - factor * b for a, b in zip(rows[r], rows[i], strict=True)]
    out = [0.0] * n
    for i in reversed(range(n)):
        out[i] = (rows[i][n] - sum(rows[i][k] * out[k] for k in range(i + 1, n))) / rows[i][i]
    return out, determinant


def quality_scores(documents, labels, pooled=0.3, ridge=0.05):
    """documents: (doc_id, text); labels: (doc_id, quality). Scores of every document, learned as the contract says."""
    vectors = {doc: statistics(text) for doc, text in documents}
    classes = defaultdict(list)
    for doc, quality in labels:
        if doc in vectors and crc(doc) % 4 != 2 and quality in (0, 1):
            classes[quality].append(vectors[doc])
    n, total = 13, sum(map(len, classes.values()))
    means = {k: [sum(v[i] for v in found) / len(found) for i in range(n)] for k, found in classes.items()}
    spread = {
        k: [[sum((v[i] - means[k][i]) * (v[j] - means[k][j]) for v in found) / len(found) for j in range(n)] for i in range(n)] for k, found in classes.items()
    }
    both = [[sum(len(classes[k]) / total * spread[k][i][j] for k in (0, 1)) for j in range(n)] for i in range(n)]
    for k in (0, 1):
        mixed = [[(1 - pooled) * spread[k][i][j] + pooled * both[i][j] for j in range(n)] for i in range(n)]
        variance = sum(mixed[i][i] for i in range(n)) / n + 1e-9
        spread[k] = [[(1 - ridge) * mixed[i][j] + (ridge * variance if i == j else 0) for j in range(n)] for i in range(n)]
    out = {}
    for doc, vector in vectors.items():
        density = {}
        for k in (0, 1):
            apart = [a - b for a, b in zip(vector, means[k], strict=True)]
            solved, determinant = solve(spread[k], apart)
            density[k] = math.log(len(classes[k])) - 0.5 * (sum(a * b for a, b in zip(apart, solved, strict=True)) + math.log(determinant))
        out[doc] = 1 / (1 + math.exp(-max(-500, min(500, density[1] - density[0]))))
    return out


def _mix(x):
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 & MASK
    x ^= x >> 29
    x = x * 0x9E3779B97F4A7C15 & MASK
    return x ^ x >> 32


def letter_runs(text):
    """Runs of lower-case letters, as code points."""
    out, run = [], []
    for c in text or "":
        if c.isalpha():
            low = c.lower()
            run.append(ord(low) if len(low) == 1 else ord(c))
        elif run:
            out.append(run)
            run = []
    return [*out, run] if run else out


def slots(run):
    padded = [0, *run, 0]
    return [_mix(a << 42 & MASK | b << 21 | c) >> 50 for a, b, c in zip(padded, padded[1:], padded[2:], strict=False)]


def languages(documents, scripts, least=0.01, smoothing=0.1, penalty=8.0):
    """documents: (doc_id, text, lang); scripts: where they begin. (language, score, spans) of every document."""
    counts, script_counts = defaultdict(Counter), defaultdict(Counter)
    script = lambda run: bisect_right(scripts, run[0]) - 1
    for doc, text, lang in documents:
        if lang is not None and text is not None and crc(doc) % 3 != 1:
            counts[lang]
            for run in letter_runs(text):
                counts[lang].update(slots(run))
                script_counts[lang][script(run)] += len(run)
    names = sorted(counts)
    size = {lang: sum(counts[lang].values()) + smoothing * (1 << 14) for lang in names}
    out = {}
    for doc, text, _ in documents:
        runs = letter_runs(text)
        if not runs or not names:
            out[doc] = ("und", 0.0, 0)
            continue
        best, back = None, []
        for run in runs:
            may = {lang for lang in names if script_counts[lang][script(run)] >= least * max(1, sum(script_counts[lang].values()))} or set(names)
            found = slots(run)
            score = [sum(math.log((counts[lang][s] + smoothing) / size[lang]) for s in found) if lang in may else -1e6 for lang in names]
            if best is None:
                best = score
                back.append(list(range(len(names))))
                continue
            top = max(range(len(names)), key=lambda k: best[k])
            came = [top if best[k] < best[top] - penalty else k for k in range(len(names))]
            best = [max(best[k], best[top] - penalty) + score[k] for k in range(len(names))]
            back.append(came)
        state = max(range(len(names)), key=lambda k: best[k])
        labels = []
        for came in reversed(back):
            labels.append(state)
            state = came[state]
        labels.reverse()
        letters = Counter()
        for run, label in zip(runs, labels, strict=True):
            letters[label] += len(run)
        most = max(range(len(names)), key=lambda k: letters[k])
        out[doc] = (names[most], letters[most] / sum(letters.values()), 1 + sum(a != b for a, b in zip(labels, labels[1:], strict=False)))
    return out
