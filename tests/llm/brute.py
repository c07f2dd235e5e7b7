"""Plain versions of the operators, for comparison on small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SECRETS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_spans(text):
    found = [(m.start(), no, kind, m.end())
             for no, (kind, pattern, good) in enumerate(SECRETS) for m in pattern.finditer(text or "") if good(m)]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def windows_removed(texts, window):
    """Per text: number of words, of removed ones, and the kept words."""
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingle_set(text, size=5):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def near_links(rows, similarity=0.8):
    """All linked pairs of different texts, through an index of shingles."""
    by_text = defaultdict(list)
    for i, t in rows:
        by_text[" ".join(WORD.findall(t or ""))].append(i)
    sets = {t: shingle_set(t) for t in by_text}
    index = defaultdict(list)
    for t, s in sets.items():
        for x in s:
            index[x].append(t)
    shared = Counter()
    for ts in index.values():
        for i, a in enumerate(ts):
            for b in ts[i + 1:]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items()
             if n >= similarity * (len(sets[a]) + len(sets[b]) - n)]
    return by_text, links


def near_classes(rows, similarity=0.8):
    """Least id of each row's class."""
    by_text, links = near_links(rows, similarity)
    parent = {t: t for t in by_text}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    least = defaultdict(list)
    for t, ids in by_text.items():
        least[root(t)] += ids
    return {i: min(ids) for ids in least.values() for i in ids}


def lines_removed(rows, window=3):
    """Per row number: number of lines, of removed ones, new text; rows are (id, text) in order."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    seen, out = set(), {}
    for k in order:
        text = rows[k][1]
        if text is None:
            out[k] = (0, 0, None)
            continue
        ls, gone = text.split("\n"), set()
        for i in range(len(ls) - window + 1):
            key = tuple(ls[i:i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        out[k] = (len(ls), len(gone), "\n".join(x for i, x in enumerate(ls) if i not in gone))
    return out


def pfair(sources, period):
    """``(source, phase, block, slot)``, slot by slot; ``sources`` has (blocks, weight) by source."""
    done, out, phase = {s: 0 for s in sources}, [], 0
    while True:
        live = [s for s in sources if sources[s][0] > done[s]]
        live = [s for s in live if sources[s][1]] or live
        if not live:
            return out
        phase += 1
        whole = sum(sources[s][1] for s in live)
        share = {s: max(1, (period - 1) * sources[s][1] // whole) if whole else period for s in live}
        rest = sorted((-((period - 1) * sources[s][1] % max(whole, 1)), s) for s in live)
        for _, s in rest[:max(0, period - sum(share.values()))]:
            share[s] += 1
        now, t = {s: 0 for s in live}, 0
        while True:
            ready = [s for s in live if now[s] * period < (t + 1) * share[s]]
            best = min((-(-(now[s] + 1) * period // share[s]), s) for s in ready)[1]
            if done[best] == sources[best][0]:
                break
            out.append((best, phase, done[best], len(out)))
            now[best] += 1
            done[best] += 1
            t += 1


def log_words(text):
    """Lower-case A-Z words and the end mark."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lower), None]
