"""Plain versions of what the operators compute."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def shingles(text, size=5):
    w = words((text or "").translate(FOLD))
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def linked_components(docs):
    """docs: list of (doc_id, text), ids may repeat."""
    sets, holders, pairs = [shingles(t) for _, t in docs], defaultdict(list), []
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in holders[x])
        for j, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n) and None not in (docs[i][0], docs[j][0]):
                pairs.append((docs[i][0], docs[j][0]))
        for x in s:
            holders[x].append(i)
    return union(pairs, {d for d, _ in docs if d is not None})


def counts(text):
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def rebuilt_conversations(rows):
    """rows: (conv_id, turn, role, text); conv_id to its (role, text) turns."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            key = (turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).digest())
            convs[c].append((key, (role or "", text or "")))
    convs = {c: [t for _, t in sorted(v)] for c, v in convs.items()}
    h = lambda c: zlib.crc32(str(c).encode()) % 9
    return {c: tuple(convs.get(c - c % 5, [])[: h(c)] + own[h(c) :]) for c, own in convs.items()}


def trie(rows):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    whole = rebuilt_conversations(rows)
    members, kids, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(node), parent, len(m), kids[node], leaves[node], saved[node], digest))
    return Counter(out)


def near(a, b):
    """Whether one code point inserted, deleted or replaced makes b of a."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    return any(a[i + (len(a) == len(b)) :] == b[i + 1 :] for i in range(len(b)) if a[:i] == b[:i])


def vocabulary(docs, length=5, times=3):
    n = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            at = h % len(run)
            n[run if h % 97 else run[:at] + run[at + 1 :]] += 1
    return {w: c for w, c in n.items() if len(w) >= length and c >= times}


def variants(n):
    """n: word to its count; (word, form, root, n, n_near, form_n)."""
    close = {w: [x for x in n if near(w, x)] for w in n}
    best = {w: min(c, key=lambda x: (-n[x], x)) for w, c in close.items() if c}
    form = {w: f for w, f in best.items() if n[f] >= 2 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(close[w]), n[form[w]] if w in form else None))
    return Counter(out)
