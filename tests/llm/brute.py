"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, width=4):
    w = WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def reach(ids, links):
    """Smallest id reachable from each."""
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_components(rows, percent=85):
    sets = {i: shingle_set(t) for i, t in rows}
    order = sorted((len(s), i) for i, s in sets.items() if s)
    links = []
    for k, (n, a) in enumerate(order):
        for m, b in order[k + 1:]:
            if 100 * n < percent * m:
                break
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (n + m - both):
                links.append((a, b))
    comp = reach(sets, links)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")


def base_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(spans)


def joined(spans):
    return ",".join(f"{('assign', 'access', 'hex', 'random')[k]}:{s}:{e}" for s, k, e in spans)


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def targets(sizes, weights=(5, 2, 1)):
    """By sharing again and again; ``sizes`` by source."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8")) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_names, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while left > 1e-9 and open_names:
        total = sum(w[s] for s in open_names)
        for s in list(open_names):
            target[s] += left * w[s] / total
        left = 0.0
        for s in list(open_names):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_names.discard(s)
    return target


def pairs(rows):
    return list(combinations(rows, 2))
