"""Plain single-machine versions of the contracts, for small inputs."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def lower(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s or "")


def crc(x):
    return zlib.crc32(str(x).encode())


def parts(nodes, links):
    """node -> smallest node reachable."""
    top = {n: n for n in nodes}

    def root(n):
        while top[n] != n:
            top[n] = top[top[n]]
            n = top[n]
        return n
    for a, b in links:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def vectors(rows, threshold=0.98):
    ok = [(i, np.array(v, dtype=float), lab) for i, v, lab in rows
          if v is not None and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = defaultdict(set)
    for k, (i, v, lab) in enumerate(ok):
        for j, w, other in ok[k + 1:]:
            if lab == other and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= threshold:
                links[i].add(j)
                links[j].add(i)
    comp = parts([r[0] for r in rows], [(a, b) for a in links for b in links[a]])
    return {i: (len(links[i]), comp[i], comp[i] == i) for i, _, _ in rows}


def simhash(text):
    w = WORD.findall(lower(text))
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_groups(rows, bits=2):
    fps = {i: simhash(t) for i, t in rows}
    ids = sorted(fps)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fps[a] ^ fps[b]).bit_count() <= bits]
    comp = parts(ids, links)
    return {i: (f"{fps[i]:016x}", comp[i]) for i in ids}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    s = 0
    for k, c in enumerate(d[::-1]):
        v = int(c) * (1 + k % 2)
        s += v if v < 10 else v - 9
    return s % 10 == 0


def base(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
            if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    kinds = ["email", "ip", "card", "phone"]
    n = [sum(k == x for _, k, _ in out) for x in range(4)]
    return (*n, sha(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(out))))


def hits(text, items, size=10):
    w = ALNUM.findall(lower(text))
    hit, found = set(), set()
    for item, t in items:
        iw = ALNUM.findall(lower(t))
        if not iw:
            continue
        n = min(size, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def licence_base(text):
    w = ALNUM.findall(lower(text))
    at, labels = [], set()
    for p, label in {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}.items():
        p = p.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def targets(sizes):
    """{source: size} -> {source: target}, by resharing until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, full, out = 1.5 * sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        out = {s: 2.0 * sizes[s] for s in full} | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if out[s] >= 2 * sizes[s]}
        if not above:
            return out
        full |= above
