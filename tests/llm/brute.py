"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def one_spaced(text: str | None) -> str:
    return SPACE.sub(" ", text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def last_ids(i):
    return (i is None, i or 0)


def copies(docs):
    """(doc_id, keep_id, group_size, kept, sha), of rows that agree in id and text one is kept."""
    groups = defaultdict(list)
    for d, t in docs:
        groups[one_spaced(t)].append(d)
    out = []
    for t, ids in groups.items():
        keep, seen = min(ids, key=last_ids), False
        for d in ids:
            kept = d == keep and not seen
            seen |= kept
            out.append((d, keep, len(ids), kept, sha(t)))
    return out


def removed_lines(docs, windows=1, min_words=5):
    """(doc_id, removed line numbers, kept text): repeated lines, or with windows=3 repeated triples."""
    docs = sorted({(d, t or "") for d, t in docs}, key=lambda x: (last_ids(x[0]), x[1]))
    units = []
    for d, t in docs:
        normal = [one_spaced(x).strip(" ").lower() for x in t.split("\n")]
        units += [(d, t, i, tuple(normal[i: i + windows])) for i in range(len(normal) - windows + 1)]
    seen, gone = set(), defaultdict(set)
    for d, t, i, unit in units:
        if not any(unit) or (windows == 1 and len(unit[0].split(" ")) < min_words):
            continue
        if unit in seen:
            gone[d, t].update(range(i, i + windows))
        seen.add(unit)
    return {(d, t): (sorted(gone[d, t]), "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d, t])) for d, t in docs}


def contamination(docs, items, width=13):
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1)) if w else ():
            windows[tuple(w[k: k + width])].add(i)
    sizes, out = sorted({len(w) for w in windows}), []
    for d, t in docs:
        w, found = words(t), set()
        hit = [0] * len(w)
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k: k + n]) in windows:
                    found |= windows[tuple(w[k: k + n])]
                    hit[k: k + n] = [1] * n
        ids = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), sum(hit), len(ids), sha(",".join(ids)), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def near_classes(docs, similarity=0.8):
    """(doc_id, class_id, size, kept); links between texts of at least that similarity of five-word shingles."""
    texts = list(dict.fromkeys(t or "" for _, t in docs))
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common >= similarity * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for d, t in docs:
        groups[find(texts.index(t or ""))].append(d)
    out = []
    for ids in groups.values():
        first, seen = min(ids, key=last_ids), False
        for d in ids:
            kept = d == first and not seen
            seen |= kept
            out.append((d, first, len(ids), kept))
    return out


def long_repeats(docs, length=200):
    where = defaultdict(int)
    data = [(d, (t or "").encode()) for d, t in docs]
    for _, b in data:
        for i in range(len(b) - length + 1):
            where[b[i: i + length]] += 1
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if where[b[i: i + length]] > 1:
                gone[i: i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def small(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def jaccard_components(docs, size=5):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", small(t))
        sets.append({tuple(w[i: i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)].append(d)
    return [(d, len(sets[i]), min(ids[find(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def collocations(rows, least=30, most=2000):
    """(group, rank, phrase, a, l, r, n, score) from (group, text)."""
    counts = defaultdict(Counter)
    for group, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", small(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                counts["und" if group is None else group].update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for group, f in counts.items():
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        told = {q[i: i + k] for q, a in known.items() for k in range(2, len(q)) for i in range(len(q) - k + 1)
                if 100 * a >= 80 * f[q[i: i + k]]}
        found = []
        for p in known.keys() - told:
            score, k = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(a for p, a in f.items() if len(p) == 1)
        out += [(group, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1)]
    return out


def prefix_nodes(turns, five=5, heads=9):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        path = tuple(own.get(c - c % five, [])[:h] + ts[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, d == len(path)))
    children, below = defaultdict(list), {}
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(below[q][0] for q in children[p]) if children[p] else 1
        below[p] = leaves, sum(below[q][1] for q in children[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        if p:
            children[p[:-1]].append(p)
    return [(min(m)[0], len(p), min(members[p[:-1]])[0] if p else None, len(m), len(children[p]), *below[p],
             sha(",".join(str(c) for c, ends in sorted(m) if ends))) for p, m in members.items()]
