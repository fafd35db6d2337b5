"""Plain definitions of the operators' results, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import xxhash

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, window=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        words = PLAIN.findall(lower(text))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[k:k + window])].add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        words, hit, found = PLAIN.findall(lower(text)), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if tuple(words[k:k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(words[k:k + size])]
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def fingerprint(text):
    words = BLANK.findall(lower(text))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius=4):
    """For each (doc_id, fingerprint), the smallest doc_id reachable; null is the largest."""
    large = float("inf")
    ids = [large if d is None else d for d, _ in prints]
    best, changed = list(ids), True
    near = [
        [j for j, (_, g) in enumerate(prints) if (f ^ g).bit_count() <= radius] for _, f in prints
    ]
    while changed:
        changed = False
        for i, others in enumerate(near):
            low = min(best[j] for j in others)
            changed, best[i] = changed or low < best[i], min(low, best[i])
    return [None if b == large else b for b in best]


def without_repeats(docs, window=13):
    large = float("inf")
    words = [(large if d is None else d, BLANK.findall(t or "")) for d, t in docs]
    first = {}
    for doc, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(doc, first.get(key, large))
    out = []
    for (doc, _), (d, w) in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), sha(kept)))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p.lstrip("0")[:4] or "0") <= 255 for p in m[0].split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15
            ):
                out.append((kind, m.start(), m.end()))
    return out


def archive(pages):
    by_payload = collections.defaultdict(list)
    for page, html in pages:
        by_payload[(html or "").encode()].append(page)
    out = []
    for payload, ids in by_payload.items():
        known = [i for i in ids if i is not None]
        for page in ids:
            first = min(known) if known and len(payload) >= 100 else page
            again = page != first
            out.append((
                page, len(payload), hashlib.sha256(payload).hexdigest(),
                "revisit" if again else "response", first if again else None,
            ))
    return out


def nearest(vectors, every=100, k=10):
    used = [(i, np.array(v, float)) for i, v in vectors if v and None not in v]
    used = [(i, v) for i, v in used if np.isfinite(v).all() and v.any()]
    out = {}
    for i, v in used:
        if i % every == 0:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in used if j != i and len(w) == len(v))
            out[i] = near[:k]
    return out


def packing_faults(rows, ids, sequence=4096):
    """What is wrong with (doc_id, start, length, crc, doc_tokens, sequence_id, offset) rows."""
    pieces, held = collections.defaultdict(list), collections.defaultdict(list)
    for doc, start, length, crc, n, seq, offset in rows:
        own = ids[doc]
        if n != len(own) or length <= 0 or zlib.crc32(own[start:start + length].tobytes()) != crc:
            return f"piece {doc} {start} {length}"
        pieces[doc].append((start, length))
        held[seq].append((offset, length))
    for name, parts in (("document", pieces), ("sequence", held)):
        for key, spans in parts.items():
            at = 0
            for start, length in sorted(spans):
                if start != at:
                    return f"{name} {key} has a gap or an overlap at {at}"
                at += length
            if name == "document" and at != len(ids[key]) or name == "sequence" and at > sequence:
                return f"{name} {key} ends at {at}"
    return "" if pieces.keys() == ids.keys() else "documents are missing"


def lloyd(vectors, k=8, rounds=10, seed=3):
    """vec_id, cluster, distance, cluster_inertia, inertia, sha of each usable (vec_id, vector) row."""
    def usable(v):
        return v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)

    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if i is not None and usable(v)]
    kept = [(i, v) for i, v in kept if max(map(abs, v)) < 1 << 27]
    centroids = [v for _, v in sorted(kept, key=lambda r: (sha(f"{seed}:{r[0]}"), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for n, mine in groups.items():
            centroids[n] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = collections.Counter()
    for _, n, d in found:
        own[n] += d
    return [(i, n, d, own[n], sum(own.values()), sha(",".join(map(str, centroids[n])))) for i, n, d in found]


def filter_table(docs, labels):
    """Rows of the filter audit, document by document and order by order; docs are (id, text, source)."""
    large = float("inf")
    first = {}
    for doc, text, _ in docs:
        first[text or ""] = min(large if doc is None else doc, first.get(text or "", large))
    fails, marks = [], []
    for doc, text, _ in docs:
        text = text or ""
        words = BLANK.findall(text)
        fails.append({f for f, bad in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": (large if doc is None else doc) > first[text],
        }.items() if bad})
        own = [(q, t) for i, q, t in labels if i is not None and i == doc]
        marks.append((any(q == 1 for q, _ in own), any(t == 1 for _, t in own)))
    out = {}
    for part in {s or "" for *_, s in docs}:
        mine = [k for k, (*_, s) in enumerate(docs) if (s or "") == part]
        total = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                total[f] += len(gone)
                late = sum(f in fails[k] for k in mine) - len(gone)
                left = [k for k in left if f not in fails[k]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), late, sum(fails[k] == {f} for k in mine),
                    sum(marks[k][0] for k in gone), sum(marks[k][1] for k in gone), f,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = total[row[-1]]
    return [(*key, *row) for key, row in out.items()]
