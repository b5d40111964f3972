"""Plain counterparts of the operators, one text or one small table at a time."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    words = WORDS.findall(text or "")
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {k for v in places.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    symbols = sum(x in "#*$%&|<>" for x in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def _kinds(text, kinds):
    found = []
    for place, (kind, pattern, good) in enumerate(kinds):
        found += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text) if good(m)]
    return sorted(found)


def _digests(text, kinds):
    found = _kinds(text or "", kinds)
    counts = [sum(x[1] == place for x in found) for place in range(len(kinds))]
    return (*counts, sha(",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)))


def _digits(match):
    return re.sub(r"[^0-9]", "", match[0])


def _luhn(match):
    digits = [int(x) for x in _digits(match)]
    doubled = [x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(digits))]
    return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0


PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: all(int(x) <= 255 for x in m[0].split(".")),
    ),
    ("card", r"[0-9]([\x20-]?[0-9])+", _luhn),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m)) <= 15),
]
SECRETS = [
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[1]) >= 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def personal(text):
    return _digests(text, PERSONAL)


def secrets(text):
    return _digests(text, SECRETS)


def repeats(docs):
    """For (id, text) the counts and the digest of what is left."""
    data = [(i, (text or "").encode()) for i, text in docs]
    first = {}
    for i, b in data:
        for k in range(len(b) - 49) if i is not None else ():
            first[b[k : k + 50]] = min(i, first.get(b[k : k + 50], i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - 49) if i is not None else ():
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(count, linked):
    """The smallest number that each of the numbers up to count reaches."""
    label = list(range(count))
    for _ in range(count):
        before = list(label)
        for a in range(count):
            for b in range(a):
                if linked(a, b):
                    label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    return label


def top_k(rows, k=5):
    """(query_id, rank, vec_id, score) for (vec_id, vector) whose ids divide by 50."""
    good = [
        (i, np.floor(256 * np.array(v, float)).astype(np.int64))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = set()
    for q, x in good:
        if q % 50 == 0:
            scores = sorted((-int(x @ y), i) for i, y in good if i != q and len(y) == len(x))[:k]
            out |= {(q, place + 1, i, -s) for place, (s, i) in enumerate(scores)}
    return out
