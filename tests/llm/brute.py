"""Plain versions of the operators, for small tables: rows are (doc_id, text)."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(body) -> str:
    return hashlib.sha256(body.encode() if isinstance(body, str) else body).hexdigest()


def lowered(text) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def ordered(rows):
    """Documents in their order: by doc_id, then text, nulls first."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))


def pii(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def lines(rows):
    """(doc_id, n_lines, n_removed, kept line numbers) in order."""
    rows = ordered(rows)
    sets, first = [], {}
    for k, (_, text) in enumerate(rows):
        own = [frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line) if w) for line in lowered(text).split("\n")]
        sets.append(own)
        for i, s in enumerate(own):
            if s:
                first.setdefault(s, (k, i))
    seen, kept = [], defaultdict(list)
    for s, (k, i) in first.items():
        if not any(9 * len(s & x) >= 4 * (len(s) + len(x)) for x in seen):
            kept[k].append(i)
        seen.append(s)
    return [(rows[k][0], len(own), sum(map(bool, own)) - len(kept[k]), kept[k]) for k, own in enumerate(sets)]


def decontamination(rows, items, window=10):
    windows = defaultdict(set)
    for name, text in items:
        w = LETTERED.findall(lowered(text))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i:i + n])].add("null" if name is None else str(name))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in rows:
        w = LETTERED.findall(lowered(text))
        hit, names = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    names |= found
        out.append((doc, len(w), len(hit), sorted(names), bool(hit)))
    return out


def substrings(rows, window=20):
    rows = ordered(rows)
    words = [SPACED.findall(t or "") for _, t in rows]
    seen, out = set(), []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def repeats(rows, window=200):
    bodies = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[i:i + window] for _, b in bodies for i in range(len(b) - window + 1))
    out = []
    for doc, b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if count[b[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def near(rows, similarity=85):
    """(doc_id, n_shingles, component_id, kept) in order."""
    rows = ordered(rows)
    sets = []
    for _, text in rows:
        w = SPACED.findall(lowered(text))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            n = len(a & b)
            if a and b and 100 * n >= similarity * (len(a) + len(b) - n):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [(rows[i][0], len(sets[i]), rows[root(i)][0], root(i) == i) for i in range(len(rows))]


def exact(rows):
    """(doc_id, keep_id, group_size, kept, sha256) of every row."""
    groups = defaultdict(list)
    for k, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", "", text or "")].append((-len(text or ""), doc is not None, doc or 0, k))
    out = []
    for body, members in groups.items():
        members.sort()
        best = members[0]
        for m in members:
            out.append((rows[m[3]][0], rows[best[3]][0], len(members), m == best, sha(body)))
    return out


def ceil_prefix(n):
    return n - math.ceil(0.8 * n) + 1


def codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """rows are (vec_id, vector, label): (vec_id, code, error, label_error) in order, and the final entries."""
    rows = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    whole = [[math.floor(scale * x) for x in r[1]] for r in rows]
    if not rows:
        return [], []
    w = len(whole[0]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for v in cut:
                own[nearest(v[p], books[p])[1]].append(v[p])
            books[p] = [[sum(c) // len(own[i]) for c in zip(*own[i])] if i in own else e for i, e in enumerate(books[p])]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    by_label = Counter()
    for r, f in zip(rows, found):
        by_label[r[2]] += sum(d for d, _ in f)
    return [(r[0], "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f), by_label[r[2]]) for r, f in zip(rows, found)], books


def resampled(rows, target, seed=42, least=20, percent=5, buckets=10_000):
    """(doc_id, n_features, weight, score, rank)."""

    def features(text):
        w = LETTERED.findall(lowered(text))
        return w, [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    docs = [(d, *features(t)) for d, t in rows]
    s, t = Counter(b for _, _, f in docs for b in f), Counter(b for text in target for b in features(text)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    out, able = [], []
    for k, (d, w, f) in enumerate(docs):
        h = int(sha(f"{seed}:{'' if d is None else d}")[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(w) >= least:
            able.append(k)
    able.sort(key=lambda k: (-out[k][3], out[k][0] is not None, out[k][0] or 0, -out[k][2], -out[k][1]))
    for place, k in enumerate(able[:percent * len(able) // 100], 1):
        out[k][4] = place
    return [tuple(o) for o in out]


def feistel(number, count, key):
    """One number's place, in plain integers: four rounds over the halves, walked until it is below count."""
    mask = (1 << 64) - 1

    def spread(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)

    half = max(1, ((count - 1).bit_length() + 1) // 2)
    while True:
        left, right = number >> half, number % (1 << half)
        for r in range(4):
            left, right = right, left ^ spread((right + key * (2 * r + 1) + r) & mask) % (1 << half)
        number = (left << half) | right
        if number < count:
            return number
