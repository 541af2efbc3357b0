"""Plain versions of the operators' results, for small tables."""

import hashlib
import re
from collections import defaultdict

SPACE = " \t\n\x0b\x0c\r"
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return (text or "").translate(_UPPER)


def words(text):
    return _WORD.findall(lower(text))


def shingle_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def near(docs, n, percent):
    """doc_id -> (set size, component); all pairs are compared."""
    sets = {i: shingle_set(t, n) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def hits(docs, items, span=10):
    """doc_id -> (words, hit words, items)."""
    windows = defaultdict(set)
    for name, text in items:
        w = words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(str(name))
    sizes, out = {len(k) for k in windows}, {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= got
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def line_dedup(docs, least=10):
    """doc_id -> (lines, dropped lines, kept text)."""
    keys = {i: [lower(x.strip(SPACE)) for x in (t or "").split("\n")] for i, t in docs}
    owners = defaultdict(set)
    for i, ks in keys.items():
        for k in ks:
            if len(k) >= least:
                owners[k].add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, keys[i], strict=True) if len(k) < least or min(owners[k]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def paragraphs(text, piece=128):
    return {u for u in re.findall(rf"[^\n]{{1,{piece}}}[^\n.!?]*[.!?\n]*|\n+", text or "") if u}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def simhash(text, n=3):
    """The fingerprint bit by bit."""
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, bits=2):
    """Smallest reachable position of each entry of a list of fingerprints; all pairs are compared."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, p in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]


def cheapest_repair(rows):
    """(cost, audit, hash) for rows of (role, text, fault): every form of the result is tried."""
    best = None
    for lead in ("", "s"):
        for pairs in range(len(rows) + 2):
            if lead and not pairs:
                continue
            roles, memo = lead + "ua" * pairs, {}

            def ways(i, j, roles=roles, memo=memo):
                """Cheapest rest from row i on, when the first j turns of the result stand."""
                if (i, j) not in memo:
                    found = []
                    if i == len(rows) and j == len(roles):
                        found.append((0, "", ()))
                    if i < len(rows):
                        role, text, fault = rows[i]
                        c, audit, out = ways(i + 1, j)
                        found.append((c + 4, "D" + audit, out))
                        if fault not in ("blank", "duplicate") and j < len(roles):
                            c, audit, out = ways(i + 1, j + 1)
                            c += 3 * (fault == "truncated")
                            if role[:1] == roles[j]:
                                found.append((c, "K" + audit, (f"{role}:{text}", *out)))
                            if roles[j] != "s":
                                name = {"u": "user", "a": "assistant"}[roles[j]]
                                found.append((c + 3, "R" + audit, (f"{name}:{text}", *out)))
                    if j < len(roles) and roles[j] != "s":
                        c, audit, out = ways(i, j + 1)
                        found.append((c + 3, "I" + audit, ({"u": "user:", "a": "assistant:"}[roles[j]], *out)))
                    memo[i, j] = min(found, default=(1 << 30, "", ()))
                return memo[i, j]

            best = min(filter(None, (best, ways(0, 0))))
    return best[0], best[1], sha("\n".join(best[2]))


def conversation_faults(rows):
    """Faults of (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        rest = text.rstrip(SPACE)
        out.append(
            "blank" if not rest else "duplicate" if (role, text) in seen else None if rest[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
    return out


def repaired_conversations(rows):
    """conv_id -> result row of the repair of (conv_id, turn, role, text)."""
    import zlib

    talks = {}
    for conv, turn, role, text in rows:
        kept = talks.setdefault(conv, [])
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, kept in talks.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [r[0] for r in kept if r[0] is not None]
        faults = conversation_faults([r[1:] for r in kept])
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False)),
            *cheapest_repair([(r[1], r[2], f) for r, f in zip(kept, faults, strict=True)]),
        )
    return out


def audited(docs, labels):
    """(part, order, step) -> counts, by applying every order of filters to (doc_id, source, text)."""
    import itertools

    def fails(i, doc, text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        tests = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": any(doc is not None and d is not None and d < doc and (t or "") == text for d, _, t in docs),
        }
        return {k for k, v in tests.items() if v}

    rows = [(d, s or "", fails(i, d, t or "")) for i, (d, s, t) in enumerate(docs)]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out, shapley = {}, defaultdict(int)
    for part in {s for _, s, _ in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [(d, f) for d, s, f in rows if s == part]
            everyone = list(left)
            for step, own in enumerate(order, 1):
                gone = [r for r in left if own in r[1]]
                left = [r for r in left if own not in r[1]]
                shapley[part, own] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(own in f for _, f in everyone) - len(gone),
                    sum(f == {own} for _, f in everyone), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}
