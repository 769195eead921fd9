"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
import string
import zlib
from fractions import Fraction

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


def repeat_words(w):
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    return len({i + k for places in seen.values() if len(places) > 1 for i in places for k in range(5)})


def shingles(text, k):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def groups(rows, k, percent=80):
    """Component (smallest id) of each (id, text), by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(key, len(s), least.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))]


def without_repeats(rows, min_lines=2, min_words=10):
    """Texts of (id, text) in the order of rows, without the lines of later copies of runs."""
    seen, out = set(), []
    for _, text in rows:
        if text is None:
            out.append(None)
            continue
        lines = text.split("\n")
        at = [n for n, x in enumerate(lines) if words(x)]
        gone = set()
        for i, n in enumerate(at):
            line = lines[n]
            if line in seen and len(words(line)) >= min_words:
                gone.add(n)
            seen.add(line)
            if i + min_lines <= len(at):
                run = tuple(lines[m] for m in at[i : i + min_lines])
                if run in seen:
                    gone.update(at[i : i + min_lines])
                seen.add(run)
        out.append("\n".join(x for n, x in enumerate(lines) if n not in gone))
    return out


def crc(key):
    return zlib.crc32(str(key).encode())


def sha_of(text):
    return hashlib.sha256(text.encode()).hexdigest()


def periodic(key, text):
    """Words of a text, made periodic where the key says so."""
    w = words(text)
    n = len(w)
    if key is None or crc(key) % 10 or not n:
        return w
    g = crc(key) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def runs(w, least=24, times=3):
    """(start, length, period) of all maximal runs, by trying every period at every place."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_row(key, text):
    w = periodic(key, text)
    told = runs(w)
    gone = {i for s, n, q in told for i in range(s + q, s + n)}
    best = min(told, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (key, len(told), *best, 1000 * best[1] // best[2] if told else None,
            sha_of("".join(f"{s},{n},{q}\n" for s, n, q in told)), sha_of(" ".join(x for i, x in enumerate(w) if i not in gone)))


SECRETS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
)


def secrets(text):
    """(start, place of the kind, end) of the base secrets."""
    return sorted((m.start(), k, m.end()) for k, (_, pattern, fits) in enumerate(SECRETS) for m in re.finditer(pattern, text or "") if fits(m))


def merkle_leaf(row):
    return sha_of("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def merkle_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha_of("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def merkle(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, merkle_leaf(r)))
        trees[lang] = merkle_levels([merkle_leaf(r) for r in by[lang]])
    top = merkle_levels([trees[lang][-1][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        for k, r in enumerate(by[lang]):
            path = []
            for tree, i in ((trees[lang], k), (top, place)):
                for level in tree[:-1]:
                    path.append((level[i ^ 1] if i ^ 1 < len(level) else "", i & 1))
                    i >>= 1
            told = list(r)
            if r[0] is not None and crc(r[0]) % 7 == 0 and r[3] is not None:
                told[3] += 1
            done = merkle_leaf(told)
            for sibling, left in path:
                done = sha_of(sibling + done if left else done + sibling)
            root = top[-1][0]
            out.append((r[0], merkle_leaf(r), trees[lang][-1][0], root, sha_of("".join(s for s, _ in path)), done, done == root))
    return out
