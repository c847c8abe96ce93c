"""The operators' results by the plainest means, for small inputs."""

import re
from collections import Counter, defaultdict

import xxhash

SPACED = r"[^\x20\x09-\x0D]+"
END = 1 << 63


def words(text):
    return re.findall(SPACED, text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def substrings(docs):
    """Kept text, words and removed words of each (doc_id, text)."""
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - 12):
            run = tuple(w[i : i + 13])
            first[run] = min(first.get(run, END), END if d is None else d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < (END if d is None else d):
                gone.update(range(i, i + 13))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def lines(docs, chars=40, least=5):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            holders[key(line)].add((END, t) if d is None else (d, None))
    out = []
    for d, t in docs:
        mine = (t or "").split("\n")
        kept = []
        for line in mine:
            held = holders[key(line)]
            last = max(h[0] for h in held)
            if len(key(line)) < chars or len(held) < least or last == (END if d is None else d):
                kept.append(line)
        out.append((d, len(mine), len(mine) - len(kept), "\n".join(kept)))
    return out


def fingerprint(text, n=4):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), seed=42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=4):
    """For (key, fingerprint) pairs the least key reachable from each."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(prints):
        least[root(i)] = min(least.get(root(i), k), k)
    return [least[root(i)] for i in range(len(prints))]


def contamination(docs, items):
    """Words, hit words, sorted item ids and the verdict of each text."""

    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    windows = defaultdict(set)
    for item, text in items:
        w = split(text)
        for i in range(max(len(w) - 12, 1)):
            if w:
                windows[tuple(w[i : i + 13])].add("" if item is None else str(item))
    sizes = {len(k) for k in windows}
    out = []
    for d, text in docs:
        w = split(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i : i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        out.append((d, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeat = set()
    for i in range(len(w) - 4):
        if windows[tuple(w[i : i + 5])] > 1:
            repeat.update(range(i, i + 5))
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeat)


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _is_pii(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return True


def pii(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PII.items()
        for m in re.finditer(pattern, text or "")
        if _is_pii(kind, m.group())
    ]
