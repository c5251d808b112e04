"""Small documents with planted cases, and brute-force versions of contracts."""

import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b + c for a in ("tor", "en", "bal", "qui", "mes") for b in ("a", "ith", "o", "und") for c in ("ner", "sk", "l", "vide", "po")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def swap(rng: random.Random, text: str, n: int) -> str:
    w = text.split(" ")
    for i in rng.sample(range(len(w)), n):
        w[i] = rng.choice(WORDS) + "x"
    return " ".join(w)


def rows(seed: int = 3, n: int = 60):
    """Documents with null and empty texts, exact copies, a group of near copies, chains, shared lines and ties."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 160)) for _ in range(n)]
    base = prose(rng, 150)
    line = prose(rng, 30)
    texts += [base] * 6 + [swap(rng, base, k) for k in (1, 1, 2, 2, 3, 4, 5, 6, 8, 10, 12)]
    step = prose(rng, 120)
    for _ in range(8):  # each close to the one before, the ends far apart
        texts.append(step)
        step = swap(rng, step, 2)
    texts += [line + " " + prose(rng, 60) for _ in range(12)]
    texts += [None, "", "  \t ", "one", "ONE", "one two three", "One Two Three", "a b c d e", "a b c d e f", "é " * 40, prose(rng, 9000)]
    out = [(10 * i + 3, t, "en", f"src{rng.randint(0, 4)}", len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(out)
    return out


def shingles(text, width=5):
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0d]+", data)
    if not w:
        return set()
    return {tuple(w[i: i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)}


def near_components(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(s), find(d)) for d, s in sets}


BASE = [("assign", r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24)]


def base_spans(text):
    found = [(m.start(), k, m.end(), name) for k, (name, p, g, least) in enumerate(BASE)
             for m in re.finditer(p, text or "", re.ASCII) if len(m[g]) >= least]
    found.sort()
    joined = ",".join(f"{name}:{a}:{b}" for a, _, b, name in found)
    return [sum(f[3] == n for f in found) for n in ("assign", "access", "hex")], joined


def sha(s) -> str:
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()
