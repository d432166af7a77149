"""Small corpora and plain-Python versions of the contracts."""

import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, id string, shard int, n long"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def corpus(seed=1, groups=25):
    """(doc_id, text) rows: copies, near copies, shared lines and passages, empty, null, blank and long texts."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(400)]
    words = lambda n: [r.choice(vocab) for _ in range(n)]
    shared = " ".join(words(60))
    rows = []
    for g in range(groups):
        base = words(r.randint(1, 120))
        for k in range(r.randint(1, 6)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 5])):
                w[r.randrange(len(w))] = r.choice(vocab)
            cut = sorted(r.sample(range(len(w) + 1), min(2, len(w))))
            lines = [" ".join(x) for x in (w[:cut[0]], w[cut[0]:cut[-1]], w[cut[-1]:])]
            if r.random() < .3:
                lines.insert(r.randrange(3), shared)
            text = "\n".join(lines)
            rows.append(text.upper() if r.random() < .2 else text)
    rows += ["", None, " \t\n", "one", "One", "é É ß\x0bx", " ".join(words(6000)), "a b c d", "a  b\tc d", rows[0], rows[0]]
    r.shuffle(rows)
    return list(enumerate(rows))


def frame(spark, rows):
    """The rows with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, "x", 3, 4) for i, t in rows], SCHEMA)


def shingles(t):
    w = [x for x in re.split("[\x20\x09-\x0D]+", lower(t)) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def removed(rows):
    """{doc_id: line numbers with a similar line before them}."""
    seen, out = [], defaultdict(list)
    for i, t in sorted(rows):
        for k, line in enumerate((t or "").split("\n")):
            w = re.findall(r"[^\s]+", line)
            if not w:
                continue
            s = frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4)))
            if any(100 * len(s & q) >= 75 * len(s | q) for q in seen):
                out[i].append(k)
            seen.append(s)
    return out


WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(rows, items):
    wins = defaultdict(set)
    for item, text in items:
        w = WORD.findall(lower(text))
        for i in range(len(w) - min(13, len(w)) + 1 if w else 0):
            wins[tuple(w[i:i + 13])].add(str(item))
    out = {}
    for d, text in rows:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in wins:
                    hit.update(range(i, i + k))
                    found |= wins[tuple(w[i:i + k])]
        out[d] = (len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def tokens(text):
    return [x for x in re.split("[\x20\x09-\x0D]+", lower(text)) if x] + ["</end>"]


def counts(rows):
    c = Counter()
    for _, t in rows:
        c.update(tokens(t))
    return c
