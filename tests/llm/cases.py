"""Documents with every awkward trait, and plain versions of what operators compute."""

import random
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0D]+")
#: Extra columns whose names operators use themselves.
CLASH = ("id", "h", "n", "bucket", "score", "kept", "found", "rest", "row", "node", "lost")


def prose(rng, words=40, vocabulary=200):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def documents(seed=1):
    """(doc_id, text) rows: copies, near copies, shared lines, nulls, empties, a long text."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(5, 60)) for _ in range(25)]
    texts = list(base)
    texts += base[:4] * 2
    for t in base[4:10]:
        w = t.split()
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))
    line = "This very line is in many documents"
    texts += [f"{prose(rng, 12)}\n  {line}\t\n{prose(rng, 8)}\n{line.upper()}" for _ in range(5)]
    texts += ["", None, " \n\t ", "one", "ONE", "a\nb\n", "\n" * 5, "é" * 70, "é" * 70 + "x",
              "\x00 \x1f\x85 z", " ".join(prose(rng, 50) for _ in range(60)) + " " + base[1]]
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    assert len({i for i, _ in rows}) == len(rows)
    return rows


def frame(spark, rows, extra=True):
    names = "doc_id long, text string"
    if extra:
        rows = [(*r, *[f"x{k}" for k in range(len(CLASH))]) for r in rows]
        names += "".join(f", {c} string" for c in CLASH)
    return spark.createDataFrame(rows, names).repartition(3)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def near_components(rows, size):
    """Smallest reachable id and set size per row id, by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = words(t)
        step = min(size, len(w))
        sets[i] = {tuple(w[k:k + step]) for k in range(len(w) - step + 1)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def dropped_lines(rows, least_chars=20, least_docs=3):
    held = defaultdict(list)
    low = -(1 << 63)

    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(LOWER)

    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            held[k].append(low if i is None else i)
    out = []
    for i, t in rows:
        mine = low if i is None else i
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= least_chars
                                         and len(held[key(x)]) >= least_docs
                                         and max(held[key(x)]) != mine)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def removed_bytes(rows, size=50):
    first = {}
    low = -(1 << 63)
    named = [(low if i is None else i, i, (t or "").encode()) for i, t in rows]
    for mine, _, b in named:
        for k in range(len(b) - size + 1):
            s = b[k:k + size]
            first[s] = min(first.get(s, mine), mine)
    out = []
    for mine, i, b in named:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if first[b[k:k + size]] < mine:
                gone[k:k + size] = b"\1" * size
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out
