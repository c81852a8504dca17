"""Small tables with the hard cases, and plain Python versions of contracts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ["n", "size", "key", "kept", "start", "starts", "gone", "label", "grp", "block", "target", "line", "words", "spans", "n_words", "h1", "h2"]
VOCAB = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta,", "Eta.", "theta", "iota", "kappa", "λάμδα", "mu", "nu", "xi", "omicron", "pi", "rho", "sigma", "tau", "upsilon"]


def prose(rng, n: int, tag: str = "") -> str:
    out = []
    for i in range(n):
        out.append(rng.choice(VOCAB) + (f"{tag}{rng.randrange(400)}" if rng.random() < 0.6 else ""))
        out.append("\n" if rng.random() < 0.08 else " ")
    return "".join(out).strip()


def texts() -> list[tuple]:
    """(doc_id, text, source): nulls, empty and blank texts, one word, exact
    and near copies, repeated rows, shared passages, one very long text."""
    rng = random.Random(7)
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t ", None), (4, "one", "a"), (5, "one two", "b"), (6, "one two", "c"), (7, "ONE  two\tthree", "a")]
    base = prose(rng, 300)
    rows += [(10, base, "a"), (11, base, "a"), (12, base.replace("gamma", "Gamma", 1), "b"), (13, base + " tail", "b")]
    for i in range(14, 40):
        words = base.split(" ")
        for _ in range(rng.randrange(1, 12)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(words), rng.choice(["a", "b", None])))
    passage = prose(rng, 60, "p")
    for i in range(40, 60):
        rows.append((i, prose(rng, rng.randrange(5, 120), "q") + "\n" + passage + "\n" + prose(rng, rng.randrange(0, 90), "r"), rng.choice(["a", "c", "é", "z"])))
    rows.append((61, prose(rng, 30000, "long"), "a"))
    rows += [(62, prose(rng, 40, "s"), "b")] * 2
    line = "this line of licence text stands in many documents, word for word"
    for i in range(63, 80):
        rows.append((i, "\n".join([prose(rng, 9, "t").replace("\n", " "), line if i % 3 else line.replace("many", "mony"), "}", "", prose(rng, 12, "u").replace("\n", " ")]), "src0"))
    return rows


def table(spark, rows=None, clash: bool = True):
    rows = texts() if rows is None else rows
    names = CLASH if clash else []
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), *[T.StructField(c, T.StringType()) for c in names]])
    return spark.createDataFrame([(*r, *["v"] * len(names)) for r in rows], schema)


def words(text) -> list[str]:
    return WORD.findall(text or "")


def shingles(text, width: int) -> set:
    w = words(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def jaccard_classes(rows, width: int = 3, percent: int = 90) -> dict:
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = [(d, shingles((t or "").translate(low), width)) for d, t, *_ in rows]
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1:]:
            if x and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {d: (len(s), root(d)) for d, s in sets}


def window_cut(rows, window: int = 13) -> list[tuple]:
    least: dict = {}
    split = [(d, words(t)) for d, t, *_ in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            least[k] = min(d, least.get(k, d))
    out = []
    for d, w in split:
        gone = {j for i in range(len(w) - window + 1) if least[tuple(w[i:i + window])] < d for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def edit_distance(a: bytes, b: bytes, most: int) -> int:
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def line_cut(rows, edits: int = 2, least: int = 20) -> list[tuple]:
    first: dict = {}
    for d, t, *_ in rows:
        for p, line in enumerate((t or "").split("\n")):
            b = line.encode()
            if len(b) >= least:
                first[b] = min(first.get(b, (d, p)), (d, p))
    near: dict = {}
    every = list(first)
    for x in every:
        near[x] = min(first[y] for y in every if x == y or abs(len(x) - len(y)) <= edits and edit_distance(x, y, edits) <= edits)
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        gone = [p for p, line in enumerate(lines) if len(line.encode()) >= least and near[line.encode()] < (d, p)]
        out.append((d, len(lines), len(gone), ",".join(map(str, gone))))
    return sorted(out)


def base_stats(text) -> tuple:
    t = text or ""
    w = words(t)
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        dup += line in seen and bool(words(line))
        seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)
