"""Prefix trie, Merkle manifest and licence scan against plain versions."""

import hashlib
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest

from tabprep.llm import license_scan, merkle, prefix_trie
from tests.llm import cases

# prefix trie

TALK = "conv_id long, turn long, role string, text string, n long, head string, seq string"


def talks(n: int = 240) -> list[tuple]:
    """Shared openings, equal conversations, null and empty values, ties."""
    rng = random.Random(3)
    rows = []
    for c in [*range(0, n), -7, -100, 900, 905, 100000]:
        base = ["hi", "hello there", "what is it?"][:rng.randrange(4)]
        said = base + [rng.choice(["a", "bb", "ccc", "", None, "d\u00e9"]) for _ in range(rng.randrange(5))]
        rows += [(c, k, rng.choice(["user", None]) if rng.random() < 0.2 else "user", t) for k, t in enumerate(said)]
    for c in range(300, 380):  # copies of one conversation
        rows += [(c, k, "user", t) for k, t in enumerate(["same", "thing", "again", "and", "again", "and more"])]
    rows += [(5, None, "system", "first"), (None, 0, "user", "lost"), (None, None, None, None)]
    rows += [(901, k, "user", f"long {k % 7}") for k in range(400)]
    return rows


def trie_by_hand(rows) -> list[tuple]:
    own: dict = {}
    for c, k, r, t in rows:
        if c is not None:
            r, t = r or "", t or ""
            own.setdefault(c, []).append(((k is not None, k or 0), hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()[:32], r, t))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    trunc = lambda c: c - (abs(c) % 100) * (1 if c >= 0 else -1)
    h = lambda c: zlib.crc32(str(c).encode()) % 6
    seqs = {c: tuple(own.get(trunc(c), [])[:h(c)] + v[h(c):]) for c, v in own.items()}
    members: dict = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids: dict = {}
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids.get(k, [])) or 1
        saved[k] = sum(saved[x] for x in kids.get(k, [])) + (len(members[k]) - 1) * (len(k[-1][1]) if k else 0)
    ends = lambda k: hashlib.sha256(",".join(str(c) for c in sorted(members[k]) if seqs[c] == k).encode()).hexdigest()
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids.get(k, [])), leaves[k], saved[k], ends(k)) for k, m in members.items()), key=repr)


@pytest.mark.parametrize("limit", [2, 40, 10 ** 6])
def test_trie(spark, limit):
    rows = talks()
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], TALK)
    got = prefix_trie.rebuilt_trie(df, limit).collect()
    assert sorted(map(tuple, got), key=repr) == trie_by_hand(rows)


def test_trie_sql_and_empty(spark):
    rows = [r for r in talks() if r[1] is not None or r[0] is None]
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    sql = duckdb.sql(prefix_trie.NODE_SQL).fetchall()
    assert sorted(sql, key=repr) == trie_by_hand(rows)
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], TALK)).collect() == []
    only = spark.createDataFrame([(3, 0, "user", "x", 1, "", "")], TALK)
    assert [tuple(r) for r in prefix_trie.rebuilt_trie(only).collect()] == trie_by_hand([(3, 0, "user", "x")])


# Merkle manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, g string, at long, run long, slots string"


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def fielded(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes: list) -> list:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def steps(tree: list, i: int) -> list:
    out = []
    for nodes in tree[:-1]:
        a = i - i % 16
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1:a + 16])))
        i //= 16
    return out


def merkle_by_hand(rows) -> list[tuple]:
    groups: dict = {}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for d, t, lang, s, n in rows:
        touched = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
        leaf = sha(*map(fielded, (d, s, lang, n, t)))
        start = sha(*map(fielded, (d, s, lang, n, t if t is None else t.translate(low)))) if touched else leaf
        groups.setdefault(s, []).append(((d is not None, d or 0), leaf, d, start))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([leaf for _, leaf, _, _ in sorted(groups[s])]) for s in order}
    crown = levels([trees[s][-1][0] for s in order])
    root, out = crown[-1][0], []
    for j, s in enumerate(order):
        for i, (_, leaf, d, start) in enumerate(sorted(groups[s])):
            path, folded = steps(trees[s], i) + steps(crown, j), start
            for a, b in path:
                folded = sha(a, folded, b)
            out.append((d, leaf, trees[s][-1][0], root, sha(*[a + b for a, b in path]), folded, folded == root))
    return sorted(out, key=repr)


def leaves(n: int) -> list[tuple]:
    rng = random.Random(n)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["a", "\u00e9", "z", "", None])
        rows.append((rng.choice([i, i * 1000003 - 500, -i]), rng.choice(["Some Text", "some text", None, "", "\u00c9A"]) if i % 3 else f"T{i}", rng.choice(["en", None]), source, rng.choice([None, 5])))
    rows += [(7, "X", "en", "hot", 1)] * 3 + [(7, "Y", "en", "hot", 1), (None, "N", None, "hot", None), (None, "N", None, "hot", None), (None, "M", None, None, None)]
    rows += [(i, f"s{i}", "en", f"src{i:04d}", 1) for i in range(40)]
    return rows


@pytest.mark.parametrize("n", [600, 1])
def test_merkle(spark, n):
    rows = leaves(n)
    got = merkle.audit(spark.createDataFrame([(*r, 0, "x", 0, 0, "y") for r in rows], DOCS)).collect()
    assert sorted(map(tuple, got), key=repr) == merkle_by_hand(rows)


def test_merkle_small_blocks_and_sparse_ids(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 4)
    monkeypatch.setattr(merkle, "RUN", 3)
    rows = [(None if i % 2 else i * 7919, f"T{i % 11}", "en", "hot", 1) for i in range(150)]
    got = merkle.audit(spark.createDataFrame([(*r, 0, "x", 0, 0, "y") for r in rows], DOCS)).collect()
    assert sorted(map(tuple, got), key=repr) == merkle_by_hand(rows)


def test_merkle_lone_leaf_empty_and_sql(spark):
    one = [(9, "Aa", "en", "s", 2)]
    df = lambda rows: spark.createDataFrame([(*r, 0, "x", 0, 0, "y") for r in rows], DOCS)
    got = merkle.audit(df(one)).collect()
    assert [tuple(r) for r in got] == merkle_by_hand(one) and got[0]["root"] == got[0]["leaf"]
    assert merkle.audit(df([])).collect() == []
    rows = [(i, f"T{i}" if i % 7 else None, "en", ["a", None, "\u00e9"][i % 3] if i % 2 else "hot", i) for i in range(300)]
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])  # noqa: F841
    assert sorted(duckdb.sql(merkle.audit_sql(3)).fetchall(), key=repr) == merkle_by_hand(rows)


# licence scan


def scan_by_hand(rows, templates, threshold=license_scan.THRESHOLD) -> list[tuple]:
    out = []
    for d, t, *_ in rows:
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        places = sorted((i, label) for p, label in license_scan.PHRASES.items() for i in range(len(ws)) if ws[i:i + len(p.split())] == p.split())
        found, s, best = set(), license_scan.SPAN, 0.0
        for a in range(0, max(0, len(ws) - s - 1) + 1, s):
            block = set(ws[a:a + 2 * s])
            for label, text in templates:
                want = set(license_scan.words(text))
                share = len(want & block) / len(want)
                if share >= threshold - 1e-9:
                    found.add(label)
                    best = max(best, share)
        base = {label for _, label in places}
        out.append((d, len(ws), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if places else best))
    return sorted(out, key=repr)


def test_license_scan(spark):
    rng = random.Random(5)
    texts = [None, "", "!!", "Under the MIT license", "under the mit license" * 2, "x under  the\nMIT-License, under the mit license", "Apache License, Version 2.0", "CC BY-NC", "cc by nc2", "\u00e9cc by nc", "UNDER THE M\u0130T LICENSE"]
    for label, notice in license_scan.TEMPLATES:
        ws = notice.split(" ")
        for gone in (0, 1, 3):
            kept = [w for i, w in enumerate(ws) if i not in rng.sample(range(len(ws)), min(gone, len(ws) - 1))]
            texts.append(cases.prose(rng, rng.randrange(0, 150)) + "\n" + " ".join(kept) + ".\n" + cases.prose(rng, rng.randrange(0, 150)))
        rng.shuffle(ws)
        texts.append(" ".join(ws))
    texts.append(" ".join(["the cc by under license apache version"] * 4000) + " under the mit license")
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(3, "twice", "s"), (3, "twice", "s"), (None, "CC by NC", "s")]
    docs = cases.table(spark, rows)
    got = license_scan.report(docs, license_scan.fit(docs)).collect()
    assert sorted(map(tuple, got), key=repr) == scan_by_hand(rows, license_scan.TEMPLATES)
    assert [r for r in got if r["doc_id"] == 8][0]["n_base"] == 0
    low = [("lost", "alpha beta gamma delta"), ("one", "epsilon")]
    got = license_scan.report(docs, license_scan.fit(docs, low, 0.5)).collect()
    assert sorted(map(tuple, got), key=repr) == scan_by_hand(rows, low, 0.5)


def test_license_scan_keeps_columns_and_takes_no_templates(spark):
    docs = cases.table(spark, [(1, "CC BY NC", "s")])
    got = license_scan.scan(docs, license_scan.fit(docs, [])).collect()
    assert got[0]["n_words"] == "v" and got[0]["lic"]["n_words"] == 3 and got[0]["lic"]["found"] == []
    assert license_scan.report(cases.table(spark, []), license_scan.fit(cases.table(spark, []))).collect() == []
    with pytest.raises(ValueError, match="different words"):
        license_scan.fit(docs, [("x", " ".join(f"w{i}" for i in range(60)))])
