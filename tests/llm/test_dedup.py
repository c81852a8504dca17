"""Jaccard join, substring dedup and line dedup against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabprep.llm import jaccard_join, line_dedup, substring_dedup
from tabprep.llm.components import components
from tests.llm import cases


def test_jaccard_classes(spark):
    rows = cases.texts()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(cases.table(spark)).collect()}
    assert got == cases.jaccard_classes(rows)


def test_jaccard_other_width_and_threshold(spark):
    rows = cases.texts()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(cases.table(spark), 5, 80).collect()}
    assert got == cases.jaccard_classes(rows, 5, 80)


@pytest.mark.parametrize("percent", [80, 90])
def test_jaccard_near_copies_of_all_sizes(spark, percent, monkeypatch):
    """Chains of near copies, small and large sets, lists and blocks cut short."""
    monkeypatch.setattr(jaccard_join, "LIST", 20)
    monkeypatch.setattr(jaccard_join, "BLOCK", 600)
    rng, rows = random.Random(percent), []
    for g in range(12):
        base = cases.prose(rng, rng.choice([4, 6, 9, 12, 20, 45, 120]), f"g{g}").split()
        for _ in range(rng.choice([2, 5, 40])):
            if rng.random() < 0.5 and len(base) > 4:
                base = list(base)
                base[rng.randrange(len(base))] = f"y{rng.randrange(1000)}"
            rows.append((len(rows), " ".join(base), "a"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(cases.table(spark, rows), 3, percent).collect()}
    assert got == cases.jaccard_classes(rows, 3, percent)


def star(n: int, size: int = 402) -> list[str]:
    """A text and n variants of it, near to it and not to each other."""
    rng, base = random.Random(n), [f"w{i}" for i in range(size)]
    out = [" ".join(base)]
    for v in range(n):
        words = list(base)
        for at in rng.sample(range(2, size - 2, 3), size // 67):
            words[at] = f"v{v}x{at}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("cell_count, most, chunks", [(4096, 200, [1024] * 3), (64, 300, [100] * 40), (4096, 256, [256, 1, 255, 1000, 1000])])
def test_long_lists_unite_whole_over_chunks(cell_count, most, chunks):
    """Lists several chunks long, each followed by another list."""
    rng, key, doc, cells = np.random.default_rng(1), [], [], []
    for k, m in enumerate([3, 1200, 257, 2, 900, 40]):
        key += [k] * m
        doc += range(len(doc), len(doc) + m)
    for _ in doc:
        cells.append(np.bincount(rng.integers(0, cell_count, 60), minlength=cell_count).astype(np.uint8).tobytes())
    rows, batches = pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array([60] * len(doc)), pa.array(cells, pa.binary())], ["key", "doc", "n", "cells"]), []
    while sum(len(b) for b in batches) < len(doc):
        batches.append(rows.slice(sum(len(b) for b in batches), chunks[len(batches)]))
    up = list(range(len(doc)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for out in jaccard_join.unite(iter(batches), 90, cell_count, most):
        for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
            assert key[a] == key[b]
            p, q = sorted((root(a), root(b)))
            up[q] = p
    step = max(256, 8192 * 64 // cell_count)
    for k, m in ((1, 1200), (4, 900)):
        assert m <= most + step or len({root(d) for d in doc if key[d] == k}) == 1


def test_jaccard_star_longer_than_a_chunk(spark, monkeypatch):
    """A group of several chunks whose members link to its first one only."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 20000)
    monkeypatch.setattr(jaccard_join, "FINE_LIST", 200)
    rows = [(i, t, "a") for i, t in enumerate(star(356, 150))]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(cases.table(spark, rows)).collect()}
    assert got == cases.jaccard_classes(rows)


def grouped(spark, monkeypatch, rows, *args) -> tuple[dict, int]:
    """Classes, and how many documents the filters leave in groups."""
    found, real = {}, jaccard_join.stored

    def spy(df, name):
        found[name] = out = real(df, name)
        if name == "jaccard-groups":
            found["n"] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stored", spy)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(cases.table(spark, rows), *args).collect()}
    return got, found["n"]


@pytest.mark.parametrize("most", [1024, 10])
def test_jaccard_passage_of_most_of_each_set_groups_nothing(spark, monkeypatch, most):
    """Sets that share 86 % of each, which is below the similarity, in lists
    filtered by cells and in long ones; links are among two of them."""
    monkeypatch.setattr(jaccard_join, "LIST", most)
    passage = [f"p{i}" for i in range(602)]
    rows = [(i, " ".join([*passage, *[f"o{i}x{j}" for j in range(100)]]), "a") for i in range(60)]
    rows.append((60, rows[7][1] + " tail", "a"))
    got, n = grouped(spark, monkeypatch, rows, 3, 80)
    assert got == cases.jaccard_classes(rows, 3, 80) and got[60][1] == 7
    assert n <= 2


def test_jaccard_unlike_large_sets_are_parted(spark, monkeypatch):
    """Large sets of one size with a few words in common: 64 cells cannot part
    them. Copies of all sizes, on either side of a rung, still link."""
    rows, rungs = [], [size for size, _ in jaccard_join.ladder(80)]
    for i in range(24):
        rows.append((i, " ".join([f"d{i}x{j}" for j in range(3000)] + [f"c{j}" for j in range(8)]), "a"))
    for g, n in enumerate([*rungs[1:], 3000]):
        base = [f"e{g}x{j}" for j in range(n + 2)]
        rows.append((100 + 3 * g, " ".join(base), "a"))
        rows.append((101 + 3 * g, " ".join(base[:-n // 7]), "a"))
        rows.append((102 + 3 * g, " ".join([*base, *[f"f{g}x{j}" for j in range(n // 7)]]), "a"))
    got, n = grouped(spark, monkeypatch, rows, 3, 80)
    assert {d: c for d, (_, c) in got.items()} == {d: d if d < 100 else d - (d - 100) % 3 for d, _, _ in rows}
    assert n == 9


def test_one_of_each_keeps_the_smallest(spark):
    rows = [*cases.texts(), (None, "a document without an id stays here", "a")]
    kept = jaccard_join.one_of_each(cases.table(spark, rows))
    want = cases.jaccard_classes(cases.texts())
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == sorted(d for d, (_, c) in want.items() if d == c)
    assert kept.filter("doc_id is null").count() == 1
    assert kept.columns == cases.table(spark).columns


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 400)] + [(5, 5), (None, 3)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = sorted((root(a), root(b)))
            up[q] = p
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("shard", [256, 1])
def test_substring_dedup(spark, shard, monkeypatch):
    """Both ways of a shard: held as an automaton, or grouped by window."""
    monkeypatch.setattr(substring_dedup, "SHARD", shard)
    rows = cases.texts()
    got = substring_dedup.dedup(cases.table(spark), digest=True)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", F.col("kept")).collect()) == cases.window_cut(rows)


def test_substring_dedup_keeps_texts_and_other_columns(spark):
    rows = [(None, "a b c d e f g h i j k l m n", "s"), (2, "a b c d e f g h i j k l m n", "s"), (3, "z a b c d e f g h i j k l m y", "s")]
    got = {r["doc_id"]: r for r in substring_dedup.dedup(cases.table(spark, rows)).collect()}
    assert got[None]["kept"] == got[2]["kept"] == "a b c d e f g h i j k l m n"
    assert got[3]["kept"] == "z y" and got[3]["start"] == "v"


def test_automaton_minima():
    rng = random.Random(3)
    for _ in range(200):
        seqs = sorted((rng.randrange(9), [rng.randrange(3) for _ in range(rng.randrange(4, 14))]) for _ in range(rng.randrange(1, 6)))
        auto = substring_dedup.Automaton()
        for number, s in seqs:
            auto.add(s, number)
        for _, s in seqs:
            want = [min(n for n, t in seqs if any(t[j:j + 4] == s[i:i + 4] for j in range(len(t) - 3))) for i in range(len(s) - 3)]
            assert auto.smallest(s, 4) == want


def test_line_dedup(spark):
    rows = cases.texts()
    got = line_dedup.report(cases.table(spark))
    assert sorted(tuple(r) for r in got.collect()) == cases.line_cut(rows)


def test_line_dedup_texts(spark):
    line = "a line that is long enough to be compared"
    rows = [(1, line + "\nx\n" + line, "s"), (2, "y\n" + line[:-1], "s"), (3, None, "s"), (None, line, "s"), (4, "nothing here repeats, at all, anywhere", "s")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(cases.table(spark, rows)).collect()}
    assert got == {1: line + "\nx", 2: "y", 3: None, None: "", 4: rows[4][1]}


def test_banded_edit_distance(spark):
    rng, rows = random.Random(5), []
    for _ in range(1500):
        a = [rng.choice("abc") for _ in range(rng.randrange(15))]
        b = list(a)
        for _ in range(rng.randrange(5)):
            i = rng.randrange(len(b) + 1)
            b[i:i + rng.randrange(2)] = [rng.choice("abcd")] * rng.randrange(2)
        a, b = sorted(("".join(a), "".join(b)), key=len, reverse=True)
        rows.append((a, b))
    df = spark.createDataFrame(rows, "a string, b string")
    for edits in (1, 2, 3):
        d = line_dedup.edit_distance(F.col("a").cast("binary"), F.col("b").cast("binary"), edits)
        bad = df.select(d.alias("d"), F.levenshtein("a", "b").alias("l")).filter(f"(l <= {edits} and d <> l) or (l > {edits} and d <= {edits})")
        assert bad.count() == 0


def test_empty_tables(spark):
    none = cases.table(spark, [])
    assert jaccard_join.classes(none).count() == 0
    assert substring_dedup.dedup(none).count() == 0
    assert line_dedup.report(none).count() == 0
    assert line_dedup.dedup(none).count() == 0


def test_spans_that_no_smaller_document_reaches_do_not_meet_the_join(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)) + " " + " ".join(f"same{j}" for j in range(15)) + " " + " ".join(f"v{i}x{j}" for j in range(40))) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole, made, kept = substring_dedup.spans, [], []
    tables, thrown = substring_dedup.stored, substring_dedup.discard
    monkeypatch.setattr(substring_dedup, "spans", lambda *a: made.append(whole(*a)) or made[-1])
    monkeypatch.setattr(substring_dedup, "stored", lambda df, name: kept.append(name) or tables(df, name))
    monkeypatch.setattr(substring_dedup, "discard", lambda *t: kept.append("gone") or thrown(*t))
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup(docs).collect()}
    assert got == {i: 15 if i else 0 for i in range(6)}
    # windows that lie partly outside the common passage have an anchor in it, but no smaller document
    assert made[1].count() < made[0].count()
    # the shards are gone before the places are looked up
    assert kept.index("shards") < kept.index("span-minima") < len(kept) - 1 - kept[::-1].index("gone") < kept.index("removals")
