"""Fingerprints, personal data, quality rules, packing, records, WARC, mixing."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabprep.llm import fingerprints, mixing, packing, pii, quality, token_records, warc
from tabprep.llm.encoding import Encoder, encoder
from tests.llm import cases

ODD = ["", "  a b", " a", "a ", "a  b\n\nc d", "a\tb c", "x \n y", "é è z w", "it's  don't\r\nok", "1234 5,6 .. !!", "a\n", "\n", "\n\n\n a b", "日本 語 テスト　x", "a\x1c b c", "x <| y |>"]


# fingerprints


def test_fingerprints(spark):
    rows = [r for r in cases.texts() if r[0] != 62]  # ids occur once here
    got = {r["doc_id"]: r for r in fingerprints.compare_with_next(cases.table(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    errors = []
    for i, (d, t, _) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        cut = len(t) // 3
        edited = t[:len(t) - cut] + following[:cut]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for other, near in ((edited, r["near_edited"]), (following, r["near_next"])):
            a, b = cases.shingles(t, 5), cases.shingles(other, 5)
            true = len(a & b) / len(a | b) if a | b else 1.0
            errors.append(abs(true - near))
            if len(a | b) <= fingerprints.K:
                assert near == pytest.approx(true)
        assert (r["fingerprint"] == r["edited_fingerprint"]) or t != edited
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.02
    assert got[10]["fingerprint"] == got[11]["fingerprint"] and got[2]["fingerprint"] == ""


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(2)
    parts = [(k % 2, " ".join(f"w{rng.randrange(3000)}" for _ in range(500))) for k in range(40)]
    df = spark.createDataFrame(parts, "g int, text string").withColumn("sketch", fingerprints.sketch(F.col("text")))
    got = {r["g"]: r["sketch"] for r in fingerprints.merge(df.select("g", "sketch"), ["g"], fan_in=4, most_parts=64).collect()}
    for g in (0, 1):
        whole = sorted({h for r in df.filter(f"g = {g}").select("sketch").collect() for h in r["sketch"]})[:fingerprints.K]
        assert got[g] == whole
    one = spark.createDataFrame([(got[0], got[1])], "a array<bigint>, b array<bigint>")
    r = one.select(fingerprints.distinct_shingles(F.col("a")).alias("n"), fingerprints.containment(F.col("a"), F.col("a")).alias("c"),
                   fingerprints.from_hex(fingerprints.to_hex(F.col("a"))).alias("back")).first()
    true = len(set().union(*[cases.shingles(t, 5) for g, t in parts if g == 0]))
    assert abs(r["n"] / true - 1) < 0.3 and r["c"] == 1.0 and r["back"] == got[0]


def test_next_document_across_ranges(spark):
    rows = [(i * 7 - 300, f"t{i}") for i in range(200)]
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.next_document(spark.createDataFrame(rows, "doc_id long, text string"), ["text"]).collect()}
    order = sorted(rows, reverse=True)
    assert got == {d: order[(i + 1) % len(order)][1] for i, (d, _) in enumerate(order)}


# personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d: str) -> bool:
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 * (v > 9)
    return s % 10 == 0


def base_spans(t: str) -> list:
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def with_check_digit(d: str) -> str:
    return next(d + c for c in "0123456789" if luhn(d + c))


def test_base_spans_are_exact(spark):
    rng = random.Random(4)
    bits = ["a.b@c.d%e@f.g", "x@y", "@", "1.2.3.4", "999.1.1.1.1.1", "0001.02.3.4", "1.2.3", "+1 (532) 555-7857", "+12", "+1((((", "4111 1111-1111 1111", "4111111111111112", "9" * 40,
            "é", " ", "\n", "😀", ".", "-", "a@b.c.d.", "+49 30 123456", "12-34", "z" * 30, with_check_digit("411111111111111"), "me [at] home.org"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(12))), "s") for i in range(400)] + [(400, None, "s"), (401, "5" * 20000 + "a" * 20000 + "@x.y", "s"), (402, "1 " * 15000, "s")]
    got = {r["doc_id"]: r["s"] for r in pii.detect(cases.table(spark, rows), None).select("doc_id", pii.listed(F.col("_base")).alias("s")).collect()}
    for d, t, _ in rows:
        assert got[d] == ",".join(base_spans(t or "")), t


def test_trees_add_spelled_out_spans_and_leave_clean_text(spark):
    rng = random.Random(9)
    digit = lambda n: "".join(rng.choice("123456789") for _ in range(n))

    def sample(kind):
        return {"email": f"{rng.choice('abcdefg')}n{digit(2)}@mail{digit(1)}.example.com", "ip": ".".join(str(rng.randrange(1, 255)) for _ in range(4)),
                "card": with_check_digit("4" + digit(14)), "phone": f"+1 ({digit(3)}) 555-{digit(4)}"}[kind]

    rows = [(i, f"{cases.prose(rng, 8)} {sample(pii.KINDS[i % 4])} {cases.prose(rng, 8)} v{digit(1)}.{digit(1)} {digit(5)}", "s") for i in range(600)]
    model = pii.fit(cases.table(spark, rows))
    new = [(1000, "write to bob.12 [at] mail3.example.com today", "s"), (1001, "call 001 (555) 555-1234 now", "s"), (1002, "nothing to see here, on 2019-05-23, at page 12 of 345", "s"), (1003, None, "s"),
           (1004, "card 4111/1111/1111/1111 here", "s"), (1005, "build 731.20 and 12, 13, 14, 15 of them", "s")]
    got = {r["doc_id"]: r["s"] for r in pii.detect(cases.table(spark, new), model).select("doc_id", pii.listed(F.col("_all")).alias("s")).collect()}
    assert got[1000].startswith("email:9:") and got[1004] == "card:5:24"
    assert got[1002] == got[1003] == got[1005] == ""
    held = [(2000 + i, f"{cases.prose(rng, 5)} {sample(pii.KINDS[i % 4])} end", "s") for i in range(80)]
    found = {r["doc_id"]: r["s"] for r in pii.detect(cases.table(spark, held), model).select("doc_id", pii.listed(F.col("_all")).alias("s")).collect()}
    assert all(set(base_spans(t)) <= set(found[d].split(",")) for d, t, _ in held)
    red = {r["doc_id"]: r["text"] for r in pii.redact(cases.table(spark, new), model).collect()}
    assert red[1000] == "write to [email] today" and red[1002] == new[2][1] and red[1003] is None


def test_spelled_out_spans_in_the_sample_do_not_stop_the_trees(spark):
    rng = random.Random(11)
    digit = lambda n: "".join(rng.choice("123456789") for _ in range(n))
    octets = lambda: [str(rng.randrange(1, 255)) for _ in range(4)]

    def card(mark):
        c = with_check_digit("4" + digit(14))
        return mark.join(c[i:i + 4] for i in range(0, 16, 4))

    base = [lambda: f"{rng.choice('abcdefg')}n{digit(2)}@mail{digit(1)}.example.com", lambda: ".".join(octets()), lambda: card(""), lambda: f"+1 ({digit(3)}) 555-{digit(4)}"]
    spelled = [lambda: f"{rng.choice('abcdefg')}n{digit(2)} [at] mail{digit(1)}.example.com", lambda: "[.]".join(octets()), lambda: card(rng.choice("./")), lambda: f"001 ({digit(3)}) 555-{digit(4)}"]
    rows = [(i, f"{cases.prose(rng, 8)} {(spelled if i % 3 == 0 else base)[i // 3 % 4]()} {cases.prose(rng, 8)} on 2019-05-{digit(2)}, {digit(5)}", "s") for i in range(900)]
    model = pii.fit(cases.table(spark, rows))
    new = [(i, f"so it is {spelled[i % 4]()} here", "s") for i in range(80)] + [(100, "on 2019-05-23, at page 12 of 345", "s"), (101, "build 731.20 and 12, 13, 14, 15 of them", "s")]
    got = {r["doc_id"]: r["s"] for r in pii.detect(cases.table(spark, new), model).select("doc_id", pii.listed(F.col("_all")).alias("s")).collect()}
    for kind, k in enumerate(pii.KINDS):
        assert sum(f"{k}:9:" in got[i] for i in range(kind, 80, 4)) >= 15, (k, model[2])
    assert got[100] == got[101] == ""


# quality


def labelled_rows():
    rng, rows, labels = random.Random(6), [], []
    for i in range(400):
        good = i % 2
        words = [f"{rng.choice(cases.VOCAB)}{rng.randrange(2000)}" for _ in range(rng.randrange(60, 150))]
        rows.append((i, " ".join(words) if good else "!! ".join(w.upper() for w in words), "s"))
        labels.append((i, good if i < 300 else None))
    return rows, labels


def test_quality_counts_and_verdicts(spark):
    rows, labels = labelled_rows()
    rows += [(r[0] + 1000, *r[1:]) for r in cases.texts()]
    docs = cases.table(spark, rows)
    model = quality.fitted(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = quality.judge(docs, model)
    right = 0
    for r in got.collect():
        text = next(t for d, t, _ in rows if d == r["doc_id"])
        n, chars, symbols, dup, repeat = cases.base_stats(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        failed = n < 50 or 100 * repeat > 50 * n
        assert r["base_failed"] == failed and not (failed and r["kept"])
        if 300 <= r["doc_id"] < 400:  # held out of the fit
            right += r["kept"] == (r["doc_id"] % 2 == 1)
    assert right >= 97
    assert "source" in got.columns and got.columns.count("kept") == 1


def test_quality_without_labels(spark):
    docs = cases.table(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fitted(docs, none) is None
    assert quality.judge(docs, None).filter("kept = base_failed").count() == 0
    assert quality.judge(cases.table(spark, []), None).count() == 0


# tokens


def test_encoder_equals_the_library():
    enc = encoder()
    texts = ODD + [t for _, t, _ in cases.texts() if t]
    for text, got in zip(texts, enc.encode_all(texts), strict=True):
        assert np.frombuffer(got, enc.dtype).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
    for text in ODD:
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def ids_of(text):
    return encoder().tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_records_roundtrip(spark, tmp_path):
    rows = cases.texts()
    manifest = token_records.write(cases.table(spark, rows), str(tmp_path / "rec")).collect()
    got = sorted(tuple(r) for r in token_records.roundtrip(cases.table(spark, rows)).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    want, start = [], 0
    for d, t, _ in sorted(rows, key=lambda r: r[0]):
        ids = [*ids_of(t), token_records.END]
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == sorted(want)
    assert sum(r["records"] for r in manifest) == len(rows)
    r = max(manifest, key=lambda r: r["records"])
    back = list(token_records.records(r["file"], r["index"], np.array([2, 0])))
    every = list(token_records.records(r["file"]))
    assert [b[0] for b in back] == [every[2][0], every[0][0]] and (back[0][1] == every[2][1]).all()
    raw = bytearray(open(r["file"], "rb").read())
    raw[40] ^= 1
    (tmp_path / "bad.rec").write_bytes(bytes(raw))
    with pytest.raises(ValueError, match="damaged"):
        list(token_records.records(str(tmp_path / "bad.rec")))


def test_packing(spark):
    rows = [r for r in cases.texts() if r[0] != 62]
    got = packing.pack(cases.table(spark, rows), group_size=16, with_ids=True).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    enc = encoder()
    for d, t, _ in rows:
        ids = [*ids_of(t), packing.END]
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            part = ids[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), crc(part)) and np.frombuffer(r["ids"], enc.dtype).tolist() == part
            at += r["length"]
        assert at == len(ids)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.LENGTH


def test_packing_bounds_a_worker_s_memory():
    """Neither a batch of many texts nor many different words make a worker
    large: texts are encoded in short runs, and few pieces are remembered."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
    texts = [" ".join(rng.choices(words, k=1200)) for _ in range(1200)]  # about 9 MB
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts, "grp": [0] * len(texts)})
    encoder()
    tracemalloc.start()
    try:
        got = [r["doc_id"] for b in packing.cut_batches([batch]) for r in b.select(["doc_id"]).to_pylist()]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert set(got) == set(range(len(texts)))
    assert most < 60e6  # 159 MB in one run

    enc = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for a in range(0, 2000, 200):
        text = " ".join(f"v{i}" for i in range(a, a + 200))
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = enc.encode_run(data, np.array([0, len(data)]), 500)
        assert ids.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert enc.entries <= 500


def test_first_fit_takes_the_first_bin_with_room():
    rng = random.Random(8)
    for _ in range(50):
        sizes = sorted((rng.randrange(1, 101) for _ in range(rng.randrange(1, 80))), reverse=True)
        bins, offsets = packing.first_fit(np.array(sizes), 100)
        room, want = [], []
        for s in sizes:
            b = next((i for i, r in enumerate(room) if r >= s), len(room))
            room += [100] * (b == len(room))
            want.append((b, 100 - room[b]))
            room[b] -= s
        assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == want


# WARC


def test_warc_roundtrip(spark):
    long, short = "<html>" + "é" * 200, "<p>x</p>"
    rows = [(3, "http://a.b/c", long), (1, "http://a.b/d?x=1\r\nevil: 1", long), (2, None, long), (4, "u", short), (5, "u", short), (6, "v", None), (7, "w", "\r\n\r\nWARC/1.1\r\n" * 50), (8, "w", "y" * 99), (9, "w", "y" * 100), (9, "w", "y" * 100), (10, "w", "y" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {int(r["capture_key"]): r for r in warc.captures(warc.write(pages)).collect()}
    first = {long: 1, "y" * 100: 9}
    assert sorted(got) == list(range(1, 11))
    for key, _, html in rows:
        r, body = got[key], (html or "").encode()
        again = html in first and first[html] != key
        assert (r["payload_bytes"], r["payload_digest"], r["declared_digest"]) == (len(body), hashlib.sha256(body).hexdigest(), hashlib.sha256(body).hexdigest())
        assert r["record_type"] == ("revisit" if again else "response") and r["refers_to"] == (str(first[html]) if again else None)
        assert r["concurrent"]["request"].startswith("GET ") and r["concurrent"]["metadata"].startswith("fetchTimeMs")
        if not again:
            assert bytes(r["payload"]) == body
    assert got[1]["uri"] == "http://a.b/d?x=1evil: 1"
    assert warc.captures(warc.write(pages.limit(0))).count() == 0


def test_warc_null_and_repeated_keys(spark):
    """A row per page, as in the SQL: null keys, a key with several payloads,
    rows that repeat whole."""
    import duckdb

    long, other = "a" * 150, "b" * 200
    rows = [(None, "n1", long), (None, "n2", long), (None, "n2", long), (None, "n3", "x"), (None, None, None), (1, "u", long), (1, "v", long), (1, "u", long),
            (1, "u", other), (1, "u", "x"), (2, "u", long), (2, "u", long), (2, "w", other), (3, "w", other), (3, "w", "x"), (3, "w", "c" * 300), (4, "w", "c" * 300), (4, "w", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.captures(warc.write(pages)).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    text = lambda x: None if x is None else str(x)
    want = [(text(k), n, d, kind, text(to)) for k, n, d, kind, to in con.execute(warc.PAGE_SQL).fetchall()]
    assert sorted(map(str, want)) == sorted(str((r["capture_key"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in got)
    assert len({r["capture_id"] for r in got}) == len(rows)
    assert sorted((r["capture_key"] or "", r["uri"]) for r in got) == sorted((text(k) or "", u or "") for k, u, _ in rows)
    assert all(r["declared_digest"] == r["payload_digest"] and r["concurrent"]["request"] and r["concurrent"]["metadata"] for r in got)


# mixing


def targets_of(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full, out = 1.5 * sum(sizes.values()), {}, {}
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(full.values())) / sum(weight[s] for s in rest) if rest else 0
        out = {**full, **{s: level * weight[s] for s in rest}}
        over = [s for s in rest if out[s] > 2 * sizes[s]]
        if not over:
            return out
        full |= {s: 2.0 * sizes[s] for s in over}


def test_mix(spark):
    rows = cases.texts()
    got = mixing.taken(cases.table(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(cases.words(t))
    want = targets_of(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.taken(cases.table(spark, rows).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_schedule_follows_the_shares(spark):
    docs = cases.table(spark)
    targets, placed, takes = mixing.mix(docs)
    share = {r["src"]: r["hi"] - r["lo"] for r in targets.collect()}
    slots = [r["src"] for r in mixing.schedule(targets).orderBy("slot").collect()]
    for n in (100, 1000, len(slots)):
        for s, p in share.items():
            assert abs(slots[:n].count(s) - p * n) <= 6
    whole = takes.groupBy("src", "bucket", "row", "pass").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("to") - F.col("from")).alias("w"), F.min("from").alias("a"), F.max("to").alias("b"))
    assert whole.filter("w <> b - a or a <> 0").count() == 0


def test_mixed_documents_and_empty_tables(spark):
    rows = [r for r in cases.texts() if r[0] != 62]
    got = mixing.mixed(cases.table(spark, rows))
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken(cases.table(spark, rows)).collect()}
    assert set(counts) == {d for d, t in taken.items() if t} and max(counts.values()) == 2
    assert got.columns == cases.table(spark, rows).columns
    none = cases.table(spark, [])
    assert mixing.taken(none).count() == mixing.mixed(none).count() == 0
    assert fingerprints.compare_with_next(none).count() == 0
    assert packing.pack(none).count() == 0 and token_records.roundtrip(none).count() == 0
    assert pii.fit(none) is None and pii.detect(none, None).count() == 0
