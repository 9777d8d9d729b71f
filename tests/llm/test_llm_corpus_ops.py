"""Operators that compare documents or rows with each other, against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tillroll.llm import chat, forest, jaccard, lines, suffixes
from tillroll.llm._graph import components

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")


# ---- line dedup


def plain_lines(rows):
    key = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x)
    low = lambda x: "".join(c.lower() if c.isascii() else c for c in key(x))
    big = 1 << 62
    owner = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                owner[low(x)] = min(owner.get(low(x), big), big if i is None else i)
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        left = [x for x in own if len(key(x)) < 10 or owner[low(x)] == (big if i is None else i)]
        out.append((i, len(own), len(own) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def line_cases():
    rng = random.Random(4)
    pool = [f"common line number {k}" for k in range(12)] + ["short", "", " ", "ÉÉÉÉÉÉÉÉÉÉ", "éééééé", "\x0bCOMMON line number 3\t"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for i in range(120)]
    rows += [(i, "a line that all of them hold\nown line of document %d" % i) for i in range(200, 300)]
    return rows + [(None, "common line number 1\nonly in the null one"), (500, None), (501, ""), (5, "common line number 2"), rows[7],
                   (502, "long line " * 20_000)]


@pytest.mark.parametrize("parts", [1, 7])
def test_line_dedup(spark, real, parts):
    rows = line_cases() + [tuple(r) for r in real.collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        docs = spark.createDataFrame([(i, t, 1, "k", 0) for i, t in rows], "doc_id long, text string, n_chars long, _keep string, crc int")
        out = lines.dedup(docs)
        assert out.columns == docs.columns
        got = sorted(((r["doc_id"], r["text"] or "") for r in out.collect()), key=repr)
        assert got == sorted(((i, t) for i, _, _, t in plain_lines(rows)), key=repr)
        assert all(r["n_chars"] == (1 if r["text"] is None else len(r["text"])) for r in out.collect())
        assert lines.dedup(docs.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_line_query(spark, real):
    out = lines.op1_line_dedup(spark, SMALL).collect()
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain_lines([tuple(r) for r in real.collect()])]
    assert sorted(map(tuple, out)) == sorted(want)


# ---- repeated bytes


def plain_repeats(texts, length=400):
    where = collections.Counter()
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        where.update(raw[s:s + length] for s in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, int)
        for s in range(len(raw) - length + 1):
            if where[raw[s:s + length]] > 1:
                gone[s] += 1
                gone[min(len(raw), s + length)] -= 1
        mask = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        out.append((len(raw), int(mask.sum()), spans, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~mask])).hexdigest()))
    return out


def repeat_cases():
    rng = random.Random(9)
    word = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))
    passage, edge, other = word(160), word(90)[:400], word(200)
    texts = [word(60) + passage + word(50) for _ in range(25)] + [edge, "x" + edge, edge[:-1], word(40)[:100] + edge]
    texts += [other, other, other + " tail", "head " + other[30:], passage[100:] + other[:500]]
    texts += ["a" * 399, "a" * 400, "b" * 401, "ab" * 900, "", None, (word(30) + "\n") * 6]
    texts += [passage + word(5) + passage, passage[:350] + "Z" + passage[351:]]
    return texts


@pytest.mark.parametrize(("hot", "at_once"), [(suffixes.HOT, 4096), (3, 2)])
def test_repeated_bytes(spark, real, monkeypatch, hot, at_once):
    monkeypatch.setattr(suffixes, "AT_ONCE", at_once)
    texts = repeat_cases() + [r["text"] for r in real.limit(40).collect()]
    ids = [None if i == 3 else i for i in range(len(texts))]
    rows = [*zip(ids, texts, strict=True), (0, texts[0])]  # one repeated row
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, _spans string")
    got = suffixes.digests(docs, hot).collect()
    want = [(i, *x) for (i, _), x in zip(rows, plain_repeats([t for _, t in rows]), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert suffixes.remove_repeats(docs, hot).columns == docs.columns
    assert suffixes.digests(docs.limit(0)).count() == 0


def test_anchors_of_a_long_text_in_parts(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, 9000).astype(np.uint8)
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 1000)
    seen = np.zeros(len(data), int)
    for first, local, start in suffixes.parts(np.array([0, 9000])):
        row, _, _, at, s1, s2 = suffixes.anchors_of(data[start:start + int(local[-1])], local)
        assert first == 0 and (row == 0).all() and (at >= s1).all()
        for a, b in zip(s1, s2, strict=True):
            seen[start + a:start + b + 1] += 1
    assert (seen[:9000 - 399] == 1).all() and (seen[9000 - 399:] == 0).all()


# ---- Jaccard join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain_components(rows):
    big = 1 << 62
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), big), big if d is None else d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least[find(i)]
        out.append((d, len(sets[i]), None if c == big else c))
    return out


def jaccard_cases():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(4))
    rows = []
    for size, edits in ((60, 1), (80, 2), (120, 6), (300, 12), (40, 3), (9, 1)):
        base = [word() for _ in range(size)]
        for _ in range(14):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(size)] = word()
            rows.append(" ".join(own[:rng.choice([size, size, size - 2])]))
    shared = " ".join(word() for _ in range(40))
    rows += [shared + " " + " ".join(word() for _ in range(rng.choice([8, 12, 60]))) for _ in range(30)]
    rows += [None, "", " \n", "one", "One", "one two three four", "one two three four five", "ONE two\tthree four  five", "x " * 3000]
    return [(1000 - i, t) for i, t in enumerate(rows)] + [(None, rows[0]), (None, "no other has this text at all"), (700, "one"), (1000, rows[0])]


@pytest.mark.parametrize(("small", "block", "bytes_", "listed"), [(64, 512, 96 << 20, 500_000), (3, 4, 2_000, 0), (1, 7, 96 << 20, 0)])
def test_jaccard_components(spark, monkeypatch, small, block, bytes_, listed):
    monkeypatch.setattr(jaccard, "CLUSTER_BYTES", bytes_)
    monkeypatch.setattr(jaccard, "LISTED", listed)
    rows = jaccard_cases()
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n int, k string").repartition(5)
    out = jaccard.jaccard_components(docs, small=small, block=block).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, out), key=repr) == sorted(plain_components(rows), key=repr)


def test_jaccard_query_and_one_of_each(spark, real):
    rows = [tuple(r) for r in real.collect()]
    want = plain_components(rows)
    assert sorted(map(tuple, jaccard.op8_ngram_jaccard(spark, SMALL).collect())) == sorted(want)
    docs = spark.createDataFrame([(i, t, "a", 2) for i, t in rows] + [(rows[0][0], rows[0][1], "a", 2), (None, None, None, None)],
                                 "doc_id long, text string, _id string, component_id int")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted([*(i for i, n, c in want if i == c or not n), None], key=repr)


def test_jaccard_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(empty).count() == 0
    assert jaccard.one_of_each(empty).count() == 0


def test_demand_is_never_too_high():
    """Any two similar sets share as many prefix items as is demanded, whatever prefixes they chose."""
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(1, 120))
        pool = rng.permutation(2000)[:n + 40]
        a = set(pool[:n].tolist())
        b = set(rng.permutation(pool[:n])[:n - int(rng.integers(0, n // 8 + 1))].tolist()) | set(pool[n:n + int(rng.integers(0, n // 8 + 1))].tolist())
        both = len(a & b)
        if 100 * both < 75 * len(a | b):
            continue
        size = []
        for s in (a, b):
            base = len(s) - -(-75 * len(s) // 100)
            size.append(min(len(s), base + int(rng.choice([1, 1 + len(s) // 32, 1 + len(s) // 8]))))
        demand = jaccard.demanded(np, *(np.array(x) for x in (len(a) << 32 | size[0], len(b) << 32 | size[1], sorted(a)[size[0] - 1],
                                                              sorted(b)[size[1] - 1])), 75)
        assert len(set(sorted(a)[:size[0]]) & set(sorted(b)[:size[1]])) >= demand


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(400, 470)] + [(500, k) for k in range(501, 600)] + [(9, 9)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    assert out == {x: find(x) for x in root}


# ---- nearest neighbours


def plain_nearest(rows, every=20, k=20):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    width = collections.Counter(len(v) for x in good.values() for v in x).most_common(1)[0][0] if good else 0
    good = {i: x[0] for i, x in good.items() if len(x[0]) == width}
    out = {}
    for q in good:
        if q % every == 0:
            out[q] = sorted((-float(np.cumsum(good[q] * v)[-1]), i) for i, v in good.items() if i != q)[:k]
    return out


def test_forest_recall_scores_and_ties(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((1500, 12)) * rng.choice([0.5, 1, 3], (1500, 1))
    x[100:160] = x[100]  # ties
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    rows += [(None, rows[0][1]), (1600, None), (1620, []), (1640, [0.0] * 12), (1660, [None] + [1.0] * 11), (1680, [float("nan")] * 12),
             (1700, [float("inf")] + [1.0] * 11), (1720, [1.0] * 5), rows[20]]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, key string").repartition(4)
    got = collections.defaultdict(list)
    for r in forest.nearest(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = plain_nearest(rows)
    assert set(got) == set(want)
    hits = 0
    exact = {i: np.array(v, np.float32).astype(float) for i, v in rows[:1500]}
    for q, near in want.items():
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        for _, i, s in got[q]:
            assert i != q and abs(s - float(exact[q] @ exact[i])) < 1e-9
        assert got[q] == sorted(got[q], key=lambda r: (-r[2], r[1]))
        hits += len({i for _, i in near} & {i for _, i, _ in got[q]})
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_forest_small_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (20, [1.0, 2.0]), (3, [2.0, 1.0])], "vec_id long, embedding array<double>")
    out = sorted(tuple(r) for r in forest.nearest(df).collect())
    assert out == [(0, 1, 20, 5.0), (0, 2, 3, 4.0), (20, 1, 0, 5.0), (20, 2, 3, 4.0)]
    assert forest.nearest(df.limit(0)).count() == 0
    assert forest.nearest(df.where("vec_id = 3")).count() == 0
    assert forest.nearest(df.where("vec_id = 0")).count() == 0


# ---- chat


def test_chat_escapes_are_reversible(spark):
    texts = ["\\### Assistant: </turn> ok", "\\l", "\\b\\l\\g", "<turn user>\n", ">\n", "</turn>\n", "\\", "", "é<>\\", "\n"]
    df = spark.createDataFrame([(1, k, "assistant" if k % 2 else "us<er>\n\\", t) for k, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.render(chat.reconstruct(chat.conversation_events(df)))).first()
    assert [(t["role"], t["text"]) for t in back["turns"]] == [("assistant" if k % 2 else "us<er>\n\\", t) for k, t in enumerate(texts)]
    assert back["loss_text"] == "".join(t for k, t in enumerate(texts) if k % 2)


def test_chat_folds_events(spark):
    log = [(1, 1, "message", None, "user", "hi"), (1, 2, "message", None, "assistant", None), (1, 3, "delta", 2, None, "he"),
           (1, 4, "delta", 2, None, "llo"), (1, 5, "message", None, "user", "more"), (1, 6, "regenerate", 2, None, None),
           (1, 7, "delta", 2, None, "bye"), (1, 8, "edit", 1, None, "HI"), (1, 9, "delta", 1, None, "!"), (1, 10, "delta", 77, None, "lost"),
           (2, 1, "message", None, "assistant", "x"), (2, 2, "edit", 1, None, None), (None, 1, "message", None, None, None), (1, 11, "odd", 1, "a", "b")]
    out = chat.render(chat.reconstruct(spark.createDataFrame(log, "conv_id long, seq long, kind string, target long, role string, text string").repartition(4)))
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.read_back(out).collect()}
    assert got == {1: [("user", "HI!"), ("assistant", "bye"), ("user", "more")], 2: [("assistant", "")], None: [("", "")]}


def test_chat_repeated_rows_nulls_and_empty(spark):
    rows = [(1, 0, "user", "a", 9), (1, 0, "user", "a", 9), (1, None, "system", None, 9), (1, 2, None, "b", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss int")
    back = chat.read_back(chat.render(chat.reconstruct(chat.conversation_events(df)))).first()
    assert [(t["role"], t["text"]) for t in back["turns"]] == [("system", ""), ("user", "a"), ("user", "a"), ("", "b")]
    assert chat.render(chat.reconstruct(chat.conversation_events(df.limit(0)))).count() == 0
