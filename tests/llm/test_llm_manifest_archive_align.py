"""Operators 11 to 13 against plain Python."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.llm import alignment, merkle, warc

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root int, tree string, `at` string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ 11
def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree_of(level):
    """Levels of a tree, three consecutive nodes under one."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, pos):
    steps = []
    for level in levels[:-1]:
        start = pos // 3 * 3
        steps.append(("".join(level[start:pos]), "".join(level[pos + 1:start + 3])))
        pos //= 3
    return steps


def plain_manifest(docs):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, source, lang, n_chars, text)."""
    by = {}
    for d in docs:
        by.setdefault(d[1], []).append(d)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        own = sorted(((d[0] is not None, d[0] or 0, H(*map(framed, d)), d) for d in by[s]), key=lambda x: x[:3])
        trees.append((own, tree_of([x[2] for x in own])))
    top = tree_of([t[-1][0] for _, t in trees]) if trees else None
    out = []
    for k, (own, levels) in enumerate(trees):
        for pos, (_, _, leaf, d) in enumerate(own):
            steps = way(levels, pos) + way(top, k)
            start = leaf
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0:
                start = H(*map(framed, (*d[:4], None if d[4] is None else d[4].replace("\n", ""))))
            for a, b in steps:
                start = H(a, start, b)
            out.append((d[0], leaf, levels[-1][0], top[-1][0], H(*[a + b for a, b in steps]), start, start == top[-1][0]))
    return sorted(out, key=repr)


def manifest_of(spark, docs, tmp, parts=3):
    df = spark.createDataFrame([(*d, "x", 1, None, "y") for d in docs], DOCS).repartition(parts)
    df.write.mode("overwrite").parquet(f"{tmp}/documents.parquet")
    return rows_of(merkle.op11_merkle_manifest(spark, str(tmp)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


LONG = "line\n" * 200_000


@pytest.mark.parametrize("case", ["one", "edges", "hot", "many sources"])
def test_manifest(spark, tmp_path, case):
    rng = random.Random(case)
    docs = {
        "one": [(5, "a", "en", 3, "a\nb")],
        "edges": [(1, None, None, None, None), (None, None, "en", 0, ""), (2, "", "é", 1, "\n"), (2, "", "é", 1, "\n"),
                  (-7, "zß", "x", 2, LONG), (9, "\U0001f600", "x", 2, "t"), (8, "￿", "x", 2, "t"), (None, "a", None, 4, "same\n")],
        "hot": [(i, "hot" if i % 3 else f"s{i % 7}", "en", i, f"text {i}\nmore") for i in range(2300)],
        "many sources": [(i, f"s{rng.randrange(400)}", "en", i, "x\n" * (i % 3)) for i in range(900)],
    }[case]
    assert manifest_of(spark, docs, tmp_path) == plain_manifest(docs)


def test_manifest_by_shuffled_joins(spark, tmp_path, monkeypatch):
    """Ancestors that are too many to broadcast are joined by a shuffle, with the same result."""
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    docs = [(i, f"s{min(i % 11, 3)}", None, i, "a\n") for i in range(1200)]
    assert manifest_of(spark, docs, tmp_path) == plain_manifest(docs)


def test_manifest_of_nothing(spark, tmp_path):
    assert manifest_of(spark, [], tmp_path) == []


def test_manifest_notices_any_change(spark, tmp_path):
    docs = [(i, "s", "en", i, f"t{i}") for i in range(30)]
    root = manifest_of(spark, docs, tmp_path)[0][3]
    for column, new in ((0, 99), (1, None), (2, "de"), (3, None), (4, "t7 ")):
        changed = [tuple(new if c == column and d[0] == 7 else v for c, v in enumerate(d)) for d in docs]
        assert manifest_of(spark, changed, tmp_path)[0][3] != root


# ------------------------------------------------------------------ 12
PAGES = "page_id long, url string, html string, rid int, payload string, same string, refers string"
TRICKY = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nb"


def plain_warc(pages):
    best = {}
    for page_id, _, html in pages:
        best[html or ""] = max(best.get(html or "", page_id), page_id, key=lambda v: (v is not None, v or 0))
    out, seen = [], set()
    for page_id, _, html in pages:
        raw = (html or "").encode()
        first = best[html or ""] == page_id and (html or "") not in seen
        if first:
            seen.add(html or "")
        out.append((page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit",
                    None if first else best[html or ""]))
    return sorted(out, key=repr)


def warc_of(spark, pages, tmp):
    spark.createDataFrame([(*p, 1, "x", "y", "z") for p in pages], PAGES).repartition(3).write.mode("overwrite").parquet(f"{tmp}/pages.parquet")
    return rows_of(warc.op12_warc(spark, str(tmp)))


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a.org/x y?q=é#f", "hello"), (2, None, "hello"), (3, "not a url\r\nX: y", ""), (4, "http://WARC/1.1", None),
             (5, "http://b", TRICKY), (6, "", TRICKY), (7, "http://c", "WARC/1." * 3), (8, "http://d", "é\r\n\r\n" * 400_000),
             (None, "http://e", "hello"), (9, "http://f", "twice"), (9, "http://f", "twice"), (None, None, "lonely"), (-3, "u", "\x00\n")]
    pages += [(100 + i, f"http://h/{i}", "hot copy") for i in range(3000)]
    assert warc_of(spark, pages, tmp_path) == plain_warc(pages)


def test_warc_of_nothing(spark, tmp_path):
    assert warc_of(spark, [], tmp_path) == []


def test_warc_records_and_captures(spark, tmp_path):
    """Files of another writer: plain and split, other versions, records that name each other either
    way, orphans, folded headers, a record cut off at the end."""
    def rec(kind, name, block, *more, version=b"1.0"):
        head = [b"WARC/" + version, b"WARC-Type: " + kind, b"WARC-Record-ID: <" + name + b">", *more, b"Content-Length: %d" % len(block)]
        return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"
    http = b"Content-Type: application/http; msgtype=response"
    body = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\xff\xfe WARC/1.1\r\nnot a record" + b"x" * 3_000_000
    data = (rec(b"warcinfo", b"i", b"software: x\r\n") + rec(b"response", b"r1", body, http, b"WARC-Concurrent-To: <q1>")
            + rec(b"request", b"q1", b"GET / HTTP/1.1\r\n\r\n", http, version=b"1.1")
            + rec(b"metadata", b"m1", b"a: 1\r\n", b"WARC-Concurrent-To: <q1>")
            + rec(b"metadata", b"m2", b"a: 2\r\n", b"WARC-Concurrent-To:\r\n <r1>")
            + rec(b"response", b"r2", b"HTTP/1.1 404 No\r\n\r\n", http) + rec(b"request", b"q9", b"GET / HTTP/1.1\r\n\r\n", http))
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.warc").write_bytes(data + rec(b"response", b"cut", body, http)[:500])
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300_000)
    try:
        found = warc.records(spark, str(tmp_path / "a"))
        rows = {r["record_id"]: r for r in found.collect()}
        made = {(r["capture"] or {"record_id": None})["record_id"]: r for r in warc.captures(found).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert set(rows) == {f"<{x}>" for x in ("i", "r1", "q1", "m1", "m2", "r2", "q9", "cut")}
    assert bytes(rows["<r1>"]["payload"]) == body[body.index(b"\r\n\r\n") + 4:] and rows["<r1>"]["intact"]
    assert not rows["<cut>"]["intact"]
    ids = lambda rs: [r["record_id"] for r in rs or []]
    assert ids(made["<r1>"]["requests"]) == ["<q1>"] and ids(made["<r1>"]["metadata"]) == ["<m1>", "<m2>"]
    assert ids(made["<r2>"]["requests"]) == [] and ids(made[None]["requests"]) == ["<q9>"]


# ------------------------------------------------------------------ 13
def plain_alignment(texts):
    both = alignment.aligner(*alignment.default_models())
    coded = []
    for t in texts:
        full = (" " + (t or "")).encode()
        a, b = both.a.encode(" " + (t or ""), add_special_tokens=False).ids, both.b.encode(t or "")
        if not t or b"".join(both.a_bytes[i] for i in a) != full or b"".join(both.b_bytes[i] for i in b) != full:
            a, b = [], []
        spans = []
        for ids, words in ((a, both.a_bytes), (b, both.b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((i, at, at + len(words[i])))
                at += len(words[i])
            spans.append(own)
        coded.append(spans)
    count = Counter()
    links = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in coded]
    for one in links:
        count.update(one)
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for (a, b), own in zip(coded, links, strict=True):
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, lo = [], 0
        for hi in ends:
            groups.append("|".join(",".join(str(x[0]) for x in side if lo < x[2] <= hi) for side in (a, b)))
            lo = hi
        text = ";".join(groups)
        out.append((len(a), len(b), len(groups), len(own), sum(count[p] == most[p[1]] for p in own), sum(count[p] for p in own),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


PARTS = [" ", "  ", "a", "aa", "\n", "\t", "-", "--", "'s", "é", "1", "=", "😀", "　", "\x85", "\x1c", "​", "▁", "<0x0A>",
         "<s>", "<|endoftext|>", "漢字", "the", "word", "\x00", "\xa0", "é", "ﬁ", "Ω", "﻿"]


def test_alignment(spark, tmp_path):
    rng = random.Random(11)
    texts = [None, "", " ", "  ", "a", "the word ", "▁", "x" * 3000, "漢" * 300 + " the", "same text", "same text"]
    texts += ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 30))) for _ in range(400)]
    texts += [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(30).select(F.substring("text", 1, 3000).alias("text")).collect()]
    rows = [(i, t, 1, "x", 2) for i, t in enumerate(texts)]
    rows[3] = (None, *rows[3][1:])
    rows[10] = (9, *rows[10][1:])  # a repeated row
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk int, pairs string, at int").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(((r[0], *w) for r, w in zip(rows, plain_alignment(texts), strict=True)), key=repr)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(alignment.op13_alignment(spark, str(tmp_path)).select(columns)) == want
    # many chunks, the same totals
    assert rows_of(alignment.digests(df, *alignment.default_models(), chunk_bytes=500).select(columns)) == want


def test_alignment_tokens(spark):
    """The tokens' bytes are the text's, and ends are those of the decoded bytes."""
    both = alignment.aligner(*alignment.default_models())
    texts = ["héllo  wörld 漢字🙂 \n x", "naïve café ", None, "a▁b", "<s> tokens</s>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in alignment.align(df, *alignment.default_models()).collect():
        text = texts[r["doc_id"]]
        if text is None or "▁" in text:
            assert r["a_ids"] == r["b_ids"] == r["a_ends"] == []
            continue
        for ids, ends, words in ((r["a_ids"], r["a_ends"], both.a_bytes), (r["b_ids"], r["b_ends"], both.b_bytes)):
            full, at = (" " + text).encode(), 0
            for i, end in zip(ids, ends, strict=True):
                assert full[at:end] == words[i]
                at = end
            assert at == len(full)


def test_alignment_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.digests(df, *alignment.default_models()).count() == 0
