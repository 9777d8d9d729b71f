"""Operator 13: alignment of the tokens of two tokenizers.

``A`` is a byte-level BPE of the tokenizers library, ``B`` a sentencepiece model with
byte fallback that puts a space before the text; A gets that space too, so both cut the
same bytes.  The libraries' spans (character offsets of A, byte spans of B's protos) are
coarse cuts: they are right wherever a token ends at a character's end.  Inside
multibyte characters and byte-fallback runs, which share or lack a span, cuts are placed
by the lengths of the decoded bytes since the last coarse cut.

Neither tokenizer joins across a space that follows a non-space: A's pattern ends its
matches there, and no piece of B holds its space mark after another character (checked
when the model is loaded).  So texts are cut there, and each worker aligns a segment
that it has seen before from memory.

``align`` returns the tokens and their ends for each document.  ``link_chunks`` turns
documents into chunks of ``CHUNK_BYTES`` (a longer document alone), each with a
dictionary of the id pairs that overlap in it; ``pair_counts`` adds the dictionaries up
over the corpus, and ``digests`` sends the totals back to the chunks.  A frequent pair is
one row for each chunk, never one for each occurrence.

Defined cases: a null or empty text, and one whose joined token bytes differ from
space + text (it holds U+2581), has no tokens; special strings are plain text; repeated
rows count each; a null document id is kept; very long texts are chunks of their own;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._stage import staged, table
from .bpe import byte_characters

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE_MARK = "\u2581"
#: White space of either regular-expression dialect other than the plain space.
OTHER_WHITE = "\t-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
HARD = re.compile(f"[{OTHER_WHITE}] ")
CUT = re.compile(f"(?<=[^ {OTHER_WHITE}])(?= )")
WORDS = re.compile(" *[^ ]+| +")
WHITE_END = re.compile(f"[{OTHER_WHITE}]")
#: Characters of new segments that are encoded in one call.
BLOCK_CHARS = 4_000
#: Text of one chunk; bounds the working arrays (about 100 bytes for each byte of text).
CHUNK_BYTES = 2 << 20
#: Tokens remembered by a worker; beyond it the memory starts anew.
REMEMBERED = 5_000_000
COMMA, BAR, SEMICOLON, END = range(4)


def default_models() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES)


def refined(coarse: np.ndarray, sure: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Ends in bytes of each segment's tokens: the coarse one where ``sure``, else the last sure
    one (or the segment's start) plus the decoded lengths since.  ``first`` holds for each token
    the first one of its segment."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    order = np.arange(1, len(lengths) + 1)
    last = np.maximum(np.maximum.accumulate(np.where(sure, order, 0)), first)
    base = np.where(last > first, coarse[last - 1], 0)
    return np.where(sure, coarse, base + total[1:] - total[last])


class Aligner:
    """Both tokenizers, and what the worker remembers of segments."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        back = {c: i for i, c in enumerate(byte_characters())}
        words = {i: s for s, i in self.a.get_vocab(with_added_tokens=False).items()}
        size = max(self.a.get_vocab().values()) + 1
        self.a_bytes = [bytes(back[c] for c in words[i]) if i in words and all(c in back for c in words[i])
                        else (words.get(i) or "").encode() for i in range(size)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
            raise ValueError("a piece holds a space after another character: segments would depend on each other")
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        #: For each segment where its tokens start in the stores, its bytes, and whether it is whole.
        self.starts, self.sizes, self.whole = (array("q", [0]), array("q", [0])), array("q"), array("b")
        self.ids, self.ends = ([], []), ([], [])

    def _learn(self, segments: list[str], alone: bool = False) -> None:
        """Tokens of new segments, each of which begins with a space; B adds its own.

        Segments that end in a non-space are joined to blocks, which the tokenizers cut there again
        (``alone``: each one is a block); others, and those with B's space mark, stay alone."""
        segments = sorted(segments, key=self._odd)
        blocks, sizes = [], []
        for segment in segments:
            if alone or not blocks or len(blocks[-1]) > BLOCK_CHARS or self._odd(segment):
                blocks.append("")
                sizes.append(0)
            blocks[-1] += segment
            sizes[-1] += 1
        joined = "".join(segments)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        wide = np.concatenate([[0], np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))])  # characters to bytes
        upto = wide[np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)))]
        chars = np.fromiter(map(len, blocks), np.int64, len(blocks))
        char_at = np.cumsum(chars) - chars
        byte_at = wide[char_at]

        coded = self.a.encode_batch(blocks, add_special_tokens=False)
        counts_a = np.fromiter(map(len, coded), np.int64, len(blocks))
        found = np.fromiter(chain.from_iterable(chain.from_iterable(x.offsets for x in coded)), np.int64).reshape(-1, 2)
        found = wide[found + np.repeat(char_at, counts_a)[:, None]]
        sure = np.ones(len(found), bool)
        sure[:-1] = found[1:, 0] >= found[:-1, 1]
        ids_a = np.fromiter(chain.from_iterable(x.ids for x in coded), np.int64)
        ends_a = refined(found[:, 1] - np.repeat(byte_at, counts_a), sure, self.a_len[ids_a], np.repeat(np.cumsum(counts_a) - counts_a, counts_a))

        protos = [y.pieces for y in self.b.encode([t[1:] for t in blocks], return_type="proto", num_threads=1)]
        counts_b = np.fromiter(map(len, protos), np.int64, len(blocks))
        spans = np.fromiter(chain.from_iterable((p.id, p.begin, p.end) for y in protos for p in y), np.int64).reshape(-1, 3)
        ids_b = spans[:, 0]
        ends_b = refined(spans[:, 2] + 1, spans[:, 2] > spans[:, 1], self.b_len[ids_b], np.repeat(np.cumsum(counts_b) - counts_b, counts_b))

        raw = joined.encode()
        whole = np.ones(len(segments), bool)
        for ids, words in ((ids_a, self.a_bytes), (ids_b, self.b_bytes)):
            if b"".join([words[i] for i in ids.tolist()]) != raw:
                if len(blocks) < len(segments):
                    return self._learn(segments, alone=True)
                cuts = np.concatenate([[0], np.cumsum(counts_a if ids is ids_a else counts_b)]).tolist()
                whole &= np.array([b"".join([words[i] for i in ids[x:y].tolist()]) == t.encode()
                                   for x, y, t in zip(cuts[:-1], cuts[1:], segments, strict=True)], bool)
        start = np.concatenate([[0], upto[:-1]])
        for k, (ids, ends, counts) in enumerate(((ids_a, ends_a, counts_a), (ids_b, ends_b, counts_b))):
            if len(blocks) == len(segments):
                each = counts
            else:  # a block's tokens end where its segments do
                each = np.bincount(np.searchsorted(upto, ends + np.repeat(byte_at, counts)), minlength=len(segments))
            self.ids[k].append(ids.astype(np.int32))
            self.ends[k].append((ends + np.repeat(byte_at, counts) - np.repeat(start, each)).astype(np.int32))
            self.starts[k].frombytes((np.cumsum(each) + self.starts[k][-1]).astype(np.int64).tobytes())
        self.known.update(zip(segments, range(len(self.sizes), len(self.sizes) + len(segments)), strict=True))
        self.sizes.frombytes((upto - start).astype(np.int64).tobytes())
        self.whole.frombytes(whole.astype(np.int8).tobytes())

    @staticmethod
    def _odd(segment: str) -> bool:
        return SPACE_MARK in segment or segment[-1] == " " or bool(WHITE_END.match(segment[-1]))

    def segments(self, text: str) -> list[str]:
        text = " " + text
        found = CUT.split(text) if HARD.search(text) else WORDS.findall(text)
        if found[-1] == " " and len(found) > 1:  # B puts no space before an empty text
            found[-2:] = [found[-2] + " "]
        return found

    def batch(self, texts: list[str | None]):
        """For a list of texts, of each side: token ids, their ends (bytes from the first text's
        start, texts one after the other), and tokens before each text; the texts' first bytes."""
        cut = [self.segments(t) if t else [] for t in texts]
        if self.starts[0][-1] + self.starts[1][-1] > REMEMBERED:
            self.forget()
        flat = list(chain.from_iterable(cut))
        at = list(map(self.known.get, flat))
        if None in at:
            self._learn(list({s for s, k in zip(flat, at, strict=True) if k is None}))
            at = list(map(self.known.__getitem__, flat))
        counts = np.array([len(one) for one in cut], np.int64)
        at = np.array(at, np.int64)
        doc = np.repeat(np.arange(len(texts)), counts)
        bad = np.unique(doc[~np.array(self.whole).astype(bool)[at]]) if len(at) else doc
        keep = ~np.isin(doc, bad)
        at, doc = at[keep], doc[keep]
        sizes = np.array(self.sizes)[at]
        offset = np.cumsum(sizes) - sizes
        first = np.concatenate([[0], np.cumsum(np.bincount(doc, sizes, len(texts)).astype(np.int64))])
        sides = []
        for k in (0, 1):
            if len(self.ids[k]) > 1:  # one store
                self.ids[k][:], self.ends[k][:] = [np.concatenate(self.ids[k])], [np.concatenate(self.ends[k])]
            starts = np.array(self.starts[k])
            lo, n = starts[at], starts[at + 1] - starts[at]
            take = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            none = np.zeros(0, np.int32)
            ids, ends = (store[0][take] if store else none for store in (self.ids[k], self.ends[k]))
            before = np.concatenate([[0], np.cumsum(np.bincount(doc, n, len(texts)).astype(np.int64))])
            sides.append((ids, ends + np.repeat(offset, n), before))
        return sides[0], sides[1], first


@lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts of at most ``most`` bytes, a longer text alone."""
    for batch in batches:
        texts = batch.column(1)
        a, total = 0, 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
            if i > a and total + n > most:
                yield batch.column(0)[a:i], texts[a:i].to_pylist()
                a, total = i, 0
            total += n
        if a < len(batch):
            yield batch.column(0)[a:], texts[a:].to_pylist()


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, a_ids, a_ends, b_ids, b_ends: the tokens of space + text and where they end in
    its UTF-8 bytes.  Where an a_end is also a b_end, a group ends."""
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_path, piece_path)
        for names, texts in chunks(batches, CHUNK_BYTES):
            *sides, first = both.batch(texts)
            columns = []
            for ids, ends, before in sides:
                ends = ends - np.repeat(first[:-1], np.diff(before))
                columns += [pa.ListArray.from_arrays(before.astype(np.int32), x.astype(np.int32)) for x in (ids, ends)]
            yield pa.RecordBatch.from_arrays([names, *[c.cast(ints) for c in columns]], names=[id_col, "a_ids", "a_ends", "b_ids", "b_ends"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, docs[text_col].cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>")


def spelled(size: int) -> np.ndarray:
    """Each id in decimal with each of the four things that may follow it."""
    out = np.empty(size * 4, object)
    out[:] = [b"%d%s" % (i, after) for i in range(size) for after in (b",", b"|", b";", b"")]
    return out


def overlaps(a, b, first: np.ndarray, spell: tuple[np.ndarray, np.ndarray]) -> dict:
    """Links, groups and the digest of the groups for the texts of one batch.

    Every link is one stretch between neighbouring cuts, for the bytes that two tokens
    share are one stretch and no other pair's."""
    (a_ids, a_ends, a_before), (b_ids, b_ends, b_before) = a, b
    n = len(first) - 1
    cuts = np.concatenate([a_ends, b_ends])
    cuts.sort(kind="stable")
    if len(cuts):
        cuts = cuts[np.concatenate([[True], cuts[1:] != cuts[:-1]])]
    i, j = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
    of = np.searchsorted(first, cuts) - 1
    common = cuts[(a_ends[i] == cuts) & (b_ends[j] == cuts)] if len(cuts) else cuts
    group_a, group_b = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    in_a, in_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=len(common)))]) for g in (group_a, group_b))
    same = lambda g: np.concatenate([g[1:] == g[:-1], [False]]) if len(g) else np.zeros(0, bool)
    after_a = np.where(same(group_a), COMMA, BAR)
    after_b = np.where(same(group_b), COMMA, SEMICOLON)
    after_b[b_before[1:][np.diff(b_before) > 0] - 1] = END
    text = np.empty(len(a_ids) + len(b_ids), object)
    text[np.arange(len(a_ids)) + in_b[group_a]] = spell[0][a_ids.astype(np.int64) * 4 + after_a]
    text[np.arange(len(b_ids)) + in_a[group_b + 1]] = spell[1][b_ids.astype(np.int64) * 4 + after_b]
    upto = a_before + b_before
    return {
        "pairs": (a_ids[i].astype(np.int64) << 32) | b_ids[j].astype(np.int64), "of": of,
        "n_a": np.diff(a_before), "n_b": np.diff(b_before), "n_links": np.bincount(of, minlength=n),
        "n_groups": np.bincount(np.searchsorted(first, common) - 1, minlength=n),
        "groups_sha256": [hashlib.sha256(b"".join(text[lo:hi].tolist())).hexdigest() if hi > lo else ""
                          for lo, hi in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]}


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def link_chunks(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each chunk: its number, its documents with their counts and digest; ``pairs``
    (a id * 2**32 + b id) and how many ``times`` they overlap in the chunk; and for each document
    the pairs that it holds (``at`` in the dictionary, ``mult`` times, ``upto`` of them)."""
    kind = docs.schema[id_col].dataType.simpleString()
    doc = pa.struct([(c, pa.int64()) for c in COUNTS] + [("groups_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_path, piece_path)
        spell = spelled(len(both.a_bytes)), spelled(len(both.b_bytes))
        number = TaskContext.get().partitionId() << 32
        for ids, texts in chunks(batches, chunk_bytes):
            *sides, first = both.batch(texts)
            got = overlaps(*sides, first, spell)
            pairs, inverse = np.unique(got["pairs"], return_inverse=True)
            held, mult = np.unique(got["of"] * max(1, len(pairs)) + inverse, return_counts=True)
            told = pa.StructArray.from_arrays([pa.array(got[c], pa.int64()) for c in COUNTS] + [pa.array(got["groups_sha256"], pa.string())],
                                              fields=list(doc))
            row = [pa.array([number], pa.int64())]
            for values in (ids, told, pairs, np.bincount(inverse, minlength=len(pairs)), (held % max(1, len(pairs))).astype(np.int32),
                           mult.astype(np.int32), np.bincount(held // max(1, len(pairs)), minlength=len(texts)).astype(np.int32)):
                values = pa.array(values) if isinstance(values, np.ndarray) else values
                row.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            yield pa.RecordBatch.from_arrays(row, names=["chunk", "ids", "docs", "pairs", "times", "at", "mult", "upto"])
            number += 1

    inner = ", ".join(f"{c}: bigint" for c in COUNTS)
    return docs.select(id_col, docs[text_col].cast("string")).mapInArrow(
        run, f"chunk long, ids array<{kind}>, docs array<struct<{inner}, groups_sha256: string>>, pairs array<long>, times array<long>, "
             "at array<int>, mult array<int>, upto array<int>")


def pair_counts(chunked: DataFrame) -> DataFrame:
    """pair, a_id, b_id, links (in the corpus) and best: whether no id of A has more with that b_id."""
    each = chunked.select(F.explode(F.arrays_zip("pairs", "times")).alias("e")).groupBy(F.col("e.pairs").alias("pair")).agg(
        F.sum("e.times").alias("links"))
    each = staged(each.select("pair", F.shiftright("pair", 32).alias("a_id"), (F.col("pair") % (1 << 32)).alias("b_id"), "links"), "links")
    most = each.groupBy("b_id").agg(F.max("links").alias("most"))  # as many rows as B has ids
    return each.join(F.broadcast(most), "b_id").select("pair", "a_id", "b_id", "links", (F.col("links") == F.col("most")).alias("best"))


def digests(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
            chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document its counts, those of its links among all, and the digest of its groups."""
    chunked = staged(link_chunks(docs, byte_path, piece_path, id_col, text_col, chunk_bytes), "chunks")
    totals = pair_counts(chunked)
    asked = chunked.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    told = asked.join(totals, "pair").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("at", "links", "best"))).alias("told"))
    met = chunked.select("chunk", "ids", "docs", "at", "mult", "upto").join(told, "chunk", "left").select(
        "ids", "docs", "at", "mult", "upto", F.col("told.links").alias("links"), F.col("told.best").alias("best"))
    names = [id_col, *COUNTS, "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                ids, docs_, at, mult, upto, links, best = (c[k].values for c in batch.columns)
                n = len(ids)
                if links is None:
                    sums = [np.zeros(n, np.int64)] * 2
                else:
                    at, mult = at.to_numpy(), mult.to_numpy().astype(np.int64)
                    ends = np.concatenate([[0], np.cumsum(upto.to_numpy())])
                    sums = []
                    for weight in (best.to_numpy(zero_copy_only=False), links.to_numpy()):
                        total = np.concatenate([[0], np.cumsum(weight[at] * mult)])
                        sums.append(total[ends[1:]] - total[ends[:-1]])
                yield pa.RecordBatch.from_arrays([ids, *[docs_.field(c) for c in COUNTS], *[pa.array(x, pa.int64()) for x in sums],
                                                  docs_.field("groups_sha256")], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return met.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in names[1:-1]) + ", groups_sha256 string")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), *default_models())


QUERIES = {"op13_alignment": op13_alignment}
ORACLES: dict[str, str] = {}
