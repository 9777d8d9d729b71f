"""Operator 2: byte-level BPE encoding and decoding with the tokenizers library.

A rank file (one base64 token and its rank a line) becomes a tokenizers BPE model:
each byte is written as one printable character, the vocabulary is the ranks, and
the merges are all splits of each token into two known tokens, by rank.  Texts
arrive as Arrow batches.  A text is cut before every run of white space; the
split pattern always ends a match there, so the pieces encode on their own, and
frequent pieces are encoded once for each worker.

Decoding goes the other way: ids to vocabulary strings, characters to bytes by the
reversed byte table, and only then bytes to text, so characters that are split
over several ids come back whole (``errors="replace"`` where ids end in the
middle of one).

Defined cases: a null text counts as empty and has no ids; special tokens are
never produced, their strings are ordinary text; an unknown or null id decodes to
no bytes; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._stage import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Unicode white space (the split pattern's \s), as a character class.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Remembered pieces for each worker; beyond it the memory starts anew.
REMEMBERED, LONGEST_REMEMBERED = 250_000, 64


def default_ranks() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def byte_characters() -> list[str]:
    """The printable character of each byte: itself where printable in Latin-1,
    the others from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class Coder:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks_path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        letter = byte_characters()
        spell = lambda raw: "".join(letter[b] for b in raw)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        merges = []
        for token, rank in ranks.items():
            halves = [(token[:k], token[k:]) for k in range(1, len(token))]
            merges += [(rank, -len(a), a, b) for a, b in halves if a in ranks and b in ranks]
        merges.sort(key=lambda m: m[:2])
        self.tokenizer = Tokenizer(models.BPE(
            vocab={spell(token): rank for token, rank in ranks.items()},
            merges=[(spell(a), spell(b)) for _, _, a, b in merges], ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        back = {c: b for b, c in enumerate(letter)}
        self.bytes_of = {i: bytes(back[c] for c in s) for s, i in self.tokenizer.get_vocab().items()}
        self.seen: dict[str, tuple[bytes, int, bytes]] = {}

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def offsets(self, text: str) -> list[tuple[int, int]]:
        """Start and end of each id, in code points; ids of one character share them."""
        return self.tokenizer.encode(text, add_special_tokens=False).offsets

    def decode_bytes(self, ids) -> bytes:
        return b"".join(self.bytes_of.get(i, b"") for i in ids)

    def pieces(self, text: str) -> list[tuple[bytes, int, bytes]]:
        """(decimal ids joined by commas, their number, decoded bytes) of each piece."""
        parts, seen = CUT.findall(text), self.seen
        if new := list({p for p in parts if p not in seen}):
            if len(seen) > REMEMBERED:
                seen.clear()
                new = list(set(parts))
            extra = {}
            for piece, got in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
                entry = (",".join(map(str, got.ids)).encode(), len(got.ids), self.decode_bytes(got.ids))
                (seen if len(piece) <= LONGEST_REMEMBERED else extra)[piece] = entry
            if extra:
                return [seen[p] if p in seen else extra[p] for p in parts]
        return [seen[p] for p in parts]


@lru_cache(maxsize=4)
def coder(ranks_path: str, pattern: str) -> Coder:
    return Coder(ranks_path, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ids array<int>, starts and ends array<int> (code points of the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(ranks_path, pattern)
        for batch in batches:
            found = [c.tokenizer.encode(t or "", add_special_tokens=False) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([e.ids for e in found], pa.list_(pa.int32())),
                pa.array([[a for a, _ in e.offsets] for e in found], pa.list_(pa.int32())),
                pa.array([[b for _, b in e.offsets] for e in found], pa.list_(pa.int32()))],
                names=[id_col, "ids", "starts", "ends"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, docs[text_col].cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, raw binary and text (with U+FFFD for an unfinished character)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(ranks_path, pattern)
        for batch in batches:
            raw = [c.decode_bytes(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary()), pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())],
                names=[id_col, "raw", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, raw binary, text string")


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: number of ids and the digests of its ids and of what they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(ranks_path, pattern)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for k in range(len(batch)):
                found = c.pieces(batch.column(1)[k].as_py() or "")
                counts.append(sum(e[1] for e in found))
                ids.append(hashlib.sha256(b",".join([e[0] for e in found])).hexdigest())
                decoded.append(hashlib.sha256(b"".join([e[2] for e in found])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), *default_ranks())


QUERIES = {"op2_byte_bpe": op2_byte_bpe}
ORACLES: dict[str, str] = {}
