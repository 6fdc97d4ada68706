"""Alignment of two tokenizers' tokens over the same text, and how often the corpus links a pair of token ids.

Tokenizer A is byte-level (a vocabulary with merges), B a piece model that puts a blank before the text. A document takes
part if the bytes of its A tokens and of its B tokens are both a blank and the text. Where tokens of both end at the same
byte, the text is cut into groups and the two tokens are linked.

Defined results: texts that are null, empty or not given back by both tokenizers have no tokens; rows without an id, and
rows that are equal, are documents of their own; an empty table gives an empty result; columns other than doc_id and text
are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.llm.common import documents, slices, staged

#: Where the vocabulary files of public tokenizers lie on the driver; tasks get their content.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the public word pattern of byte-level vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer runs of white space are more than the fast encoder's pattern search can hold.
LONG_BLANK = re.compile(r"\s{1000}")
#: Bytes of text that one lane of the merge covers; longer documents take several lanes.
LANE = 1024
#: Texts that a task encodes at a time, and how many bytes of them.
ROWS, BYTES = 512, 4_000_000
#: Links that a task counts at a time.
COUNTED = 4_000_000
#: Pairs of ids whose counts are broadcast, 17 bytes each: the most frequent ones; the others are joined.
HEAD = 1 << 21


@dataclass(frozen=True)
class Tokenizers:
    """The content of both files (a few MB, whatever the corpus), and what tasks make of it."""

    a_json: bytes
    b_model: bytes
    made: dict = field(default_factory=dict, compare=False)

    @classmethod
    def read(cls, folder: str = TOKENIZERS, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> Tokenizers:
        found = []
        for name in (a, b):
            with open(os.path.join(folder, name), "rb") as file:
                found.append(file.read())
        return cls(*found)

    def __reduce__(self):
        return Tokenizers, (self.a_json, self.b_model)

    def _load(self) -> dict:
        if not self.made:
            import sentencepiece
            import tiktoken
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            whole = Tokenizer.from_buffer(self.a_json)
            whole.encode_special_tokens = True
            model = json.loads(self.a_json)
            special = {t["id"] for t in model.get("added_tokens", ())}
            in_bytes = {i: _byte_level(t) for t, i in model["model"]["vocab"].items()}
            ranks = {b: i for i, b in in_bytes.items() if i not in special}
            pieces = sentencepiece.SentencePieceProcessor(model_proto=self.b_model)
            self.made.update(
                whole=whole,
                fast=tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}),
                pieces=pieces,
                a_bytes=[in_bytes.get(i, b"") for i in range(max(in_bytes) + 1)],
                b_bytes=[_piece_bytes(pieces, i) for i in range(pieces.get_piece_size())],
            )
            for side in "ab":
                self.made[f"{side}_lengths"] = np.array([len(x) for x in self.made[f"{side}_bytes"]], np.int64)
        return self.made

    def bytes_of(self, side: str) -> list[bytes]:
        """What each id stands for, of side "a" or "b"."""
        return self._load()[f"{side}_bytes"]

    def lengths(self, side: str) -> np.ndarray:
        return self._load()[f"{side}_lengths"]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        made = self._load()
        out = []
        for text in texts:
            if LONG_BLANK.search(text):
                out.append(made["whole"].encode(text, add_special_tokens=False).ids)
            else:
                out.append(made["fast"].encode_ordinary(text))
        return out

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self._load()["pieces"].encode(texts, num_threads=1)


def _byte_level(token: str) -> bytes:
    """Undo the byte-level spelling: printable bytes are themselves, the others come after code point 255, in order."""
    if not _SPELT:
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        _SPELT.update({chr(b): b for b in plain})
        _SPELT.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))})
    if any(c not in _SPELT for c in token):
        return token.encode()
    return bytes(_SPELT[c] for c in token)


_SPELT: dict[str, int] = {}


def _piece_bytes(pieces, at: int) -> bytes:
    piece = pieces.id_to_piece(at)
    return bytes([int(piece[3:-1], 16)]) if pieces.is_byte(at) else piece.replace("▁", " ").encode()


@dataclass
class Aligned:
    """The tokens of a batch of documents, one after the other, and their links.

    a_at, b_at: n + 1 places where documents begin and end; partner: of each A token the B token that it is linked with, or
    -1. A linked token is the last of its group, and every document ends with one.
    """

    a: np.ndarray
    b: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    partner: np.ndarray


def lockstep(a_end: np.ndarray, b_end: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Of each A token the B token that ends where it does, or -1.

    Ends are byte offsets, ascending over all documents; lanes begin at `begins`. All lanes move together: in each step
    the token that ends first is passed, or both where they end together, which is a link and a cut. Lanes in which one
    side is through are taken out.
    """
    partner = np.full(a_end.size, -1, np.int64)
    i, j = (np.searchsorted(end, begins, "right") for end in (a_end, b_end))
    i_to, j_to = np.append(i[1:], a_end.size), np.append(j[1:], b_end.size)
    while True:
        live = (i < i_to) & (j < j_to)
        if not live.all():
            i, j, i_to, j_to = i[live], j[live], i_to[live], j_to[live]
        if not i.size:
            return partner
        x, y = a_end[i], b_end[j]
        met = x == y
        partner[i[met]] = j[met]
        i, j = i + (x <= y), j + (y <= x)


def align_texts(texts: list[str | None], tokenizers: Tokenizers) -> Aligned:
    spelt = [f" {t}" if t else "" for t in texts]
    ids_a = tokenizers.encode_a(spelt)
    ids_b = tokenizers.encode_b([t or "" for t in texts])
    a_bytes, b_bytes = tokenizers.bytes_of("a"), tokenizers.bytes_of("b")
    for k, text in enumerate(spelt):
        whole = text.encode()
        if b"".join(map(a_bytes.__getitem__, ids_a[k])) != whole or b"".join(map(b_bytes.__getitem__, ids_b[k])) != whole:
            ids_a[k], ids_b[k] = [], []
    a, a_at, a_end = _joined(ids_a, tokenizers.lengths("a"))
    b, b_at, b_end = _joined(ids_b, tokenizers.lengths("b"))
    ends = np.append(0, a_end)[a_at]
    lanes = -(-np.diff(ends) // LANE)
    begins = np.repeat(ends[:-1], lanes) + LANE * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
    return Aligned(a, b, a_at, b_at, lockstep(a_end, b_end, begins))


def _joined(ids: list[list[int]], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(x) for x in ids], out=at[1:])
    flat = np.fromiter((x for one in ids for x in one), np.int64, at[-1])
    return flat, at, np.cumsum(lengths[flat])


def group_texts(found: Aligned, sizes: tuple[int, int]) -> list[bytes]:
    """Per document its groups as text, A ids|B ids, separated by semicolons. sizes: of both vocabularies."""
    table = _spelling(sizes)
    linked = np.flatnonzero(found.partner >= 0)
    mate = found.partner[linked]
    last_a, last_b = found.partner >= 0, np.zeros(found.b.size, bool)
    last_b[mate] = True
    before_a, before_b = (np.cumsum(last) - last for last in (last_a, last_b))  # groups that ended earlier
    codes = np.empty(found.a.size + found.b.size, np.int64)
    codes[np.arange(found.a.size) + np.append(-1, mate)[before_a] + 1] = 2 * found.a + last_a
    codes[np.arange(found.b.size) + linked[before_b] + 1] = 2 * (sizes[0] + found.b) + last_b
    spelt = table[codes]
    used = spelt != 0
    ends = np.append(0, np.cumsum(used.sum(1)))[found.a_at + found.b_at]
    flat = spelt[used].tobytes()
    return [flat[x : max(x, y - 1)] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]


_TABLES: dict[tuple[int, int], np.ndarray] = {}


def _spelling(sizes: tuple[int, int]) -> np.ndarray:
    """Rows of bytes, filled with zeros: each id with what follows inside a side, and at its end."""
    if sizes not in _TABLES:
        texts = [f"{i}{end}" for size, marks in zip(sizes, (",|", ",;")) for i in range(size) for end in marks]
        width = max(map(len, texts))
        _TABLES[sizes] = np.array(texts, f"S{width}").view(np.uint8).reshape(-1, width)
    return _TABLES[sizes]


def _positions(found: Aligned, tokenizers: Tokenizers) -> dict[str, pa.Array]:
    """The real outputs: ids of both sides, links as token positions, and cuts as byte offsets of the blank and the text."""
    linked = np.flatnonzero(found.partner >= 0)
    at = np.searchsorted(linked, found.a_at)
    doc = np.repeat(np.arange(at.size - 1), np.diff(at))
    ends = np.cumsum(tokenizers.lengths("a")[found.a])
    begin = np.append(0, ends)[found.a_at][doc]
    lists = {
        "a_ids": (found.a_at, found.a),
        "b_ids": (found.b_at, found.b),
        "a_linked": (at, linked - found.a_at[doc]),
        "b_linked": (at, found.partner[linked] - found.b_at[doc]),
        "cuts": (at, ends[linked] - begin),
    }
    return {k: pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(v, pa.int64())) for k, (o, v) in lists.items()}


def _digest(found: Aligned, tokenizers: Tokenizers) -> dict[str, pa.Array]:
    """Counts, the hash of the groups, and the linked pairs of ids, ascending, as binary of their kind (`pair_kind`)."""
    sizes = tuple(len(tokenizers.bytes_of(x)) for x in "ab")
    linked = np.flatnonzero(found.partner >= 0)
    at = np.searchsorted(linked, found.a_at)
    pairs = (found.a[linked] * sizes[1] + found.b[found.partner[linked]]).astype(pair_kind(sizes))
    held = [np.sort(pairs[x:y]).tobytes() for x, y in zip(at[:-1], at[1:])]
    counts = {"n_a": found.a_at, "n_b": found.b_at, "n_groups": at, "n_links": at}
    hashes = [hashlib.sha256(x).hexdigest() if x else "" for x in group_texts(found, sizes)]
    out = {k: pa.array(np.diff(v), pa.int64()) for k, v in counts.items()}
    return out | {"groups_sha256": pa.array(hashes, pa.string()), "pairs": pa.array(held, pa.binary())}


def pair_kind(sizes: tuple[int, int]) -> np.dtype:
    return np.dtype(np.uint32 if sizes[0] * sizes[1] < 1 << 32 else np.int64)


#: Outputs of `align`: function and columns.
POSITIONS = _positions, ", ".join(f"{c} array<long>" for c in ("a_ids", "b_ids", "a_linked", "b_linked", "cuts"))
DIGEST = _digest, "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def align(docs: DataFrame, tokenizers: Tokenizers, show: tuple[Callable, str] = POSITIONS) -> DataFrame:
    """doc_id and, per row of docs, the alignment of its whole text: token ids of A and B, linked tokens, cuts.

    Each task takes batches of whole texts; nothing is shuffled.
    """
    make, columns = show
    shared = docs.sparkSession.sparkContext.broadcast(tokenizers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _bounded(batches):
            found = align_texts(batch.column("text").to_pylist(), shared.value)
            made = make(found, shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made.values()], ["doc_id", *made])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {columns}")


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ROWS texts, and of at most BYTES but for a single longer text."""
    for batch in slices(batches, ROWS):
        lengths = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for k, n in enumerate(lengths.tolist()):
            if k > first and held + n > BYTES:
                yield batch.slice(first, k - first)
                first, held = k, 0
            held += n
        yield batch.slice(first)


def pair_counts(pairs: DataFrame, kind: np.dtype) -> DataFrame:
    """(pair, n): how many links hold each pair, from a binary column `pairs`; counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for value in batch.column(0):
                held.append(np.frombuffer(value.as_buffer() if value.is_valid else b"", kind))
                size += held[-1].size
                if size >= COUNTED:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        ids, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

    return pairs.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _head_count(counts: DataFrame, head: int) -> int:
    """The least count such that at most `head` pairs have it or more; bands of an eighth of a doubling."""
    band = F.floor(F.log2("n") * 8)
    bands = counts.groupBy(band.alias("band")).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).collect()
    least, held = 1 << 62, 0
    for row in sorted(bands, key=lambda r: -r.band):
        held += row.pairs
        if held > head:
            break
        least = row.least
    return least


def link_counts(aligned: DataFrame, sizes: tuple[int, int], head: int = HEAD) -> DataFrame:
    """The rows of `aligned` (made with DIGEST and written) with n_best and count_sum in place of `pairs`.

    Counts of the `head` most frequent pairs are broadcast as sorted arrays; the other pairs of a document, if there are
    any, are joined with their counts.
    """
    spark = aligned.sparkSession
    kind, width = pair_kind(sizes), sizes[1]
    counts = staged(pair_counts(aligned.select("pairs"), kind), "pair-counts")
    most = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("most"))  # a row for each id of B at most
    judged = counts.withColumn("b", F.col("pair") % width).join(F.broadcast(most), "b")
    judged = judged.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    least = _head_count(counts, head)
    table = judged.filter(F.col("n") >= least).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))
    kept = [c for c in aligned.columns if c != "pairs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in slices(batches):
            values = [np.frombuffer(v.as_buffer() if v.is_valid else b"", kind) for v in batch.column("pairs")]
            at = np.append(0, np.cumsum([v.size for v in values]))
            ids = np.concatenate(values).astype(np.int64)
            place = np.minimum(np.searchsorted(pair, ids), max(pair.size - 1, 0))
            known = pair[place] == ids if pair.size else np.zeros(ids.size, bool)
            sums = []
            for worth in (best, n):
                got = np.zeros(ids.size, np.int64)
                got[known] = worth[place[known]]
                sums.append(np.diff(np.append(0, np.cumsum(got))[at]))
            rest_at = np.append(0, np.cumsum(~known))[at]
            rest = pa.ListArray.from_arrays(pa.array(rest_at, pa.int32()), pa.array(ids[~known], pa.int64()))
            arrays = [batch.column(c) for c in kept] + [pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()), rest]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "n_best", "count_sum", "rest"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name in kept)
    scored = aligned.mapInArrow(run, f"{kinds}, n_best long, count_sum long, rest array<long>")
    if least <= 1:
        return scored.drop("rest")
    numbered = staged(scored.withColumn("row", F.monotonically_increasing_id()), "links")
    rare = numbered.select("row", F.explode("rest").alias("pair")).join(judged.filter(F.col("n") < least), "pair")
    rare = rare.groupBy("row").agg(F.sum("n").alias("more"), F.count_if("best").alias("more_best"))
    summed = {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0))}
    return numbered.join(rare, "row", "left").withColumns(summed).drop("row", "rest", "more", "more_best")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, groups and links under both tokenizers, and how common its links are in the corpus.

    Texts that are null, empty or not given back have zeros and an empty groups_sha256; equal rows each give a row.
    """
    tokenizers = Tokenizers.read()
    aligned = staged(align(documents(spark, sf_dir), tokenizers, DIGEST), "aligned")
    counted = link_counts(aligned, tuple(len(tokenizers.bytes_of(x)) for x in "ab"))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return counted.select("doc_id", *columns, "groups_sha256")
