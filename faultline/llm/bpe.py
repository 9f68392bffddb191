"""Byte-level BPE encoding and decoding with forced boundaries.

A pair of bytes that stands in no vocabulary token can never be joined by a merge,
so the text may be cut there. Every pre-token is cut at such pairs into fragments;
fragments are merged independently (all of a batch at once, in numpy) and their ids
are put together again. Equal pre-tokens are encoded once while a bounded table
remembers them.

Ids travel as binary, little-endian unsigned 32-bit numbers. Defined cases: NULL
text encodes as empty and decodes as empty; special tokens standing in the text are
recognised as such; ids without a token are skipped in decoding; bytes that are not
UTF-8 decode to U+FFFD. Repeated rows are encoded row by row. Only the columns named
are read, and only those come back.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import arrow_stage, slices

PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.int32(2**31 - 1)
LONG_FRAGMENT = 256
REMEMBERED = 200_000


@dataclass(frozen=True)
class Vocabulary:
    """Fixed-size tables of one tokenizer file; small enough to broadcast whatever the data."""

    byte_ids: np.ndarray  # id of each byte
    joinable: np.ndarray  # [256, 256]: the pair stands inside some token
    pair_keys: np.ndarray  # left id << 32 | right id, ascending
    pair_ranks: np.ndarray
    pair_ids: np.ndarray
    token_bytes: np.ndarray  # all tokens joined, by id
    token_starts: np.ndarray
    token_lengths: np.ndarray
    special: dict[str, int]


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    letters = _byte_letters()
    vocab: dict[str, int] = file["model"]["vocab"]
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    spelled = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
    joinable = np.zeros((256, 256), bool)
    for token in spelled.values():
        joined = np.frombuffer(token, np.uint8)
        joinable[joined[:-1], joined[1:]] = True
    pairs = sorted(
        ((vocab[a] << 32) | vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(map(tuple, file["model"]["merges"]))
    )
    keys, ranks, ids = (np.array(x) for x in zip(*pairs, strict=True))
    spelled |= {i: text.encode() for text, i in special.items()}
    tokens = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
    lengths = np.array([len(t) for t in tokens])
    return Vocabulary(
        np.array([vocab[c] for c in sorted(letters, key=letters.get)], np.int32),
        joinable,
        keys.astype(np.int64),
        ranks.astype(np.int32),
        ids.astype(np.int32),
        np.frombuffer(b"".join(tokens), np.uint8),
        np.cumsum(lengths) - lengths,
        lengths,
        special,
    )


def _ranks(vocab: Vocabulary, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = (left.astype(np.int64) << 32) | right
    at = np.minimum(np.searchsorted(vocab.pair_keys, keys), len(vocab.pair_keys) - 1)
    return np.where(vocab.pair_keys[at] == keys, vocab.pair_ranks[at], NO_RANK), vocab.pair_ids[at]


def merge_fragments(vocab: Vocabulary, data: np.ndarray, fragment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all fragments and the fragment of each id; ``fragment`` numbers the bytes, ascending.

    Each round joins, in every fragment, all places of its lowest-ranked pair. A
    joined token takes part only in merges of higher rank, so this equals one merge
    at a time from the left.
    """
    ids, done_ids, done_of = vocab.byte_ids[data], [], []
    while len(ids):
        rank, joined = np.full(len(ids), NO_RANK, np.int32), np.zeros(len(ids), np.int32)
        inside = np.flatnonzero(fragment[:-1] == fragment[1:])
        rank[inside], joined[inside] = _ranks(vocab, ids[inside], ids[inside + 1])
        starts = np.flatnonzero(np.r_[True, fragment[1:] != fragment[:-1]])
        lengths = np.diff(np.r_[starts, len(ids)])
        lowest = np.repeat(np.minimum.reduceat(rank, starts), lengths)
        open_ = lowest != NO_RANK
        done_ids.append(ids[~open_])
        done_of.append(fragment[~open_])
        ids, fragment, rank, joined, lowest = ids[open_], fragment[open_], rank[open_], joined[open_], lowest[open_]
        if not len(ids):
            break
        hit = rank == lowest
        # Of overlapping places (a run of one repeated token) every second is joined, from the left.
        at = np.arange(len(hit))
        run_start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], at, 0))
        hit &= (at - run_start) % 2 == 0
        ids = np.where(hit, joined, ids)
        keep = ~np.r_[False, hit[:-1]]
        ids, fragment = ids[keep], fragment[keep]
    ids, fragment = np.concatenate([*done_ids, ids[:0]]), np.concatenate([*done_of, fragment[:0]])
    order = np.argsort(fragment, kind="stable")
    return ids[order], fragment[order]


def merge_long(vocab: Vocabulary, data: np.ndarray) -> np.ndarray:
    """Ids of one long fragment, n log n in its length: a heap of pairs over a linked list."""
    ids = vocab.byte_ids[data].tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank, joined = _ranks(vocab, np.array(ids[:-1]), np.array(ids[1:]))
    heap = [(int(r), i, ids[i], ids[i + 1], int(j)) for i, (r, j) in enumerate(zip(rank, joined, strict=True)) if r != NO_RANK]
    heapq.heapify(heap)
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def offer(i: int, k: int) -> None:
        pair = ids[i], ids[k]
        if pair not in known:
            r, j = _ranks(vocab, np.array(pair[:1]), np.array(pair[1:]))
            known[pair] = int(r[0]), int(j[0])
        r, j = known[pair]
        if r != NO_RANK:
            heapq.heappush(heap, (r, i, *pair, j))

    while heap:
        _, i, left, right, new = heapq.heappop(heap)
        k = after[i]
        if ids[i] != left or k >= n or ids[k] != right:
            continue
        ids[i], ids[k] = new, -1
        after[i] = after[k]
        if after[i] < n:
            before[after[i]] = i
            offer(i, after[i])
        if before[i] >= 0:
            offer(before[i], i)
    return np.array([x for x in ids if x >= 0], np.int32)


class Encoder:
    """Encodes texts with tables that remember up to ``REMEMBERED`` pre-tokens between slices."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(vocab.special, key=len, reverse=True))) + ")")
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {text: k for k, text in enumerate(self.vocab.special)}
        self.flat = np.array(list(self.vocab.special.values()), np.int32)
        self.lengths = np.ones(len(self.number), np.int64)

    def pieces(self, text: str) -> list[str]:
        if not self.vocab.special or not self.specials.search(text):
            return self.pre_tokens(text)
        found = []
        for part in self.specials.split(text):
            found += [part] if part in self.vocab.special else self.pre_tokens(part)
        return found

    def learn(self, pieces: list[str]) -> None:
        """Ids of new pre-tokens: cut at forced boundaries, merge the fragments, put them together."""
        raw = [p.encode() for p in pieces]
        data = np.frombuffer(b"".join(raw), np.uint8)
        piece = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        forced = np.ones(len(data), bool)
        forced[1:] = (piece[1:] != piece[:-1]) | ~self.vocab.joinable[data[:-1], data[1:]]
        fragment = np.cumsum(forced) - 1
        lengths = np.bincount(fragment)
        long_ = lengths > LONG_FRAGMENT
        short = ~long_[fragment]
        ids, of = merge_fragments(self.vocab, data[short], fragment[short])
        if long_.any():
            starts = np.cumsum(lengths) - lengths
            more = [(f, merge_long(self.vocab, data[starts[f] : starts[f] + lengths[f]])) for f in np.flatnonzero(long_)]
            ids = np.concatenate([ids, *(m for _, m in more)])
            of = np.concatenate([of, *(np.full(len(m), f) for f, m in more)])
            order = np.argsort(of, kind="stable")
            ids, of = ids[order], of[order]
        owner = piece[np.flatnonzero(forced)][of]
        self.flat = np.concatenate([self.flat, ids])
        self.lengths = np.concatenate([self.lengths, np.bincount(owner, minlength=len(raw))])
        self.number.update(zip(pieces, range(len(self.number), len(self.number) + len(pieces)), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self.pieces(t) if t else [] for t in texts]
        new = {p for pieces in split for p in pieces if p not in self.number}
        if new:
            self.learn(list(new))
        starts = np.cumsum(self.lengths) - self.lengths
        flat = self.flat.astype("<u4")
        out = []
        get = self.number.__getitem__
        for pieces in split:
            at = np.fromiter(map(get, pieces), np.int64, len(pieces))
            out.append(gather(flat, starts[at], self.lengths[at]).tobytes())
        if len(self.number) > REMEMBERED:
            self.forget()
        return out


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after another."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return flat[:0]
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])]


def encode(docs: DataFrame, vocab: Vocabulary, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (binary) of each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def make():
        encoder = Encoder(shared.value)

        def step(batch: pa.RecordBatch):
            ids = encoder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary())], ["id", "ids"])

        return step

    kind = rows.schema["id"].dataType.simpleString()
    return arrow_stage(rows, make, f"id {kind}, ids binary").withColumnRenamed("id", id_col)


#: Bytes of text that ``round_trip`` holds encoded and decoded at a time, one text at least.
PIECE = 1 << 20


def round_trip(docs: DataFrame, vocab: Vocabulary, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids``, their digest and that of the text decoded from them, in one Python stage.

    Decoded texts are hashed where they are made, so they never travel.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def make():
        encoder = Encoder(shared.value)

        def digests(part: pa.RecordBatch):
            ids = encoder.encode(part.column("text").to_pylist())
            back = [text_of(shared.value, raw).encode() for raw in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"), pa.array([len(raw) // 4 for raw in ids], pa.int64()), pa.array(ids, pa.binary()),
                    pa.array([hashlib.sha256(raw).hexdigest() for raw in ids], pa.string()),
                    pa.array([hashlib.sha256(text).hexdigest() for text in back], pa.string()),
                ],
                ["id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
            )

        def step(batch: pa.RecordBatch):
            for part in slices(batch, PIECE):
                yield from digests(part)

        return step

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"
    return arrow_stage(rows, make, schema).withColumnRenamed("id", id_col)


def text_of(vocab: Vocabulary, raw: bytes | None) -> str:
    """The text of little-endian ids; unknown ids are skipped, broken UTF-8 is repaired."""
    ids = np.frombuffer(raw or b"", "<u4")
    ids = ids[ids < len(vocab.token_lengths)]
    found = gather(vocab.token_bytes, vocab.token_starts[ids], vocab.token_lengths[ids])
    return found.tobytes().decode("utf-8", "replace")


def decode(encoded: DataFrame, vocab: Vocabulary, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``ids`` as given and the decoded ``text`` of each row, special tokens included."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocab)
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def make():
        def step(batch: pa.RecordBatch):
            texts = [text_of(shared.value, raw) for raw in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("ids"), pa.array(texts, pa.string())], ["id", "ids", "text"]
            )

        return step

    kind = rows.schema["id"].dataType.simpleString()
    return arrow_stage(rows, make, f"id {kind}, ids binary, text string").withColumnRenamed("id", id_col)
