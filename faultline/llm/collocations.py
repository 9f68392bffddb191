"""Phrases whose words stand together more often than their parts suggest, per language.

Only windows of the top order are counted: for every word the window of up to ``ORDER``
words that starts there and ends with its piece, in ``ORDER`` lead columns padded with empty
words. A task sums its windows by successively shorter prefixes, so they yield the count of
every phrase of one to ``ORDER`` words and, with no words left, the number of all words of the
language. These sums leave the task dealt by hash into ``PARTS`` compressed blocks, and the
blocks of a part are summed together.

Before that, words, then pairs of frequent words, then triples of frequent pairs are counted
by hashes, and the frequent ones marked in bitmaps of fixed size. Sorted hashes leave a task in
blocks by range, as gaps of ``KEY_BITS``-bit numbers. A window ends where
its last word, pair or triple is rare: no phrase beyond can reach ``least``, while the counts
of all that can stay exact. A mark set by chance only makes a window longer.

Defined cases: NULL text is empty, NULL language is ``und`` together with those named so.
A text without words adds nothing; a language without phrases has no rows. Repeated rows
count as rows. Texts of any length are read in pieces of ``PIECE`` bytes, cut between words,
each window counted once; equal windows of a task are summed before they are passed on, up to
``HELD_WINDOWS`` or ``HELD_BYTES``, as are equal words, pairs and triples, up to ``HELD_KEYS``. Equal scores go by count, then by the phrase's
bytes. Two of n windows summed together share a hash with a chance of about n^2 / 2^65. Columns other than text
and language are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import arrow_stage, mix, stored, summed
from faultline.llm.line_dedup import UPPER
from faultline.llm.shingles import BASE, FACTORS, LETTERS, _powers

ORDER = 5
#: Runs of up to this many words are marked before windows are counted.
MARKED = 3
#: Languages whose totals are sent to every task; beyond that they are joined by shuffle.
FEW_LANGUAGES = 10_000
UNKNOWN = "und"
PIECE = 1 << 20
LEADS = [f"w{k}" for k in range(1, ORDER + 1)]
#: A-Z to lower case, what ends a piece to a line feed, a tab to a space.
PLAIN = bytes.maketrans(
    UPPER.encode() + b".,;:!?\x0b\x0c\x0d\t", UPPER.lower().encode() + b"\n" * 9 + b" "
)
NEXT_WORDS = re.compile(rb"(?: *[^ \n]++){0,%d}" % (ORDER - 1))
SALTS = 64
#: Distinct keys of pieces that a task gathers before it passes on their sums.
HELD_KEYS = 3_000_000
#: Distinct windows that a task gathers before it passes on the sums of their phrases.
HELD_WINDOWS = 500_000
HELD_BYTES = 128 << 20
#: Leading bits of a run's key that are counted before marking; the first ``PART_BITS`` of them name the part.
KEY_BITS = 32
PART_BITS = 9
PARTS = 1 << PART_BITS


def chunks(text: bytes) -> Iterator[tuple[bytes, int]]:
    """A plain text in chunks of about ``PIECE`` bytes, and where in each the last window may start.

    Chunks end with a piece, or if that is too long with a word; then the words that the last windows need follow.
    """
    at = 0
    while len(text) - at > PIECE:
        cut = text.rfind(b"\n", at + 1, at + PIECE)
        if cut < 0:
            found = [x for x in (text.find(b, at + PIECE) for b in (b" ", b"\n")) if x >= 0]
            if not found:
                break
            cut = min(found)
        yield text[at : NEXT_WORDS.match(text, cut).end()], cut - at
        at = cut
    yield text[at:], len(text) - at


def joined_chunks(texts: list[bytes]) -> Iterator[tuple[bytes, int]]:
    """Chunks of many texts; short texts share one."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if size and size + len(text) > PIECE:
            yield b"\n".join(held), size
            held, size = [], 0
        if len(text) > PIECE:
            yield from chunks(text)
        else:
            held.append(text)
            size += len(text) + 1
    if held:
        yield b"\n".join(held), size


def scan(chunk: bytes, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Hash, start and end of each word, whether the next word stands in its piece, and how many words start below ``limit``."""
    data = np.frombuffer(chunk, np.uint8)
    inside = (data != 32) & (data != 10)
    starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    ends = np.flatnonzero(inside & ~np.r_[inside[1:], False])
    size = 1 << max(PIECE.bit_length() + 1, len(data).bit_length())
    total = np.cumsum(LETTERS[data] * _powers(BASE, size)[: len(data)])
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    hashes = mix((total[ends] - before) * _powers(pow(BASE, -1, 1 << 64), size)[starts])
    breaks = np.cumsum(data == 10)[starts]
    near = np.zeros(len(starts), bool)
    near[:-1] = breaks[1:] == breaks[:-1]
    return hashes, starts, ends + 1, near, int(np.searchsorted(starts, limit))


def run_keys(words: np.ndarray, size: int) -> np.ndarray:
    """A key for the run of ``size`` words that starts at each word; the last runs are too short and mean nothing."""
    padded = np.r_[words, np.zeros(size, np.uint64)]
    total = np.full(len(words), size, np.uint64)
    for k in range(size):
        total += padded[k : k + len(words)] * FACTORS[k]
    return mix(total)


def known_runs(words: np.ndarray, near: np.ndarray, marks: list[np.ndarray], orders: int) -> list[np.ndarray]:
    """For 1 to ``orders`` words: whether the run at each word is within its piece and no part of it is known to be rare."""
    found: list[np.ndarray] = []
    for k in range(orders):
        on = np.ones(len(words), bool) if not k else found[-1] & np.r_[found[-1][1:], False] & near
        found.append(on & marked(marks[k], run_keys(words, k + 1)) if k < len(marks) else on)
    return found


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.uint64, bytes, int]]:
    langs = np.array(batch.column("lang").to_pylist(), object)
    for lang in sorted(set(langs)):
        column = batch.column("text").filter(pa.array(langs == lang)).cast(pa.binary())
        salt = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        for chunk, limit in joined_chunks([t.translate(PLAIN) for t in column.to_pylist()]):
            yield lang, salt, chunk, limit


def _count_keys(shared):
    def make():
        marks = shared.value
        order = len(marks) + 1

        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            if held:
                found, n = summed(*zip(*held, strict=True))
                held.clear()
                step.size = 0
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["key", "n"])

        def step(batch: pa.RecordBatch):
            for _, salt, chunk, limit in _by_language(batch):
                hashes, _, _, near, count = scan(chunk, limit)
                words = mix(hashes ^ salt)
                on = known_runs(words, near, marks, order)[-1][:count]
                found, n = np.unique(run_keys(words, order)[:count][on], return_counts=True)
                if len(found):
                    held.append((found, n.astype(np.int64)))
                    step.size += len(found)
            if step.size >= HELD_KEYS:
                yield from flush()

        step.size, step.end = 0, flush
        return step

    return make


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, bytes of equal weight together, so that small ones compress well."""
    return zlib.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(block: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(block), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.uint64)


def _bounds(parts: np.ndarray) -> list[tuple[int, int, int]]:
    """Each part that ascending ``parts`` name, with where it begins and ends."""
    edges = np.searchsorted(parts, np.arange(PARTS + 1, dtype=parts.dtype)).tolist()
    return [(k, *edge) for k, edge in enumerate(zip(edges[:-1], edges[1:], strict=True)) if edge[0] < edge[1]]


def _in_blocks(make_inner: Callable[[], Callable], as_blocks: Callable[[list[pa.RecordBatch]], pa.RecordBatch]):
    """A stage whose batches leave as blocks; what one call yields is packed together."""

    def make():
        inner = make_inner()

        def blocks(batches: Iterable[pa.RecordBatch]):
            if held := list(batches):
                yield as_blocks(held)

        def step(batch: pa.RecordBatch):
            yield from blocks(inner(batch))

        step.end = lambda: blocks(inner.end())
        return step

    return make


def _key_blocks(shared, least: int):
    """Ascending keys and their numbers, ``least`` at most, by range of keys."""

    def as_blocks(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        (batch,) = batches
        keys = batch.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - KEY_BITS)
        n = np.minimum(batch.column("n").to_numpy(), min(least, (1 << 32) - 1))
        parts = keys >> np.uint64(KEY_BITS - PART_BITS)
        keys &= np.uint64((1 << KEY_BITS - PART_BITS) - 1)
        rows = [(k, packed(np.diff(keys[a:b], prepend=np.uint64(0))), packed(n[a:b])) for k, a, b in _bounds(parts)]
        types = (pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["part", "gaps", "n"])

    return _in_blocks(_count_keys(shared), as_blocks)


def _often(least: int, bits: int):
    """The marks of one part's keys that are found ``least`` times in all its blocks, in 64-bit words."""

    def total(table: pa.Table) -> pa.Table:
        held, size = [], 0
        for gaps, numbers in zip(table["gaps"], table["n"], strict=True):
            held.append((np.cumsum(unpacked(gaps.as_py())), unpacked(numbers.as_py()).astype(np.int64)))
            size += len(held[-1][0])
            if size >= HELD_KEYS:
                held, size = [summed(*zip(*held, strict=True))], 0
        keys, n = summed(*zip(*held, strict=True))
        part = np.uint64(table["part"][0].as_py() << KEY_BITS - PART_BITS)
        slots = (part | keys[n >= least]) >> np.uint64(KEY_BITS - bits)
        at, first = np.unique(slots >> np.uint64(6), return_index=True)
        ones = np.uint64(1) << (slots & np.uint64(63))
        words = np.bitwise_or.reduceat(ones, first) if len(first) else ones
        return pa.table({"at": at.astype(np.int64), "m": words.view(np.int64)})

    return total


def frequent_marks(rows: DataFrame, marks: list[np.ndarray], least: int, bits: int) -> np.ndarray:
    """Bitmap of ``2 ** bits`` places, ``KEY_BITS`` at most: those of the runs of one word more than ``marks`` know, found ``least`` times.

    Only runs whose shorter parts are marked are counted. What reaches the driver is the bitmap's size at most, or a word for each
    part if that is more.
    """
    shared = rows.sparkSession.sparkContext.broadcast(marks)
    blocks = arrow_stage(rows, _key_blocks(shared, least), "part int, gaps binary, n binary")
    found = blocks.groupBy("part").applyInArrow(_often(least, bits), "at long, m long").toPandas()
    table = np.zeros(1 << (bits - 6), np.uint64)
    np.bitwise_or.at(table, found["at"].to_numpy(np.int64), found["m"].to_numpy(np.int64).astype(np.uint64))
    return table


def marked(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = len(table).bit_length() + 5
    slots = keys >> np.uint64(64 - bits)
    return (table[slots >> np.uint64(6)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)


class HeldWindows:
    """Distinct windows of one language with their numbers; their words are made once."""

    def __init__(self):
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.columns: list[list[pa.Array]] = []
        self.size = 0

    def add(self, keys: np.ndarray, n: np.ndarray, words_of) -> None:
        """Distinct ascending ``keys`` met ``n`` times; ``words_of(at)`` gives the lead columns of those at ``at``."""
        slot = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = slot < len(self.keys)
        known[inside] = self.keys[slot[inside]] == keys[inside]
        self.n[self.place[slot[known]]] += n[known]
        new = np.flatnonzero(~known)
        if len(new):
            self.columns.append(words_of(new))
            self.size += sum(c.nbytes for c in self.columns[-1])
            self.place = np.insert(self.place, slot[new], np.arange(len(self.n), len(self.n) + len(new)))
            self.keys = np.insert(self.keys, slot[new], keys[new])
            self.n = np.r_[self.n, n[new]]

    def batches(self, lang: str) -> Iterator[pa.RecordBatch]:
        at = 0
        for columns in self.columns:
            n = self.n[at : at + len(columns[0])]
            at += len(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *columns, pa.array(n)], ["lang", *LEADS, "n"])


def _windows(shared, most: int = 0):
    """Distinct windows with their number; one without words stands for all places whose word is rare.

    Passed on when after a batch there are more than ``most`` or their words take ``HELD_BYTES``, and at the end.
    """

    def make():
        marks = shared.value
        held: dict[str, HeldWindows] = {}

        def flush():
            for lang, windows in held.items():
                yield from windows.batches(lang)
            held.clear()

        def step(batch: pa.RecordBatch):
            for lang, salt, chunk, limit in _by_language(batch):
                hashes, starts, ends, near, count = scan(chunk, limit)
                if not count:
                    continue
                words = mix(hashes ^ salt)
                length = sum(on.astype(np.int64) for on in known_runs(words, near, marks, ORDER))[:count]
                padded = np.r_[words, np.zeros(ORDER, np.uint64)]
                keys = length.astype(np.uint64)
                for k in range(ORDER):
                    keys += np.where(length > k, padded[k : k + count] * FACTORS[k], np.uint64(0))
                found, first, n = np.unique(keys, return_index=True, return_counts=True)
                last = first + np.maximum(length[first], 1) - 1

                def words_of(at, chunk=chunk, begin=starts[first], end=ends[last], size=length[first]):
                    spans = zip(begin[at].tolist(), end[at].tolist(), size[at].tolist(), strict=True)
                    pads = [b""] * ORDER
                    rows = [(chunk[s:e].split() + pads)[:ORDER] if size else pads for s, e, size in spans]
                    return [pa.array(c, pa.binary()).cast(pa.string()) for c in zip(*rows, strict=True)]

                held.setdefault(lang, HeldWindows()).add(found, n.astype(np.int64), words_of)
            if sum(len(windows.n) for windows in held.values()) > most or sum(windows.size for windows in held.values()) >= HELD_BYTES:
                yield from flush()

        step.end = flush
        return step

    return make


def phrase_sums(windows: pa.Table) -> pa.Table:
    """``lang, phrase, n`` of all that windows begin with; the empty phrase counts all words."""
    found = []
    for k in range(ORDER, 0, -1):
        on = windows.filter(pc.not_equal(windows[LEADS[k - 1]], ""))
        found.append((on["lang"], pc.binary_join_element_wise(*[on[w] for w in LEADS[:k]], " "), on["n"]))
        shorter = ["lang", *LEADS[: k - 1]]
        sums = windows.group_by(shorter, use_threads=False).aggregate([("n", "sum")])
        windows = sums.select([*shorter, "n_sum"]).rename_columns([*shorter, "n"])
    found.append((windows["lang"], pa.array([""] * len(windows)), windows["n"]))
    return pa.concat_tables([pa.table(dict(zip(("lang", "phrase", "n"), columns, strict=True))) for columns in found])


def _phrase_blocks(shared):
    """The sums of a task's phrases, dealt by hash."""

    def block(table: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()

    def as_blocks(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        sums = phrase_sums(pa.Table.from_batches(batches))
        names = zip(sums["lang"].to_pylist(), sums["phrase"].to_pylist(), strict=True)
        parts = np.array([xxhash.xxh3_64_intdigest(f"{lang}\n{phrase}") % PARTS for lang, phrase in names], np.int64)
        sums = sums.append_column("part", pa.array(parts)).sort_by([(c, "ascending") for c in ("part", "lang", "phrase")])
        bounds = _bounds(sums["part"].to_numpy())
        plain = sums.drop_columns("part").combine_chunks()
        blocks = [block(plain.slice(a, b - a)) for _, a, b in bounds]
        return pa.RecordBatch.from_arrays([pa.array([k for k, *_ in bounds], pa.int32()), pa.array(blocks, pa.binary())], ["part", "block"])

    return _in_blocks(_windows(shared, HELD_WINDOWS), as_blocks)


def _often_phrases(least: int):
    """The phrases of one part that are found ``least`` times in all its blocks, and the numbers of words."""

    def total(table: pa.Table) -> pa.Table:
        blocks = pa.concat_tables(pa.ipc.open_stream(b).read_all() for b in table["block"].to_pylist())
        sums = blocks.group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
        often = sums.filter(pc.or_(pc.greater_equal(sums["n_sum"], least), pc.equal(sums["phrase"], "")))
        return often.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "f"])

    return total


def phrase_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = 100, bits: int = 24) -> DataFrame:
    """``lang, size, words, phrase, f`` of all phrases of 1 to ``ORDER`` words found ``least`` times; size 0 counts all words."""
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).where("text <> ''")
    marks: list[np.ndarray] = []
    for _ in range(MARKED):
        marks.append(frequent_marks(rows, marks, least, bits))
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    blocks = arrow_stage(rows, _phrase_blocks(shared), "part int, block binary")
    found = blocks.groupBy("part").applyInArrow(_often_phrases(least), "lang string, phrase string, f long")
    words = F.array_remove(F.split("phrase", " "), "")
    return found.select("lang", words.alias("words"), "phrase", "f").select("lang", F.size("words").alias("size"), "words", "phrase", "f")



def collocations(docs: DataFrame, *, most: int = 2000, least: int = 100, **options) -> DataFrame:
    """Per language its first ``most`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase's score is its lowest over all cuts in two, ``floor(1000 * a * n / (l * r))``
    in exact decimals; ties take the first cut. A phrase inside a longer candidate that is
    as frequent is left out.
    """
    counts = stored(phrase_counts(docs, least=least, **options), "phrase-counts")
    parts = counts.where("size > 0").select("lang", "phrase", "f")
    candidates = counts.where("size > 1").select("lang", "phrase", "words", "size", F.col("f").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    if totals.limit(FEW_LANGUAGES + 1).count() <= FEW_LANGUAGES:
        totals = F.broadcast(totals)
    joined = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    wide = [F.col(c).cast("decimal(19,0)") for c in ("n", "l", "r")]
    over = (F.col("a") * 1000).cast("decimal(19,0)") * wide[0]
    scored = joined.withColumn("over", over).withColumn("under", wide[1] * wide[2]).withColumn("score", F.expr("over div under"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Starts 1 .. size - m + 1 of the shorter phrases of m = 2 .. size - 1 words.
    inner = candidates.where("size > 2").select(
        "lang", "a",
        F.explode(F.expr(
            "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), s -> array_join(slice(words, s, m), ' '))))"
        )).alias("phrase"),
    )
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(longest, ["lang", "phrase"], "left").where("longer is null or longer < a")
    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = Window.partitionBy("lang", "salt").orderBy(*order)
    first = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = first.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
