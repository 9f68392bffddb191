"""Language identification with bit-sliced Bloom filters over n-grams.

One filter per language, stored sliced: a slot holds one bit per language, so a
lookup of an n-gram ANDs its slots and returns the mask of all languages that
contain it. Per language the set bits over a text are counted, corrected for the
filter's false positives, and the largest corrected count decides.

Defined cases: NULL text or a text without a letter is ``und`` with score 0; so is
everything when nothing could be learned. Ties and texts without a known n-gram go
to the language with more learned rows, then to the smaller name. Repeated rows
count as rows. NULL ``lang`` is never learned. Columns other than the id and the
text are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import arrow_stage, mix, slices

UNKNOWN = "und"
PIECE = 1 << 20
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LanguageModel:
    """``slots[s, w]``: bits of languages ``64 w`` to ``64 w + 63`` at slot ``s``; languages in order of preference."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    sizes: tuple[int, ...]
    hashes: int


def letters(text: str | None) -> bytes:
    """Lower-case letters, every run of anything else as one space, one space around; empty without a letter."""
    if text is None or not LETTER.search(text):
        return b""
    return f" {NOT_LETTERS.sub(' ', text.lower()).strip()} ".encode()


def ngram_codes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all byte n-grams of the joined texts, and where one lies inside a single text."""
    padded = np.concatenate([data, np.zeros(size, np.uint8)])
    codes = np.full(len(data), size, np.uint64)
    for k in range(size):
        codes = (codes << np.uint64(8)) | padded[k : k + len(data)]
    valid = np.ones(len(data) + 1, bool)
    for back in range(1, size):
        ends = starts + lengths - back
        valid[ends[ends >= starts]] = False
    return mix(codes), valid[:-1]


def slot_numbers(codes: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    """The slots of each code: disjoint bit ranges of its hash."""
    mask = np.uint64((1 << bits) - 1)
    return [(codes >> np.uint64(k * bits)) & mask for k in range(hashes)]


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    texts = [letters(x) for x in column.to_pylist()]
    lengths = np.array([len(x) for x in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths, lengths


def learn(
    docs: DataFrame,
    training: Column | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = 2000,
    sizes: tuple[int, ...] = (3, 5),
    bits: int = 20,
    hashes: int = 2,
    least_count: int = 2,
    least_share: float = 0.5,
) -> LanguageModel:
    """Filters from at most about ``rows_per_language`` rows of each language, chosen by a hash of the id.

    A language contains an n-gram seen ``least_count`` times in its sample whose
    relative frequency is at least ``least_share`` of the largest over languages.
    What reaches the driver is bounded by languages and slots, not by rows.
    """
    rows = docs.where(F.lit(True) if training is None else F.coalesce(training, F.lit(False))).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    rows = rows.where("lang is not null and text is not null").withColumn("h", F.xxhash64("id"))
    first = Window.partitionBy("lang").orderBy("h")
    chosen = (
        rows.select("lang", "h")
        .withColumn("r", F.row_number().over(first))
        .where(F.col("r") <= rows_per_language)
        .groupBy("lang")
        .agg(F.count("*").alias("n"), F.max("h").alias("cut"))
        .collect()
    )
    chosen.sort(key=lambda r: (-r["n"], r["lang"]))
    languages = [r["lang"] for r in chosen]
    words = max(1, -(-len(languages) // 64))
    table = np.zeros((1 << bits, words), np.uint64)
    if not languages:
        return LanguageModel([], table, np.zeros(0), sizes, hashes)

    cuts = F.create_map(*[F.lit(x) for r in chosen for x in (r["lang"], r["cut"])])
    sample = rows.where(F.col("h") <= F.element_at(cuts, F.col("lang"))).select("lang", "text")
    grams = arrow_stage(sample, lambda: _counts(sizes), "lang string, gram long, n long")
    grams = grams.groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    totals = {r["lang"]: r["n"] for r in grams.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    numbers = [lang for lang in languages if lang in totals]
    if not numbers:
        return LanguageModel([], table, np.zeros(0), sizes, hashes)
    total = F.create_map(*[F.lit(x) for lang in numbers for x in (lang, float(totals[lang]))])
    number = F.create_map(*[F.lit(x) for k, lang in enumerate(numbers) for x in (lang, k)])
    share = grams.withColumn("f", F.col("n") / F.element_at(total, F.col("lang")))
    best = share.withColumn("top", F.max("f").over(Window.partitionBy("gram")))
    kept = best.where((F.col("n") >= least_count) & (F.col("f") >= least_share * F.col("top")))
    low = (1 << bits) - 1
    cells = kept.select(
        F.element_at(number, F.col("lang")).alias("k"),
        F.explode(
            F.array(*[F.shiftrightunsigned("gram", i * bits).bitwiseAND(F.lit(low)) for i in range(hashes)])
        ).alias("slot"),
    )
    masks = cells.groupBy("slot", F.floor(F.col("k") / 64).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, k % 64)")).alias("m")
    )
    found = masks.toPandas()
    table[found["slot"].to_numpy(np.int64), found["w"].to_numpy(np.int64)] = found["m"].to_numpy(np.int64).astype(np.uint64)
    fill = np.array([np.mean((table[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)) for k in range(len(numbers))])
    return LanguageModel(numbers, table, fill**hashes, sizes, hashes)


def _counts(sizes: tuple[int, ...]):
    def step(batch: pa.RecordBatch):
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in sorted(set(langs)):
            data, starts, lengths = _joined(batch.column("text").filter(pa.array(langs == lang)))
            for size in sizes:
                codes, valid = ngram_codes(data, starts, lengths, size)
                found, n = np.unique(codes[valid], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"],
                )

    return step


def identify(
    docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text", inside: bool = False
) -> DataFrame:
    """Per row: the id, ``lang_pred`` and ``score``, the corrected share of the text's n-grams in that language's filter.

    ``inside``: the id is a struct and the text one of its fields, so it is sent once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), *([] if inside else [F.col(text_col).alias("text")]))
    schema = T.StructType([rows.schema["id"]]).add("lang_pred", "string").add("score", "double")
    out = arrow_stage(rows, lambda: _predict(shared.value, text_col if inside else None), schema)
    return out.withColumnRenamed("id", id_col)


def _predict(model: LanguageModel, field: str | None = None):
    bits = int(model.slots.shape[0]).bit_length() - 1

    def step(batch: pa.RecordBatch):
        # A byte of text takes some fifty while its n-grams are looked up, so one megabyte at a time.
        for part in slices(batch, PIECE):
            yield from judge(part)

    def judge(batch: pa.RecordBatch):
        texts = batch.column("text") if field is None else pc.struct_field(batch.column("id"), field)
        data, starts, lengths = _joined(texts)
        full = np.flatnonzero(lengths)
        pred = np.full(len(lengths), UNKNOWN, object)
        score = np.zeros(len(lengths))
        if len(full) and model.languages:
            hits = np.zeros((len(model.languages), len(full)))
            grams = np.zeros(len(full))
            for size in model.sizes:
                codes, valid = ngram_codes(data, starts, lengths, size)
                slots = slot_numbers(codes, bits, model.hashes)
                grams += np.add.reduceat(valid, starts[full], dtype=np.int64)
                for w in range(model.slots.shape[1]):
                    mask = model.slots[slots[0], w]
                    for s in slots[1:]:
                        mask = mask & model.slots[s, w]
                    mask[~valid] = 0
                    for k in range(64 * w, min(64 * w + 64, len(model.languages))):
                        bit = (mask >> np.uint64(k % 64)) & np.uint64(1)
                        hits[k] += np.add.reduceat(bit.astype(np.uint8), starts[full], dtype=np.int64)
            rate = model.false_rate[:, None]
            known = np.clip((hits - grams * rate) / np.maximum(1 - rate, 1e-9), 0, grams)
            best = known.argmax(axis=0)
            pred[full] = np.array(model.languages, object)[best]
            score[full] = known[best, np.arange(len(full))] / np.maximum(grams, 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(pred.tolist(), pa.string()), pa.array(score)], ["id", "lang_pred", "score"]
        )

    return step
