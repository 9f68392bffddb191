"""Personal data in texts: base patterns, and further spans found by weak supervision.

Base spans are the leftmost non-overlapping matches of each kind's pattern that pass the
kind's check; they always stay. Further candidates are forms that these patterns miss:
addresses written with "at" and "dot", defanged and version 6 addresses, card numbers with
other separators, phone numbers without a plus.

Every candidate, base matches and those that failed their check included, gets the votes of
five labelers: strict shape, check (checksum, range, number of digits), gazetteer (top-level
domains, card issuers, calling codes), words nearby, and the characters around it. Each says
yes, no or nothing. Expectation-maximisation over the counts of all vote patterns estimates
how reliable each labeler is and how likely each pattern is personal data. These
probabilities, as soft labels, train the final classifier, a logistic regression over votes
and shape. A candidate outside the base is added if it passes its check, a gazetteer or
word nearby speaks for it, the classifier gives it at least ``LEAST``, and no base span or
earlier added span overlaps it.

Texts are read once; what reaches the driver are counts of (kind, votes, shape), at most
4 * 3^5 * 2^6 rows whatever the input.

Defined cases: NULL text is empty and has no spans, as have texts without any. Repeated rows
count as rows. Positions are code points, the end exclusive. Of base spans with one start
the kind listed first comes first. An empty table trains nothing and has no rows. Texts of
any length are read whole, in time linear in their length. ``n_...`` count base spans,
``n_added`` the others. Columns other than id and text are not read, so names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import arrow_stage, stored

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LABELERS = ("shape", "check", "gazetteer", "words", "around")
SILENT, YES, NO = range(3)
#: What is kept of a candidate; ``closed`` ones (base matches, failed checks) are never added.
CANDIDATE = ("kind", "votes", "shape", "start", "end", "closed")
#: A candidate is added from this probability on.
LEAST = 0.5

# The base patterns. Possessive and anchored forms of the same, so that no text takes quadratic time.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Further forms; every repetition is bounded.
AT = re.compile(r"(?P<marked>[(\[{] ?at ?[)\]}])|(?<= )at(?= )", re.IGNORECASE)
AFTER_AT = re.compile(r" ?[A-Za-z0-9-]{1,63}(?:(?: ?[(\[{] ?dot ?[)\]}] ?| dot |\.)[A-Za-z0-9-]{1,63}){1,6}", re.IGNORECASE)
BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?\Z")
DOT_WORD = re.compile(r"[(\[{]? ?\bdot\b ?[)\]}]?", re.IGNORECASE)
DEFANGED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![0-9])")
SIX = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
FOURS = re.compile(r"(?<![0-9.])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.])(?:00[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ ./-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")

# Gazetteers and words nearby.
TOP_LEVEL = frozenset("com org net edu gov mil int info biz io co de fr es uk us eu ca au ch at nl be it pt mx ar example".split())
WORDS = {
    EMAIL: "email e-mail mail contact write reach courriel correo kontakt contacto adresse address".split(),
    IP: "ip ipv4 ipv6 host server address addr adresse dirección serveur servidor login logged".split(),
    CARD: "card credit visa mastercard amex karte kreditkarte carte tarjeta payment".split(),
    PHONE: "phone tel telephone call mobile cell fax telefon telefono teléfono téléphone anrufen llamar appeler".split(),
}
OTHER_WORDS = frozenset("version isbn issn page pages id token order invoice total build release chapter section figure".split())
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?[46]?")
NEAR = 48


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _quads(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def passes(kind: int, text: str) -> bool:
    """The kind's check on a match of its base pattern."""
    if kind == EMAIL:
        return True
    if kind == IP:
        return _quads(text)
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == CARD else 9 <= len(digits) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from each ``@`` outwards."""
    at, low = text.find("@"), 0
    while at >= 0:
        start = low + len(text[low:at].rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        low = found.end() if found else at + 1
        at = text.find("@", low)


def base_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """``(start, kind, end, passes)`` of every base match, kind by kind."""
    for start, end in emails(text):
        yield start, EMAIL, end, True
    for kind, pattern in ((IP, QUAD), (CARD, DIGITS), (PHONE, PLUS)):
        for m in pattern.finditer(text):
            yield m.start(), kind, m.end(), passes(kind, m.group())


def further_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """The same of the forms that the base patterns miss."""
    for m in AT.finditer(text):
        before = BEFORE_AT.search(text[max(0, m.start() - 66) : m.start()])
        after = AFTER_AT.match(text, m.end())
        if before and after and (m["marked"] or DOT_WORD.search(after.group())):
            last = DOT_WORD.sub(".", after.group()).replace(" ", "").rpartition(".")[2].lower()
            yield m.start() - len(before.group()), EMAIL, after.end(), last in TOP_LEVEL
    for m in DEFANGED.finditer(text):
        yield m.start(), IP, m.end(), all(int(p) <= 255 for p in re.findall("[0-9]+", m.group()))
    for m in SIX.finditer(text):
        yield m.start(), IP, m.end(), True
    for m in FOURS.finditer(text):
        yield m.start(), CARD, m.end(), luhn(_digits(m.group()))
    for m in LOCAL_PHONE.finditer(text):
        yield m.start(), PHONE, m.end(), 9 <= len(_digits(m.group())) <= 15


# --- votes --------------------------------------------------------------------------------


def _gazetteer(kind: int, found: str) -> int:
    if kind == EMAIL:
        last = DOT_WORD.sub(".", found).replace(" ", "").rpartition(".")[2].lower()
        return YES if last in TOP_LEVEL else SILENT
    digits = _digits(found)
    if kind == IP:
        return NO if digits[:1] == "0" and ":" not in found else SILENT
    if kind == CARD:
        return YES if digits[:1] in ("4", "6") or "51" <= digits[:2] <= "55" or digits[:2] in ("34", "37") else SILENT
    return YES if found[0] == "+" or found.startswith("00") or "(" in found else SILENT


def votes(text: str, start: int, kind: int, end: int, is_base: bool, good: bool) -> int:
    """The labelers' votes on a candidate, as one number in base 3."""
    found = text[start:end]
    words = {w.lower() for w in WORD.findall(text[max(0, start - NEAR) : start])[-6:]}
    near = YES if words.intersection(WORDS[kind]) else NO if words & OTHER_WORDS else SILENT
    sides = text[start - 1 : start] + text[end : end + 1]
    around = NO if any(c.isalnum() or c in "=/\\#" for c in sides) else YES if not sides.strip(" \n,.;:()[]\"'") else SILENT
    given = (YES if is_base else SILENT, YES if good else NO, _gazetteer(kind, found), near, around)
    return sum(v * 3**k for k, v in enumerate(given))


def shape(text: str, start: int, end: int) -> int:
    """Length class (two bits), blanks, dots, letters, start of a line."""
    found = text[start:end]
    bits = min(3, (end - start) // 6)
    bits |= (" " in found) << 2 | ("." in found) << 3 | any(c.isalpha() for c in found[:20]) << 4
    return bits | (start == 0 or text[start - 1] == "\n") << 5


def _find_all():
    """One row per text: base spans and candidates as flat lists of numbers."""

    def step(batch: pa.RecordBatch):
        base, further = [], []
        for text in batch.column("text").to_pylist():
            spans, rest = [], []
            if text:
                for start, kind, end, good in base_matches(text):
                    if good:
                        spans.append((start, kind, end))
                    rest.append((kind, votes(text, start, kind, end, True, good), shape(text, start, end), start, end, 1))
                for start, kind, end, good in further_matches(text):
                    code = votes(text, start, kind, end, False, good)
                    rest.append((kind, code, shape(text, start, end), start, end, 0 if good else 1))
            spans.sort()
            base.append([n for span in spans for n in span])
            further.append([dict(zip(CANDIDATE, c, strict=True)) for c in rest])
        kinds = pa.list_(pa.struct([(n, pa.int64()) for n in CANDIDATE]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(base, pa.list_(pa.int64())), pa.array(further, kinds)], ["id", "base", "found"]
        )

    return step


# --- reliabilities and the classifier -------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """``reliability[l, z, v]``: chance of vote v of labeler l where z is 1 for personal data; ``weights`` of ``features``."""

    share: float
    reliability: np.ndarray
    weights: np.ndarray


def vote_table(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELERS)) % 3


def estimate(table: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation: share of personal data, reliabilities, and the probability of each vote pattern.

    It starts from labelers that are right more often than not; one count is added to every cell.
    """
    right = np.array([[0.5, 0.1, 0.4], [0.5, 0.4, 0.1]])
    reliability = np.repeat(right[None], table.shape[1], axis=0)
    share, p = 0.5, np.full(len(table), 0.5)
    for _ in range(rounds):
        logs = np.log(reliability)[np.arange(table.shape[1]), :, table].sum(axis=1)
        logs += np.log([1 - share, share])
        p = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))
        weight = np.stack([counts * (1 - p), counts * p])
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        for v in range(3):
            reliability[:, :, v] = (weight @ (table == v) + 1).T
        reliability /= reliability.sum(axis=2, keepdims=True)
    return float(share), reliability, p


def features(kind: np.ndarray, codes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    table = vote_table(codes)
    parts = [kind[:, None] == np.arange(len(KINDS)), table == YES, table == NO]
    parts += [(shapes & 3)[:, None] == np.arange(4), shapes[:, None] >> np.arange(2, 6) & 1]
    return np.concatenate(parts, axis=1).astype(float)


def fit(x: np.ndarray, labels: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton's method."""
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (counts * (labels - p)) - ridge * weights
        curve = (x.T * (counts * p * (1 - p))) @ x + ridge * np.eye(x.shape[1])
        change = np.linalg.solve(curve, slope)
        weights = weights + change
        if np.abs(change).max() < 1e-9:
            break
    return weights


def train(found: DataFrame) -> Model:
    """The model of all candidates of ``find`` rows, from counts of kind, votes and shape."""
    each = found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.votes", "c.shape").agg(F.count("*").alias("n"))
    rows = sorted(tuple(r) for r in each.collect())
    width = features(*np.zeros((3, 1), np.int64)).shape[1]
    if not rows:
        return Model(0.5, np.full((len(LABELERS), 2, 3), 1 / 3), np.zeros(width))
    kind, codes, shapes, counts = np.array(rows, np.int64).T
    share, reliability, p = estimate(vote_table(codes), counts.astype(float))
    return Model(share, reliability, fit(features(kind, codes, shapes), p, counts.astype(float)))


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored ``id``, ``base`` (start, kind, end, and so on) and ``found`` (all candidates) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    numbers = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in CANDIDATE]))
    schema = T.StructType([rows.schema["id"]]).add("base", T.ArrayType(T.LongType())).add("found", numbers)
    return stored(arrow_stage(rows, _find_all, schema), "pii-found")


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _decide(weights: np.ndarray):
    def make():
        def step(batch: pa.RecordBatch):
            base_texts, texts, counts, added = [], [], [], []
            for base, found in zip(batch.column("base").to_pylist(), batch.column("found").to_pylist(), strict=True):
                spans = [tuple(base[i : i + 3]) for i in range(0, len(base), 3)]
                more = []
                for c in sorted((c for c in found if not c["closed"]), key=lambda c: (c["start"], -c["end"], c["kind"])):
                    supported = YES in vote_table(np.array([c["votes"]]))[0, 2:4]
                    x = features(*(np.array([c[n]]) for n in ("kind", "votes", "shape")))
                    likely = 1 / (1 + np.exp(-np.clip((x @ weights)[0], -30, 30))) >= LEAST
                    taken = any(s < c["end"] and c["start"] < e for s, _, e in spans + more)
                    if supported and likely and not taken:
                        more.append((c["start"], c["kind"], c["end"]))
                base_texts.append(_joined(spans))
                texts.append(_joined(spans + more))
                counts.append([sum(kind == k for _, kind, _ in spans) for k in range(len(KINDS))])
                added.append(len(more))
            columns = np.array(counts, np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(c) for c in columns], pa.array(added, pa.int64()), pa.array(base_texts, pa.string()), pa.array(texts, pa.string())],
                ["id", *[f"n_{k}" for k in KINDS], "n_added", "base", "spans"],
            )

        return step

    return make


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``n_added``, ``base`` and ``spans``, as ``kind:start:end`` lists."""
    found = find(docs, id_col=id_col, text_col=text_col)
    model = train(found)
    schema = T.StructType([found.schema["id"]])
    for name in (*[f"n_{k}" for k in KINDS], "n_added"):
        schema = schema.add(name, "long")
    schema = schema.add("base", "string").add("spans", "string")
    return arrow_stage(found, _decide(model.weights), schema).withColumnRenamed("id", id_col)
