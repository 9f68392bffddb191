"""Personal data: base spans against the plain patterns, estimation against simulated votes, added spans, cases."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """Base spans straight from the contract's patterns."""
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c.isdigit()]
            doubled = sum(sum(divmod(d * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and doubled % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(found))


def base_of(text):
    return pii._joined([(s, k, e) for s, k, e, good in pii.base_matches(text) if good])


@pytest.mark.parametrize("seed", range(6))
def test_base_equals_patterns_on_random_text(seed):
    rng = random.Random(seed)
    alphabet = ["1", "2", "25", "4111 1111 1111 1111", ".", "@", "a", "_", "é", "-", " ", "+", "(", ")", "0", "\n", "x.y", "٣", "%"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert base_of(text) == plain(text), text


def test_base_cases():
    for text in ["a@b.c_d@e.f", "a@b@c.d.", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.0255", "4111-1111-1111-1111 2", "+1 (843) 555-4223. +", "@.@"]:
        assert base_of(text) == plain(text)
    assert base_of("0" * 5000 + ".1.2.3") == f"ip:0:{5006}"


def test_long_texts_take_linear_time():
    began = time.perf_counter()
    for part in ("1", "1.", "a@", "a", "+1", "+1 ", "1 ", "(at) ", "a at ", "a@b.", "00", "1:", "4111."):
        text = part * (1_000_000 // len(part))
        sum(1 for _ in pii.base_matches(text)), sum(1 for _ in pii.further_matches(text))
    assert time.perf_counter() - began < 60


def test_estimation_finds_good_and_bad_labelers():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.3
    accuracy = np.array([0.95, 0.9, 0.85, 0.6, 0.75])
    right = rng.random((len(truth), 5)) < accuracy
    spoken = rng.random((len(truth), 5)) < 0.8
    votes = np.where(~spoken, pii.SILENT, np.where(right == truth[:, None], pii.YES, pii.NO))
    table, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    share, reliability, p = pii.estimate(table, counts.astype(float))
    assert abs(share - 0.3) < 0.03
    told = reliability[:, 1, pii.YES] / (reliability[:, 1, pii.YES] + reliability[:, 1, pii.NO])
    assert np.abs(told - accuracy).max() < 0.06
    majority = (votes == pii.YES).sum(1) > (votes == pii.NO).sum(1)
    assert ((p[which.ravel()] >= 0.5) == truth).mean() > max(0.93, (majority == truth).mean())


def test_classifier_follows_soft_labels():
    x = np.array([[1.0, 0.0], [1.0, 1.0]])
    weights = pii.fit(x, np.array([0.2, 0.9]), np.array([1e6, 1e6]))
    assert 1 / (1 + np.exp(-x @ weights)) == pytest.approx([0.2, 0.9], abs=1e-4)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(400):
        number = "".join(rng.choice("0123456789") for _ in range(16))
        rows.append((i, f"the words {number} and mail of.{i}@mail.example.com or +1 (843) 555-{i:04d} from 10.0.{i % 200}.7, {number[:9]}.99.1.2 end"))
    return rows


def test_adds_disguised_forms_and_leaves_clean_texts_alone(spark, corpus):
    planted = [
        (1001, "contact jane.doe (at) mail (dot) example (dot) com now", ["jane.doe (at) mail (dot) example (dot) com"]),
        (1002, "call me on (843) 555-4223 today", ["(843) 555-4223"]),
        (1003, "server ip 10[.]20[.]30[.]40 is down", ["10[.]20[.]30[.]40"]),
        (1004, "credit card 4111.1111.1111.1111 expired", ["4111.1111.1111.1111"]),
        (1005, "the number 20230415-001 of version 10.2.3 on page 12 at noon dot", []),
        (1006, "they met at the com dot in 1999, 12 34 56 and 1234 5678", []),
        (1007, "credit card 4111.1111.1111.1112 expired", []),
        (1008, "phone +1 (843) 555-4223", []),
    ]
    docs = spark.createDataFrame(corpus + [p[:2] for p in planted], "doc_id long, text string").withColumn("base", F.lit(1))
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    for doc_id, text, want in planted:
        r = got[doc_id]
        base = set(r.base.split(",")) if r.base else set()
        added = [s for s in r.spans.split(",") if s and s not in base]
        assert [text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in added] == want, text
        assert r.n_added == len(want)
    assert all(got[i].n_added == 0 and got[i].spans == got[i].base == plain(t) for i, t in corpus)


def test_cases(spark):
    rows = [(1, None), (1, None), (None, "a@b.c"), (2, ""), (3, "x" * 3_000 + " a@b.c"), (4, "é a@b.c 🙂 1.2.3.4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("x"), "spans": F.lit(2), "found": F.lit(3)})
    got = sorted((r.doc_id or 0, r.base) for r in pii.find_personal_data(docs).collect())
    assert got == sorted((i or 0, plain(t)) for i, t in rows)
    assert pii.find_personal_data(docs.where("false")).count() == 0


def test_query_equals_patterns(spark, sf_dir):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    for r in queries.op12_pii(spark, sf_dir).collect():
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        kinds = [s.split(":")[0] for s in want.split(",") if s]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in pii.KINDS]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
