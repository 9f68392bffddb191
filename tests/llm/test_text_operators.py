"""BPE, line dedup, language identification and the context tree."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from compare import connect, difference
from faultline.llm import bpe, context_tree, language_id, line_dedup, oracles, queries
from faultline.llm.shingles import hashed_words, words
from llm.brute import ContextTree
from llm.brute import words as plain_words

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    "", " ", "\n\n  x", "it's we'll I'd 'start", "a" * 5000, " " * 700, "<|endoftext|>a<|endoftext|>", "naïve café 12.5% 中文 🙂",
    "A b c\x1c d\x85", "<|endof text|>", "ab" * 400, "tab\tnew\r\n line", "x" * 300 + " " + "0123456789" * 60,
]


@pytest.fixture(scope="module")
def vocab():
    return bpe.load_vocabulary(PATH)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_bpe_equals_library(vocab):
    rng = random.Random(3)
    texts = HARD + ["".join(rng.choice("abthe 'sll\n\t é中1.!<|>") for _ in range(rng.randint(0, 200))) for _ in range(400)]
    library = Tokenizer.from_file(PATH)
    got = bpe.Encoder(vocab).encode(texts)
    assert [ids(g) for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_fragment_equals_short_merges(vocab):
    rng = random.Random(5)
    for n in (2, 40, 255):
        data = np.array([rng.choice(b"abcdeth") for _ in range(n)], np.uint8)
        short, _ = bpe.merge_fragments(vocab, data, np.zeros(n, np.int64))
        assert short.tolist() == bpe.merge_long(vocab, data).tolist()


def test_no_token_spans_a_forced_boundary(vocab):
    for start, length in zip(vocab.token_starts[:50_000], vocab.token_lengths[:50_000], strict=True):
        token = vocab.token_bytes[start : start + length]
        assert vocab.joinable[token[:-1], token[1:]].all()


def test_bpe_round_trip_in_spark(spark, vocab):
    rows = [(1, "Hello"), (1, "Hello"), (2, None), (None, "x\ny"), (3, ""), *[(10 + k, t) for k, t in enumerate(HARD)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    back = bpe.decode(bpe.encode(docs, vocab), vocab).collect()
    assert collections.Counter((r.doc_id, r.text) for r in back) == collections.Counter((i, t or "") for i, t in rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(empty, vocab), vocab).count() == 0


def test_decode_skips_unknown_ids_and_repairs_bytes(spark, vocab):
    half = vocab.byte_ids[0xC3]
    raw = bytearray(np.array([900_000, half, vocab.byte_ids[ord("a")]], "<u4").tobytes())
    docs = spark.createDataFrame([(1, raw), (2, None)], "doc_id long, ids binary")
    assert [r.text for r in bpe.decode(docs, vocab).orderBy("doc_id").collect()] == ["�a", ""]


def test_bpe_query_digests(spark, sf_dir):
    library = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    for r in queries.op1_bpe(spark, sf_dir).collect():
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        decoded = library.decode(want, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_line_dedup_query(spark, sf_dir):
    assert difference(queries.op3_line_dedup(spark, sf_dir), connect(sf_dir), oracles.oracle_sql()["op3_line_dedup"]) is None


def lines_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, line string, pos int, id int")
    found = line_dedup.dedup_lines(docs.fillna(0, ["pos"]), salts=4).collect()
    assert all(r.line == "L" for r in found)
    return sorted(((r.doc_id is None, r.doc_id, r.lines.kept_text, r.lines.n_lines, r.lines.n_dropped) for r in found), key=str)


def test_line_dedup_cases(spark):
    common = "the very common line"
    rows = [(k, f"{common}\nown line number {k}", "L", 0, 0) for k in range(40)]
    rows += [(100, None, "L", 0, 0), (101, "", "L", 0, 0), (102, "short\nshort", "L", 0, 0), (103, "short", "L", 0, 0)]
    rows += [(104, "  A Repeated Line\t\na repeated line", "L", 0, 0), (105, "a repeated line\n\nx", "L", 0, 0)]
    rows += [(None, common, "L", 0, 0), (104, "a repeated line", "L", 0, 0)]
    got = {(r[1], r[2]): r[3:] for r in lines_of(spark, rows)}
    assert got[0, f"{common}\nown line number 0"] == (2, 0)
    assert all(got[k, f"own line number {k}"] == (2, 1) for k in range(1, 40))
    assert got[100, ""] == got[101, ""] == (1, 0)
    assert got[102, "short\nshort"] == (2, 0) and got[103, "short"] == (1, 0)
    assert got[104, "  A Repeated Line\t\na repeated line"] == (2, 0) and got[104, "a repeated line"] == (1, 0)
    assert got[105, "\nx"] == (3, 1)
    assert got[None, ""] == (1, 1)
    assert len(got) == len(rows)
    assert lines_of(spark, []) == []


def test_keep_bitmap_is_run_length(spark):
    docs = spark.createDataFrame([(1, "aaaaaaaaaaaa\nkept\nbbbbbbbbbbbb"), (0, "aaaaaaaaaaaa"), (2, "bbbbbbbbbbbb\nc")], "doc_id long, text string")
    runs = {r.doc_id: [tuple(x) for x in r.lines.keep_bitmap] for r in line_dedup.dedup_lines(docs).collect()}
    assert runs == {0: [(0, 1)], 1: [(1, 2)], 2: [(1, 1)]}


def test_language_id_held_out(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in queries.table(spark, sf_dir, "documents").select("doc_id", "lang").collect()}
    rows = [r for r in queries.op8_language_id(spark, sf_dir).collect() if r.held_out]
    assert {r.doc_id for r in rows} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_id_cases(spark):
    base = [(k, "the cat and the dog " * 4, "en") for k in range(6)] + [(k, "der hund und die katze " * 4, "de") for k in range(10, 13)]
    odd = [(20, None, "en"), (21, "", "en"), (22, "123 %% \n", "de"), (23, "the dog", None), (24, "zzqq", None), (None, "der hund", "de")]
    odd += [(23, "the dog", None)]
    docs = spark.createDataFrame(base + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    model = language_id.learn(docs)
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(docs, model).collect()}
    assert {(20, "und"), (21, "und"), (22, "und"), (23, "en"), (24, "en"), (None, "de")} <= got
    empty = docs.limit(0)
    nothing = language_id.learn(empty)
    assert language_id.identify(empty, nothing).count() == 0
    assert {(r.lang_pred, r.score) for r in language_id.identify(docs, nothing).collect()} == {("und", 0.0)}


def test_language_id_with_over_64_languages(spark):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(70):
        own = ["".join(rng.choices(letters, k=6)) for _ in range(5)]
        rows += [(100 * k + j, " ".join(rng.choices(own, k=20)), f"l{k}") for j in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    assert model.slots.shape[1] == 2
    found = language_id.identify(docs, model).join(docs, "doc_id").select("lang", "lang_pred").collect()
    assert all(r.lang == r.lang_pred for r in found)


def test_hashed_words_are_the_words():
    texts = [b"", b" ", b"One two\x0bTWO", b"x" * 700_000 + b" y", b"a b " * 200_000, "é É".encode()]
    known = {}
    for text, hashes in zip(texts, hashed_words(texts), strict=True):
        found = words(text)
        assert len(found) == len(hashes)
        for word, h in zip(found, hashes.tolist(), strict=True):
            assert known.setdefault(h, word) == word
    assert len(known) == len(set(known.values()))


def test_context_tree_weights_from_the_definition():
    counts = {b"the": 5, b"then": 2, b"thin": 1, b"a": 4, b"an": 1, b"that": 0, b"x": 0, "é".encode(): 2, b"\x09z": 1}
    plain = ContextTree(counts)
    groups = collections.defaultdict(list)
    for w in sorted(counts):
        groups[w[:2]].append(w)
    upper = collections.defaultdict(lambda: np.zeros(3))
    for g in groups.values():
        u = context_tree.upper_counts(g, np.array([counts[w] for w in g]))
        for k, *v in zip(u["key"], u["zeros"], u["ones"], u["below"], strict=True):
            upper[int(k)] += v
    keys = sorted(upper)
    table = np.array([upper[k] for k in keys])
    tree = context_tree.UpperTree(np.array(keys), table[:, 0].astype(int), table[:, 1].astype(int), table[:, 2])
    for g in groups.values():
        got = context_tree.word_scores(g, np.array([counts[w] for w in g]), tree)
        assert got == pytest.approx([plain.log10(w) for w in g], abs=1e-9)


def test_context_tree_query(spark, sf_dir):
    docs = {r.doc_id: plain_words(r.text) + [None] for r in queries.table(spark, sf_dir, "documents").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = collections.Counter(w for i, found in docs.items() if not held[i] for w in found)
    n, v = counts.total(), len(counts)
    rows = queries.op2_context_tree(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        found = docs[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(found), n)
        assert r.n_known == sum(counts[w] > 0 for w in found)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in found))
        assert r.score < 0


def test_stretches_are_shared_by_equal_passages():
    rng = random.Random(2)
    passage = " ".join(str(rng.randint(0, 10**6)) for _ in range(200))
    texts = [f"{head} {passage} {tail}".encode() for head, tail in (("one two", "x"), ("three", "y z"))]
    a, b = (set(context_tree.stretches(hashes)[1].tolist()) for hashes in hashed_words(texts))
    assert len(a & b) >= 0.6 * min(len(a), len(b))


def test_context_tree_cases(spark):
    rows = [(1, "the cat\x00 sat"), (1, "the cat\x00 sat"), (2, None), (3, ""), (None, "the dog"), (4, "unseen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1))
    got = context_tree.score_texts(docs, F.col("doc_id") == 4).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 2, 3, 4, 4]
    assert {r.train_tokens for r in got} == {4 + 4 + 1 + 1 + 3}
    assert [r.n_known for r in got if r.doc_id == 4] == [1]
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    nothing = context_tree.score_texts(docs, F.lit(True)).collect()
    assert {r.train_tokens for r in nothing} == {0} and all(math.isfinite(r.score) for r in nothing)
    assert context_tree.score_texts(docs.limit(0), F.lit(False)).count() == 0
