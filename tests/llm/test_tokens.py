import hashlib
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from routelytics.llm import byte_bpe, token_counts
from routelytics.llm.blocks import text_blocks

WORD_FILE, RANK_FILE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LIB = Tokenizer.from_file(WORD_FILE)
RANKS = byte_bpe.read_ranks(RANK_FILE)
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
COUNTER = token_counts.Counter(token_counts.Merges.read(WORD_FILE))
TABLES = byte_bpe.Ranks.build(RANKS, P.PATTERN)
PIECES = ["a", "b", "the", "'s", "'S", " ", "aaaa", "é", "é", "ß", "İ", "ΑΣ", "日本", "😀", "1239", "=", "--", "\n",
          "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "\x85", "\xa0", "\x1c", "\x00", "Ⅷ", "Ɤ"]


def random_texts(n):
    rng = random.Random(n)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(50))) for _ in range(n)] + [
        "", "a" * 3000, "ab" * 2000, " " * 500, "=-" * 1000, "".join(rng.choice("ab") for _ in range(2000))]


def counts(texts):
    return [len(e.ids) for e in LIB.encode_batch(texts, add_special_tokens=False)]


def check_ids(texts, tables=TABLES, enc=ENC):
    ids, begin, rows = byte_bpe.Coder(tables)(texts)
    for t, r in zip(texts, rows):
        own = byte_bpe._text_ids(ids, begin, r)
        assert own.tolist() == enc.encode_ordinary(t)
        assert byte_bpe.decode(own, tables) == t.encode()


def test_many_texts_equal_the_libraries():
    texts = random_texts(1500)
    assert COUNTER(texts) == counts(texts)
    check_ids(texts)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_has_the_library_s_ids(t):
    check_ids([t])


@pytest.mark.parametrize("seed", range(8))
def test_ranks_out_of_merge_order(seed):
    """Random tables, in which a merge may bring up a pair of lower rank."""
    rng = random.Random(seed)
    tokens = {bytes([b]) for b in range(256)}
    while len(tokens) < 330:
        tokens.add(bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))))
    more = sorted(t for t in tokens if len(t) > 1)
    rng.shuffle(more)
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(more)}
    enc = tiktoken.Encoding("odd", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tables = byte_bpe.Ranks.build(ranks, P.PATTERN)
    assert tables.one_by_one.any()
    check_ids(["".join(rng.choice("abc") for _ in range(rng.randrange(1, 90))) for _ in range(400)], tables, enc)


def test_queries_on_edge_rows(spark):
    texts = [None, "", "plain words here", "plain words here", "x<|endoftext|>y", "word " * 60_000, "é" * 50_000, "z" * 100_000]
    rows = [(None if i == 2 else min(i, 6), t, "en", None, 0, 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA + ", n_tokens int")
    got = token_counts.token_counts(docs, WORD_FILE).collect()
    full = [t or "" for t in texts]
    want = [(r[0], len(t.encode()), n, n > 2048) for r, t, n in zip(rows, full, counts(full))]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    got = byte_bpe.digest(docs, RANK_FILE, P.PATTERN).collect()
    want = []
    for r, t in zip(rows, full):
        ids = ENC.encode_ordinary(t)
        want.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_encode_then_decode_restores_the_bytes(spark):
    texts = random_texts(60)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    back = byte_bpe.decode_ids(byte_bpe.encode(docs, RANK_FILE, P.PATTERN), RANK_FILE, P.PATTERN).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in back} == dict(enumerate(texts))
    assert {r.doc_id: list(r.ids) for r in back} == {i: ENC.encode_ordinary(t) for i, t in enumerate(texts)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert token_counts.token_counts(docs, WORD_FILE).collect() == []
    assert byte_bpe.digest(docs, RANK_FILE, P.PATTERN).collect() == []
    assert byte_bpe.decode_ids(byte_bpe.encode(docs, RANK_FILE, P.PATTERN), RANK_FILE, P.PATTERN).collect() == []


def test_no_words():
    assert token_counts.surviving([], COUNTER.m).tolist() == []
    ids, begin = byte_bpe.replay([], TABLES)
    assert len(ids) == 0 and begin.tolist() == [0]
    assert byte_bpe.decode(np.empty(0, np.int32), TABLES) == b""


def test_memory_of_a_task_is_that_of_a_small_block(monkeypatch):
    made = {}
    monkeypatch.setattr(byte_bpe, "_shared", lambda *a: SimpleNamespace(value=TABLES))
    monkeypatch.setattr(byte_bpe, "map_texts", lambda docs, make, added, keep, block_chars: made.update(f=make(), chars=block_chars))
    byte_bpe.digest(None, RANK_FILE, P.PATTERN, with_ids=True)
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 9))) for _ in range(3000)]

    def peak(n_chars):
        texts = [" ".join(rng.choices(words, k=2000)) for _ in range(n_chars // 11_000)]
        batch = pa.RecordBatch.from_pydict({"text": texts})
        tracemalloc.start()
        done = sum(len(made["f"](part)[0]) for _, part in text_blocks(iter([batch]), made["chars"]))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert done == len(texts)
        return most
    assert peak(8 << 20) < 1.5 * peak(2 << 20)


@pytest.mark.parametrize("chars", [1, 40, 1000])
def test_ids_do_not_depend_on_blocks(chars):
    texts = random_texts(60)
    batch = pa.RecordBatch.from_pydict({"text": texts})
    for _, part in text_blocks(iter([batch]), chars):
        check_ids(part)
