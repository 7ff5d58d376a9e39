"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task takes the documents it holds in blocks; each block is a corpus of its
own.  Its pre-tokens are reduced to distinct words, which lie end to end in
one linked array of symbols.  An inverted index from a pair of tokens (named
by the token it merges to) to its positions replays the merges in rank order:
the next rank is applied at all its positions at once, and only the pairs with
the touched neighbours are looked up again and entered into the index.

Ids equal those of repeatedly merging the leftmost pair of least rank in each
pre-token.  Ranks do not depend on each other across words; inside a word,
one rank can be applied everywhere at once unless a token made with it may at
once be part of a pair of lower rank.  Such ranks are found when the table is
loaded and applied one position per word at a time.

The rank file has a fixed size (about 50,000 tokens); its tables are broadcast
from the driver.  No shuffle is needed: documents never leave their task.

Defined results: null and empty texts have no ids and decode to empty bytes;
null ids and repeated rows are encoded each by their text; texts of any
length are encoded whole; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType)

from routelytics.llm.blocks import map_texts

#: a Python worker stays about as large as its largest block made it, whatever it runs next
BLOCK_CHARS = 2 << 20
_SHIFT = 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@dataclass
class Ranks:
    """Lookup tables of a rank file."""
    pattern: str
    whole: dict          # token bytes to id
    first: np.ndarray    # byte to id
    pair_key: np.ndarray  # left id << 20 | right id, in order
    pair_to: np.ndarray
    one_by_one: np.ndarray  # ids that must be merged one position per word at a time
    blob: np.ndarray     # bytes of all tokens
    start: np.ndarray
    length: np.ndarray

    @classmethod
    def build(cls, ranks: dict[bytes, int], pattern: str) -> Ranks:
        size = max(ranks.values()) + 1
        if size >= 1 << _SHIFT:
            raise ValueError(f"more than {1 << _SHIFT} tokens")
        keys, to = [], []
        lower = np.zeros(size, bool)
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << _SHIFT | b)
                    to.append(r)
                    lower[a] |= len(token[:i]) > 1 and r < a
                    lower[b] |= len(token[i:]) > 1 and r < b
        order = np.argsort(np.array(keys, np.int64))
        length, tokens = np.zeros(size, np.int64), [b""] * size
        for token, r in ranks.items():
            tokens[r], length[r] = token, len(token)
        return cls(pattern, ranks, np.array([ranks[bytes([b])] for b in range(256)], np.int32),
                   np.array(keys, np.int64)[order], np.array(to, np.int32)[order], lower,
                   np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum(length)[:-1]]), length)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id that each pair merges to, or -1."""
        key = a.astype(np.int64) << _SHIFT | b
        k = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[k] == key, self.pair_to[k], -1).astype(np.int32)


def _every_other(pos: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Of pairs that share a symbol, the first, third, ... of each run; ``pos`` in order."""
    if len(pos) < 2:
        return pos
    joined = nxt[:-1] == pos[1:]
    if not joined.any():
        return pos
    begins = np.concatenate([[True], ~joined])
    at = np.arange(len(pos))
    return pos[(at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0]


def replay(words: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words end to end, and where each word's ids begin (one more at the end)."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    total = int(size.sum())
    if not total:
        return np.empty(0, np.int32), np.zeros(len(words) + 1, np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    sym = ranks.first[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words), dtype=np.int32), size)
    nxt = np.arange(1, total + 1)
    prv = np.arange(-1, total - 1)
    nxt[ends[size > 0] - 1] = -1
    prv[starts[size > 0]] = -1
    dead = np.zeros(total, bool)
    # a word that is a token is done
    done = np.fromiter((ranks.whole.get(w, -1) for w in words), np.int32, len(words))
    known = done[word] >= 0
    cand = np.full(total, -1, np.int32)  # what the pair that begins here merges to
    left = np.flatnonzero((nxt >= 0) & ~known)
    pairs = ranks.merged(np.repeat(ranks.first, 256), np.tile(ranks.first, 256)).reshape(256, 256)
    byte = np.frombuffer(b"".join(words), np.uint8)
    cand[left] = pairs[byte[left], byte[left + 1]]

    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(pos: np.ndarray, to: np.ndarray) -> None:
        ok = to >= 0
        if not ok.all():
            pos, to = pos[ok], to[ok]
        if not len(pos):
            return
        if len(pos) > 1:
            order = np.argsort(to, kind="stable")
            pos, to = pos[order], to[order]
            cuts = np.flatnonzero(to[1:] != to[:-1]) + 1
            parts, names = np.split(pos, cuts), to[np.concatenate([[0], cuts])].tolist()
        else:
            parts, names = [pos], [int(to[0])]
        for r, part in zip(names, parts):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(heap, r)

    enter(left, cand[left])
    while heap:
        r = heapq.heappop(heap)
        parts = index.pop(r)
        pos = np.unique(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])
        pos = pos[cand[pos] == r]
        if not len(pos):
            continue
        if ranks.one_by_one[r]:
            _, first = np.unique(word[pos], return_index=True)
            if len(first) < len(pos):
                enter(np.delete(pos, first), np.full(len(pos) - len(first), r, np.int32))
            pos = pos[first]
        else:
            pos = _every_other(pos, nxt[pos])
        gone = nxt[pos]
        after = nxt[gone]
        sym[pos] = r
        dead[gone] = True
        cand[gone] = -1
        nxt[pos] = after
        has = after >= 0
        prv[after[has]] = pos[has]
        before = prv[pos]
        touched = np.unique(np.concatenate([pos, before[before >= 0]]))
        right = nxt[touched]
        to = np.where(right >= 0, ranks.merged(sym[touched], sym[right]), -1).astype(np.int32)
        cand[touched] = to
        enter(touched, to)

    sym[starts[done >= 0]] = done[done >= 0]
    dead[known] = True
    dead[starts[done >= 0]] = False
    ids = sym[~dead]
    count = np.bincount(word[~dead], minlength=len(words))
    return ids, np.concatenate([[0], np.cumsum(count)])


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + count[0] - 1, start[1] .., end to end."""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)


def decode(ids: np.ndarray, ranks: Ranks) -> bytes:
    """Bytes of the tokens, end to end."""
    return ranks.blob[_spread(ranks.start[ids], ranks.length[ids])].tobytes()


class Coder:
    """Encodes a block of texts; words met in the block are merged once."""

    def __init__(self, ranks: Ranks):
        self.ranks, self.find = ranks, regex.compile(ranks.pattern).findall

    def words(self, texts: list[str]) -> tuple[list[bytes], list[np.ndarray]]:
        seen: dict[str, int] = {}
        rows = []
        for t in texts:
            found = self.find(t)
            rows.append(np.fromiter([seen.setdefault(w, len(seen)) for w in found], np.int32, len(found)))
        return [w.encode("utf-8", "surrogatepass") for w in seen], rows

    def __call__(self, texts: list[str]):
        """(ids, begin, rows): word w's ids are ids[begin[w]:begin[w + 1]]; a text is a row of words."""
        words, rows = self.words(texts)
        return *replay(words, self.ranks), rows


def _text_ids(ids, begin, row) -> np.ndarray:
    return ids[_spread(begin[row], begin[row + 1] - begin[row])]


_IDS = StructType([StructField("ids", ArrayType(IntegerType()))])
_DIGEST = StructType([StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
                      StructField("decoded_sha256", StringType())])


def _shared(docs: DataFrame, path: str, pattern: str):
    return docs.sparkSession.sparkContext.broadcast(Ranks.build(read_ranks(path), pattern))


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) and ``ids`` of every whole text."""
    ranks = _shared(docs, path, pattern)

    def make():
        coder = Coder(ranks.value)

        def f(texts):
            ids, begin, rows = coder(texts)
            count = np.array([int((begin[r + 1] - begin[r]).sum()) for r in rows], np.int64)
            flat = np.concatenate([_text_ids(ids, begin, r) for r in rows]) if rows else np.empty(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
        return f
    return map_texts(docs, make, _IDS, keep or ["doc_id"], block_chars=BLOCK_CHARS)


def decode_ids(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` and ``decoded``: the bytes of the ids (null ids: null)."""
    ranks = _shared(rows, path, pattern)

    def run(batches):
        at = None
        for b in batches:
            at = b.schema.get_field_index(ids_col)
            out = [decode(np.asarray(x.values), ranks.value) if x.is_valid else None for x in b.column(at)]
            yield b.append_column("decoded", pa.array(out, pa.binary()))
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("decoded", BinaryType())]))


def digest(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Columns of the op3 contract: texts are encoded, the ids decoded, both hashed."""
    ranks = _shared(docs, path, pattern)

    def make():
        coder = Coder(ranks.value)

        def f(texts):
            ids, begin, rows = coder(texts)
            names = list(map(str, ids.tolist()))
            cuts = begin.tolist()
            spelled = [" ".join(names[a:z]) for a, z in zip(cuts[:-1], cuts[1:])]
            del names
            n, sha, back, lists = [], [], [], []
            for r in rows:
                own = _text_ids(ids, begin, r)
                n.append(len(own))
                sha.append(hashlib.sha256(" ".join([spelled[w] for w in r.tolist()]).encode()).hexdigest())
                back.append(hashlib.sha256(decode(own, coder.ranks)).hexdigest())
                if with_ids:
                    lists.append(own)
            out = [n, sha, back]
            if with_ids:
                flat = np.concatenate(lists) if lists else np.empty(0, np.int32)
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32))))
            return out
        return f
    added = StructType([*_DIGEST.fields, *_IDS.fields]) if with_ids else _DIGEST
    return map_texts(docs, make, added, ["doc_id"], block_chars=BLOCK_CHARS)
