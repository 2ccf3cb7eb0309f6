"""Byte-level BPE with a hierarchical-bitmap queue of merge ranks."""

import base64
import hashlib
import re
import unicodedata

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from millrace.functions.ngrams import blocks
from millrace.sources import table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens remembered by a worker, in each of two generations.
REMEMBERED = 350_000
#: Characters whose new pre-tokens are encoded together.
BLOCK = 1 << 22


class RankQueue:
    """Positions by merge rank; the lowest rank is found by two find-first-set operations.

    One bit per block of 256 ranks says whether the block holds any; one word of 256 bits a block
    says which. A bucket holds the linked-list positions whose pair had that rank when queued; an
    entry whose pair has changed since is stale and skipped by the caller.
    """

    __slots__ = ("buckets", "low", "top")

    def __init__(self):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.low: dict[int, int] = {}
        self.top = 0

    def put(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        block, low = rank >> 8, self.low
        if block in low:
            low[block] |= 1 << (rank & 255)
        else:
            low[block] = 1 << (rank & 255)
            self.top |= 1 << block

    def add(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Queue positions by their ranks; those of rank -1 are not queued."""
        if len(ranks) > 1:
            order = ranks.argsort(kind="stable")
            ranks, positions = ranks[order], positions[order]
        cuts = [*(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        s = 0
        for r, e in zip(ranks[[0, *cuts[:-1]]].tolist(), cuts, strict=True):
            if r >= 0:
                self.put(r, positions[s:e])
            s = e

    def take(self) -> tuple[int, np.ndarray]:
        """Remove the bucket of the lowest rank; the queue must not be empty."""
        top, low = self.top, self.low
        block = (top & -top).bit_length() - 1
        word = low[block]
        bit = word & -word
        if word == bit:
            del low[block]
            self.top = top & (top - 1)
        else:
            low[block] = word ^ bit
        rank = block << 8 | bit.bit_length() - 1
        bucket = self.buckets.pop(rank)
        return rank, bucket[0] if len(bucket) == 1 else np.concatenate(bucket)


#: Stands between pre-tokens; no token has this id.
_MARK = (1 << 20) - 1


class BytePairs:
    """Encodes and decodes byte strings by a table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes = {r: b for b, r in ranks.items()}
        self.first_ids = np.array([ranks[bytes([i])] for i in range(256)])
        self.pattern = regex.compile(pattern)
        # every pair of tokens that joins to a token, by both ids, in order
        pairs = {ranks[b[:k]] << 20 | ranks[b[k:]]: r for b, r in ranks.items() for k in range(1, len(b)) if b[:k] in ranks and b[k:] in ranks}
        self.pair_keys = np.array([*sorted(pairs), np.iinfo(np.int64).max])
        self.pair_values = np.array([*map(pairs.__getitem__, sorted(pairs)), -1])

    @classmethod
    def load(cls, path: str, pattern: str = public_tokenizers.PATTERN) -> "BytePairs":
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(r) for a, r in map(bytes.split, f)}, pattern)

    def split(self, text: str) -> list[str]:
        """The matches of the pattern. Python's own engine, which is faster, takes texts of Latin-1 characters."""
        if self.pattern.pattern == public_tokenizers.PATTERN and _NOT_LATIN.search(text) is None:
            return _LATIN.findall(text)
        return self.pattern.findall(text)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pre-tokens in a row, and where each ends: always a piece's lowest rank,
        then its leftmost position, is merged.

        All pieces share one linked list, with a mark between them that joins with nothing, and one
        queue: the lowest rank of all is the lowest of every piece that has it. A bucket is merged
        at once in all its pieces; where that could pass over a lower rank that a merge opens, only
        at a piece's leftmost position, and its other positions go back to the queue.
        """
        if not pieces:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        size = np.array([len(p) for p in pieces])
        at = np.cumsum(size + 1)  # the mark after each piece
        n = int(at[-1]) + 1
        token = np.full(n, _MARK)
        inside = np.ones(n, bool)
        inside[0] = inside[at] = False
        token[inside] = self.first_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.cumsum(~inside)
        rank_at = np.full(n, -1)
        rank_at[:-1] = self.pair_ranks((token[:-1] << 20) | token[1:])
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        queue = RankQueue()
        queue.add(rank_at, np.arange(n))
        while queue.top:
            rank, i = queue.take()
            i = i[rank_at[i] == rank]  # the others are stale: their pair has changed
            if not len(i):
                continue
            if len(i) > 1:
                i = np.unique(i)
                w = piece[i]
                if (w[1:] == w[:-1]).any():
                    i, again = self._at_once(rank, i, w, token, after, before)
                    if len(again):
                        queue.put(rank, again)
            j = after[i]
            nxt = after[j]
            token[i] = rank
            token[j] = rank_at[j] = -1
            after[i] = nxt
            before[nxt] = i
            p = before[i]
            new = self.pair_ranks(np.concatenate([rank << 20 | token[nxt], token[p] << 20 | rank]))
            rank_at[i], rank_at[p] = new[: len(i)], new[len(i) :]
            queue.add(new, np.concatenate([i, p]))
        token = token[token >= 0]
        mark = token == _MARK
        return token[~mark], (np.cumsum(~mark)[mark])[1:]

    def _at_once(self, rank: int, i: np.ndarray, w: np.ndarray, token, after, before) -> tuple[np.ndarray, np.ndarray]:
        """Which of a bucket's positions (sorted, of pieces ``w``) are merged now, and which wait.

        Of positions that overlap in a row, every other one from the left is merged. A piece where
        some merge would open a lower rank merges its leftmost position only.
        """
        k = np.arange(len(i))
        apart = np.concatenate([[True], after[i[:-1]] != i[1:]])
        keep = (k - np.maximum.accumulate(np.where(apart, k, 0))) & 1 == 0
        t = i[keep]
        opened = self.pair_ranks(np.concatenate([rank << 20 | token[after[after[t]]], token[before[t]] << 20 | rank, [rank << 20 | rank]]))
        low = (opened >= 0) & (opened < rank)
        if not low.any():
            return t, i[:0]
        bad = w if low[-1] else np.concatenate([w[keep], w[keep]])[low[:-1]]
        slow = np.isin(w, bad)
        first = np.concatenate([[True], w[1:] != w[:-1]])
        return i[np.where(slow, first, keep)], i[slow & ~first]

    def pair_ranks(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of pairs of token ids, -1 for pairs that join to no token."""
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_values[at], -1)


def _class(kind: str) -> str:
    return "".join(re.escape(chr(i)) for i in range(256) if unicodedata.category(chr(i))[0] == kind)


_L, _N, _S = _class("L"), _class("N"), r" \t\n\r\f\v\x85\xa0"
_NOT_LATIN = re.compile("[^\x00-\xff]")
#: The public pattern with its classes spelled out for Latin-1.
_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


class Memory:
    """Encoded pre-tokens in two generations: bounded, and frequent ones stay."""

    def __init__(self, bpe: BytePairs):
        self.bpe = bpe
        self.text = {r: str(r) for r in bpe.bytes}
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def ids(self, documents: list[list[str]]) -> list[str]:
        """Each document's ids in decimal, joined by commas, from its pre-tokens."""
        young, old, fresh = self.young, self.old, []
        for p in set().union(*documents).difference(young):
            if p in old:
                young[p] = old[p]
            else:
                fresh.append(p)
        ids, ends = self.bpe.encode([p.encode("utf-8", "replace") for p in fresh])
        text, s = list(map(self.text.__getitem__, ids.tolist())), 0
        for p, e in zip(fresh, ends.tolist(), strict=True):
            young[p] = ",".join(text[s:e])
            s = e
        out = [",".join(map(young.__getitem__, d)) for d in documents]
        for p in fresh:
            if len(p) > 100:
                del young[p]
        if len(young) >= REMEMBERED:
            self.young, self.old = {}, young
        return out


class Decoder:
    """Bytes of decimal token ids."""

    def __init__(self, bpe: BytePairs):
        self.token = {str(r): b for b, r in bpe.ranks.items()}

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.split(",")))


_loaded: dict[str, tuple[Memory, Decoder]] = {}


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Byte-level BPE of every whole text: ``docs(doc_id, text)`` -> digests of ids and of decoded bytes.

    Each match of the public pattern is encoded by itself from the ranks in the file at ``path``
    (read by each worker; give a path that executors can read), as the tiktoken library does for
    ordinary text, and its ids are decoded again. Pre-tokens repeat, so a worker remembers a bounded
    number of them; a pre-token of any length is merged in time n log n at most. Texts are taken
    in blocks of about BLOCK characters, and their new pre-tokens are encoded together.

    Null and empty texts have no tokens: n_tokens 0 and the digests of the empty string. Null ids
    and repeated rows are rows like others; other columns are ignored; an empty table gives no rows.
    Columns: doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256.
    """

    def encode(batches):
        if path not in _loaded:
            bpe = BytePairs.load(path)
            _loaded[path] = Memory(bpe), Decoder(bpe)
        memory, decoder = _loaded[path]
        split = memory.bpe.split
        for b in batches:
            count, ids_hash, raw_hash = [], [], []
            for _, texts in blocks(b.column(b.schema.get_field_index("text")).to_pylist(), BLOCK):
                for ids in memory.ids([split(t) for t in texts]):
                    count.append(ids.count(",") + 1 if ids else 0)
                    ids_hash.append(hashlib.sha256(ids.encode()).hexdigest())
                    raw_hash.append(hashlib.sha256(decoder.decode(ids) if ids else b"").hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(count, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(raw_hash, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("CAST(doc_id AS long) doc_id", "CAST(text AS string) text").mapInArrow(encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_byte_bpe(spark, folder: str) -> DataFrame:
    return encode_documents(table(spark, folder, "documents"), public_tokenizers.path(RANKS))
