"""Bounded-space online packing of token sequences."""

import re
import unicodedata
import zlib
from itertools import compress, count
from operator import not_

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.work import written
from millrace.sources import table

TOKENIZER, END_ID = "word_bpe_49k.json", 2
#: Tokens of a sequence; open windows of a partition; leftovers below this many tokens are merged
#: across partitions, this many partitions at a time.
SIZE, OPEN, LEAST, MERGED = 4096, 32, 256, 64
#: Words remembered by a worker, in each of two generations.
REMEMBERED = 400_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part int"


def _class(kind: str) -> str:
    return "".join(re.escape(chr(i)) for i in range(256) if unicodedata.category(chr(i))[0] == kind)


_L, _N = _class("L"), _class("N")


class WordIds:
    """Token ids as little-endian 32-bit words: every text as the tokenizers library gives them.

    Words are encoded by the library, many at a time, and remembered. Splitting into words is done
    here only for texts of printable Latin-1 characters, where it is the tokenizer's own pattern on
    lower case; any other text, and one that holds the string of a special token, goes to the
    library whole.
    """

    # no two alternatives begin with the same character, but those that begin with an apostrophe
    _split = re.compile(rf"[{_L}]+|[{_N}]|'s|'t|'re|'ve|'m|'ll|'d|[^ \t\n\r\xa0{_L}{_N}]+")
    _odd = re.compile(r"[^\t\n\r\x20-\x7e\xa0-\xff]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # tokens that end a word
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Each word's ids: words apart by spaces are encoded together and cut where words end."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = (np.flatnonzero(self.last[ids]) + 1) * 4
        if len(ends) != len(words):
            return [self._whole(w) for w in words]
        raw, ends = ids.tobytes(), [0, *ends.tolist()]
        return [raw[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        odd, split, young, old = self._odd.search, self._split.findall, self.young, self.old
        words = [None if odd(t) or any(x in t for x in self.special) else split(t.lower()) for t in texts]
        found = [None if ws is None else list(map(young.get, ws)) for ws in words]
        gaps = [None if f is None else list(compress(count(), map(not_, f))) for f in found]  # no word is without an id
        fresh = []
        for w in {ws[i] for ws, at in zip(words, gaps, strict=True) if at for i in at}:
            if w in old:
                young[w] = old[w]
            else:
                fresh.append(w)
        for s in range(0, len(fresh), 2048):
            part = fresh[s : s + 2048]
            young.update(zip(part, self._words(part), strict=True))
        for ws, f, at in zip(words, found, gaps, strict=True):
            for i in at or ():
                f[i] = young[ws[i]]
        out = [self._whole(t) if f is None else b"".join(f) for t, f in zip(texts, found, strict=True)]
        if len(young) > REMEMBERED:
            self.young, self.old = {}, young
        return out


_loaded: dict[str, WordIds] = {}


class Windows:
    """A fixed number of open windows; best fit, and the fullest is filled up and emitted when none fits."""

    def __init__(self, size: int, keep: int, emit):
        self.size, self.keep, self.emit = size, keep, emit
        self.open: list[list] = []  # [free tokens, pieces]

    def add(self, doc, ids: memoryview, total: int) -> None:
        """Place a document's ids (4 bytes each); what exceeds a window is cut."""
        start, left = 0, total
        while left >= self.size:  # whole windows of one document
            self.emit([(doc, start, self.size, ids, total)])
            start, left = start + self.size, left - self.size
        while left:
            best = min((w for w in self.open if w[0] >= left), key=lambda w: w[0], default=None)
            if best is None and len(self.open) < self.keep:
                self.open.append(best := [self.size, []])
            if best is None:
                best = min(self.open, key=lambda w: w[0])
            n = min(left, best[0])
            best[1].append((doc, start, n, ids, total))
            best[0] -= n
            start, left = start + n, left - n
            if not best[0]:
                self.emit(best[1])
                self.open = [w for w in self.open if w is not best]

    def drain(self, least: int) -> list:
        """Fill windows from one another and emit them; of the rest, emit powers of two down to
        ``least`` tokens; returns the pieces that are left, below ``least`` tokens together."""
        pieces = [p for w in sorted(self.open, key=lambda w: w[0]) for p in w[1]]
        self.open = []
        total = sum(p[2] for p in pieces)
        goal = self.size
        while goal >= least:
            while total >= goal:
                full, need = [], goal
                while need:
                    doc, start, n, ids, all_ = pieces[0]
                    k = min(n, need)
                    full.append((doc, start, k, ids, all_))
                    pieces[:1] = [(doc, start + k, n - k, ids, all_)] if k < n else []
                    need -= k
                self.emit(full)
                total -= goal
            goal //= 2
        return pieces


def pack(docs: DataFrame, path: str, size: int = SIZE, keep: int = OPEN) -> DataFrame:
    """Pack all documents into sequences: ``docs(doc_id, text)`` -> one row per piece.

    A document is its token ids, without special tokens, and id 2. Each partition keeps ``keep``
    open windows. A piece goes to the open window that it fits most tightly; when none fits and no
    more may be opened, it is cut to fill the fullest, which is emitted, so an emitted window has no
    padding. At the end of the partition the open windows are merged into full ones; from the rest,
    sequences of a power of two are cut, which are not padded either, down to ``LEAST`` tokens. What
    remains, fewer than ``LEAST`` tokens a partition, is merged across ``MERGED`` partitions at a
    time. Only the open windows are in memory, and the corpus is read once and not shuffled.

    Null and empty texts have the single id 2. Repeated ids and null ids are documents of their own;
    other columns are ignored; an empty table gives no rows. ``start`` counts a document's ids
    before the piece, ``offset`` the sequence's; ids_crc32 is over unsigned little-endian words.
    """

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        coder = _loaded.get(path)
        if coder is None:
            coder = _loaded[path] = WordIds(path)
        rows: list[tuple] = []
        number = part << 32

        def emit(pieces, merged=False):
            nonlocal number
            offset = 0
            for doc, start, n, ids, total in pieces:
                rows.append((doc, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), total, -1 if merged else number, offset, part))
                offset += n
            number += not merged

        def out():
            cols = list(zip(*rows, strict=True))
            rows.clear()
            kinds = [pa.int64()] * 7 + [pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

        w = Windows(size, keep, emit)
        end = np.array([END_ID], "<u4").tobytes()
        for b in batches:
            ids = b.column(b.schema.get_field_index("doc_id")).to_pylist()
            texts = b.column(b.schema.get_field_index("text"))
            for s in range(0, b.num_rows, 64):
                for doc, raw in zip(ids[s : s + 64], coder.encode([t or "" for t in texts.slice(s, 64).to_pylist()]), strict=True):
                    raw = memoryview(raw + end)
                    w.add(doc, raw, len(raw) // 4)
            if rows:
                yield out()
        emit(w.drain(LEAST), True)
        if rows:
            yield out()

    pieces = written(docs.selectExpr("CAST(doc_id AS long) doc_id", "CAST(text AS string) text").mapInArrow(run, PIECES), "pieces")
    done, rest = pieces.where("sequence_id >= 0"), pieces.where("sequence_id < 0")

    def merge(key, pdf):
        """First-fit over whole leftovers: each is far below the size, so windows fill well."""
        used, ids, offsets = size, (1 << 62) | int(key[0]) << 16, []
        for _, left in pdf.sort_values(["part", "offset"]).groupby("part", sort=True):
            n = int(left.length.sum())
            if used + n > size:
                used, ids = 0, ids + 1
            offsets.append(left.assign(sequence_id=ids, offset=left.offset + used))
            used += n
        import pandas as pd

        return pd.concat(offsets)[[x.split()[0] for x in PIECES.split(", ")]]

    merged = rest.groupBy((F.col("part") / MERGED).cast("int").alias("g")).applyInPandas(merge, PIECES)
    return done.union(merged).drop("part")


def op8_packing(spark, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
