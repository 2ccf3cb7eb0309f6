"""Language identification by a bidirectional gated recurrent network over bytes."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.plans.names import quoted
from millrace.sources import table

#: Units a direction; documents sampled a language, windows cut from each and bytes a window, for
#: training; training steps and windows a step.
UNITS, SAMPLE_DOCS, SAMPLE_WINDOWS, SAMPLE_BYTES, STEPS, BATCH = 8, 300, 4, 96, 200, 128
#: Bytes of a window at prediction and windows run side by side. Windows follow one another without
#: a gap, and each starts from a zero state in both directions.
SPAN, LANES = 128, 2048


class ByteGru:
    """Two gated recurrent passes over bytes and a softmax at every position.

    z, r = sigmoid(x Wz + h Uz), sigmoid(x Wr + h Ur); c = tanh(x Wc + r * (h Uc)); h = z h + (1 - z) c.
    Inputs are one byte each, so x W is a row of a table. Sigmoids are taken as tanh(x / 2): the
    tables hold halved values of the gates.
    """

    def __init__(self, labels: list[str], units: int, seed: int):
        rng = np.random.default_rng(seed)
        n = max(1, len(labels))
        self.labels = labels
        self.p = {}
        for side in "fb":
            self.p[f"w{side}"] = rng.normal(0, 0.3, (257, 3 * units))
            self.p[f"u{side}"] = rng.normal(0, 0.4 / units**0.5, (units, 3 * units))
        self.p["o"] = rng.normal(0, 0.3, (2 * units, n))
        self.p["c"] = np.zeros(n)
        self.units = units
        self._rest()

    def _rest(self) -> None:
        """Past the end of a text the state stays as it is: the update gate is shut."""
        for side in "fb":
            self.p["w" + side][256] = 0
            self.p["w" + side][256, : self.units] = 60

    def forward(self, x: np.ndarray, side: str):
        """States (steps, lanes, units) and what backward needs, over bytes (steps, lanes)."""
        h_, w, u = self.units, self.p["w" + side], self.p["u" + side]
        steps, lanes = x.shape
        h = np.zeros((lanes, h_))
        out, kept = np.empty((steps, lanes, h_)), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            a, g = w[x[t]], h @ u
            zr = 1 / (1 + np.exp(-(a[:, : 2 * h_] + g[:, : 2 * h_])))
            z, r, s = zr[:, :h_], zr[:, h_:], g[:, 2 * h_ :]
            c = np.tanh(a[:, 2 * h_ :] + r * s)
            kept.append((t, h, z, r, s, c))
            h = z * h + (1 - z) * c
            out[t] = h
        return out, kept

    def backward(self, x: np.ndarray, side: str, kept: list, d_out: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients by backpropagation through time."""
        h_, w, u = self.units, self.p["w" + side], self.p["u" + side]
        dw, du, dh = np.zeros_like(w), np.zeros_like(u), np.zeros(d_out.shape[1:])
        for t, h, z, r, s, c in reversed(kept):
            dh = dh + d_out[t]
            dc = dh * (1 - z) * (1 - c * c)
            da = np.concatenate([dh * (h - c) * z * (1 - z), dc * s * r * (1 - r), dc], 1)
            dg = np.concatenate([da[:, : 2 * h_], dc * r], 1)
            np.add.at(dw, x[t], da)
            du += h.T @ dg
            dh = dh * z + dg @ u.T
        return {"w" + side: dw, "u" + side: du}

    def train(self, x: np.ndarray, y: np.ndarray, steps: int, batch: int, seed: int) -> None:
        """Cross entropy of every position's label by Adam; ``x``: bytes (windows, steps), 256 past the end."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        for i in range(1, steps + 1):
            rows = rng.integers(0, len(x), batch)
            xt, real = x[rows].T, (x[rows] < 256).T[:, :, None]
            (hf, kf), (hb, kb) = self.forward(xt, "f"), self.forward(xt, "b")
            hh = np.concatenate([hf, hb], 2)
            score = hh @ self.p["o"] + self.p["c"]
            prob = np.exp(score - score.max(2, keepdims=True))
            prob /= prob.sum(2, keepdims=True)
            prob[:, np.arange(batch), y[rows]] -= 1
            d = prob * real / real.sum()
            dh = d @ self.p["o"].T
            g = self.backward(xt, "f", kf, dh[:, :, : self.units]) | self.backward(xt, "b", kb, dh[:, :, self.units :])
            g |= {"o": np.einsum("tbh,tbl->hl", hh, d), "c": d.sum((0, 1))}
            size = np.sqrt(sum((a * a).sum() for a in g.values()))
            for k, a in g.items():
                a = a * min(1, 1 / size)
                m[k] = 0.9 * m[k] + 0.1 * a
                v2[k] = 0.99 * v2[k] + 0.01 * a * a
                self.p[k] -= 0.02 * (1 - 0.9 * i / steps) * (m[k] / (1 - 0.9**i)) / (np.sqrt(v2[k] / (1 - 0.99**i)) + 1e-8)
            self._rest()


class Reader:
    """Single-precision prediction over many windows side by side."""

    def __init__(self, net: ByteGru):
        h = self.h = net.units
        half = np.concatenate([np.full(2 * h, 0.5), np.ones(h)])
        self.w = [np.ascontiguousarray((net.p["w" + s] * half).astype(np.float32)) for s in "fb"]
        self.u = [np.ascontiguousarray((net.p["u" + s] * half).astype(np.float32)) for s in "fb"]
        self.o = net.p["o"].astype(np.float32)
        self.c = net.p["c"].astype(np.float32)
        self.labels = net.labels

    def _states(self, x: np.ndarray, side: int) -> np.ndarray:
        h_, w, u = self.h, self.w[side], self.u[side]
        steps, lanes = x.shape
        out = np.empty((steps, lanes, h_), np.float32)
        h = np.zeros((lanes, h_), np.float32)
        a, g = np.empty((lanes, 3 * h_), np.float32), np.empty((lanes, 3 * h_), np.float32)
        zr, c = np.empty((lanes, 2 * h_), np.float32), np.empty((lanes, h_), np.float32)
        for t in range(steps) if not side else range(steps - 1, -1, -1):
            np.take(w, x[t], axis=0, out=a)
            np.dot(h, u, out=g)
            np.add(a[:, : 2 * h_], g[:, : 2 * h_], out=zr)
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            np.multiply(zr[:, h_:], g[:, 2 * h_ :], out=c)
            c += a[:, 2 * h_ :]
            np.tanh(c, out=c)
            new = out[t]
            np.subtract(h, c, out=new)
            new *= zr[:, :h_]
            new += c
            h = new
        return out

    def label(self, x: np.ndarray) -> np.ndarray:
        """Summed position probabilities (windows, labels) of bytes (windows, steps); 256 is past the end."""
        xt = np.ascontiguousarray(x.T)
        score = self._states(xt, 0) @ self.o[: self.h] + self._states(xt, 1) @ self.o[self.h :]
        score += self.c
        np.exp(np.minimum(score, 60), out=score)
        score /= score.sum(2, keepdims=True)
        score[xt == 256] = 0
        return score.sum(0)


def sample(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Training windows: at most SAMPLE_DOCS documents a language, those of the least hashes of their
    ids, and at most SAMPLE_WINDOWS evenly spaced windows of SAMPLE_BYTES bytes of each.

    A language's documents are counted first, so that only hashes below a bound that about ten times
    the sample meets go on: what is shuffled, ranked and collected is a few thousand windows a
    language, whatever the size of the table and however common one language is.
    """
    fit = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out()).where(F.col("text").rlike(r"\p{L}"))
    n = fit.groupBy("lang").agg(F.count("*").alias("of"))  # one row a language
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52))
    cut = F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)), lambda i: F.substring(F.col("text"), (F.length("text") * i / SAMPLE_WINDOWS).cast("int") + 1, F.lit(SAMPLE_BYTES)))
    near = fit.join(F.broadcast(n), "lang").where(place.cast("double") * F.col("of") <= 10.0 * SAMPLE_DOCS * (1 << 52))
    near = near.select("lang", "doc_id", place.alias("place"), F.array_distinct(cut).alias("cut"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("place", "doc_id", "cut"))
    rows = near.withColumn("r", rank).where(F.col("r") <= SAMPLE_DOCS).orderBy("lang", "doc_id", "cut").collect()
    labels = sorted({r.lang for r in rows})
    x, y = [], []
    for r in rows:
        for t in r.cut:
            raw = t.encode()[:SAMPLE_BYTES]
            if raw:
                x.append(np.pad(np.frombuffer(raw, np.uint8).astype(np.int16), (0, SAMPLE_BYTES - len(raw)), constant_values=256))
                y.append(labels.index(r.lang))
    return (np.array(x) if x else np.empty((0, SAMPLE_BYTES), np.int16)), np.array(y, np.int64), labels


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, seed: int = 5, names: tuple[str, str, str] = ("held_out", "lang_pred", "score")) -> DataFrame:
    """The language of every whole text: adds ``held_out, lang_pred, score`` (or ``names``) to the input's columns.

    A network is trained on the driver in numpy from a bounded sample (SAMPLE_DOCS documents a
    language) of labelled documents that are not held out; only text and lang are learned from.
    Every byte of every text is then labelled, in windows of SPAN bytes that follow one another,
    and a document's score is the mean probability of its best language over its positions (ties:
    the label first in the alphabet).

    ``lang_pred`` is ``und`` with score 0 for a null or empty text, one without a letter, and for
    all texts when nothing can be learned. Text is only ever predicted from text. Null ids and null
    languages are kept as rows. Repeated rows are separate rows with equal answers. Columns with one of
    the three names are replaced; all others are kept. Memory is bounded by a batch of
    rows and LANES windows; a very long text is read in pieces.
    """
    spark = docs.sparkSession
    x, y, labels = sample(docs)
    net = ByteGru(labels, UNITS, seed)
    if len(x):
        net.train(x, y, STEPS, BATCH, seed)
    reader = spark.sparkContext.broadcast(Reader(net) if len(x) else None)  # a few kB
    held, pred, score_ = names
    keep = [c for c in docs.columns if c.lower() not in [n.lower() for n in names]]
    base = docs.select(*quoted(*keep), F.col("text").rlike(r"\p{L}").alias(pred), held_out().alias(held))

    def predict(batches):
        r = reader.value
        for b in batches:
            n = b.num_rows
            best, score = np.full(n, "und", object), np.zeros(n)
            letters = b.column(b.schema.get_field_index(pred))
            todo = np.flatnonzero(np.array(letters.fill_null(False).to_pylist(), bool)) if r else []
            if len(todo):
                text = b.column(b.schema.get_field_index("text")).take(pa.array(todo)).cast(pa.binary()).cast(pa.large_binary())
                off = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
                data = np.frombuffer(text.buffers()[2], np.uint8)
                total = np.zeros((len(todo), len(r.labels)))
                for lo, hi, x, piece in _lanes(data, off):
                    np.add.at(total[lo:hi], piece, r.label(x))
                size = np.diff(off)
                top = total.argmax(1)
                best[todo] = np.array(r.labels, object)[top]
                score[todo] = np.clip(total[np.arange(len(todo)), top] / size, 0, 1)
            cols = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, b.column(b.schema.get_field_index(held)), pa.array(best.tolist(), pa.string()), pa.array(score)], [*keep, *names])

    out = base.select(*quoted(*keep), held).schema.add(pred, "string").add(score_, "double")
    return base.mapInArrow(predict, out)


def _lanes(data: np.ndarray, off: np.ndarray):
    """(first text, last text, windows, each one's text from the first) in groups of about LANES windows."""
    n = -(-np.diff(off) // SPAN)
    text = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    order = np.argsort(np.minimum(off[1:][text] - off[:-1][text] - k * SPAN, SPAN), kind="stable")
    text, k = text[order], k[order]
    for s in range(0, len(text), LANES):
        t, w = text[s : s + LANES], k[s : s + LANES]
        first = off[:-1][t] + w * SPAN
        span = int(np.minimum(off[1:][t] - first, SPAN).max())
        at = first[:, None] + np.arange(span)
        x = np.where(at < off[1:][t][:, None], data[np.minimum(at, len(data) - 1)].astype(np.int16), np.int16(256))
        yield 0, len(n), x, t


def op4_language_id(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")
