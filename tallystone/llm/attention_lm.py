"""Language-model scoring with a small causal self-attention model.

Words are lower-cased and cut into subword ids of a public vocabulary; a
document is its words' ids and one end.  The model gives each id the product of
the probability of its class, from one causal self-attention layer over the ids
before it, and of the id within its class, from the training counts of ids.
The most frequent ids are classes of their own; the others share classes by
frequency.  A class's probability is that of its band times that of the class in
the band, each from a softmax of its own: two short ones in place of a long one.

Windows hold ``2 * stride`` ids and overlap by half: the second half of each is
scored, with everything before it in the window as context, so each id is
scored once (the first window of a document has no first half).  Windows are
scored in batches with a mask for the future and for what is not of the
document.

Training: every stride-aligned window of every training document is learned
from as it is scored, by its second half, so each training id is learned once a
pass.  Some windows that follow each other are learned from together and share
the work on the ids that they have in common.  Trainers run on the executors and read the chunks where they lie: each
makes the windows of some documents at a time, starts anew after its share, and
their parameters are averaged.  At every size of the corpus there is one pass,
in two parts (every second of those rows of windows each): the second part's
trainers begin from the average of the first's.  Counts of words and of ids cover all training
documents.

The base score needs the count of every word of every document.  Documents are
packed in chunks; a chunk's distinct words go out once with their counts in the
chunk, in one row for each range of hashes, are summed by word within the range,
and come back to the chunk in one row each; the words' order in documents stays
in the chunk.  There are twice as many ranges as partitions of the input, 64 at
least, so a range's words stay as many however large the input is.

Defined cases: null and empty texts are one end; a row with a null id counts
as id ""; without training documents all counts are 0 and the model is the
untrained one; equal rows get equal scores, but for rounding; very long texts
are scored whole, some 300,000 words at a time; an empty table gives no row;
other columns are not carried along, so no name can clash.  64-bit hashes stand
for words.
"""

from __future__ import annotations

from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Words, blocks, keep_heap, spaces_table, tidy, written
from .language_id import held_out
from .token_counts import MODEL

CHUNK, STRIDE, DIM, HIDDEN, SLOTS, VOCAB, BEGIN, END = 14_000_000, 16, 16, 16, 2048, 32_000, 1, 2
#: A class is one of ``EACH`` in one of ``BANDS``.
BANDS, EACH = 16, 16
CLASSES = BANDS * EACH
#: Ranges of hashes at least.
RANGES = 64
#: Windows of a trainer and of one of its steps; tasks that add parameters up.
SHARE, BATCH, SUMMERS = 100_000, 256, 8
#: Windows whose arrays are worked on at a time.
FEW = 96
#: Windows that follow each other and are learned from in one step, as they share the work on their ids.
ROW = 16
#: Parts of the one pass over all windows; parameters are averaged after each.
PARTS = 2
EDGE = U64(0)  # hash of the end, counted as a word
F32 = np.float32
LEAST = F32(1e-25)  # sums of exps below this, or above its inverse, are made again with the largest logit taken off


# ------------------------------------------------------------------ the model


def shared(counts: np.ndarray, n: int) -> np.ndarray:
    """One of ``n`` places for each id: the most frequent have three quarters of the places to themselves, and the others
    share the rest by frequency, each place with about the same sum of square roots of counts."""
    order = np.argsort(-counts, kind="stable")
    alone = min(n * 3 // 4, len(counts) - 1)
    of = np.empty(len(counts), np.int64)
    of[order[:alone]] = np.arange(alone)
    rest = order[alone:]
    mass = np.sqrt(counts[rest] + 0.5)
    up = np.cumsum(mass)
    of[rest] = alone + np.minimum(n - alone - 1, (up - mass) * (n - alone) // up[-1]).astype(np.int64)
    return of


def classes_of(counts: np.ndarray, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Class of each id, and its log probability within the class."""
    of = shared(counts, classes)
    within = counts + 0.5
    return of, np.log(within / np.bincount(of, within, classes)[of])


def start(seed: int = 9) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    g = lambda *s: (r.standard_normal(s) * 0.1).astype(F32)
    return {
        "slot": g(SLOTS, DIM), "qkv": g(DIM, 3 * DIM), "near": np.zeros(2 * STRIDE, F32), "w1": g(DIM, HIDDEN), "w2": g(HIDDEN, DIM),
        "out": g(DIM + 1, BANDS), "band": g(BANDS, HIDDEN), "w3": g(DIM, HIDDEN), "each": g(HIDDEN + 1, EACH),
    }


SHAPES = {k: v.shape for k, v in start().items()}


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def views(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = x[at : at + n].reshape(s)
        at += n
    return out


def shaped(x: np.ndarray) -> dict[str, np.ndarray]:
    return views(x.astype(F32))


def gap_bias(near: np.ndarray) -> np.ndarray:
    """(queries, keys): the bias by distance, and -1e9 for the future; queries are the second half of the keys."""
    back = np.arange(STRIDE, 2 * STRIDE)[:, None] - np.arange(2 * STRIDE)[None, :]
    return np.where(back >= 0, near[np.clip(back, 0, len(near) - 1)], F32(-1e9)).astype(F32)


def pairs(z: np.ndarray, first: int, n: int) -> np.ndarray:
    """(rows - 1, 2 * stride, n): columns ``first`` to ``first + n`` of each row of (rows, stride, width) and the next, without a copy."""
    row, cell, _ = z.strides
    return np.ndarray((len(z) - 1, 2 * STRIDE, n), F32, z, first * 4, (row, cell, 4))


def fine(total: np.ndarray) -> bool:
    """Whether no sum of exps has left the range that F32 holds well."""
    return LEAST < float(total.min(initial=1)) and float(total.max(initial=1)) < 1 / LEAST


def exp_columns(w: np.ndarray, h: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """exp of each column of ``w`` @ ``h``, their sums, and the logits at the flat places ``at``; if sums leave the range, over the columns' maxima."""
    ones = np.ones(len(w), F32)
    o = w @ h
    hit = None if at is None else np.take(o.ravel(), at)
    np.exp(o, out=o)
    total = ones @ o
    if not fine(total):
        o = w @ h
        o -= o.max(0)
        hit = None if at is None else np.take(o.ravel(), at)
        np.exp(o, out=o)
        total = ones @ o
    return o, total, hit


def by_window(x: np.ndarray, first: int, n: int) -> np.ndarray:
    """(rows, n, stride): rows ``first`` to ``first + n`` of ``x`` (rows, columns of queries), for each window's queries, without a copy."""
    row, cell = x.strides
    return np.ndarray((x.shape[1] // STRIDE, n, STRIDE), F32, x, first * row, (STRIDE * cell, row, cell))


def attend(k: np.ndarray, q: np.ndarray, v: np.ndarray, bias: np.ndarray, gate: np.ndarray, live: np.ndarray, opening: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights of attention (window, key, query) before they are divided by their sum, and by columns of queries what they make of ``v``.

    The last column of ``v`` is 1, or 0 for keys that are not there; ``bias``: (key, query); ``gate``: exp of it; ``live``:
    queries whose sum counts; ``opening``: windows whose first half is not there.
    """
    mean = np.empty((DIM + 1, len(k) * STRIDE), F32)
    a = k @ q
    np.exp(a, out=a)
    a *= gate
    if opening is not None:
        a[opening, :STRIDE] = 0
    np.matmul(v.transpose(0, 2, 1), a, out=by_window(mean, 0, DIM + 1))
    if fine(mean[DIM][live]):
        return a, mean
    a = k @ q
    a += bias
    a += np.where(v[:, :, DIM:] > 0, F32(0), F32(-1e9))
    if opening is not None:
        a[opening, :STRIDE] = -1e9
    a -= a.max(1, keepdims=True)
    np.exp(a, out=a)
    np.matmul(v.transpose(0, 2, 1), a, out=by_window(mean, 0, DIM + 1))
    return a, mean


class Learner:
    """Adam on the parameters ``x``, one flat array (``p``: its parts by name); ids by ``slot_of`` and ``of``.

    Columns of ids make the arrays behind the attention, so that sums over classes run along the ids.
    """

    def __init__(self, slot_of: np.ndarray, of: np.ndarray, p: dict[str, np.ndarray], rate: float = 0.02):
        # the last of each, found at -1, is for no id
        self.slot_of = np.append(slot_of, SLOTS).astype(np.int32)
        self.band_of, self.each_of = (np.append(k, -1).astype(np.int8) for k in (of // EACH, of % EACH))
        self.rate, self.step, self.x = rate, 0, flat(p).astype(F32)
        self.g, self.m, self.s, self.spare, self.more = (np.zeros_like(self.x) for _ in range(5))
        self.p, self.d = views(self.x), views(self.g)
        self.back = np.arange(STRIDE, 2 * STRIDE)[None, :] - np.arange(2 * STRIDE)[:, None]  # (key, query)
        self.kinds = np.arange(max(BANDS, EACH), dtype=np.int8)[:, None]
        self.past, self.past_at = self.back >= 0, np.flatnonzero(self.back >= 0)
        self.slot = np.ones((SLOTS + 1, DIM + 1), F32)  # with a column of ones, which sums the weights of attention
        self.slot[SLOTS] = 0
        self.qkv = np.zeros((DIM + 1, 3 * DIM + 1), F32)
        self.qkv[DIM, 3 * DIM] = 1
        self.by_place = np.zeros(STRIDE * 2 * STRIDE, F32)  # (key, query)
        self.place = np.arange((SLOTS + 1) * DIM).reshape(-1, DIM)

    def learn(self, w: np.ndarray) -> None:
        """A step on (n, 2 * stride + 1) ids (-1: none): the second half is predicted, from all before it in the window.

        A window whose first half is the second of the one before it shares its row with that, and one whose first half
        is not there needs none.  The gradient is added
        up over a few rows at a time, whose arrays stay in a core's cache.
        """
        live = np.count_nonzero(w[:, STRIDE + 1 :] >= 0)
        if not live:
            return
        alone = np.ones(len(w), bool)
        blank = (w[:, :STRIDE] < 0).all(1)
        alone[1:] = (w[1:, :STRIDE] != w[:-1, STRIDE:-1]).any(1) & ~blank[1:]
        at = np.arange(len(w)) + np.cumsum(alone)
        x, y = np.full((at[-1] + 1, STRIDE), -1, np.int32), np.full((at[-1] + 1, STRIDE), -1, np.int32)
        x[at[alone] - 1], x[at], y[at] = w[alone, :STRIDE], w[:, STRIDE:-1], w[:, STRIDE + 1 :]
        opening = np.zeros(len(x), bool)
        opening[at[blank]] = True
        x = np.take(self.slot_of, x, mode="wrap")
        p, g = self.p, self.d
        self.g[:], self.by_place[:] = 0, 0
        self.slot[:SLOTS, :DIM] = p["slot"]
        self.qkv[:DIM, : 3 * DIM] = p["qkv"]
        self.qkv[:DIM, :DIM] *= F32(DIM**-0.5)
        self.bias = np.where(self.past, np.take(p["near"], self.back, mode="clip"), F32(-1e9))
        self.gate = np.exp(self.bias)
        self.back_kv = np.ascontiguousarray(self.qkv[:DIM, DIM:-1].T)
        self.wide = np.concatenate([p["band"], p["w3"]])
        de = np.zeros((len(x), STRIDE, DIM), F32)
        few = -(-(len(x) - 1) // -(-(len(x) - 1) // FEW))  # parts of one size
        with np.errstate(over="ignore", invalid="ignore"):  # what overflows is made again
            for a in range(1, len(x), few):
                self._add(x[a - 1 : a + few], y[a : a + few], de[a - 1 : a + few], np.flatnonzero(opening[a : a + few]))
        g["near"] += np.bincount(self.back.ravel()[self.past_at], self.by_place[self.past_at], 2 * STRIDE)
        by_slot = np.zeros(self.place.size, F32)
        np.add.at(by_slot, np.take(self.place, x.ravel(), axis=0).ravel(), de.ravel())
        g["slot"] += by_slot.reshape(-1, DIM)[:SLOTS]
        g["qkv"][:, :DIM] *= F32(DIM**-0.5)
        self.g *= F32(1 / live)
        self._step()

    def _step(self) -> None:
        self.step += 1
        u, v = self.spare, self.more
        np.subtract(self.g, self.m, out=u)
        u *= F32(0.1)
        self.m += u
        np.multiply(self.g, self.g, out=u)
        u -= self.s
        u *= F32(0.01)
        self.s += u
        np.multiply(self.s, F32(1 / (1 - 0.99**self.step)), out=u)
        np.sqrt(u, out=u)
        u += F32(1e-8)
        np.divide(self.m, u, out=v)
        v *= F32(self.rate / (1 - 0.9**self.step))
        self.x -= v

    def _head(self, h: np.ndarray, out: str, hot: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Gradient of ``h`` (with its row of ones) of the loss of predicting ``hot`` (1 for each column's class); that of the weights is added up."""
        o, total, _ = exp_columns(self.p[out].T, h)
        o *= live / total
        o -= hot
        self.d[out] += h @ o.T
        return self.p[out][:-1] @ o

    def _add(self, x: np.ndarray, y: np.ndarray, de: np.ndarray, opening: np.ndarray) -> None:
        """x: (rows + 1, stride) slots, y: (rows, stride) ids that follow those of all rows but the first; the gradient by
        place is added to ``de``; ``opening``: rows that do not see the row before them."""
        p, g = self.p, self.d
        y = y.ravel()
        live = (y >= 0).astype(F32)
        if not live.any():
            return
        n, rows = len(y), len(x) - 1
        e = np.take(self.slot, x.ravel(), axis=0)
        z = (e @ self.qkv).reshape(rows + 1, STRIDE, -1)
        own = np.empty((2 * DIM, n), F32)  # columns of embeddings, then of queries
        own[:DIM] = e[STRIDE:, :DIM].T
        np.matmul(self.qkv[:DIM, :DIM].T, own[:DIM], out=own[DIM:])
        q, k, v = z[1:, :, :DIM], pairs(z, DIM, DIM), pairs(z, 2 * DIM, DIM + 1)
        a, mean = attend(k, by_window(own, DIM, DIM), v, self.bias, self.gate, x[1:].ravel() != SLOTS, opening)
        over = F32(1) / np.maximum(mean[DIM], LEAST)  # (0 where there is no id)
        mean = mean[:DIM]
        mean *= over
        h = mean + own[:DIM]
        z1 = p["w1"].T @ h
        t = np.maximum(z1, 0)
        b = np.empty((BANDS + HIDDEN + 1, n), F32)  # the band, the state, ones
        kinds = self.kinds
        b[:BANDS] = np.take(self.band_of, y, mode="wrap") == kinds[:BANDS]
        np.matmul(p["w2"].T, t, out=b[BANDS:-1])
        b[BANDS:-1] += h
        b[-1] = 1
        d2 = self._head(b[BANDS:], "out", b[:BANDS], live)
        z3 = self.wide.T @ b[:-1]
        t3 = np.ones((HIDDEN + 1, n), F32)
        np.maximum(z3, 0, out=t3[:-1])
        d3 = self._head(t3, "each", (np.take(self.each_of, y, mode="wrap") == kinds[:EACH]).astype(F32), live)
        d3 *= z3 > 0
        wide = b[:-1] @ d3.T
        g["band"] += wide[:BANDS]
        g["w3"] += wide[BANDS:]
        d2 += p["w3"] @ d3
        g["w2"] += t @ d2.T
        dz = p["w2"] @ d2
        dz *= z1 > 0
        g["w1"] += h @ dz.T
        d2 += p["w1"] @ dz
        dm = np.empty((DIM + 1, n), F32)
        np.multiply(d2, over, out=dm[:DIM])
        np.negative(np.ones(DIM, F32) @ (dm[:DIM] * mean), out=dm[DIM])
        da = v @ by_window(dm, 0, DIM + 1)
        da *= a
        self.by_place += np.ones(rows, F32) @ da.reshape(rows, -1)
        kv = np.empty((rows, 2 * STRIDE, 2 * DIM), F32)
        np.matmul(da, q, out=kv[:, :, :DIM])
        np.matmul(a, np.ascontiguousarray(dm[:DIM].T).reshape(rows, STRIDE, DIM), out=kv[:, :, DIM:])
        both = np.empty((rows + 1, STRIDE, 2 * DIM), F32)  # a row's keys and values meet its own queries and the next row's
        both[0], both[-1] = kv[0, :STRIDE], kv[-1, STRIDE:]
        np.add(kv[:-1, STRIDE:], kv[1:, :STRIDE], out=both[1:-1])
        both = both.reshape(-1, 2 * DIM)
        dq = np.empty((DIM, n), F32)
        np.matmul(k.transpose(0, 2, 1), da, out=by_window(dq, 0, DIM))
        g["qkv"][:, :DIM] += (dq @ e[STRIDE:, :DIM]).T
        g["qkv"][:, DIM:] += e[:, :DIM].T @ both
        de += (both @ self.back_kv).reshape(de.shape)
        d2 += self.qkv[:DIM, :DIM] @ dq
        de[1:].reshape(n, DIM)[:] += d2.T


def train(windows: np.ndarray, counts: np.ndarray, p: dict[str, np.ndarray], batch: int = 64, rate: float = 0.01, passes: int = 20) -> dict[str, np.ndarray]:
    """Parameters that one learner gets from windows in memory, in so many passes however many windows there are."""
    learner, r = Learner(shared(counts, SLOTS), classes_of(counts)[0], p, rate), np.random.default_rng(1)
    for _ in range(passes):
        order = r.permutation(len(windows))
        for at in range(0, len(order), batch):
            learner.learn(windows[order[at : at + batch]])
    return learner.p


def windows_of(ids: np.ndarray, offs: np.ndarray, which: np.ndarray | None = None) -> np.ndarray:
    """(n, 2 * stride + 1): every stride-aligned window (or ``which``, by number) of documents of ids (offs: offsets; each has an id); -1: none.

    The ids at stride * k + 1 and on, BEGIN first, are the second half of a document's window k; each is there once.
    """
    size = np.diff(offs)
    rows = -(-size // STRIDE)
    start = np.cumsum(rows + 2) - rows - 2  # rows of ids: none, BEGIN and the document's, at least one more
    laid = np.full((int((rows + 2).sum()) + 1) * STRIDE, -1, np.int32)
    laid[np.repeat(start * STRIDE + STRIDE + 1 - offs[:-1], size) + np.arange(len(ids))] = ids
    laid[start * STRIDE + STRIDE] = BEGIN
    at = np.arange(int(rows.sum())) + np.repeat(2 * np.arange(len(rows)), rows)
    windows = np.ndarray((max(0, len(laid) // STRIDE - 2), 2 * STRIDE + 1), np.int32, laid, 0, (4 * STRIDE, 4))
    return windows[at if which is None else at[which]]


class Scorer:
    """Scores documents of ids; keys and values are a small table by slot, which stays in a core's cache."""

    def __init__(self, p: dict[str, np.ndarray], counts: np.ndarray):
        self.p, (of, self.within) = p, classes_of(counts)
        # the last of each, found at -1, is for no id
        self.band_of, self.each_of = (np.append(k, 0).astype(np.int32) for k in (of // EACH, of % EACH))
        self.within = np.append(self.within, 0)
        self.slot_of, e = shared(counts, SLOTS).astype(np.int32), p["slot"]
        _, k, v = np.split(e @ p["qkv"], 3, axis=1)
        self.table = np.concatenate([k, v, np.ones((SLOTS, 1), F32)], axis=1)  # the ones sum the weights
        self.slot, self.q = e, p["qkv"][:, :DIM].T * F32(DIM**-0.5)
        self.bias = np.ascontiguousarray(gap_bias(p["near"]).T)
        self.gate = np.exp(self.bias)

    @staticmethod
    def _head(h: np.ndarray, out: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit of each column's class over the largest taken off, if any, and the sum of the exps that belong to it."""
        _, total, hit = exp_columns(out.T, h, y * h.shape[1] + np.arange(h.shape[1], dtype=y.dtype))
        return hit.astype(np.float64), total.astype(np.float64)

    def log10(self, ids: np.ndarray, offs: np.ndarray, batch: int = FEW) -> np.ndarray:
        """log10 probability of each document's ids (offs: offsets); the first is predicted from BEGIN alone."""
        with np.errstate(over="ignore", invalid="ignore"):  # what overflows is made again
            return self._log10(ids, offs, batch)

    def _log10(self, ids: np.ndarray, offs: np.ndarray, batch: int) -> np.ndarray:
        size = np.diff(offs)
        rows = -(-size // STRIDE)
        first_row = np.cumsum(rows) - rows
        n = int(rows.sum())
        x, y = np.zeros((n + 1, STRIDE), np.int32), np.full((n + 1, STRIDE), -1, np.int32)  # row 0 is no document's
        cell = np.repeat((first_row + 1) * STRIDE - offs[:-1], size) + np.arange(len(ids))
        y.ravel()[cell] = ids
        begin = np.empty(len(ids), np.int32)
        begin[1:] = ids[:-1]
        begin[offs[:-1][size > 0]] = BEGIN
        x.ravel()[cell] = np.take(self.slot_of, begin)
        opening = np.zeros(n + 1, bool)
        opening[first_row[rows > 0] + 1] = True
        total = np.zeros(n)
        p = self.p
        wide = np.concatenate([p["band"], p["w3"]])
        kinds = np.arange(BANDS, dtype=np.int32)[:, None]
        for a in range(1, n + 1, batch):
            b = min(n + 1, a + batch)
            target = y[a:b].ravel()
            # a window is two rows of ids that follow each other in memory: windows overlap without copies
            z = np.take(self.table, x[a - 1 : b], axis=0)
            own = np.empty((2 * DIM, len(target)), F32)  # columns of embeddings, then of queries
            own[:DIM] = np.take(self.slot, x[a:b].ravel(), axis=0).T
            np.matmul(self.q, own[:DIM], out=own[DIM:])
            _, mean = attend(pairs(z, 0, DIM), by_window(own, DIM, DIM), pairs(z, DIM, DIM + 1), self.bias, self.gate, target >= 0, np.flatnonzero(opening[a:b]))
            h = mean[:DIM]
            h /= np.maximum(mean[DIM], LEAST)
            h += own[:DIM]
            t = p["w1"].T @ h
            np.maximum(t, 0, out=t)
            state = np.empty((BANDS + HIDDEN + 1, len(target)), F32)  # the band, the state, ones
            band = np.take(self.band_of, target, mode="wrap")
            state[:BANDS] = band == kinds
            np.matmul(p["w2"].T, t, out=state[BANDS:-1])
            state[BANDS:-1] += h
            state[-1] = 1
            t = np.ones((HIDDEN + 1, len(target)), F32)
            np.maximum(wide.T @ state[:-1], 0, out=t[:-1])
            (hit, s), (hit2, s2) = self._head(state[BANDS:], p["out"], band), self._head(t, p["each"], np.take(self.each_of, target, mode="wrap"))
            s *= s2
            hit += hit2
            hit -= np.log(s)
            hit += np.take(self.within, target, mode="wrap")
            hit *= target >= 0
            total[a - 1 : b - 1] = hit.reshape(-1, STRIDE).sum(1)
        out = np.zeros(len(size))
        full = rows > 0
        if full.any():
            out[full] = np.add.reduceat(total, first_row[full])
        return out / np.log(10)


# ------------------------------------------------------------ over the corpus

PACKED = pa.schema([("kind", pa.string()), ("chunk", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("at", pa.int32()), ("body", pa.binary())])


def _arrays(*xs: np.ndarray) -> bytes:
    head = np.array([len(xs), *(x.nbytes for x in xs)], np.int64)
    return zstandard.ZstdCompressor(1).compress(b"".join([head.tobytes(), *(np.ascontiguousarray(x).tobytes() for x in xs)]))


def _from_arrays(body: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    at, out = 8 * (n + 1), []
    for size, kind in zip(np.frombuffer(raw, np.int64, n, 8).tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw[at : at + size], kind))
        at += size
    return out


def spread(values: np.ndarray, offs: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the ragged rows ``which`` of ``values``, and each row's length."""
    first = offs[which]
    k = offs[which + 1] - first
    return values[np.repeat(first - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))], k


def grouped(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, a place of each, and for each place the number of its value; the sort need not be stable."""
    order = np.argsort(h)
    in_order = h[order]
    new = np.ones(len(h), bool)
    new[1:] = in_order[1:] != in_order[:-1]
    which = np.empty(len(h), np.uint32)
    which[order] = np.cumsum(new) - 1
    return in_order[new], order[new], which


def _pack(model, chunk: int, ranges: int = RANGES):
    """model: broadcast bytes of the vocabulary; ranges: a power of two.  (id, text, train) -> rows of PACKED.

    'chunk': documents; 'word': h, a range of hashes, n, how many of its words the chunk has, and their hashes in order
    with their counts in training; 'id': h, an id of the vocabulary, and n, its count in training.
    """

    def run(batches):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        table, part, made = spaces_table(), TaskContext.get().partitionId(), 0
        seqs, sizes, ids, nulls, trains, hashes, words = [], [], [], [], [], [], []
        held = known = 0

        def flush():
            per_doc, train = np.concatenate(sizes), np.concatenate(trains)
            distinct, where, number = grouped(np.concatenate(hashes))
            order = np.empty(len(where), np.uint32)  # a word's number: as the places lie
            order[np.argsort(where)] = np.arange(len(where))
            number = order[number]
            lengths, subs, a = [np.zeros(0, np.int64)], [np.zeros(0, np.uint16)], 0
            for h in hashes:
                low, start, end = words.pop(0)
                new = np.sort(where[(where >= a) & (where < a + len(h))]) - a
                a += len(h)
                for some in np.split(new, range(20_000, len(new), 20_000)):
                    pieces = sp.encode([low[i:j] for i, j in zip(start[some].tolist(), end[some].tolist(), strict=True)], num_threads=1)
                    lengths.append(np.fromiter(map(len, pieces), np.int64, len(pieces)))
                    subs.append(np.fromiter(chain.from_iterable(pieces), np.uint16, int(lengths[-1].sum())))
            hashes.clear()
            count = np.zeros(len(distinct), np.int64)
            for i, (x, k, learned) in enumerate(zip(seqs, sizes, trains, strict=True)):
                seqs[i] = x = number[x]
                count += np.bincount(x[np.repeat(learned, k)], minlength=len(distinct))
            seq = np.concatenate(seqs)
            seqs.clear()
            length, sub = np.concatenate(lengths), np.concatenate(subs)
            body = _arrays(np.concatenate(ids), np.concatenate(nulls), per_doc, seq, length.astype(np.uint32), sub, train, order)
            yield rows("chunk", [0], [0], [body])
            edge = np.searchsorted(distinct >> U64(64 - ranges.bit_length() + 1), np.arange(ranges + 1))
            had = np.flatnonzero(np.diff(edge))
            by_hash = count[order]
            yield rows("word", had, np.diff(edge)[had], [_arrays(distinct[edge[i] : edge[i + 1]], by_hash[edge[i] : edge[i + 1]]) for i in had.tolist()])
            many, edge = np.zeros(VOCAB), np.concatenate([[0], np.cumsum(length)])
            for a in range(0, len(length), 100_000):
                b = min(len(length), a + 100_000)
                many += np.bincount(sub[edge[a] : edge[b]], np.repeat(count[a:b], length[a:b]), VOCAB)
            many = many.astype(np.int64)
            many[END] += int(train.sum())
            at = np.flatnonzero(many)
            yield rows("id", at, many[at])

        def rows(kind, h, n, body=None):
            k = len(h)
            return pa.RecordBatch.from_arrays([pa.array([kind] * k), pa.array(np.full(k, part << 32 | made)), pa.array(np.asarray(h, np.int64)), pa.array(np.asarray(n, np.int64)), pa.array(np.arange(k, dtype=np.int32)), pa.array(body if body is not None else [None] * k, pa.binary())], schema=PACKED)

        for batch in batches:
            for some, data, offs in blocks(batch, "text", 1_000_000):
                w = Words(data, offs, table)
                h = w.hashes()
                h[h == EDGE] = U64(1)
                u, where, which = grouped(h)
                hashes.append(u)
                seqs.append(which + np.uint32(known))
                known += len(u)
                words.append((w.low.tobytes().replace(b"\xff", b"\0"), w.start[where].astype(np.uint32), w.end[where].astype(np.uint32)))
                sizes.append(np.diff(w.per_row))
                id_ = some.column(some.schema.get_field_index("id"))
                ids.append(np.asarray(id_.fill_null(0)).astype(np.int64))
                nulls.append(np.asarray(id_.is_null().to_numpy(zero_copy_only=False)))
                trains.append(some.column(some.schema.get_field_index("train")).to_numpy(zero_copy_only=False))
                held += len(data)
                if held >= chunk:
                    yield from flush()
                    made += 1
                    seqs, sizes, ids, nulls, trains, hashes, words, held, known = [], [], [], [], [], [], [], 0, 0
        if sizes:
            yield from flush()

    return run


def _read(body: bytes):
    """Arrays of a chunk: ids, nulls, words of each document, words by number, pieces of each number, pieces, train, numbers by hash."""
    return _from_arrays(body, np.int64, np.bool_, np.int64, np.uint32, np.uint32, np.uint16, np.bool_, np.uint32)


def _runs(per_doc: np.ndarray, seq: np.ndarray, length: np.ndarray, sub: np.ndarray):
    """(from, to, words by number, ids with the ends, their offsets) of runs of documents of some 300,000 words."""
    edge = np.concatenate([[0], np.cumsum(per_doc)])
    first = np.concatenate([[0], np.cumsum(length.astype(np.int64))])
    # the end is one more word, of one piece
    first, sub = np.append(first, len(sub) + 1), np.append(sub, np.uint16(END)).astype(np.int32)
    at = 0
    while at < len(per_doc):
        to = max(at + 1, int(np.searchsorted(edge, edge[at] + 300_000, "right")) - 1)
        mine = seq[edge[at] : edge[to]]
        stops = np.cumsum(per_doc[at:to] + 1)
        words = np.full(int(stops[-1]), len(length), np.int64)
        is_word = np.ones(len(words), bool)
        is_word[stops - 1] = False
        words[is_word] = mine
        full, k = spread(sub, first, words)
        yield at, to, mine, full, np.concatenate([[0], np.cumsum(k)[stops - 1]])
        at = to


SUMS = pa.schema([("task", pa.int32()), ("n", pa.int64()), ("p", pa.binary())])


def _trainer(model, share: int, batch: int, part: int = 0, parts: int = 1):
    """(body) -> a row of SUMS: windows learned from, and the trainers' parameters times their windows, summed.

    Part ``part`` of ``parts`` of the windows, dealt by turns within each run of documents: rows of ``ROW`` windows that follow each other.

    A trainer takes runs of documents until it has had ``share`` windows; the next begins from the start again.
    """

    def run(batches):
        keep_heap()
        counts, x = model.value
        slots, of, p, r = shared(counts, SLOTS), classes_of(counts)[0], shaped(x), np.random.default_rng(1)
        total, done, learner, n = np.zeros(len(x)), 0, Learner(slots, of, p), 0
        for some in batches:
            for body in some.column(0):
                _, _, per_doc, seq, length, sub, train, _ = _read(body.as_py())
                for _, _, _, ids, offs in _runs(per_doc[train], seq[np.repeat(train, per_doc)], length, sub):
                    n_windows = int((-(-np.diff(offs) // STRIDE)).sum())
                    row = r.permutation(np.arange(part, -(-n_windows // ROW), parts))
                    which = (row[:, None] * ROW + np.arange(ROW)).ravel()
                    w = windows_of(ids, offs, which[which < n_windows])
                    for a in range(0, len(w), batch):
                        learner.learn(some_of := w[a : a + batch])
                        n += len(some_of)
                        if n >= share:
                            total, done, learner, n = total + n * learner.x.astype(np.float64), done + n, Learner(slots, of, p), 0
        total, done = total + n * learner.x.astype(np.float64), done + n
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([done]), pa.array([total.tobytes()], pa.binary())], schema=SUMS)

    return run


def _sum(batches):
    total, done = 0.0, 0
    for some in batches:
        for n, p in zip(some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True):
            total, done = total + np.frombuffer(p), done + n
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([done]), pa.array([total.tobytes()], pa.binary())], schema=SUMS)


def fit(packed: DataFrame, share: int = SHARE, batch: int = BATCH, parts: int = PARTS) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Counts of ids, and the parameters after one pass: trainers of ``share`` windows each, averaged after each of ``parts``."""
    spark = packed.sparkSession
    counts = np.zeros(VOCAB, np.int64)
    for r in packed.filter("kind = 'id'").groupBy("h").agg(F.sum("n").alias("n")).collect():  # the vocabulary at most
        counts[r["h"]] = r["n"]
    # small chunks are brought together until they make a share; nothing is shuffled
    chunks = packed.filter("kind = 'chunk'").select("body").coalesce(max(1, -(-int(counts.sum()) // (share * STRIDE))))
    p, sums = start(), "task int, n long, p binary"
    for part in range(parts):
        model = spark.sparkContext.broadcast((counts, flat(p)))
        made = chunks.mapInArrow(tidy(_trainer(model, share, batch, part, parts)), sums).repartition(SUMMERS, "task").sortWithinPartitions("task").mapInArrow(_sum, sums).collect()
        if made:
            made = sorted(made, key=lambda r: bytes(r["p"]))
            p = shaped(sum(np.frombuffer(r["p"]) for r in made) / sum(r["n"] for r in made))
    return counts, p


COUNTED = pa.schema([("chunk", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("v", pa.int64()), ("body", pa.binary())])


def _count(batches):
    """(chunk, h, body) by h -> rows of COUNTED: for each chunk the counts of its words in all chunks; with one of a range's rows their sum and how many are not 0."""

    def counted():
        parts = [_from_arrays(x, U64, np.int64) for x in bodies]
        _, which = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
        c = np.bincount(which, np.concatenate([n for _, n in parts])).astype(np.int64)
        each = np.split(c[which], np.cumsum([len(h) for h, _ in parts])[:-1])
        first = np.arange(len(parts)) == 0
        return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array([now] * len(parts), pa.int64()), pa.array(first * c.sum()), pa.array(first * np.count_nonzero(c)), pa.array([_arrays(x) for x in each], pa.binary())], schema=COUNTED)

    now, chunks, bodies = None, [], []
    for batch in batches:
        for chunk, h, body in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if h != now and bodies:
                yield counted()
                chunks, bodies = [], []
            now = h
            chunks.append(chunk)
            bodies.append(body)
    if bodies:
        yield counted()


SCORED = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _score(model, total: int, distinct: int, ends: int):
    """(chunk, body, counts: array of (h, body): a range of hashes, the counts in training of the chunk's words there) -> SCORED."""

    def run(batches):
        keep_heap()
        counts, p = model.value
        scorer = Scorer(p, counts)
        norm = np.log10(total + 0.1 * (distinct + 1))
        for batch in batches:
            for r in range(batch.num_rows):
                ids, nulls, per_doc, seq, length, sub, _, order = _read(batch.column("body")[r].as_py())
                c = np.zeros(len(length))
                got = batch.column("counts")[r].as_py() or []
                at = 0
                for x in sorted(got, key=lambda x: x["h"]):
                    (some,) = _from_arrays(x["body"], np.int64)
                    c[order[at : at + len(some)]] = some
                    at += len(some)
                value, known = np.log10(c + 0.1), (c > 0).astype(np.int64)
                for at, to, mine, full, offs in _runs(per_doc, seq, length, sub):
                    doc = np.repeat(np.arange(to - at), per_doc[at:to])
                    score = scorer.log10(full, offs)
                    n = per_doc[at:to] + 1
                    base = np.bincount(doc, value[mine], to - at) + np.log10(ends + 0.1) - n * norm
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at:to], mask=nulls[at:to]), pa.array(n), pa.array(np.bincount(doc, known[mine], to - at).astype(np.int64) + (ends > 0)), pa.array(base), pa.array(score)], schema=SCORED)

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, model: str = MODEL, chunk: int = CHUNK, share: int = SHARE) -> DataFrame:
    """A row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), (~held_out(id_col, folds)).alias("train"))
    ranges = max(RANGES, 1 << (2 * source.rdd.getNumPartitions() - 1).bit_length())
    packed = written(source.mapInArrow(tidy(_pack(spark.sparkContext.broadcast(Path(model).read_bytes()), chunk, ranges)), "kind string, chunk long, h long, n long, at int, body binary"), "packed")
    words = packed.filter("kind = 'word'").select("chunk", "h", "body").repartition(ranges, "h").sortWithinPartitions("h")
    counted = written(words.mapInArrow(tidy(_count), "chunk long, h long, n long, v long, body binary"), "counts")
    n, v = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    ends = source.filter("train").count()
    back = counted.groupBy("chunk").agg(F.collect_list(F.struct("h", "body")).alias("counts"))
    n, v = n + ends, v + (ends > 0)
    trained = spark.sparkContext.broadcast(fit(packed, share))
    chunks = packed.filter("kind = 'chunk'").select("chunk", "body").join(back, "chunk", "left").select("chunk", "body", "counts")
    out = chunks.mapInArrow(tidy(_score(trained, n, v, ends)), "id long, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("id").alias(id_col), held_out("id", folds).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
