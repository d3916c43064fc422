"""9. Language-model scores by causal self-attention, trained in numpy on subword ids.

The model has two parts, mixed word by word with weight ``MIX``:

* a one-layer causal self-attention model over subword ids. From the current id and the
  attended context it gives the class of the next id (``CLASSES`` classes, clustered by
  the ids' neighbours) and from the class the id. It is trained with Adam on all training
  documents: in each of ``EPOCHS`` rounds every block of documents starts from the same
  parameters and takes its own steps, and Spark averages the blocks' results (an id's
  vector by how often the block has the id, the rest by the block's targets), so that the
  driver holds only tables of the vocabulary's size;
* the share of the word in all training documents. These counts grow with the corpus: each
  block of documents sends its distinct words with their counts to hash shards, which sum
  them and send the sums back to the block (see ``blocks``).

Texts are scored in overlapping windows: each window holds ``LAP`` ids of context and
``STRIDE`` ids to score, so every id is scored exactly once; windows are batched and masked.
A word's probability is the product of its ids'; the end of the text is a word of its own.

Defined results: null and empty texts are the end alone; rows of null doc_id are not held
out; without training rows the counts are 0, the attention part is uniform over ids, and
base_score is 0 for every token (log10 of 1/1); ids unseen in training share one class;
every row is scored by itself, so repeated rows keep (and count as) their rows; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.session import shared_path

from . import blocks, langid, subword, textvec as tv

CLASSES, WIDTH, LAP, STRIDE, MIX = 128, 16, 8, 24, 0.6
EPOCHS, BATCH, RATE = 1, 64, 0.02
AT_ONCE = 64
RUN = 96
PLACES = np.arange(-LAP, STRIDE)
END_WORD = np.uint64(0x5EED5EED5EED5EED)
SPAN, SLICE = 1 << 20, 1 << 18
COMMON, PART, LOTS = 256, 512, 64


# --- the attention model -----------------------------------------------------------------

def _windows(ids: np.ndarray, first: np.ndarray, end: int):
    """Inputs and targets of all texts, as windows: input positions (n, LAP + STRIDE), -1 before
    a text; target positions (n, STRIDE), -1 beyond it; and the flat inputs and targets."""
    n = np.diff(first) + 1  # each text is led by ``end`` and closed by it
    at = np.r_[0, np.cumsum(n)]
    i4 = np.int32 if at[-1] < 1 << 31 else np.int64
    inputs, targets = np.full(at[-1], end, np.int32), np.full(at[-1], end, np.int32)
    own = np.ones(at[-1], bool)
    own[at[:-1]] = False
    inputs[own] = ids
    own[:] = True
    own[at[1:] - 1] = False
    targets[own] = ids
    k = -(-n // STRIDE)
    text = np.repeat(np.arange(len(n)), k)
    nth = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
    where = (nth * STRIDE - LAP).astype(i4)[:, None] + np.arange(LAP + STRIDE, dtype=i4)[None, :]
    out = (where < 0) | (where >= n[text].astype(i4)[:, None])
    where += at[:-1][text].astype(i4)[:, None]
    where[out] = -1
    return where, inputs, targets, at


def _joined(ids: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each led by ``end`` and one more ``end`` behind the last: what follows a place
    is its target. And the texts' places (n+1)."""
    at = np.r_[0, np.cumsum(np.diff(first) + 1)]
    out = np.full(at[-1] + 1, end, ids.dtype)
    own = np.ones(at[-1] + 1, bool)
    own[at] = False
    out[own] = ids
    return out, at


def _spread(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window: its first scored place, where its text ends, and whether it is its text's first."""
    n = np.diff(at)
    k = -(-n // STRIDE)
    nth = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
    return np.repeat(at[:-1], k) + nth * STRIDE, np.repeat(at[1:], k), nth == 0


def _inputs(flat: np.ndarray, start: np.ndarray, stop: np.ndarray, lead: np.ndarray, end: int):
    """Ids of some windows, ``end`` where a window leaves its text; their scored places and which of these are
    the text's; and the windows that lead a text."""
    place = start[:, None] + PLACES
    x = np.take(flat, place, mode="clip")
    place, ok = place[:, LAP:], np.ones((len(x), STRIDE), bool)
    short = np.flatnonzero(start + STRIDE > stop)
    ok[short] = place[short] < stop[short][:, None]
    x[short, LAP:] = np.where(ok[short], x[short, LAP:], x.dtype.type(end))
    lead = np.flatnonzero(lead)
    x[lead, :LAP] = end
    return x, place.ravel(), ok.ravel(), lead


def _relative() -> np.ndarray:
    """Distance from each scored place back to each place of the window; negative: not yet seen."""
    return np.arange(STRIDE)[:, None] + LAP - np.arange(LAP + STRIDE)[None, :]


def _exp(x: np.ndarray, some: np.ndarray) -> np.ndarray:
    """exp of scores, in place; less each row's greatest only where float32 needs that, since ``some`` (one
    score of every row) and the greatest of all mostly show that no row can overflow or vanish."""
    if x.max() > 60 or some.min() < -60:
        x -= x.max(-1, keepdims=True)
    return np.exp(x, out=x)


def _itself(s: np.ndarray) -> np.ndarray:
    """The score of every scored place for itself."""
    return np.diagonal(s, LAP, 1, 2)


class Model:
    """Tables for scoring: everything that depends on one id alone is looked up."""

    def __init__(self, p: dict):
        self.p = p
        e = p["e"]
        one = np.ones((len(e), 1), e.dtype)
        self.q = e @ p["wq"]
        # a last column of ones: what is attended to comes with the sum of its weights
        self.kv = np.concatenate((e @ p["wk"], e @ p["wv"], one), axis=1)
        # an id's vector, room for what it attends to, and 1 for the bias: classes are one product away
        self.e = np.concatenate((e, np.zeros_like(e), one), axis=1)
        self.top = np.concatenate((p["wr"], p["o"], p["b"][None]))
        d = _relative()
        self.bias = np.where(d >= 0, p["rel"][np.maximum(d, 0)], -1e4).astype(np.float32)

    def logp(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probability of every target (each text's ids, then its end), and their places (n+1)."""
        p = self.p
        full, end = self.top.shape[1], p["compact"][p["end"]]
        text, at = _joined(ids.astype(np.int32), first, p["end"])
        x_all, cls, inner = p["compact"][text], p["cls"][text], p["inner"][text[1:]]
        starts, stops, leads = _spread(at)
        out = np.empty(at[-1])
        one, row, f4 = np.ones(full, self.top.dtype), np.arange(AT_ONCE * STRIDE) * full, self.top.dtype
        most = min(AT_ONCE, len(starts))
        # arrays are written again and again: fresh ones cost page faults
        kvs, qs, es = np.empty((most, LAP + STRIDE, 2 * WIDTH + 1), f4), np.empty((most, STRIDE, WIDTH), f4), np.empty((most, STRIDE, 2 * WIDTH + 1), f4)
        scores, sums, every = np.empty((most, STRIDE, LAP + STRIDE), f4), np.empty((most, STRIDE, WIDTH + 1), f4), np.empty((most * STRIDE, full), f4)
        for lo in range(0, len(starts), AT_ONCE):
            own = slice(lo, lo + AT_ONCE)
            x, t, ok, lead = _inputs(x_all, starts[own], stops[own], leads[own], end)
            n = len(x)
            q = x[:, LAP:]
            kv = np.take(self.kv, x, axis=0, out=kvs[:n], mode="clip")
            a = np.matmul(np.take(self.q, q, axis=0, out=qs[:n], mode="clip"), kv[:, :, :WIDTH].swapaxes(1, 2), out=scores[:n])
            a += self.bias
            a[lead, :, :LAP] = -1e4
            z = np.matmul(_exp(a, _itself(a)), kv[:, :, WIDTH:], out=sums[:n])
            h = np.take(self.e, q, axis=0, out=es[:n], mode="clip")
            np.divide(z[:, :, :WIDTH], z[:, :, WIDTH:], out=h[:, :, WIDTH:2 * WIDTH])
            logits = np.matmul(h.reshape(len(t), -1), self.top, out=every[:len(t)])
            pick = logits.ravel()[np.take(cls, t + 1, mode="clip") + row[:len(t)]]
            if logits.max() > 60 or pick.min() < -60:
                top = logits.max(1)
                logits -= top[:, None]
                pick -= top
            got = pick - np.log(np.exp(logits, out=logits) @ one)
            out[t[ok]] = got[ok]
        out += inner
        return out, at


def _cluster(ids: np.ndarray, first: np.ndarray, n: int, end: int, classes: int) -> np.ndarray:
    """A class for each of n compact ids, by k-means over what stands before and after them."""
    _, inputs, targets, _ = _windows(ids, first, end)
    size = np.bincount(targets, minlength=n).astype(float)
    cells = _cells(inputs, targets, _columns(size))
    m = np.bincount(cells, minlength=n * 2 * COMMON).reshape(n, 2, COMMON).astype(float)
    return _kmeans(m, size, classes)


def _columns(size: np.ndarray) -> np.ndarray:
    """The column of each of the most frequent ids; -1 for the others."""
    top = np.argsort(-size, kind="stable")[:COMMON]
    col = np.full(len(size), -1)
    col[top] = np.arange(len(top))
    return col


def _cells(inputs: np.ndarray, targets: np.ndarray, col: np.ndarray) -> np.ndarray:
    """(id, side, column) of every neighbour that has a column, as one number."""
    out, kind = [], np.int32 if 2 * COMMON * len(col) < 1 << 31 else np.int64
    for side, (a, b) in enumerate(((targets, inputs), (inputs, targets))):
        ok = col[b] >= 0
        out.append((a[ok].astype(kind) * 2 + side) * COMMON + col[b[ok]].astype(kind))
    return np.concatenate(out)


def _neighbours(ids: np.ndarray, first: np.ndarray, compact: np.ndarray, end: int, col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct cells and how often each occurs; some texts at a time, so that work arrays don't grow with the block."""
    sums = None
    for lo, hi in tv.spans(first, SLICE):
        text, _ = _joined(compact[ids[first[lo]:first[hi]]], first[lo:hi + 1] - first[lo], end)
        sums = _merged(sums, np.unique(_cells(text[:-1], text[1:], col), return_counts=True))
    return sums or (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _merged(a: tuple[np.ndarray, np.ndarray] | None, b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct cells of both, and the sums of their counts."""
    if a is None:
        return b
    at = np.concatenate((a[0], b[0]))
    order = np.argsort(at, kind="stable")  # two sorted runs are merged
    at, n = at[order], np.concatenate((a[1], b[1]))[order]
    edge = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
    return at[edge], np.add.reduceat(n, edge) if len(at) else n


def _kmeans(m: np.ndarray, size: np.ndarray, classes: int) -> np.ndarray:
    """Classes of ids from their neighbours' counts (n, 2, COMMON)."""
    m /= np.maximum(m.sum(2, keepdims=True), 1)
    f = np.sqrt(m, out=m).reshape(len(m), -1)
    half = f * np.sqrt(size / size.sum())[:, None].astype(f.dtype)
    vt = np.linalg.eigh((half.T @ half).astype(float))[1].T[::-1]
    f = f @ vt[:24].T
    centre = f[np.argsort(-size, kind="stable")[:classes]].copy()
    for _ in range(12):
        dist = (f * f).sum(1)[:, None] - 2 * f @ centre.T + (centre * centre).sum(1)[None, :]
        c = dist.argmin(1)
        for j in range(len(centre)):
            own = c == j
            if size[own].sum():
                centre[j] = np.average(f[own], axis=0, weights=size[own] + 1e-9)
    return c


def train(texts: list[np.ndarray], vocabulary: int, end: int, epochs: int = EPOCHS, seed: int = 5) -> dict:
    """Parameters from id arrays; ids that do not occur get a class of their own."""
    rng = np.random.default_rng(seed)
    flat = np.concatenate([*texts, np.array([end])]).astype(np.int64)
    seen, ids = np.unique(flat, return_inverse=True)
    ids = ids[:-1]
    first = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    n = len(seen)
    last = int(np.searchsorted(seen, end))
    classes = min(CLASSES, n)
    cls = _cluster(ids, first, n, last, classes)
    count = np.bincount(_windows(ids, first, last)[2], minlength=n) + 0.5
    p, state = _start(count, cls, classes, rng), {}
    for k in range(epochs):
        _epoch(p, ids, first, last, cls, rng, state, k, epochs)
    return _whole(p, seen, count, cls, classes, vocabulary, end)


def _start(count: np.ndarray, cls: np.ndarray, classes: int, rng) -> dict:
    """First parameters, from the ids' counts and classes."""
    n, d, c, span = len(count), WIDTH, classes + 1, LAP + STRIDE
    f4 = np.float32
    p = {"e": rng.standard_normal((n + 1, d)).astype(f4) * f4(0.3), "rel": np.zeros(span, f4), "b": np.zeros(c, f4)}
    for k in ("wq", "wk", "wv"):
        p[k] = (rng.standard_normal((d, d)) / np.sqrt(d)).astype(f4)
    for k in ("wr", "o"):
        p[k] = (rng.standard_normal((d, c)) * 0.1).astype(f4)
    p["b"][:classes] = np.log(np.maximum(np.bincount(cls, count, minlength=classes), 0.5) / count.sum()).astype(f4)
    p["b"][classes] = np.log(1e-5)
    return p


def _across(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b for many rows of few columns, in runs of rows that BLAS leaves to one thread: a task has one core."""
    a, b = a.reshape(-1, a.shape[-1]), b.reshape(-1, b.shape[-1])
    whole = len(a) // RUN * RUN
    out = a[whole:].T @ b[whole:]
    if whole:
        pieces = np.matmul(a[:whole].reshape(-1, RUN, a.shape[1]).swapaxes(1, 2), b[:whole].reshape(-1, RUN, b.shape[1]))
        out = out + pieces.sum(0)
    return out


def _adam(value: np.ndarray, one: np.ndarray, two: np.ndarray, m: np.ndarray, rate: float, step: int, own=None) -> None:
    """One step of Adam on the rows ``own`` (all, if None), in place; other rows and their moments rest."""
    if own is None:
        a, b = one, two
    else:
        a, b = np.take(one, own, axis=0), np.take(two, own, axis=0)
    a *= np.float32(0.9)
    a += np.float32(0.1) * m
    b *= np.float32(0.99)
    b += np.float32(0.01) * m * m
    if own is not None:
        one[own], two[own] = a, b
    by = np.sqrt(b)
    by *= np.float32(1 / math.sqrt(1 - 0.99 ** step))
    by += np.float32(1e-8)
    np.divide(a, by, out=by)
    by *= np.float32(rate / (1 - 0.9 ** step))
    if own is None:
        value -= by
    else:
        value[own] = np.take(value, own, axis=0) - by


def _flat(p: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All parameters but the vectors in one array, with views of it: projections (WIDTH, 3 * WIDTH),
    what leads to the classes (2 * WIDTH + 1, classes), and distances."""
    flat = np.concatenate((np.concatenate([p[k] for k in ("wq", "wk", "wv")], axis=1).ravel(), p["wr"].ravel(), p["o"].ravel(), p["b"], p["rel"]))
    return flat, *_views(flat, len(p["rel"]))


def _views(flat: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = 3 * WIDTH * WIDTH
    return flat[:n].reshape(WIDTH, -1), flat[n:-span].reshape(2 * WIDTH + 1, -1), flat[-span:]


def _epoch(p: dict, ids: np.ndarray, first: np.ndarray, end: int, cls: np.ndarray, rng, state: dict, k: int, epochs: int) -> None:
    """The k-th pass over the texts: Adam steps on p, in place, for vectors only where a batch has their
    id. ``state`` keeps the moments between passes.

    A softmax is never divided out as a whole: its sums scale the narrow side of the products it enters."""
    f4, d, span = np.float32, WIDTH, LAP + STRIDE
    table = p["e"]
    # 16 bits are sorted by digits
    flat_ids, at = _joined(ids.astype(np.uint16 if len(table) <= 1 << 16 else np.int32, copy=False), first, end)
    starts, stops, leads = _spread(at)
    flat, w_in, top, rel = _flat(p)
    change = np.empty_like(flat)
    g_in, g_top, g_rel = _views(change, span)
    if "moment" not in state:
        state["moment"] = [np.zeros_like(x) for x in (table, table, flat, flat)]
    e_one, e_two, one, two = state["moment"]
    step = state.get("step", 0)
    dist = _relative()
    causal, back = dist >= 0, np.maximum(dist, 0)
    bias = np.empty(dist.shape, f4)
    done, steps = k * -(-len(starts) // BATCH), epochs * -(-len(starts) // BATCH)
    order, full = rng.permutation(len(starts)), top.shape[1]
    every, row = np.ones(full, f4), np.arange(BATCH * STRIDE) * full
    qkv, back_qkv = np.ones((BATCH, span, 3 * d + 1), f4), np.zeros((BATCH, span, 3 * d), f4)
    h_all, dz_all = np.ones((BATCH, STRIDE, 2 * d + 1), f4), np.empty((BATCH, STRIDE, d + 1), f4)
    # arrays are written again and again: fresh ones cost page faults
    first_all = np.ones(BATCH * span, bool)
    e_all, de_all, rest = (np.empty((BATCH * m, d), f4) for m in (span, span, span))
    a_all, ds_all, z_all = (np.empty((BATCH, STRIDE, m), f4) for m in (span, span, d + 1))
    spare, minus = np.empty((BATCH, STRIDE, d), f4), np.full(d, -1, f4)
    g_all, hs_all, dh_all = (np.empty((BATCH * STRIDE, m), f4) for m in (full, 2 * d + 1, 2 * d))
    for lo in range(0, len(order), BATCH):
        some = order[lo:lo + BATCH]
        x, t, ok, lead = _inputs(flat_ids, starts[some], stops[some], leads[some], end)
        n, x = len(x), x.ravel()
        line = np.argsort(x, kind="stable")
        own = x[line]
        new = first_all[:len(x)]
        np.not_equal(own[1:], own[:-1], out=new[1:])
        edge = np.flatnonzero(new)
        own = own[edge].astype(np.intp)
        at = np.empty(len(x), np.intp)
        at[line] = np.cumsum(new) - 1
        e = np.take(np.take(table, own, axis=0), at, axis=0, out=e_all[:len(x)], mode="clip")
        np.matmul(e, w_in, out=qkv.reshape(-1, 3 * d + 1)[:len(e), :3 * d])
        q, key, v = qkv[:n, LAP:, :d], qkv[:n, :, d:2 * d], qkv[:n, :, 2 * d:]  # v has a last column of ones
        np.copyto(bias, np.where(causal, rel[back], f4(-1e4)))
        a = np.matmul(q, key.swapaxes(1, 2), out=a_all[:n])
        a += bias
        a[lead, :, :LAP] = -1e4
        _exp(a, _itself(a))
        z = np.matmul(a, v, out=z_all[:n])
        less = f4(1) / z[:, :, d:]
        h = h_all[:n]
        h[:, :, :d] = e.reshape(n, span, d)[:, LAP:]
        z = np.multiply(z[:, :, :d], less, out=h[:, :, d:2 * d])
        flat_h = h.reshape(n * STRIDE, -1)
        g = np.matmul(flat_h, top, out=g_all[:len(flat_h)])
        hit = cls[np.take(flat_ids, t + 1, mode="clip")] + row[:len(t)]
        _exp(g, g.ravel()[hit])
        total = g @ every
        g.ravel()[hit] -= total
        scale = (ok / (total * f4(max(ok.sum(), 1))))[:, None].astype(f4)
        np.matmul(np.multiply(flat_h, scale, out=hs_all[:len(flat_h)]).T, g, out=g_top)
        dh = np.matmul(g, top[:2 * d].T, out=dh_all[:len(flat_h)])
        dh *= scale
        dh = dh.reshape(n, STRIDE, 2 * d)
        dz = dz_all[:n]
        np.multiply(dh[:, :, d:], less, out=dz[:, :, :d])
        dz[:, :, d] = np.multiply(dz[:, :, :d], z, out=spare[:n]) @ minus
        ds = np.matmul(dz, v.swapaxes(1, 2), out=ds_all[:n])
        ds *= a
        grad = back_qkv[:n]
        np.matmul(ds, key, out=grad[:, LAP:, :d])
        np.matmul(ds.swapaxes(1, 2), q, out=grad[:, :, d:2 * d])
        np.matmul(a.swapaxes(1, 2), dz[:, :, :d], out=grad[:, :, 2 * d:])
        g_rel[:] = np.bincount(back.ravel(), ds.sum(0).ravel(), minlength=span)
        grad = grad.reshape(-1, 3 * d)
        np.matmul(e.T, grad, out=g_in)
        de = np.matmul(grad, w_in.T, out=de_all[:len(x)])
        de.reshape(n, span, d)[:, LAP:] += dh[:, :, :d]
        step, done = step + 1, done + 1
        rate = RATE * min(1.0, step / 20) * (1 - done / (steps + 1))
        _adam(table, e_one, e_two, np.add.reduceat(np.take(de, line, axis=0, out=rest[:len(x)], mode="clip"), edge), rate, step, own)
        _adam(flat, one, two, change, rate, step)
    state["step"] = step
    for i, name in enumerate(("wq", "wk", "wv")):
        p[name][:] = w_in[:, i * d:(i + 1) * d]
    p["wr"][:], p["o"][:], p["b"][:], p["rel"][:] = top[:d], top[d:2 * d], top[-1], rel


def _whole(p: dict, seen: np.ndarray, count: np.ndarray, cls: np.ndarray, classes: int, vocabulary: int, end: int) -> dict:
    """Parameters with the tables over all ids of the vocabulary; those not seen share the last class and vector."""
    n = unseen = len(seen)
    inner = np.log(count / np.bincount(cls, count, minlength=classes)[cls])
    p["e"][unseen] = 0
    full_cls, full_inner = np.full(vocabulary, classes), np.full(vocabulary, -np.log(max(vocabulary - n, 1)), np.float64)
    compact = np.full(vocabulary, unseen)
    full_cls[seen], full_inner[seen], compact[seen] = cls, inner, np.arange(n)
    return p | {"cls": full_cls, "inner": full_inner, "compact": compact, "end": end}


IDS = "block int, nth int, ids binary, first binary"
SPARSE = "part int, lot int, at binary, x binary"


def _encode(path: str | None):
    """A block's ids in rows of bounded size, its texts in an order that a retried task repeats."""
    def run(rows: pa.Table) -> pa.Table:
        block, kind, texts = rows.column("block")[0].as_py(), "<u2" if subword.encoder(path).size() <= 1 << 16 else "<u4", []
        for b in blocks.unpack(rows):
            key = b.column("key").to_numpy()
            texts += [(key[i], ids[first[i - lo]:first[i - lo + 1]].astype(kind)) for lo, hi, ids, first in
                      subword.encode_column(b.column("text"), path) for i in range(lo, hi)]
        texts.sort(key=lambda t: t[0])
        first = np.r_[0, np.cumsum([len(t) for _, t in texts])].astype("<i8")
        out = {"block": [], "nth": [], "ids": [], "first": []}
        for nth, (lo, hi) in enumerate(tv.spans(first, SLICE)):
            for name, v in zip(out, (block, nth, np.concatenate([t for _, t in texts[lo:hi]]).tobytes(), (first[lo:hi + 1] - first[lo]).tobytes())):
                out[name].append(v)
        texts.clear()
        tv.release()
        return pa.table(out, schema=pa.schema([("block", pa.int32()), ("nth", pa.int32()), ("ids", pa.binary()), ("first", pa.binary())]))
    return run


def _pieces(batches, kind: str):
    """(block, nth, ids, first) of all rows of ids."""
    for b in batches:
        for block, nth, ids, first in zip(*(b.column(c) for c in ("block", "nth", "ids", "first"))):
            yield block.as_py(), nth.as_py(), np.frombuffer(ids.as_buffer(), kind), np.frombuffer(first.as_buffer(), "<i8")


def _sparse(lot: int, at, x: np.ndarray):
    """Rows of indexes, as :func:`_parted` gives them, with their values."""
    part, edge, at = at
    for i, lo, hi in zip(part.tolist(), edge[:-1].tolist(), edge[1:].tolist()):
        yield pa.RecordBatch.from_arrays(
            [pa.array([i], pa.int32()), pa.array([lot], pa.int32()), pa.array([at[lo:hi].astype("<i4").tobytes()], pa.binary()),
             pa.array([x[lo:hi].astype("<f4").tobytes()], pa.binary())], names=["part", "lot", "at", "x"])


def _counted(kind: str, lots: int, add, parted):
    """mapInArrow over rows of ids: add(sums so far or None, ids, first), then parted(sums) to rows."""
    def run(batches):
        sums, lot = None, 0
        for block, _, ids, first in _pieces(batches, kind):
            sums, lot = add(sums, ids, first), block % lots
        if sums is not None:
            yield from _sparse(lot, *parted(sums))
        tv.release()
    return run


def _each(kind: str, lots: int, each):
    """mapInArrow over rows of ids, where a block is in one task; each(block, ids, first) gives (indexes, values a row) to be summed."""
    def run(batches):
        own: dict[int, list] = {}
        for block, nth, ids, first in _pieces(batches, kind):
            own.setdefault(block, []).append((nth, ids, first))
        for block in sorted(own):
            parts = sorted(own.pop(block), key=lambda r: r[0])
            ids = np.concatenate([ids for _, ids, _ in parts])
            first = np.r_[0, np.cumsum(np.concatenate([np.diff(first) for _, _, first in parts]))]
            parts.clear()
            for at, x in each(block, ids, first):
                yield from _sparse(block % lots, at, x)
            tv.release()
    return run


def _parted(at: np.ndarray, size: int):
    """(part numbers, their edges, at) of sorted indexes, ``size`` to a part."""
    part = at // size
    edge = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    return part[edge], np.r_[edge, len(at)], at


def _total(width: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("lot")
        at = np.concatenate([np.frombuffer(x.as_buffer(), "<i4") for x in rows.column("at")])
        x = np.concatenate([np.frombuffer(x.as_buffer(), "<f4") for x in rows.column("x")]).reshape(-1, width)
        order = np.argsort(at, kind="stable")
        edge = np.flatnonzero(np.r_[True, at[order][1:] != at[order][:-1]])
        x = np.add.reduceat(x[order].astype(float), edge)
        return pa.table([rows.column("part")[:1], rows.column("lot")[:1], pa.array([at[order][edge].tobytes()], pa.binary()),
                         pa.array([x.astype("<f4").tobytes()], pa.binary())], names=["part", "lot", "at", "x"])
    return run


def _added(sparse: DataFrame, lots: int, width: int) -> DataFrame:
    """One row a part: the sums over all blocks, first within lots of blocks where there are many."""
    if lots > LOTS:
        sparse = sparse.groupBy("part", "lot").applyInArrow(_total(width), SPARSE)
    return sparse.groupBy("part").applyInArrow(_total(width), SPARSE)


def _unpacked(rows: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([np.frombuffer(x.as_buffer(), "<i4") for x in rows.column("at")])
    return at, np.concatenate([np.frombuffer(x.as_buffer(), "<f4") for x in rows.column("x")]).reshape(-1, width).astype(float)


def _class_task(size: np.ndarray, classes: int):
    """The neighbours' counts of the whole vocabulary (a fixed size) to classes."""
    def run(rows: pa.Table) -> pa.Table:
        at, x = _unpacked(rows, 1)
        m = np.zeros(len(size) * 2 * COMMON, np.float32)
        m[at] = x[:, 0]
        cls = _kmeans(m.reshape(len(size), 2, COMMON), size, classes)
        return pa.table({"cls": pa.array([cls.astype("<i4").tobytes()], pa.binary())})
    return run


def _learn(end: int, k: int, epochs: int, shared):
    """One block's steps of round k from the shared parameters."""
    def each(block: int, ids: np.ndarray, first: np.ndarray):
        start, compact, cls = shared.value
        small = np.uint16 if len(start["e"]) <= 1 << 16 else np.int32
        cuts = [slice(lo, lo + SLICE) for lo in range(0, len(ids), SLICE)]  # indexing widens what it is given
        n = sum((np.bincount(compact[ids[c]], minlength=len(start["e"])) for c in cuts), np.zeros(len(start["e"]), np.int64))
        n[compact[end]] += len(first) - 1
        own = np.flatnonzero(n)  # ids that a block lacks keep their vectors
        place = (np.cumsum(n > 0) - 1).astype(small)
        local, last = np.empty(len(ids), small), int(place[compact[end]])
        for c in cuts:
            local[c] = place[compact[ids[c]]]
        p = {name: v.copy() for name, v in start.items()} | {"e": start["e"][own]}
        seed = np.random.default_rng([5, k, block])
        _epoch(p, local, first, last, cls[own], seed, {}, k, epochs)
        n = n[own].astype(float)
        yield _parted(own, PART), np.c_[p["e"] * n[:, None], n]
        flat = np.r_[np.concatenate([p[name].ravel() for name in sorted(p) if name != "e"]).astype(float), 1.0] * n.sum()
        flat = np.r_[flat, np.zeros(-len(flat) % (WIDTH + 1))].reshape(-1, WIDTH + 1)
        yield (np.array([-1]), np.array([0, len(flat)]), np.arange(len(flat))), flat
    return each


def fit(docs: DataFrame, path: str | None = None, block_bytes: int = blocks.BLOCK_BYTES, epochs: int = EPOCHS) -> dict:
    """The attention model of (doc_id, text) rows, trained on all of them, block by block."""
    spark = docs.sparkSession
    size = subword.Encoder(path).size()
    end, kind = size - 1, "<u2" if size <= 1 << 16 else "<u4"
    rows, n_blocks = blocks.pack(docs.select("doc_id", "text", F.xxhash64("text", "doc_id").alias("key")), block_bytes)
    lots = math.isqrt(n_blocks - 1) + 1 if n_blocks > LOTS else n_blocks
    out = shared_path(spark, f"attention-{uuid.uuid4().hex}")
    # small row groups: a reader holds one at a time
    rows.groupBy("block").applyInArrow(_encode(path), IDS).write.options(
        **{"parquet.block.size": 4 << 20, "parquet.page.size.row.check.min": 1}).parquet(out)
    coded = spark.read.parquet(out)

    def summed(run, width: int, rows: DataFrame = coded) -> DataFrame:
        return _added(rows.mapInArrow(run, SPARSE), lots, width)

    def count_ids(n, ids, first):
        n = np.bincount(ids, minlength=size) if n is None else n + np.bincount(ids, minlength=size)
        n[end] += len(first) - 1
        return n

    def counts(n):
        at = np.flatnonzero(n)
        return _parted(at, PART), n[at][:, None]
    got = summed(_counted(kind, lots, count_ids, counts), 1).toArrow()
    if not got.num_rows:
        p = train([np.zeros(0, np.int64)], size, end, epochs=0)
        p["e"][:], p["b"][:] = 0, np.log([1 / size, (size - 1) / size])
        return p
    at, n = _unpacked(got, 1)
    count = np.zeros(size)
    count[at] = n[:, 0]
    seen = np.flatnonzero(count)
    count = count[seen]
    compact = np.full(size, len(seen))
    compact[seen] = np.arange(len(seen))
    last, col, classes = int(compact[end]), _columns(count), min(CLASSES, len(seen))

    def count_cells(sums, ids, first):
        return _merged(sums, _neighbours(ids, first, compact, last, col))

    def cells(sums):
        return _parted(sums[0], 2 * COMMON * PART), sums[1][:, None]
    every = summed(_counted(kind, lots, count_cells, cells), 1).select("at", "x", F.lit(0).alias("all"))
    cls = np.frombuffer(every.groupBy("all").applyInArrow(_class_task(count, classes), "cls binary").first()["cls"], "<i4").astype(np.int64)
    count = count + 0.5
    p = _start(count, cls, classes, np.random.default_rng(5))
    apart = coded.repartitionByRange(n_blocks, "block")  # a block is a task, so that none waits for another's
    for k in range(epochs):
        shared = spark.sparkContext.broadcast((p, compact, cls))
        got = summed(_each(kind, lots, _learn(end, k, epochs, shared)), WIDTH + 1, apart).toArrow()
        shared.destroy()
        p = {name: v.copy() for name, v in p.items()}
        part = got.column("part").to_numpy()
        at, x = _unpacked(got.filter(pa.array(part >= 0)), WIDTH + 1)
        p["e"][at] = x[:, :-1] / x[:, -1:]
        flat = _unpacked(got.filter(pa.array(part < 0)), WIDTH + 1)[1].ravel()
        names, lo = [name for name in sorted(p) if name != "e"], 0
        total = flat[sum(p[name].size for name in names)]
        for name in names:
            p[name] = (flat[lo:lo + p[name].size] / total).reshape(p[name].shape).astype(np.float32)
            lo += p[name].size
    return _whole(p, seen, count, cls, classes, size, end)


# --- the words' counts -------------------------------------------------------------------

def _spans(rows: pa.Table):
    for b in blocks.unpack(rows):
        data, off = tv.utf8(b.column("text"))
        for lo, hi in tv.spans(off, SPAN):
            yield b, lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]


def _words(data, off):
    return tv.words(data, off, is_word=tv.INK, accents=False)


def _asked(rows: pa.Table, kept: list | None = None) -> np.ndarray:
    """A block's distinct words, as sorted hashes, the end among them. ``kept`` gets each span's
    words: starts, hashes, first words, and which of its texts are held out."""
    every = [np.array([END_WORD])]
    for b, lo, hi, data, off in _spans(rows):
        start, _, h, first = _words(data, off)
        if kept is not None:
            kept.append((start, h, first, b.column("held_out").to_numpy(zero_copy_only=False)[lo:hi]))
        every.append(_distinct(h))
    return _distinct(np.concatenate(every))


def _keys(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """A block's distinct words, their counts in training documents, and all of these."""
    kept: list = []
    keys = _asked(rows, kept)
    own = np.sort(np.concatenate([np.zeros(0, np.uint64), *(h[np.repeat(~held, np.diff(first))] for _, h, first, held in kept)]))
    edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, int)
    n, ends = np.zeros(len(keys), np.int64), sum(int((~held).sum()) for *_, held in kept)
    n[np.searchsorted(keys, own[edge])] = np.diff(np.r_[edge, len(own)])
    n[np.searchsorted(keys, END_WORD)] += ends
    return keys, n, len(own) + ends


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.r_[True, h[1:] != h[:-1]]] if len(h) else h


def _shards(keys: np.ndarray, bits: int):
    """(shard, lo, hi) of the non-empty ranges of sorted keys by their leading bits."""
    top = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edge = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    return zip(top[edge].tolist(), edge.tolist(), [*edge[1:].tolist(), len(keys)])


def _ask(bits: int):
    def run(rows: pa.Table) -> pa.Table:
        keys, n, tokens = _keys(rows)
        block, out = rows.column("block")[0].as_py(), {k: [] for k in ("block", "shard", "keys", "n", "tokens")}
        for s, lo, hi in _shards(keys, bits):
            has_end = keys[lo] <= END_WORD <= keys[hi - 1]
            for k, v in zip(out, (block, s, keys[lo:hi].tobytes(), n[lo:hi].astype("<u4").tobytes(), tokens if has_end else 0)):
                out[k].append(v)
        return pa.table(out, schema=ASKED)
    return run


ASKED = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("n", pa.binary()), ("tokens", pa.int64())])
SUMMED = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("n", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64())])


def _sum(rows: pa.Table) -> pa.Table:
    """One shard's sums, back to each block. The end's shard, where every block asks, also sums all
    tokens; the shard's distinct training words go with its first row."""
    keys = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("keys")])
    n = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in rows.column("n")]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    edge = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
    total = np.add.reduceat(n[order], edge)
    back = np.empty(len(keys), "<i8")
    back[order] = np.repeat(total, np.diff(np.r_[edge, len(keys)]))
    at = np.r_[0, np.cumsum([len(x.as_buffer()) // 8 for x in rows.column("keys")])]
    return pa.table({
        "block": rows.column("block"), "shard": rows.column("shard"), "n": [back[a:z].tobytes() for a, z in zip(at[:-1], at[1:])],
        "tokens": [int(sum(rows.column("tokens").to_pylist()))] * rows.num_rows,
        "types": [int((total > 0).sum())] + [0] * (rows.num_rows - 1)}, schema=SUMMED)


SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("logs", pa.float64()), ("score", pa.float64()), ("types", pa.int64())])


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values)]
    return total[first[1:]] - total[first[:-1]]


def _answer(shared, path: str | None, mix: float):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        model, enc = Model(shared.value), subword.encoder(path)
        order = np.argsort(answers.column("shard").to_numpy(), kind="stable")
        n = np.concatenate([np.frombuffer(answers.column("n")[int(i)].as_buffer(), "<i8") for i in order])
        tokens, types = max(answers.column("tokens").to_pylist()), sum(answers.column("types").to_pylist())
        kept: list = []
        keys = _asked(rows, kept)
        known = tv.Positions()
        known.add(keys)
        ends = int(n[np.searchsorted(keys, END_WORD)])

        def mixed(att, c):
            with np.errstate(divide="ignore"):
                return np.logaddexp(att + np.log(mix), np.log((1 - mix) * c / max(tokens, 1)))
        out = []
        for (b, lo, hi, data, off), (start, h, first, _) in zip(_spans(rows), kept):
            c = n[known.find(h)]
            ids, at, piece, size = enc.encode_pieces(data, off)
            logp, place = model.logp(ids, at)
            word = np.zeros(len(data), np.int32)
            word[start] = 1
            word = np.repeat((np.cumsum(word) - 1)[piece], size)
            last = place[1:] - 1
            inside = np.ones(len(logp), bool)
            inside[last] = False
            att = np.bincount(word, logp[inside], minlength=len(h))
            total = _sums(mixed(att, c), first) + mixed(logp[last], np.full(hi - lo, ends))
            m = hi - lo
            out.append(pa.table({
                "doc_id": b.column("doc_id").slice(lo, m), "held_out": b.column("held_out").slice(lo, m),
                "n_tokens": np.diff(first) + 1, "n_known": _sums((c > 0).astype(np.int64), first) + int(ends > 0),
                "train_tokens": np.full(m, tokens), "logs": _sums(np.log10(c + 1.0), first) + np.log10(ends + 1.0),
                "score": total / np.log(10), "types": np.r_[types, np.zeros(m - 1, np.int64)]}, schema=SCORED))
            types = 0
        return pa.concat_tables(out) if out else SCORED.empty_table()
    return run


def score(docs: DataFrame, path: str | None = None, mix: float = MIX) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", langid.held_out("doc_id", 7))
    shared = spark.sparkContext.broadcast(fit(docs.where("not held_out").select("doc_id", "text"), path))
    rows, n = blocks.pack(docs)
    bits = max(0, n // 2).bit_length()
    asked = rows.groupBy("block").applyInArrow(_ask(bits), "block int, shard int, keys binary, n binary, tokens long")
    sums = asked.groupBy("shard").applyInArrow(_sum, "block int, shard int, n binary, tokens long, types long")
    out = shared_path(spark, f"attention-{uuid.uuid4().hex}")
    rows.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(
        _answer(shared, path, mix), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                    "logs double, score double, types long").write.parquet(out)
    scored = spark.read.parquet(out)
    types = scored.agg(F.sum("types")).first()[0] or 0
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.col("train_tokens") + F.lit(types + 1.0))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", base.alias("base_score"), "score")
