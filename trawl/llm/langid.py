"""Operator 2, language identification by a bidirectional GRU over bytes.

A gated recurrent network (reset gate after the matrix product) runs over the
UTF-8 bytes of a text in both directions; a softmax over both states labels
every position, and a document's probabilities are the mean over all its
positions. The network is trained in numpy by backpropagation through time on
windows of labelled documents. A text is cut into windows of ``WINDOW`` bytes
that are run side by side, so memory is bounded by ``LANES`` windows however
long the text is. Windows overlap by ``MARGIN`` bytes on either side, which are read for the state and not
counted, so a label near a cut has seen its neighbours; every byte of every text counts once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW, MARGIN = 256, 32
TRAINED = 64  # bytes of a training window
LANES = 1024
UND = "und"


def has_letter(text: str) -> bool:
    """A character of Unicode's letter categories (L): digits and numerals of any kind are none."""
    return next(filter(str.isalpha, text), None) is not None


# ---- the network -------------------------------------------------------------
# Weights are kept transposed, (3H, .), so a gate of all lanes is one contiguous block.

def new_weights(n_labels: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    g = lambda *s, k=0.3: (rng.normal(size=s) * k).astype(np.float32)
    w = {"out": g(n_labels, 2 * hidden), "bias": np.zeros((n_labels, 1), np.float32)}
    for d in ("f", "b"):
        w["x" + d], w["u" + d] = g(3 * hidden, 256), g(3 * hidden, hidden)
        w["x" + d][:hidden] += 1.0  # remember by default
    return w


def _sigma(v):
    return 0.5 * np.tanh(0.5 * v) + 0.5


def _direction(x, u, bytes_, valid):
    """States (L, H, B) and what the backward pass needs. A padded lane keeps its state."""
    length, lanes = bytes_.shape
    hid = u.shape[1]
    h, keep = np.zeros((hid, lanes), np.float32), []
    states = np.empty((length, hid, lanes), np.float32)
    for t in range(length):
        a, p = x[:, bytes_[t]], u @ h
        z, r = _sigma(a[:hid] + p[:hid]), _sigma(a[hid:2 * hid] + p[hid:2 * hid])
        n = np.tanh(a[2 * hid:] + r * p[2 * hid:])
        new = z * h + (1 - z) * n
        keep.append((h, z, r, n, p[2 * hid:]))
        h = np.where(valid[t], new, h)
        states[t] = h
    return states, keep


def _direction_back(x, u, bytes_, valid, keep, dstates):
    hid = u.shape[1]
    dx, du = np.zeros_like(x), np.zeros_like(u)
    dh = np.zeros_like(dstates[0])
    for t in range(len(bytes_) - 1, -1, -1):
        h, z, r, n, pn = keep[t]
        dh = dh + dstates[t]
        dnew, dpass = dh * valid[t], dh * ~valid[t]
        dz, dn = dnew * (h - n) * z * (1 - z), dnew * (1 - z) * (1 - n * n)
        dr = dn * pn * r * (1 - r)
        da = np.concatenate([dz, dr, dn])
        dp = np.concatenate([dz, dr, dn * r])
        np.add.at(dx.T, bytes_[t], da.T)
        du += dp @ h.T
        dh = dpass + dnew * z + u.T @ dp
    return dx, du


def train(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, n_labels: int, *, hidden: int | None = None,
          steps: int | None = None, batch: int = 192, rate: float = 0.02, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on the mean cross-entropy of all positions of (N, L) byte windows. Hidden units and
    steps, unless given, grow with the root of the labels beyond 16."""
    scale = max(1.0, (n_labels / 16) ** 0.5)
    hidden, steps = hidden or round(12 * scale), steps or round(260 * scale)
    rng, w = np.random.default_rng(seed), new_weights(n_labels, hidden, seed)
    m, v = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), batch)
        by, valid = windows[pick].T.astype(np.intp), np.arange(windows.shape[1])[:, None] < lengths[pick][None]
        sf, kf = _direction(w["xf"], w["uf"], by, valid)
        sb, kb = _direction(w["xb"], w["ub"], by[::-1], valid[::-1])
        both = np.concatenate([sf, sb[::-1]], axis=1)                       # (L, 2H, B)
        logits = np.matmul(w["out"], both) + w["bias"]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[:, labels[pick], np.arange(batch)] -= 1
        p *= valid[:, None] / max(1, valid.sum())
        g = {"out": np.tensordot(p, both, axes=([0, 2], [0, 2])), "bias": p.sum(axis=(0, 2))[:, None]}
        dboth = np.matmul(w["out"].T, p)
        g["xf"], g["uf"] = _direction_back(w["xf"], w["uf"], by, valid, kf, dboth[:, :hidden])
        g["xb"], g["ub"] = _direction_back(w["xb"], w["ub"], by[::-1], valid[::-1], kb, dboth[::-1, hidden:])
        norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
        lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in w:
            a = g[k] * min(1.0, 1.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * a
            v[k] = 0.99 * v[k] + 0.01 * a * a
            w[k] -= (lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return w


class Labeller:
    """Fast inference: both directions over many windows at once."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.hid = w["uf"].shape[1]
        half = np.ones((3 * self.hid, 1), np.float32)
        half[:2 * self.hid] = 0.5  # sigma(v) = tanh(v/2)/2 + 1/2
        self.x = [np.ascontiguousarray(w[k] * half) for k in ("xf", "xb")]
        self.u = [np.ascontiguousarray(w[k] * half) for k in ("uf", "ub")]
        self.out, self.bias = w["out"], w["bias"]

    def _states(self, d, by, lens):
        """States (L, H, B); windows are left-aligned and lanes sorted by falling length, so step t runs a prefix of the lanes."""
        hid, (length, lanes) = self.hid, by.shape
        states = np.zeros((length, hid, lanes), np.float32)
        live = np.searchsorted(-lens, -np.arange(length), side="left")  # lanes with lens > t
        h_all = np.zeros((hid, lanes), np.float32)
        for t in (range(length) if d == 0 else range(length - 1, -1, -1)):
            n_live = live[t]
            if not n_live:
                continue
            h = h_all[:, :n_live]
            a = np.take(self.x[d], by[t, :n_live], axis=1, mode="clip")
            p = self.u[d] @ h
            g = p[:2 * hid]
            g += a[:2 * hid]
            np.tanh(g, out=g)
            g += 1
            g *= 0.5
            n = p[2 * hid:]
            n *= g[hid:]
            n += a[2 * hid:]
            np.tanh(n, out=n)
            h -= n
            h *= g[:hid]
            h += n
            states[t, :, :n_live] = h
        return states

    def positions(self, by, lens):
        """(L, K, B) label probabilities of every position; zero beyond a window's length."""
        both = np.concatenate([self._states(0, by, lens), self._states(1, by, lens)], axis=1)
        logits = np.matmul(self.out, both)
        logits += self.bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        logits *= (np.arange(len(by))[:, None] < lens[None])[:, None]
        return logits

    def pooled(self, raws: list[bytes]):
        """For each text: summed probabilities (K), positions won by each label (K), bytes."""
        k = len(self.bias)
        sums, won = np.zeros((len(raws), k)), np.zeros((len(raws), k), np.int64)
        sizes = np.array([len(r) for r in raws], np.int64)
        data = np.frombuffer(b"".join(raws), np.uint8)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(raws) else np.zeros(0, np.int64)
        step = WINDOW - 2 * MARGIN
        per = -(-sizes // step)
        owner = np.repeat(np.arange(len(raws)), per)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        first = np.maximum(nth * step - MARGIN, 0)
        at, lens = starts[owner] + first, np.minimum(nth * step + step + MARGIN, sizes[owner]) - first
        lo = nth * step - first  # the inner positions, which count
        hi = np.minimum(lo + step, lens)
        order = np.argsort(-lens, kind="stable")
        padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
        lanes = max(16, min(LANES, LANES * 64 // k))  # the probabilities of all positions take the same memory
        for i in range(0, len(order), lanes):
            o = order[i: i + lanes]
            by = padded[at[o][None] + np.arange(WINDOW)[:, None]]
            p = self.positions(by.astype(np.intp), lens[o])
            inside = (np.arange(WINDOW)[:, None] >= lo[o][None]) & (np.arange(WINDOW)[:, None] < hi[o][None])
            best = p.argmax(axis=1)
            p *= inside[:, None]
            np.add.at(sums, owner[o], p.sum(axis=0).T)
            np.add.at(won, owner[o], np.stack([((best == j) & inside).sum(axis=0) for j in range(k)], axis=1))
        return sums, won, sizes


# ---- Spark -------------------------------------------------------------------

def sample_windows(docs: DataFrame, text: Column, label: Column, key: Column, *, per_label: int = 400,
                   piece: int = 1024, shared: int = 64):
    """A training sample: of every label the ``per_label`` documents first by hash, a piece of each;
    more than ``shared`` labels share the rows of so many, at least 16 each."""
    lab = docs.select(label.alias("label"), text.alias("text"), F.xxhash64(key, text).alias("h")) \
        .where("label is not null and text is not null and length(text) > 0")
    counts = lab.groupBy("label").count().collect()
    names = sorted(r["label"] for r in counts)
    per_label = min(per_label, max(16, per_label * shared // max(1, len(names))))
    # a share of each label's hashes that holds a little more than enough; then the first of those
    shares = docs.sparkSession.createDataFrame(
        [(r["label"], min(1 << 30, int((1 << 30) * 2 * per_label / r["count"]))) for r in counts], T.StructType([
            T.StructField("label", lab.schema["label"].dataType), T.StructField("share", T.LongType())]))
    at = F.pmod(F.col("h"), F.greatest(F.length("text") - piece, F.lit(0)) + 1).cast("int") + 1
    top = (lab.join(F.broadcast(shares), "label").where(F.pmod("h", F.lit(1 << 30)) < F.col("share"))
           .select("label", "h", F.substring(F.col("text"), at, F.lit(piece)).alias("t"))
           .withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy(F.pmod("h", F.lit(1 << 30)), "h")))
           .where(F.col("r") <= per_label))
    rows = top.orderBy("label", "h").collect()
    windows, lengths, labels, at = [], [], [], {n: i for i, n in enumerate(names)}
    for r in rows:
        raw = r["t"].encode("utf-8", "replace")
        for i in range(0, len(raw), TRAINED):
            w = raw[i: i + TRAINED]
            windows.append(np.frombuffer(w.ljust(TRAINED, b"\0"), np.uint8))
            lengths.append(len(w))
            labels.append(at[r["label"]])
    return names, np.array(windows), np.array(lengths), np.array(labels)


def fit(docs: DataFrame, text: Column, label: Column, key: Column, **options):
    """(label names, weights) from the labelled rows of ``docs``; no labelled row: no names."""
    names, windows, lengths, labels = sample_windows(docs, text, label, key)
    if len(names) == 0:
        return [], None
    if len(names) == 1:
        return names, new_weights(1, 2, 0)
    return names, train(windows, lengths, labels, len(names), **options)


def identify(docs: DataFrame, names: list[str], weights, *, text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred, score, agree (share of positions with that label).

    A null, empty or letterless text, or a model without labels, gives ``und``
    with score 0. Rows are judged each for itself: repeated rows agree. All
    input columns stay; columns of the added names are replaced.
    """
    added = ("lang_pred", "score", "agree")
    own = [c for c in docs.columns if c not in added]

    def run(batches):
        model = Labeller(weights) if names else None
        for b in batches:
            texts = b.column(b.schema.names.index("_t"))
            pred, score, agree = [], [], []
            i = 0
            while i < len(texts):
                raws, room = [], 4 << 20  # bytes run at once; one longer text goes alone
                while i < len(texts) and (room > 0 or not raws):
                    t = texts[i].as_py() or ""
                    raws.append(t.encode("utf-8", "replace") if model and has_letter(t) else b"")
                    room -= len(raws[-1])
                    i += 1
                if not model:
                    pred += [UND] * len(raws)
                    score += [0.0] * len(raws)
                    agree += [0.0] * len(raws)
                    continue
                sums, won, sizes = model.pooled(raws)
                best = sums.argmax(axis=1)
                rows = np.arange(len(raws))
                n = np.maximum(sizes, 1)
                pred += [names[j] if s else UND for j, s in zip(best, sizes, strict=True)]
                score += np.clip(sums[rows, best] / n, 0, 1).tolist()
                agree += (won[rows, best] / n).tolist()
            keep = [b.column(i) for i, n in enumerate(b.schema.names) if n != "_t"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(agree, pa.float64())],
                [*(n for n in b.schema.names if n != "_t"), *added])

    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"),
                        F.col(f"`{text_col}`").cast("string").alias("_t"))
    schema = T.StructType([inner.schema["_row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("agree", T.DoubleType())])
    return inner.mapInArrow(run, schema).select("_row.*", *added)
