"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word comes in as two embeddings: one of the word and the mean of those of its character n-grams,
both by hashing. A window's words run through the network in both directions; attention weighs the
states, and their mean gives one logit per window.
"""

from __future__ import annotations

import numpy as np

from dossierlake.llm.words import mix, spans, word_hashes

HIDDEN = 8
EMBED = 8
WORD_BINS = 1 << 14
GRAM_BINS = 1 << 15
GRAMS = (3, 4, 5)
WINDOW = 32
STRIDE = 16
WINDOWS_AT_ONCE = 2048

# Letters, digits and bytes above ASCII form words; capitals count as small letters.
GAP = np.ones(256, bool)
GAP[48:58] = GAP[65:91] = GAP[97:123] = GAP[128:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Batch:
    """Words of some texts: distinct ones with their bins, and the distinct word at each place."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        starts, ends, self.rows = spans(data, offsets, GAP)
        hashes = word_hashes(data, starts, ends)
        distinct, first, self.place = np.unique(hashes, return_index=True, return_inverse=True)
        self.bins = (distinct >> np.uint64(64 - WORD_BINS.bit_length() + 1)).astype(np.int64)
        self.grams, self.gram_starts = _grams(data, starts[first], ends[first])
        self.n_rows = len(offsets) - 1
        self.windows, self.window_rows = _windows(self.rows, self.n_rows)


    def part(self, windows: np.ndarray) -> "Batch":
        """Only these windows, with the distinct words that they hold."""
        at = self.windows[windows]
        places = np.where(at >= 0, self.place[at], -1)
        used = np.unique(places[places >= 0])
        out = object.__new__(Batch)
        counts = np.diff(np.append(self.gram_starts, len(self.grams)))[used]
        out.gram_starts = np.cumsum(counts) - counts
        within = np.arange(int(counts.sum())) - np.repeat(out.gram_starts, counts)
        out.grams = self.grams[within + np.repeat(self.gram_starts[used], counts)]
        out.bins, out.place = self.bins[used], np.arange(len(used))
        out.windows = np.where(places >= 0, np.searchsorted(used, places), -1)
        return out


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the n-grams of every word within marks of its ends, and where each word's begin."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = ends - starts + 2
    begin = np.cumsum(size) - size
    letters = np.full(int(size.sum()), 256, np.uint64)
    inside = np.ones(len(letters), bool)
    inside[begin] = inside[begin + size - 1] = False
    at = np.arange(int((ends - starts).sum())) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)
    letters[inside] = data[at + np.repeat(starts, ends - starts)]
    word = np.repeat(np.arange(len(size)), size)
    found, owners = [], []
    for n in GRAMS:
        m = len(letters) - n + 1
        if m <= 0:
            continue
        total = np.full(m, n, np.uint64)
        for i in range(n):
            total = total * np.uint64(1021) + letters[i : i + m]
        whole = np.flatnonzero(word[:m] == word[n - 1 :])
        found.append(mix(total[whole]) >> np.uint64(64 - GRAM_BINS.bit_length() + 1))
        owners.append(word[whole])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(size))
    return np.concatenate(found)[order].astype(np.int64), np.cumsum(counts) - counts


def _windows(rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the word at each place of every window, -1 behind a text's end; and their rows."""
    count = np.bincount(rows, minlength=n_rows)
    begin = np.cumsum(count) - count
    n = np.where(count > 0, 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(n_rows), n)
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = step[:, None] * STRIDE + np.arange(WINDOW)
    return np.where(at < count[row][:, None], at + begin[row][:, None], -1), row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        h, e = HIDDEN, 2 * EMBED
        self.p = {
            "word": r.normal(0, 0.03, (WORD_BINS, EMBED)),
            "gram": r.normal(0, 0.03, (GRAM_BINS, EMBED)),
            "wf": r.normal(0, e**-0.5, (e, 3 * h)),
            "wb": r.normal(0, e**-0.5, (e, 3 * h)),
            "uf": r.normal(0, h**-0.5, (h, 3 * h)),
            "ub": r.normal(0, h**-0.5, (h, 3 * h)),
            "bf": np.zeros(3 * h),
            "bb": np.zeros(3 * h),
            "attend": r.normal(0, 0.3, 2 * h),
            "out": r.normal(0, 0.3, 2 * h),
            "bias": np.array([-1.0]),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def inputs(self, batch: Batch) -> np.ndarray:
        """Both embeddings of every distinct word."""
        if not len(batch.bins):
            return np.zeros((0, 2 * EMBED), np.float32)
        grams = np.add.reduceat(self.p["gram"][batch.grams], batch.gram_starts)
        counts = np.diff(np.append(batch.gram_starts, len(batch.grams)))
        return np.concatenate([self.p["word"][batch.bins], grams / counts[:, None]], 1)

    def run(self, words: np.ndarray, windows: np.ndarray, keep: list | None = None):
        """Logit of every window. words: for each direction, the input part of the gates of each
        distinct word; windows: distinct word at each place or -1. keep: gets what learning needs."""
        h, n = HIDDEN, len(windows)
        real = (windows >= 0)[:, :, None]
        state = np.zeros((n, WINDOW, 2 * h), np.float32)
        for side, u in enumerate((self.p["uf"], self.p["ub"])):
            now = np.zeros((n, h), np.float32)
            for t in range(WINDOW) if side == 0 else range(WINDOW - 1, -1, -1):
                x = words[side][windows[:, t]]
                y = now @ u
                gates = _sigmoid(x[:, : 2 * h] + y[:, : 2 * h])
                fresh = np.tanh(x[:, 2 * h :] + gates[:, h:] * y[:, 2 * h :])
                after = np.where(real[:, t], fresh + gates[:, :h] * (now - fresh), now)
                if keep is not None:
                    keep.append((side, t, now, y[:, 2 * h :], gates, fresh))
                state[:, t, side * h : side * h + h] = now = after
        weight = np.where(real[:, :, 0], state @ self.p["attend"], -np.inf)
        weight = np.exp(weight - weight.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
        pooled = (weight[:, :, None] * state).sum(1)
        if keep is not None:
            keep.append((state, weight, pooled, real))
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gates(self, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return inputs @ self.p["wf"] + self.p["bf"], inputs @ self.p["wb"] + self.p["bb"]

    def logits(self, batch: Batch) -> np.ndarray:
        """Logit of every window of a batch."""
        words = self.gates(self.inputs(batch))
        out = np.zeros(len(batch.windows), np.float32)
        for a in range(0, len(out), WINDOWS_AT_ONCE):
            at = batch.windows[a : a + WINDOWS_AT_ONCE]
            out[a : a + WINDOWS_AT_ONCE] = self.run(words, np.where(at >= 0, batch.place[at], -1))
        return out

    def gradients(self, batch: Batch, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy of the windows of a part."""
        places = batch.windows
        inputs = self.inputs(batch)
        keep: list = []
        logit = self.run(self.gates(inputs), places, keep)
        at = places
        h, p = HIDDEN, self.p
        state, weight, pooled, real = keep.pop()
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d_logit = ((_sigmoid(logit) - target) / len(target)).astype(np.float32)
        g["bias"][0] = d_logit.sum()
        g["out"] = d_logit @ pooled
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = (state @ d_pooled[:, :, None])[:, :, 0]
        d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
        g["attend"] = np.einsum("nt,ntk->k", d_score, state)
        d_state = weight[:, :, None] * d_pooled[:, None] + d_score[:, :, None] * p["attend"]
        d_inputs = np.zeros_like(inputs)
        back = [np.zeros((len(at), h), np.float32), np.zeros((len(at), h), np.float32)]
        for side, t, before, y, gates, fresh in reversed(keep):
            u, w = ("uf", "wf") if side == 0 else ("ub", "wb")
            live = real[:, t]
            d_after = back[side] + d_state[:, t, side * h : side * h + h]
            d = np.where(live, d_after, 0)
            z, r = gates[:, :h], gates[:, h:]
            d_fresh = d * (1 - z) * (1 - fresh * fresh)
            d_z = d * (before - fresh) * z * (1 - z)
            d_r = d_fresh * y * r * (1 - r)
            d_y = np.concatenate([d_z, d_r, d_fresh * r], 1)
            d_x = np.concatenate([d_z, d_r, d_fresh], 1)
            g[u] += before.T @ d_y
            back[side] = np.where(live, d * z, d_after) + d_y @ p[u].T
            x = inputs[places[:, t]]
            g[w] += x.T @ d_x
            g["bf" if side == 0 else "bb"] += d_x.sum(0)
            np.add.at(d_inputs, places[:, t][live[:, 0]], (d_x @ p[w].T)[live[:, 0]])
        used = np.flatnonzero(d_inputs.any(1))
        np.add.at(g["word"], batch.bins[used], d_inputs[used, :EMBED])
        counts = np.diff(np.append(batch.gram_starts, len(batch.grams)))
        share = np.zeros((len(inputs), EMBED), np.float32)
        share[used] = d_inputs[used, EMBED:] / counts[used, None]
        owner = np.repeat(np.arange(len(inputs)), counts)
        touched = np.flatnonzero(np.isin(owner, used))
        np.add.at(g["gram"], batch.grams[touched], share[owner[touched]])
        return g


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.rate, self.step = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def update(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.step += 1
        fix1, fix2 = 1 - 0.9**self.step, 1 - 0.999**self.step
        for k in p:
            self.m[k] += 0.1 * (g[k] - self.m[k])
            self.v[k] += 0.001 * (g[k] * g[k] - self.v[k])
            # Embeddings move slowly: few windows hold each, and they would learn those by heart.
            rate = self.rate * (0.5 if k in ("word", "gram") else 1.0)
            p[k] -= rate * (self.m[k] / fix1) / (np.sqrt(self.v[k] / fix2) + 1e-8)
