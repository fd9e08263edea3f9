"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Characters are known by class (``classes``). Gates and cell use piecewise linear squashing, which costs a fraction
of the exponentials and trains as well on this task. States are kept feature by feature, so that each step is a few
operations on contiguous rows of all windows at once.
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)  # 0 is outside

GROUPS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "@", ".", "+", "-", "(", ")", " ", "\n\t\r\v\f"]
GROUPS += ["_", "%", ":", "/", "=", ",;!?", "\"'"]
OTHER, BEYOND, PAD = len(GROUPS), len(GROUPS) + 1, len(GROUPS) + 2
CLASSES = len(GROUPS) + 3
CLASS_OF_BYTE = np.full(256, OTHER, np.uint8)
for _i, _group in enumerate(GROUPS):
    CLASS_OF_BYTE[[ord(c) for c in _group]] = _i
CLASS_OF_BYTE[0x80:] = BEYOND  # the first byte of any character beyond ASCII


def fresh(hidden: int, seed: int) -> dict[str, np.ndarray]:
    """Random weights. Rows of gates: input, forget, output, cell."""
    rng = np.random.default_rng(seed)
    w = {}
    for side in ("f", "b"):
        w[f"x{side}"] = rng.normal(0, 0.5, (4 * hidden, CLASSES))
        w[f"x{side}"][hidden : 2 * hidden] += 1.5  # remember at first
        w[f"h{side}"] = rng.normal(0, 0.6 / np.sqrt(hidden), (4 * hidden, hidden))
    w["out"] = rng.normal(0, 0.3, (LABELS, 2 * hidden))
    w["bias"] = np.zeros((LABELS, 1))
    w["bias"][0] = 1.0
    w["step"] = np.eye(LABELS) * 1.0
    w["start"] = np.zeros((LABELS, 1))
    return {k: v.astype(np.float32) for k, v in w.items()}


def lstm(wx: np.ndarray, wh: np.ndarray, x: np.ndarray, out: np.ndarray, trace: list | None = None) -> None:
    """States of all steps of ``x`` (steps, windows) into ``out`` (hidden, steps, windows)."""
    hidden, n = wh.shape[1], x.shape[1]
    scale = np.ones((4 * hidden, 1), np.float32)
    shift = np.zeros((4 * hidden, 1), np.float32)
    scale[: 3 * hidden], shift[: 3 * hidden] = 0.25, 0.5
    wx, wh = np.ascontiguousarray(wx * scale + shift), np.ascontiguousarray(wh * scale)
    h = c = np.zeros((hidden, n), np.float32)
    for t in range(len(x)):
        z = np.take(wx, x[t], axis=1)
        z += wh @ h
        gates, g = z[: 3 * hidden], z[3 * hidden :]
        np.clip(gates, 0, 1, out=gates)
        np.clip(g, -1, 1, out=g)
        i, f, o = gates[:hidden], gates[hidden : 2 * hidden], gates[2 * hidden :]
        before = c
        c = f * c
        c += i * g
        m = np.clip(c, -1, 1)
        last, h = h, o * m
        out[:, t] = h
        if trace is not None:
            trace.append((z, before, c, m, last))


def lstm_back(wh: np.ndarray, x: np.ndarray, trace: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and the state weights."""
    hidden, n = wh.shape[1], x.shape[1]
    dx, dwh = np.zeros((4 * hidden, CLASSES), np.float32), np.zeros_like(wh)
    dh = np.zeros((hidden, n), np.float32)
    dc = np.zeros((hidden, n), np.float32)
    onehot = np.eye(CLASSES, dtype=np.float32)
    for t in range(len(x) - 1, -1, -1):
        z, before, c, m, last = trace[t]
        i, f, o, g = (z[j * hidden : (j + 1) * hidden] for j in range(4))
        dh = dh + dout[:, t]
        dc = dc + dh * o * (np.abs(c) < 1)
        dz = np.concatenate([dc * g, dc * before, dh * m, dc * i])
        dz[: 3 * hidden] *= 0.25 * ((z[: 3 * hidden] > 0) & (z[: 3 * hidden] < 1))
        dz[3 * hidden :] *= np.abs(g) < 1
        dwh += dz @ last.T
        dx += dz @ onehot[x[t]]
        dh, dc = wh.T @ dz, dc * f
    return dx, dwh


def states(w: dict, x: np.ndarray, traces: dict | None = None) -> np.ndarray:
    """Both directions' states (2 * hidden, steps, windows)."""
    hidden = w["hf"].shape[1]
    out = np.empty((2 * hidden, *x.shape), np.float32)
    for side, rows, order in (("f", slice(0, hidden), slice(None)), ("b", slice(hidden, None), slice(None, None, -1))):
        trace = [] if traces is not None else None
        lstm(w[f"x{side}"], w[f"h{side}"], x[order], out[rows][:, order], trace)
        if traces is not None:
            traces[side] = trace
    return out


def emissions(w: dict, h: np.ndarray) -> np.ndarray:
    flat = w["out"] @ h.reshape(len(h), -1) + w["bias"]
    return flat.reshape(LABELS, *h.shape[1:])


def decode(w: dict, x: np.ndarray) -> np.ndarray:
    """The best labels (steps, windows) of windows of classes (steps, windows)."""
    e = emissions(w, states(w, x))
    steps, n = x.shape
    best = np.empty((steps, LABELS, n), np.float32)
    best[0] = e[:, 0] + w["start"]
    for t in range(1, steps):
        for k in range(LABELS):
            row = best[t - 1, 0] + w["step"][0, k]
            for j in range(1, LABELS):
                np.maximum(row, best[t - 1, j] + w["step"][j, k], out=row)
            np.add(row, e[k, t], out=best[t, k])
    labels = np.empty((steps, n), np.uint8)
    labels[-1] = best[-1].argmax(0)
    for t in range(steps - 2, -1, -1):
        came = best[t] + w["step"][:, labels[t + 1]]
        top, at = came[0], np.zeros(n, np.uint8)
        for j in range(1, LABELS):
            more = came[j] > top
            at[more] = j
            top = np.where(more, came[j], top)
        labels[t] = at
    return labels


def logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))


def loss_and_gradient(w: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """The mean negative log-likelihood of labels y (steps, windows), and its gradient."""
    traces: dict = {}
    h = states(w, x, traces)
    e = emissions(w, h)
    steps, n = x.shape
    pair = w["step"][:, :, None]
    ahead = np.empty((steps, LABELS, n), np.float32)
    ahead[0] = e[:, 0] + w["start"]
    for t in range(1, steps):
        ahead[t] = logsum(ahead[t - 1][:, None] + pair, 0) + e[:, t]
    total = logsum(ahead[-1], 0)
    behind = np.zeros((LABELS, n), np.float32)
    de = np.empty_like(e)
    dstep = np.zeros_like(w["step"])
    for t in range(steps - 1, -1, -1):
        de[:, t] = np.exp(ahead[t] + behind - total)
        if t:
            after = (e[:, t] + behind)[None]
            dstep += np.exp(ahead[t - 1][:, None] + pair + after - total).sum(2)
            behind = logsum(pair + after, 1)
    one = np.eye(LABELS, dtype=np.float32)[y].transpose(2, 0, 1)
    gold = (e * one).sum() + w["start"][y[0], 0].sum() + w["step"][y[:-1], y[1:]].sum()
    np.subtract.at(dstep, (y[:-1].ravel(), y[1:].ravel()), 1)
    dstart = (de[:, 0] - one[:, 0]).sum(1, keepdims=True)
    de -= one
    flat, hidden = de.reshape(LABELS, -1), w["hf"].shape[1]
    grad = {"out": flat @ h.reshape(len(h), -1).T, "bias": flat.sum(1, keepdims=True), "step": dstep, "start": dstart}
    dh = (w["out"].T @ flat).reshape(h.shape)
    grad["xf"], grad["hf"] = lstm_back(w["hf"], x, traces["f"], dh[:hidden])
    grad["xb"], grad["hb"] = lstm_back(w["hb"], x[::-1], traces["b"], dh[hidden:, ::-1])
    return float(total.sum() - gold) / n, {k: v / n for k, v in grad.items()}


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 8, rounds: int = 150, size: int = 192, rate: float = 0.02, seed: int = 3) -> dict:
    """Weights trained with Adam on windows x and labels y, both (steps, windows)."""
    w = fresh(hidden, seed)
    rng = np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for r in range(1, rounds + 1 if x.shape[1] else 1):
        at = rng.integers(0, x.shape[1], min(size, 4 * x.shape[1]))
        _, grad = loss_and_gradient(w, x[:, at], y[:, at])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        now = rate * min(1.0, 2 * (1 - r / (rounds + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 5 / max(norm, 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w[k] = w[k] - now * (first[k] / (1 - 0.9**r)) / (np.sqrt(second[k] / (1 - 0.99**r)) + 1e-8)
    return {k: np.ascontiguousarray(v, np.float32) for k, v in w.items()}
