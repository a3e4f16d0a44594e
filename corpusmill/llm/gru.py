"""A gated recurrent language model in numpy, with a class-factored softmax.

Word ids: 0 is the end of a text, 1 .. ``words - 1`` the commonest words,
``words`` stands for every other word. Classes hold ``SLOTS`` ids each, by
rank; the other words are one more class, inside which the caller spreads the
probability. So a token costs a softmax over the classes and one inside its
class. Output biases start at the logarithm of the words' shares, and the model
starts as the unigram model.

Texts run in lanes, one after the other in a lane, each from a zero state. A
lane is worked off in windows of ``window`` steps: the state is carried into
the next window, the gradient is not (truncated backpropagation through time).
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN = 16
SLOTS = 64
CLASSES = 24
_NONE = np.float32(-1e4)  # bias of a slot without a word
Params = dict[str, np.ndarray]


def fresh(counts: np.ndarray, other: float, seed: int = 5) -> Params:
    """Parameters for ids with these (smoothed) counts, and of all others."""
    n = len(counts)
    rng = np.random.default_rng(seed)
    full = np.zeros(CLASSES * SLOTS)
    full[:n] = counts
    by_class = full.reshape(CLASSES, SLOTS)
    share = np.append(by_class.sum(axis=1), other)
    with np.errstate(divide="ignore"):
        inside = np.log(by_class) - np.log(np.maximum(by_class.sum(axis=1), 1e-300))[:, None]
        top = np.log(share) - np.log(share.sum())

    def small(*shape):
        return rng.normal(0, 0.1, shape)

    out = {
        "x": small(n + 2, 3 * HIDDEN),  # every id, the other words, the start of a text
        "h": small(HIDDEN, 3 * HIDDEN), "hn": np.zeros(HIDDEN),
        "class_w": np.zeros((HIDDEN, CLASSES + 1)), "class_b": np.maximum(top, _NONE),
        "word_w": np.zeros((CLASSES, HIDDEN, SLOTS)), "word_b": np.maximum(inside, _NONE)}
    return {k: v.astype(np.float32) for k, v in out.items()}


def lanes(texts: list[np.ndarray], widest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, input ids, text index or -1), each steps x lanes, of texts that
    end with 0; longest texts first, each to the shortest lane. The input of a
    text's first step is the start, -1."""
    total, longest = sum(map(len, texts)), max(map(len, texts))
    n = max(1, min(widest, total // longest, len(texts)))
    ends = [(0, k) for k in range(n)]
    parts: list[list[int]] = [[] for _ in range(n)]
    for i in sorted(range(len(texts)), key=lambda i: (-len(texts[i]), i)):
        at, k = heapq.heappop(ends)
        parts[k].append(i)
        heapq.heappush(ends, (at + len(texts[i]), k))
    steps = max(at for at, _ in ends)
    ids, ins = np.zeros((n, steps), np.int32), np.full((n, steps), -1, np.int32)
    owner = np.full((n, steps), -1, np.int32)
    for k, mine in enumerate(parts):
        at = 0
        for i in mine:
            m = len(texts[i])
            ids[k, at:at + m] = texts[i]
            ins[k, at + 1:at + m] = texts[i][:-1]
            owner[k, at:at + m] = i
            at += m
    return np.ascontiguousarray(ids.T), np.ascontiguousarray(ins.T), np.ascontiguousarray(owner.T)


def states(p: Params, ins: np.ndarray, h: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (steps x HIDDEN x lanes) after each step, from ``h``
    (HIDDEN x lanes). A start (-1) sets the state to zero."""
    n = HIDDEN
    x = np.ascontiguousarray(p["x"][ins].transpose(0, 2, 1))
    w, bias = np.ascontiguousarray(p["h"].T), p["hn"][:, None]
    goes_on = (ins >= 0).astype(x.dtype)
    starts = (ins < 0).any(axis=1).tolist()
    out = np.empty((len(ins), n, ins.shape[1]), x.dtype)
    for t in range(len(ins)):
        if starts[t]:
            h = h * goes_on[t]
        a = w @ h
        gates = x[t, :2 * n] + a[:2 * n]  # the sigmoid of u is (1 + tanh(u / 2)) / 2
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates[:n], gates[n:]
        an = a[2 * n:]
        an += bias
        c = r * an
        c += x[t, 2 * n:]
        np.tanh(c, out=c)
        to = out[t]
        np.subtract(h, c, out=to)
        to *= z
        to += c
        if keep is not None:
            keep.append((h, z, r, an, c))
        h = to
    return out


def _softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(exponentials, their sums, logs of the denominators), by columns."""
    top = logits.max(axis=0)
    e = logits - top
    np.exp(e, out=e)
    s = e.sum(axis=0)
    return e, s, np.log(s) + top


def output(p: Params, hidden: np.ndarray, ids: np.ndarray, grad: Params | None = None):
    """(natural log probability of every id, gradient of the mean loss by the
    hidden states), for states in columns. ``grad`` receives the output
    layer's."""
    n, at = len(ids), np.arange(len(ids))
    other = len(p["x"]) - 2
    cls = np.where(ids == other, CLASSES, ids // SLOTS).astype(np.int16)
    order = np.argsort(cls, kind="stable")
    hidden, ids, cls = np.take(hidden, order, axis=1), ids[order], cls[order]
    logits = p["class_w"].T @ hidden
    logits += p["class_b"][:, None]
    prob, total, norm = _softmax(logits)
    out = (logits[cls, at] - norm).astype(np.float64)
    if grad is not None:
        total *= n
        prob /= total
        prob[cls, at] -= logits.dtype.type(1 / n)
        grad["class_w"], grad["class_b"] = hidden @ prob.T, prob.sum(axis=1)
        d = p["class_w"] @ prob
        grad["word_w"], grad["word_b"] = np.zeros_like(p["word_w"]), np.zeros_like(p["word_b"])
    bounds = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
    for c, (i, j) in enumerate(zip(bounds[:-1], bounds[1:])):
        if i == j:
            continue
        h, slot, k = hidden[:, i:j], ids[i:j] - c * SLOTS, at[:j - i]
        logits = p["word_w"][c].T @ h
        logits += p["word_b"][c][:, None]
        prob, total, norm = _softmax(logits)
        out[i:j] += logits[slot, k] - norm
        if grad is not None:
            total *= n
            prob /= total
            prob[slot, k] -= logits.dtype.type(1 / n)
            np.matmul(h, prob.T, out=grad["word_w"][c])
            prob.sum(axis=1, out=grad["word_b"][c])
            d[:, i:j] += p["word_w"][c] @ prob
    back = np.empty_like(out)
    back[order] = out
    if grad is None:
        return back, None
    dh = np.empty_like(d)
    dh[:, order] = d
    return back, dh


def columns(hidden: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The states (steps x HIDDEN x lanes) of the steps in ``mask``, as columns."""
    flat = hidden.transpose(1, 0, 2).reshape(HIDDEN, -1)
    return flat if mask.all() else np.compress(mask.ravel(), flat, axis=1)


def gradient(p: Params, ins: np.ndarray, ids: np.ndarray, mask: np.ndarray, h: np.ndarray):
    """(gradients of the window's mean loss, those of ``x`` for the ids of the
    window only as (ids, rows), state after the window)."""
    keep: list = []
    n, hidden = HIDDEN, states(p, ins, h, keep)
    grad: Params = {}
    _, d = output(p, columns(hidden, mask), ids[mask], grad)
    from_output = np.zeros((n, mask.size), hidden.dtype)
    from_output[:, mask.ravel()] = d
    from_output = np.ascontiguousarray(from_output.reshape(n, *mask.shape).transpose(1, 0, 2))
    dx = np.empty((len(ins), 3 * n, ins.shape[1]), hidden.dtype)
    da = np.empty_like(dx)
    goes_on, back = (ins >= 0).astype(hidden.dtype), np.zeros_like(h)
    for t in range(len(ins) - 1, -1, -1):
        before, z, r, an, c = keep[t]
        d = from_output[t]
        d += back
        dz, dr, dc = dx[t, :n], dx[t, n:2 * n], dx[t, 2 * n:]
        np.subtract(before, c, out=dz)
        dz *= d
        one = 1 - z
        np.multiply(d, one, out=dc)
        one *= z
        dz *= one
        dc *= 1 - c * c
        np.multiply(dc, an, out=dr)
        dr *= r
        dr *= 1 - r
        da[t, :2 * n] = dx[t, :2 * n]
        np.multiply(dc, r, out=da[t, 2 * n:])
        d *= z
        back = p["h"] @ da[t]
        back += d
        back *= goes_on[t]
    flat = da.transpose(1, 0, 2).reshape(3 * n, -1)
    grad["h"] = np.stack([k[0] for k in keep], axis=1).reshape(n, -1) @ flat.T
    grad["hn"] = flat[2 * n:].sum(axis=1)
    which = (ins.ravel() % len(p["x"])).astype(np.int16)  # CLASSES * SLOTS and a few
    order = np.argsort(which, kind="stable")
    first = np.flatnonzero(np.append(True, which[order][1:] != which[order][:-1]))
    rows = np.add.reduceat(dx.transpose(0, 2, 1).reshape(-1, 3 * n)[order], first, axis=0)
    return grad, (which[order][first], rows), hidden[-1]


def step(p: Params, second: Params, grad: Params, rows: tuple[np.ndarray, np.ndarray], rate: float) -> None:
    """One Adagrad step; ``second`` holds the sums of squares."""
    for k, g in grad.items():
        second[k] += g * g
        p[k] -= np.float32(rate) * g / np.sqrt(second[k])
    at, g = rows
    second["x"][at] += g * g
    p["x"][at] -= np.float32(rate) * g / np.sqrt(second["x"][at])


def train(p: Params, second: Params, texts: list[np.ndarray], rate: float, window: int, widest: int) -> int:
    """Work through ``texts`` once, changing ``p`` in place; tokens seen."""
    if not texts:
        return 0
    ids, ins, owner = lanes(texts, widest)
    h = np.zeros((HIDDEN, ids.shape[1]), np.float32)
    for t in range(0, len(ids), window):
        mask = owner[t:t + window] >= 0
        grad, rows, h = gradient(p, ins[t:t + window], ids[t:t + window], mask, h)
        step(p, second, grad, rows, rate)
    return sum(map(len, texts))


def score(p: Params, texts: list[np.ndarray], window: int, widest: int) -> np.ndarray:
    """Natural log probability of every whole text (as ids)."""
    out = np.zeros(len(texts))
    if not texts:
        return out
    ids, ins, owner = lanes(texts, widest)
    h = np.zeros((HIDDEN, ids.shape[1]), np.float32)
    for t in range(0, len(ids), window):
        hidden = states(p, ins[t:t + window], h)
        h, mask = hidden[-1], owner[t:t + window] >= 0
        logp, _ = output(p, columns(hidden, mask), ids[t:t + window][mask])
        out += np.bincount(owner[t:t + window][mask], weights=logp, minlength=len(texts))
    return out
