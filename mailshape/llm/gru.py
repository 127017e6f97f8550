"""A gated recurrent language model in numpy with a class-factored output.

Texts are token streams laid side by side in lanes. A window of steps is run for all lanes at once and
the hidden state is carried to the next window; it is cleared where a new text begins. Training cuts
the gradient at window ends.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
WINDOW = 16
SCORE_WINDOW = 64
# Training begins anew after so many steps of a text, so that lanes are of like length.
TRAIN_STEPS = 1024


@dataclass(frozen=True)
class Classes:
    """Output symbols in classes: ``of[symbol]`` is its class, members of a class lie side by side in
    ``order`` from ``first[class]`` to ``first[class + 1]``, ``place[symbol]`` is a symbol's place."""

    of: np.ndarray
    order: np.ndarray
    first: np.ndarray
    place: np.ndarray

    @staticmethod
    def by_frequency(counts: np.ndarray, classes: int, alone: int) -> "Classes":
        """Symbols by falling count in ``classes`` runs of near-equal sums of square roots; the last
        ``alone`` symbols are a class of their own each."""
        head = len(counts) - alone
        mass = np.cumsum(np.sqrt(np.maximum(counts[:head], 1e-9)))
        of = np.minimum((mass - 1e-9) / (mass[-1] if head else 1) * classes, classes - 1).astype(int)
        # Numbers without members are closed up.
        of = np.concatenate([np.unique(of, return_inverse=True)[1] if head else of,
                             np.arange(alone)])
        if head:
            of[head:] += of[:head].max() + 1
        order = np.argsort(of, kind="stable")
        first = np.searchsorted(of[order], np.arange(of.max() + 2))
        place = np.empty(len(of), dtype=np.int64)
        place[order] = np.arange(len(of))
        return Classes(of, order, first, place)


def initial(counts: np.ndarray, classes: Classes, hidden: int = HIDDEN, seed: int = 0) -> dict:
    """Small random weights; output biases give the frequencies of classes and members."""
    rng = np.random.default_rng(seed)
    symbols, n_classes = len(counts), len(classes.first) - 1
    smooth = counts + 0.5
    by_class = np.bincount(classes.of, smooth, n_classes)
    small = lambda *shape: (rng.normal(size=shape) * 0.1).astype(np.float32)
    return {
        "x": small(symbols, 3 * hidden), "u": small(hidden, 3 * hidden),
        "c": np.zeros((hidden, n_classes), np.float32),
        "cb": np.log(by_class / by_class.sum()).astype(np.float32),
        "w": np.zeros((symbols, hidden), np.float32),
        "wb": np.log(smooth / by_class[classes.of])[classes.order].astype(np.float32)}


def lanes(texts: list[np.ndarray], width: int):
    """``(targets, starts, text)`` of shape (steps, width): every text whole in one lane, longest
    first to the shortest lane; ``text`` is -1 where a lane has ended."""
    filled = [(0, lane) for lane in range(width)]
    members: list[list[int]] = [[] for _ in range(width)]
    for i in sorted(range(len(texts)), key=lambda i: (-len(texts[i]), i)):
        size, lane = heapq.heappop(filled)
        members[lane].append(i)
        heapq.heappush(filled, (size + len(texts[i]), lane))
    steps = max(size for size, _ in filled)
    targets = np.zeros((steps, width), dtype=np.int32)
    starts = np.zeros((steps, width), dtype=bool)
    text = np.full((steps, width), -1, dtype=np.int32)
    for lane, held in enumerate(members):
        at = 0
        for i in held:
            end = at + len(texts[i])
            targets[at:end, lane] = texts[i]
            text[at:end, lane] = i
            starts[at, lane] = True
            at = end
    return targets, starts, text


def _step(p: dict, x: np.ndarray, h: np.ndarray):
    n = h.shape[1]
    u = h @ p["u"]
    gates = x[:, :2 * n] + u[:, :2 * n]
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    keep, reset = gates[:, :n], gates[:, n:]
    new = np.tanh(x[:, 2 * n:] + reset * u[:, 2 * n:])
    return new + keep * (h - new), keep, reset, new, u[:, 2 * n:]


def _log_softmax_at(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    top = logits.max(axis=1)
    logits -= top[:, None]
    chosen = logits[np.arange(len(at)), at]
    return chosen - np.log(np.exp(logits, out=logits).sum(axis=1))


def _by_class(classes: Classes, targets: np.ndarray):
    """Rows with a class of two or more members: ``(class, rows, place within the class)``."""
    of = classes.of[targets]
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(len(classes.first)))
    for c in np.flatnonzero(np.diff(bounds) > 0):
        if classes.first[c + 1] - classes.first[c] > 1:
            rows = order[bounds[c]:bounds[c + 1]]
            yield int(c), rows, classes.place[targets[rows]] - classes.first[c]


def log_chances(p: dict, classes: Classes, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target symbol after each state."""
    found = _log_softmax_at(states @ p["c"] + p["cb"], classes.of[targets]).astype(np.float64)
    weights = p["w"][classes.order]
    for c, rows, at in _by_class(classes, targets):
        part = slice(classes.first[c], classes.first[c + 1])
        found[rows] += _log_softmax_at(states[rows] @ weights[part].T + p["wb"][part], at)
    return found


def score(p: dict, classes: Classes, texts: list[np.ndarray], width: int = 256) -> np.ndarray:
    """Natural log likelihood of each whole text, its state carried from window to window."""
    total = np.zeros(len(texts))
    if not texts:
        return total
    longest, every = max(map(len, texts)), sum(map(len, texts))
    targets, starts, text = lanes(texts, int(np.clip(every // max(longest, 1), 1, width)))
    h = np.zeros((targets.shape[1], p["u"].shape[0]), dtype=np.float32)
    end = np.full((1, targets.shape[1]), END, dtype=np.int32)
    before = np.concatenate([end, targets[:-1]])
    for first in range(0, len(targets), SCORE_WINDOW):
        part = slice(first, first + SCORE_WINDOW)
        states = np.empty((len(targets[part]), *h.shape), dtype=np.float32)
        for t in range(len(states)):
            h[starts[first + t]] = 0
            # Inputs: the symbol before; at a text's start that is the end of the one before it.
            h = _step(p, p["x"][np.where(starts[first + t], END, before[first + t])], h)[0]
            states[t] = h
        live = text[part] >= 0
        chances = log_chances(p, classes, states[live], targets[part][live])
        total += np.bincount(text[part][live], chances, len(texts))
    return total


# Every text ends with symbol 0, which also stands before its first word.
END = 0


def window_gradient(p: dict, classes: Classes, h: np.ndarray, inputs: np.ndarray,
                    starts: np.ndarray, targets: np.ndarray, live: np.ndarray):
    """Loss (sum of -log p), its gradient, and the state after the window.

    The state ``h`` that comes in is a constant. Gradients of ``x`` and ``w`` are given for the rows
    in use only: ``(rows, values)``.
    """
    steps, n = len(inputs), h.shape[1]
    kept, states = [], np.empty((steps, *h.shape), dtype=p["u"].dtype)
    for t in range(steps):
        before = np.where(starts[t][:, None], 0, h).astype(p["u"].dtype)
        h, keep, reset, new, un = _step(p, p["x"][inputs[t]], before)
        kept.append((before, keep, reset, new, un))
        states[t] = h
    flat, wanted = states[live], targets[live]
    grad = {"u": np.zeros_like(p["u"])}
    logits = flat @ p["c"] + p["cb"]
    logits -= logits.max(axis=1)[:, None]
    chance = np.exp(logits)
    chance /= chance.sum(axis=1)[:, None]
    rows = np.arange(len(wanted))
    of = classes.of[wanted]
    loss = -np.log(np.maximum(chance[rows, of], 1e-30)).sum()
    chance[rows, of] -= 1
    grad["c"], grad["cb"] = flat.T @ chance, chance.sum(axis=0)
    d_flat = chance @ p["c"].T
    grad["wb"] = np.zeros_like(p["wb"])
    w_rows, w_parts = [], []
    for c, rows, at in _by_class(classes, wanted):
        part = slice(classes.first[c], classes.first[c + 1])
        symbols = classes.order[part]
        weights = p["w"][symbols]
        logits = flat[rows] @ weights.T + p["wb"][part]
        logits -= logits.max(axis=1)[:, None]
        chance = np.exp(logits)
        chance /= chance.sum(axis=1)[:, None]
        each = np.arange(len(rows))
        loss -= np.log(np.maximum(chance[each, at], 1e-30)).sum()
        chance[each, at] -= 1
        grad["wb"][part] = chance.sum(axis=0)
        w_rows.append(symbols)
        w_parts.append(chance.T @ flat[rows])
        d_flat[rows] += chance @ weights
    grad["w"] = (np.concatenate(w_rows), np.concatenate(w_parts)) if w_rows else (
        np.zeros(0, dtype=np.int64), np.zeros((0, n), dtype=p["w"].dtype))
    d_states = np.zeros_like(states)
    d_states[live] = d_flat
    d_x = np.empty((steps, h.shape[0], 3 * n), dtype=p["u"].dtype)
    d_h = np.zeros_like(h)
    for t in range(steps - 1, -1, -1):
        before, keep, reset, new, un = kept[t]
        d_h = d_h + d_states[t]
        d_new = d_h * (1 - keep) * (1 - new * new)
        d_keep = d_h * (before - new) * keep * (1 - keep)
        d_reset = d_new * un * reset * (1 - reset)
        d_x[t] = np.concatenate([d_keep, d_reset, d_new], axis=1)
        d_u = np.concatenate([d_keep, d_reset, d_new * reset], axis=1)
        grad["u"] += before.T @ d_u
        d_h = np.where(starts[t][:, None], 0, d_h * keep + d_u @ p["u"].T)
    used, back = np.unique(inputs, return_inverse=True)
    sums = np.zeros((len(used), 3 * n), dtype=p["x"].dtype)
    np.add.at(sums, back.ravel(), d_x.reshape(-1, 3 * n))
    grad["x"] = (used, sums)
    return float(loss), grad, h


class AdaGrad:
    """Updates in place; sparse gradients touch their rows only."""

    def __init__(self, p: dict, rate: float = 0.05):
        self.rate = rate
        self.seen = {k: np.full_like(v, 1e-2) for k, v in p.items()}

    def update(self, p: dict, grad: dict) -> None:
        for k, g in grad.items():
            if isinstance(g, tuple):
                rows, g = g
                self.seen[k][rows] += g * g
                p[k][rows] -= self.rate * g / np.sqrt(self.seen[k][rows])
            else:
                self.seen[k] += g * g
                p[k] -= self.rate * g / np.sqrt(self.seen[k])


def train(p: dict, classes: Classes, texts: list[np.ndarray], optimiser: AdaGrad, width: int = 128,
          window: int = WINDOW) -> tuple[float, int]:
    """One pass over the texts, changing ``p``; loss and number of tokens."""
    if not texts:
        return 0.0, 0
    texts = [t[i:i + TRAIN_STEPS] for t in texts for i in range(0, len(t), TRAIN_STEPS)]
    longest, every = max(map(len, texts)), sum(map(len, texts))
    targets, starts, text = lanes(texts, int(np.clip(every // max(longest, 1), 1, width)))
    h = np.zeros((targets.shape[1], p["u"].shape[0]), dtype=p["u"].dtype)
    end = np.full((1, targets.shape[1]), END, dtype=np.int32)
    inputs = np.where(starts, END, np.concatenate([end, targets[:-1]]))
    loss = 0.0
    for first in range(0, len(targets), window):
        part = slice(first, first + window)
        value, grad, h = window_gradient(p, classes, h, inputs[part], starts[part], targets[part],
                                         text[part] >= 0)
        loss += value
        optimiser.update(p, grad)
    return loss, every
