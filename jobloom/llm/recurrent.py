"""A small gated recurrent language model in numpy, with a class-factored softmax.

Symbols are numbered by falling frequency, after 0 for all words outside the vocabulary and 1 for the end of a text.
A symbol's probability is that of its class times its own within the class, so a step costs a class softmax and one of
``members`` symbols, not one over the vocabulary.  Symbol 0 is a class by itself.

Texts run side by side in lanes, several to a lane, one symbol a step.  The state is carried through a text from window
to window and cleared where the next one starts; gradients end at a window's first step (truncated backpropagation).
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

RARE, END = 0, 1
#: Output weights and biases stay within this; states lie between -1 and 1, so logits stay below 17 times as much.
_BOUND = 4.0


@dataclass(frozen=True)
class Shape:
    """Sizes of a net: ``1 + (classes - 1) * members`` symbols at most, ``hidden`` units."""

    hidden: int = 16
    classes: int = 32
    members: int = 96

    @property
    def symbols(self) -> int:
        return 1 + (self.classes - 1) * self.members


def new_net(shape: Shape, counts: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """Random weights; output biases make the net start as the frequencies ``counts`` of the symbols."""
    rng = np.random.default_rng(seed)
    full = np.zeros(shape.symbols)
    full[: len(counts)] = counts
    rest = full[1:].reshape(shape.classes - 1, shape.members)
    h, scale = shape.hidden, 0.3 / np.sqrt(shape.hidden)
    net = {
        "inputs": rng.normal(0, 0.1, (shape.symbols + 1, 3 * h)),  # the last row begins a text
        "state": rng.normal(0, scale, (h, 3 * h)),
        "class_w": rng.normal(0, scale, (h, shape.classes)),
        "class_b": np.log(np.concatenate([full[:1], rest.sum(axis=1)]) + 1),
        "word_w": rng.normal(0, scale, (shape.classes - 1, h, shape.members)),
        "word_b": np.log(rest + 1e-3),
    }
    for k in ("class_b", "word_b"):
        net[k] = np.maximum(net[k] - net[k].max(axis=-1, keepdims=True), -20)
    return {k: v.astype(np.float32) for k, v in net.items()}


def packed(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in sorted(net)])


def unpacked(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    ends = np.cumsum([like[k].size for k in sorted(like)])
    return {k: part.reshape(like[k].shape).copy() for k, part in zip(sorted(like), np.split(flat, ends[:-1]), strict=True)}


def lanes(texts: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Texts dealt to lanes, each to the one with the least symbols so far: targets, begins and lane lengths.

    Lanes are rows, longest first; the last result is the lane and the place of each text.
    """
    loads = [(0, i) for i in range(min(width, max(1, len(texts))))]
    held = [[] for _ in loads]
    spot = [None] * len(texts)
    for t in sorted(range(len(texts)), key=lambda t: -len(texts[t])):
        load, lane = heapq.heappop(loads)
        spot[t] = (lane, load)
        held[lane].append(t)
        heapq.heappush(loads, (load + len(texts[t]), lane))
    length = np.zeros(len(held), np.int64)
    for load, lane in loads:
        length[lane] = load
    order = np.argsort(-length, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    length = length[order]
    target = np.zeros((len(held), int(length.max(initial=0))), np.uint16)
    begin = np.zeros(target.shape, bool)
    for row, lane in enumerate(order.tolist()):
        if held[lane]:
            line = np.concatenate([texts[t] for t in held[lane]])
            target[row, : len(line)] = line
            begin[row, [spot[t][1] for t in held[lane]]] = True
    return target, begin, length, [(int(rank[lane]), at) for lane, at in spot]


def _softmax(logits: np.ndarray, target: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of the targets, and all exponentials with their row sums taken out (in place).

    Weights are kept within bounds (``_BOUND``), so no exponential overflows and rows need no shift.
    """
    own = logits[n, target]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], np.float32)
    return own - np.log(total), total


def _output(net, states, target, live, grads):
    """Natural-log probabilities of the targets given the states; with ``grads`` also the states' gradients."""
    members = net["word_b"].shape[1]
    cls = (target.astype(np.int64) - 1) // members + 1
    cls[target == RARE] = 0
    n = np.arange(len(target))
    p = states @ net["class_w"]
    p += net["class_b"]
    logp, total = _softmax(p, cls, n)
    back = None
    if grads is not None:
        p *= (live / total)[:, None]
        p[n, cls] -= live
        grads["class_w"] += states.T @ p
        grads["class_b"] += p.sum(axis=0)
        back = p @ net["class_w"].T
    chosen = np.flatnonzero(live & (cls > 0))
    chosen = chosen[np.argsort(cls[chosen].astype(np.uint8), kind="stable")]
    edges = np.searchsorted(cls[chosen], np.arange(1, len(net["word_b"]) + 2)).tolist()
    for c in range(len(net["word_b"])):
        if edges[c] == edges[c + 1]:
            continue
        at = chosen[edges[c] : edges[c + 1]]
        state, own, k = states[at], target[at].astype(np.int64) - 1 - c * members, n[: len(at)]
        p = state @ net["word_w"][c]
        p += net["word_b"][c]
        found, total = _softmax(p, own, k)
        logp[at] += found
        if grads is not None:
            p /= total[:, None]
            p[k, own] -= 1
            grads["word_w"][c] += state.T @ p
            grads["word_b"][c] += p.sum(axis=0)
            back[at] += p @ net["word_w"][c].T
    return logp, back


def window(net, before, target, begin, live, h, grads=None):
    """One window of steps (rows) by lanes: log probabilities, the state after it, and gradients added to ``grads``."""
    steps, width = target.shape
    size = net["state"].shape[0]
    gate = net["inputs"][before]  # steps, lanes, 3 * hidden
    state, fixed = net["state"], ~begin
    # A sigmoid is half a tanh of half the argument, so halve what goes in.
    kept, resets, candidates, mixed, states = (np.empty((steps, width, size), np.float32) for _ in range(5))
    starts = np.empty((steps, width, size), np.float32)
    for t in range(steps):
        h = h * fixed[t][:, None]
        starts[t] = h
        a = h @ state
        zr = gate[t, :, : 2 * size] + a[:, : 2 * size]
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr += 1
        zr *= 0.5
        z, r, m = zr[:, :size], zr[:, size:], a[:, 2 * size :]
        c = r * m
        c += gate[t, :, 2 * size :]
        np.tanh(c, out=c)
        kept[t], resets[t], candidates[t], mixed[t] = z, r, c, m
        h = h - c
        h *= z
        h += c
        states[t] = h
    flat = states.reshape(-1, size)
    logp, back = _output(net, flat, target.ravel(), live.ravel(), grads)
    if grads is None:
        return logp.reshape(steps, width), h
    back = back.reshape(steps, width, size)
    d_gate = np.empty((steps, width, 3 * size), np.float32)
    d_state = np.empty((steps, width, 3 * size), np.float32)
    turned = np.ascontiguousarray(state.T)
    dh = np.zeros((width, size), np.float32)
    for t in range(steps - 1, -1, -1):
        dh += back[t]
        z, r, c = kept[t], resets[t], candidates[t]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (starts[t] - c) * z * (1 - z)
        dr = dc * mixed[t] * r * (1 - r)
        d_gate[t, :, :size] = d_state[t, :, :size] = dz
        d_gate[t, :, size : 2 * size] = d_state[t, :, size : 2 * size] = dr
        d_gate[t, :, 2 * size :] = dc
        d_state[t, :, 2 * size :] = dc * r
        dh *= z
        dh += d_state[t] @ turned
        dh *= fixed[t][:, None]
    grads["state"] += starts.reshape(-1, size).T @ d_state.reshape(-1, 3 * size)
    ids = before.ravel()
    order = np.argsort(ids, kind="stable")
    sorted_ids = ids[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
    grads["inputs"][sorted_ids[first]] += np.add.reduceat(d_gate.reshape(-1, 3 * size)[order], first, axis=0)
    return logp.reshape(steps, width), h


def windows(dealt: tuple, symbols: int, steps: int):
    """The windows of ``lanes`` from left to right: first step, live lanes, before, target, begin, live; steps are rows."""
    target, begin, length, _ = dealt
    before = np.empty(target.shape, np.uint16)
    before[:, 1:] = target[:, :-1]
    before[begin] = symbols
    for lo in range(0, target.shape[1], steps):
        n = int(np.searchsorted(-length, -lo))
        cut = np.s_[:n, lo : lo + steps]
        live = np.arange(lo, lo + before[cut].shape[1])[:, None] < length[:n]
        yield lo, n, *(np.ascontiguousarray(part[cut].T) for part in (before, target, begin)), live


def train(net: dict, texts: list[np.ndarray], sums: dict, *, rate: float = 0.2, width: int = 512, steps: int = 16, piece: int = 1024) -> None:
    """One pass over all of ``texts``; changes ``net`` and the squared-gradient sums ``sums`` (Adagrad).

    Long texts are cut to pieces that begin anew, so that lanes end together.
    """
    pieces = [t[i : i + piece] for t in texts for i in range(0, len(t), piece)]
    h = np.zeros((width, net["state"].shape[0]), np.float32)
    for _, n, before, target, begin, live in windows(lanes(pieces, width), len(net["inputs"]) - 1, steps):
        grads = {k: np.zeros_like(v) for k, v in net.items()}
        _, h = window(net, before, target, begin, live, h[:n], grads)
        for k, g in grads.items():
            sums[k] += g * g
            net[k] -= rate * g / np.sqrt(sums[k])
        for k in ("class_w", "word_w"):
            np.clip(net[k], -_BOUND, _BOUND, out=net[k])


def log_probabilities(net: dict, texts: list[np.ndarray], *, width: int = 512, steps: int = 32, cells: int = 1 << 24) -> np.ndarray:
    """Natural-log probability of each whole text, its end included.

    Texts too long for ``width`` lanes within ``cells`` run in fewer lanes, at worst one by one.
    """
    found = np.zeros(len(texts))
    waiting = sorted(range(len(texts)), key=lambda t: -len(texts[t]))
    while waiting:
        lanes_here = max(1, min(width, cells // max(1, len(texts[waiting[0]]))))
        count = len(waiting) if lanes_here == width else lanes_here
        now, waiting = waiting[:count], waiting[count:]
        found[now] = _scored(net, [texts[t] for t in now], lanes_here, steps)
    return found


def _scored(net: dict, texts: list[np.ndarray], width: int, steps: int) -> np.ndarray:
    dealt = lanes(texts, width)
    of_text = np.zeros(dealt[0].shape, np.int32)
    for t, (lane, at) in enumerate(dealt[3]):
        of_text[lane, at : at + len(texts[t])] = t
    found = np.zeros(len(texts))
    h = np.zeros((width, net["state"].shape[0]), np.float32)
    for lo, n, before, target, begin, live in windows(dealt, len(net["inputs"]) - 1, steps):
        logp, h = window(net, before, target, begin, live, h[:n])
        found += np.bincount(of_text[:n, lo : lo + steps].T[live], weights=logp[live], minlength=len(texts))
    return found
