"""A small causal self-attention model over subword ids, trained and applied in numpy.

One layer: each position attends to the ones before it in its window, with a learned bias for each distance. The
next subword is predicted in two steps, each a softmax over what the position has seen: first its group, then itself
among the group's members. Groups hold subwords that stand next to the same subwords.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass
from pathlib import Path

import numpy as np

#: Positions of a window, and how many of them, the last ones, a following window scores.
WINDOW, STRIDE = 24, 20
WIDTH, GROUPS = 24, 24
BATCH, EPOCHS, RATE = 48, 6, 4e-3
#: Windows that attend at once, and how many of such lots choose their next subwords at once.
SCORED, LOTS = 32, 16


def one_thread() -> None:
    """Keep numpy's BLAS to one thread in this process: Spark's tasks are as many as there are cores."""
    for path in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        limit = getattr(ctypes.CDLL(str(path)), "scipy_openblas_set_num_threads64_", None)
        if limit:
            limit(1)


@dataclass
class Groups:
    """The group of each subword, its place among all members in the order of groups, and where groups begin there."""

    of: np.ndarray
    place: np.ndarray
    edges: np.ndarray


@dataclass
class Model:
    """Weights, and the groups of the subwords."""

    weights: dict[str, np.ndarray]
    groups: Groups


def window_places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over streams of these lengths laid end to end, of which each place but the last predicts the next.

    Returns the places of each window's inputs, whether they exist, and whether the prediction counts: every
    predicting place counts in exactly one window.
    """
    predicting = np.maximum(lengths - 1, 0)
    count = np.where(predicting > 0, 1 + np.maximum(0, -(-(predicting - WINDOW) // STRIDE)), 0)
    first = np.cumsum(lengths) - lengths
    stream = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    inside = number[:, None] * STRIDE + np.arange(WINDOW)[None, :]
    exists = inside < predicting[stream][:, None]
    counts = exists & ((number == 0)[:, None] | (np.arange(WINDOW) >= WINDOW - STRIDE)[None, :])
    places = np.where(exists, first[stream][:, None] + inside, first[stream][:, None])
    return places, exists, counts


def _mask() -> np.ndarray:
    return np.where(np.tri(WINDOW, dtype=bool), 0, -1e9).astype(np.float32)


def _distance() -> np.ndarray:
    i = np.arange(WINDOW)
    return np.maximum(i[:, None] - i[None, :], 0)


def _joint(w: dict[str, np.ndarray]) -> np.ndarray:
    """What an embedding is multiplied with, side by side: for its queries (scaled), keys, values and hidden layer."""
    return np.concatenate([w["q"] * w["q"].dtype.type(1 / np.sqrt(w["q"].shape[1])), w["k"], w["v"], w["own"]], 1)


def _attend(a: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The softmax over the places up to each one, written over the products of queries and keys."""
    if max(a.max(initial=0), -a.min(initial=0)) + np.abs(bias).max() < 60:
        # the causal mask and the distances' bias are factors
        np.exp(a, out=a)
        a *= np.exp(bias[_distance()]) * np.tri(WINDOW, dtype=a.dtype)
    else:
        a += bias[_distance()] + _mask()
        a -= a.max(-1, keepdims=True)
        np.exp(a, out=a)
    a /= (a.reshape(-1, WINDOW) @ np.ones(WINDOW, a.dtype)).reshape(*a.shape[:2], 1)
    return a


def forward(w: dict[str, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, tuple]:
    """What each position has seen (its hidden layer), for windows of ids at once; and what backward() needs."""
    d = w["q"].shape[1]
    x = w["embed"][ids.reshape(-1)]
    p = (x @ _joint(w)).reshape(*ids.shape, -1)
    a = _attend(p[..., :d] @ p[..., d : 2 * d].transpose(0, 2, 1), w["bias"])
    o = (a @ p[..., 2 * d : 3 * d]).reshape(-1, d)
    r = o @ w["seen"]
    r += p.reshape(len(x), -1)[:, 3 * d :]
    r += w["base"]
    np.maximum(r, 0, out=r)
    return r.reshape(*ids.shape, -1), (ids, x, p, a, o, r)


def backward(w: dict[str, np.ndarray], kept: tuple, dr: np.ndarray) -> dict[str, np.ndarray]:
    ids, x, p, a, o, r = kept
    d = w["q"].shape[1]
    q, k, v = (p[..., n * d : (n + 1) * d] for n in range(3))
    of_p = np.empty_like(p)
    flat = of_p.reshape(len(x), -1)
    dh = flat[:, 3 * d :]
    np.multiply(dr.reshape(r.shape), r > 0, out=dh)
    g = {"seen": o.T @ dh, "base": np.ones(len(dh), dh.dtype) @ dh}
    do = dh @ w["seen"].T
    # what all of a place's attention has in common is its product with what it saw
    common = ((do * o) @ np.ones(d, o.dtype)).reshape(*ids.shape, 1)
    do = do.reshape(*ids.shape, d)
    ds = do @ v.transpose(0, 2, 1)
    ds -= common
    ds *= a
    np.matmul(ds, k, out=of_p[..., :d])
    np.matmul(ds.transpose(0, 2, 1), q, out=of_p[..., d : 2 * d])
    np.matmul(a.transpose(0, 2, 1), do, out=of_p[..., 2 * d : 3 * d])
    g["bias"] = np.bincount(_distance().reshape(-1), ds.sum(0).reshape(-1), WINDOW).astype(ds.dtype)
    both = x.T @ flat
    g |= {"q": both[:, :d] * both.dtype.type(1 / np.sqrt(d)), "k": both[:, d : 2 * d], "v": both[:, 2 * d : 3 * d], "own": both[:, 3 * d :]}
    dx = flat @ _joint(w).T
    cells = ids.reshape(-1, 1) * d + np.arange(d)
    g["embed"] = np.bincount(cells.reshape(-1), dx.reshape(-1), w["embed"].size).reshape(-1, d).astype(dx.dtype)
    return g


def _logs(z: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The logs of the targets' probabilities, and each row's divisor of exp(z), which stands in the place of z."""
    if not abs(z.max(initial=0)) < 80:
        z -= z.max(1, keepdims=True)
    chosen = z[np.arange(len(z)), target]
    np.exp(z, out=z)
    total = z @ np.ones(z.shape[1], z.dtype)
    return chosen - np.log(total), total


def choose(w: dict[str, np.ndarray], groups: Groups, r: np.ndarray, target: np.ndarray, scale: float | np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None, dict[str, np.ndarray]]:
    """The log of each target's probability after its hidden layer; given a scale, one for all or each its own, also the loss's gradients."""
    held = np.ones((len(r), r.shape[1] + 1), r.dtype)
    held[:, :-1] = r
    return _choose(w, groups, held, target, scale)


def _choose(w: dict[str, np.ndarray], groups: Groups, held: np.ndarray, target: np.ndarray, scale: float | np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None, dict[str, np.ndarray]]:
    """The same of hidden layers with a column of ones, so that products include what is added."""
    n, width = len(held), held.shape[1] - 1
    of = groups.of[target]
    order = np.argsort(of.astype(np.int16), kind="stable")
    of, target = of[order], target[order]
    held = held[order]
    first, then = np.concatenate([w["out"], w["prior"][None]]), np.concatenate([w["member"], w["usual"][None]])
    z = held @ first
    logs, total = _logs(z, of)
    edges = groups.edges.tolist()
    bounds = np.searchsorted(of, np.arange(len(edges))).tolist()
    place = groups.place[target] - groups.edges[of]
    parts = [(slice(bounds[k], bounds[k + 1]), slice(edges[k], edges[k + 1])) for k in range(len(edges) - 1) if bounds[k] < bounds[k + 1]]
    back = np.empty_like(order)
    back[order] = np.arange(n)
    if scale is None:
        for rows, own in parts:
            logs[rows] += _logs(held[rows] @ then[:, own], place[rows])[0]
        return logs[back], None, {}
    scale = np.broadcast_to(scale, n)[order].astype(held.dtype)
    z *= (scale / total)[:, None]
    z[np.arange(n), of] -= scale
    both = held.T @ z
    g = {"out": both[:width], "prior": both[width]}
    dr = z @ w["out"].T
    # the members' rows of all groups end to end, so that all but the products is done for all at once
    sizes = np.diff(groups.edges)[of]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    z = np.empty(int(sizes.sum()), held.dtype)
    pieces = [z[starts[rows.start] : ends[rows.stop - 1]].reshape(-1, own.stop - own.start) for rows, own in parts]
    for (rows, own), piece in zip(parts, pieces, strict=True):
        np.matmul(held[rows], then[:, own], out=piece)
    if not abs(z.max(initial=0)) < 80:
        z -= np.repeat(np.maximum.reduceat(z, starts), sizes)
    at = starts + place
    chosen = z[at]
    np.exp(z, out=z)
    total = np.add.reduceat(z, starts)
    logs += chosen - np.log(total)
    z *= np.repeat(scale / total, sizes)
    z[at] -= scale
    both = np.zeros_like(then)
    for (rows, own), piece in zip(parts, pieces, strict=True):
        np.matmul(held[rows].T, piece, out=both[:, own])
        dr[rows] += piece @ w["member"][:, own].T
    return logs[back], dr[back], g | {"member": both[:width], "usual": both[width]}


def subword_groups(stream: np.ndarray, n: int, groups: int, rounds: int = 15) -> Groups:
    """Groups of the subwords below n by what they follow and precede in a stream; those not in it are dealt in turn."""
    return pair_groups(np.bincount(stream, minlength=n), np.bincount(stream[:-1] * n + stream[1:], minlength=n * n).reshape(n, n), groups, rounds)


def pair_groups(counts: np.ndarray, pairs: np.ndarray, groups: int, rounds: int = 15) -> Groups:
    """The same by how often each subword comes, and how often it (a row) comes before each other one (a column)."""
    n, counts = len(counts), counts.astype(np.float64)
    order = np.argsort(-counts, kind="stable")
    seen = order[: int((counts > 0).sum())]
    marks = np.full(n, 255)
    marks[order[:255]] = np.arange(min(n, 255))
    mark = np.zeros((n, 256))
    mark[np.arange(n), marks] = 1
    around = np.concatenate([pairs.T @ mark, pairs @ mark], 1)
    around = np.sqrt(around[seen] / np.maximum(around[seen].sum(1, keepdims=True), 1))
    m = min(groups, len(seen))
    centres = around[np.linspace(0, min(len(seen), 8 * m) - 1, m).astype(int)]
    for _ in range(rounds):
        near = (around @ centres.T - (centres**2).sum(1) / 2).argmax(1)
        for c in range(m):
            if (near == c).any():
                centres[c] = np.average(around[near == c], axis=0, weights=counts[seen[near == c]])
    near = np.unique(near, return_inverse=True)[1]
    of = np.empty(n, np.int64)
    of[seen], of[order[len(seen) :]] = near, np.arange(n - len(seen)) % (near.max() + 1)
    place = np.empty(n, np.int64)
    place[np.argsort(of, kind="stable")] = np.arange(n)
    return Groups(of, place, np.concatenate([[0], np.cumsum(np.bincount(of))]))


class Trainer:
    """Weights that learn by Adam from batches of windows."""

    def __init__(self, weights: dict[str, np.ndarray], groups: Groups):
        ends = np.cumsum([v.size for v in weights.values()])
        # all weights end to end; what goes by name are views of them
        self._all, self._grads, self._first, self._second, self._passing = (np.zeros(ends[-1], np.float32) for _ in range(5))
        views = lambda flat: {k: flat[e - v.size : e].reshape(v.shape) for (k, v), e in zip(weights.items(), ends, strict=True)}
        self.w, self._by_name, self.first, self.second = (views(x) for x in (self._all, self._grads, self._first, self._second))
        self.groups, self.steps = groups, 0
        for k, v in weights.items():
            self.w[k][...] = v

    def learn(self, whole: np.ndarray, places: np.ndarray, exists: np.ndarray, rate: float, times: np.ndarray | None = None) -> None:
        """One step on windows of the ids `whole`, each of which counts once or so many times."""
        r, kept = forward(self.w, whole[places])
        dr = np.zeros_like(r)
        weight = exists[exists] if times is None else np.broadcast_to(times[:, None], exists.shape)[exists]
        _, dr[exists], grads = choose(self.w, self.groups, r[exists], whole[places[exists] + 1], weight / max(1, weight.sum()))
        self.steps += 1
        rate *= min(1, self.steps / 50)
        for k, g in (grads | backward(self.w, kept, dr)).items():
            self._by_name[k][...] = g
        g, t = self._grads, self._passing
        np.subtract(g, self._first, out=t)
        t *= np.float32(0.1)
        self._first += t
        np.multiply(g, g, out=t)
        t -= self._second
        t *= np.float32(0.01)
        self._second += t
        np.multiply(self._second, np.float32(1 / (1 - 0.99**self.steps)), out=t)
        np.sqrt(t, out=t)
        t += np.float32(1e-8)
        np.divide(self._first, t, out=t)
        t *= np.float32(rate / (1 - 0.9**self.steps))
        self._all -= t


def train(streams: list[np.ndarray], n: int, seed: int = 4, epochs: int | None = None, pairs: np.ndarray | None = None) -> Model:
    """A model of streams of subword ids below n; before its first step it gives each subword its share in them.

    Given pairs, how often each subword comes before each other one, the shares and groups are theirs instead.
    """
    one_thread()
    epochs = EPOCHS if epochs is None else epochs
    whole = np.concatenate(streams)
    groups = subword_groups(whole, n, GROUPS) if pairs is None else pair_groups(pairs.sum(0), pairs, GROUPS)
    smooth = (np.bincount(whole, minlength=n) if pairs is None else pairs.sum(0)) + 0.05
    totals = np.bincount(groups.of, smooth)
    rng = np.random.default_rng(seed)
    d = WIDTH
    shapes = {"embed": (n, d), "q": (d, d), "k": (d, d), "v": (d, d), "own": (d, 2 * d), "seen": (d, 2 * d), "out": (2 * d, len(totals)), "member": (2 * d, n)}
    w = {k: (rng.standard_normal(s) * (0.5 if k == "embed" else 1 / np.sqrt(s[0]))).astype(np.float32) for k, s in shapes.items()}
    w["member"] *= np.float32(0.2)
    w |= {"bias": np.linspace(0.5, -0.5, WINDOW).astype(np.float32), "base": np.zeros(2 * d, np.float32)}
    w |= {"prior": np.log(totals / totals.sum()).astype(np.float32), "usual": np.empty(n, np.float32)}
    w["usual"][groups.place] = np.log(smooth / totals[groups.of])
    places, exists, _ = window_places(np.array([len(s) for s in streams]))
    trainer, steps = Trainer(w, groups), epochs * -(-len(places) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(places))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            trainer.learn(whole, places[some], exists[some], RATE * (1 - 0.95 * trainer.steps / steps))
    return Model(trainer.w, groups)


def tune(trainer: Trainer, streams: list[np.ndarray], times: np.ndarray) -> int:
    """One pass over more streams, which stand for so many each, at the rate that training ended with, doubled; returns the number of windows."""
    whole, lengths = np.concatenate(streams), np.array([len(s) for s in streams])
    places, exists, _ = window_places(lengths)
    times = times[np.searchsorted(np.cumsum(lengths), places[:, 0], "right")]
    for at in range(0, len(places), BATCH):
        trainer.learn(whole, places[at : at + BATCH], exists[at : at + BATCH], RATE * 0.1, times[at : at + BATCH])
    return len(places)


def packed(weights: dict[str, np.ndarray]) -> np.ndarray:
    """All weights end to end, by name."""
    return np.concatenate([weights[k].reshape(-1) for k in sorted(weights)]).astype(np.float64)


def unpacked(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def score(model: Model, stream: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each id of streams laid end to end the log of its probability after those before it; 0 for each first id.

    The same sums as forward(), with fewer passes: the causal mask and the distances' bias are factors of the
    attention, and its divisor is one more column of the values.
    """
    w, out = model.weights, np.zeros(len(stream), np.float32)
    places, _, counts = window_places(lengths)
    d = WIDTH
    joint = np.concatenate([w["q"] * np.float32(1 / np.sqrt(d)), w["k"], w["v"], np.zeros((d, 1), np.float32), w["own"]], 1)
    table = w["embed"] @ joint  # what an id brings to its queries, keys, values and hidden layer
    table[:, 3 * d] = 1
    near = np.exp(w["bias"][_distance()]) * np.tri(WINDOW, dtype=np.float32)
    held, filled = np.ones((LOTS * SCORED * WINDOW, 2 * d + 1), np.float32), 0
    following: list[np.ndarray] = []
    for at in range(0, len(places), SCORED):
        p, c = places[at : at + SCORED], counts[at : at + SCORED]
        x = table[stream[p]]
        a = x[..., :d] @ x[..., d : 2 * d].transpose(0, 2, 1)
        np.minimum(a, 60, out=a)
        np.exp(a, out=a)
        a *= near
        o = a @ x[..., 2 * d : 3 * d + 1]
        o, h = o[c], x[..., 3 * d + 1 :][c]
        h += (o[:, :d] / o[:, d:]) @ w["seen"]
        h += w["base"]
        np.maximum(h, 0, out=held[filled : filled + len(h), :-1])
        filled += len(h)
        following.append(p[c] + 1)
        if len(following) == LOTS or at + SCORED >= len(places):
            nxt = np.concatenate(following)
            out[nxt] = _choose(w, model.groups, held[:filled], stream[nxt], None)[0]
            filled, following = 0, []
    return out
