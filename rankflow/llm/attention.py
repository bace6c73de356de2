"""A small causal self-attention model over subword ids, in numpy.

It predicts the class of the next id: the most frequent ids are classes of
their own, the others are clustered by what stands before and after them. An
id's share of its class, given the context class of the id before (more ids are
of their own there, as that costs a look-up only), is a count, see
``lm_scoring``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SINGLES, CLUSTERS = 64, 63
CLASSES = SINGLES + CLUSTERS + 1  # the last one for ids that the training rows lack
CONTEXT_IDS = 192  # ids that are a context class of their own
CONTEXTS = CONTEXT_IDS + CLASSES
INPUTS = 1024  # frequent ids with an embedding of their own; others share their class's
DIM, HIDDEN = 24, 48
HALF = 32  # positions scored in a window; as many more are context only
SPAN = 2 * HALF


def classes_of(counts: np.ndarray, before: np.ndarray, after: np.ndarray, seed: int = 0) -> np.ndarray:
    """A class for each id. ``counts``: of each id; ``before``, ``after``: by id
    (rows), how often each of some frequent ids stands there."""
    out = np.full(len(counts), CLASSES - 1, np.int64)
    order = np.argsort(-counts, kind="stable")
    seen = order[: np.count_nonzero(counts)]
    out[seen[:SINGLES]] = np.arange(len(seen[:SINGLES]))
    rest = seen[SINGLES:]
    if len(rest) <= CLUSTERS:
        out[rest] = SINGLES + np.arange(len(rest))
        return out
    share = lambda m: np.sqrt((m[rest] + 0.01) / (m[rest] + 0.01).sum(axis=1, keepdims=True))
    points = np.hstack([share(before), share(after)]).astype(np.float32)
    weight = np.sqrt(counts[rest]).astype(np.float32)[:, None]
    centres = points[np.random.default_rng(seed).choice(len(rest), CLUSTERS, replace=False)]
    for _ in range(15):
        near = np.argmax(points @ centres.T - (centres ** 2).sum(axis=1) / 2, axis=1)
        for k in range(CLUSTERS):
            own = near == k
            if own.any():
                centres[k] = (points[own] * weight[own]).sum(axis=0) / weight[own].sum()
    out[rest] = SINGLES + near
    return out


@dataclass
class Adam:
    """Moments of the gradients, by parameter, after ``n`` steps."""

    m: dict[str, np.ndarray]
    s: dict[str, np.ndarray]
    n: int = 0

    @classmethod
    def new(cls, params: dict[str, np.ndarray]) -> Adam:
        return cls(*({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2)))

    def update(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray],
               rate: float) -> None:
        self.n += 1
        for k, d in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * d
            self.s[k] = 0.99 * self.s[k] + 0.01 * d * d
            step = ((self.m[k] / (1 - 0.9 ** self.n))
                    / (np.sqrt(self.s[k] / (1 - 0.99 ** self.n)) + 1e-8))
            params[k] -= (rate * step).astype(np.float32)


@dataclass
class AttentionModel:
    params: dict[str, np.ndarray]
    class_of: np.ndarray  # of each id
    input_of: np.ndarray  # row of the embedding table of each id
    context_of: np.ndarray  # context class of each id

    @classmethod
    def new(cls, counts: np.ndarray, class_of: np.ndarray, seed: int = 0) -> AttentionModel:
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        order = np.argsort(-counts, kind="stable")
        order = order[counts[order] > 0]

        def own_first(n: int) -> np.ndarray:
            out = n + class_of
            out[order[:n]] = np.arange(len(order[:n]))
            return out

        input_of, context_of = own_first(INPUTS), own_first(CONTEXT_IDS)
        share = np.bincount(class_of, weights=counts, minlength=CLASSES) + 1
        return cls({
            "E": (0.3 * rng.standard_normal((INPUTS + CLASSES, DIM))).astype(np.float32),
            "Q": draw(DIM, DIM), "K": draw(DIM, DIM), "V": draw(DIM, DIM),
            "X": draw(DIM, HIDDEN), "C": draw(DIM, HIDDEN), "h": np.zeros(HIDDEN, np.float32),
            "U": draw(HIDDEN, CLASSES) * np.float32(0.5),
            "u": np.log(share / share.sum()).astype(np.float32),
            "D": np.linspace(0, -2, SPAN).astype(np.float32),  # by distance
        }, class_of, input_of, context_of)

    def _attend(self, x: np.ndarray, keys: np.ndarray, values: np.ndarray, first: int,
                hide: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """``x``: queries, the first at place ``first`` of the keys. ``hide``:
        windows whose keys before that place are none of theirs. Gives scaled
        queries, distances, attention before it is divided by its sums, the
        sums, and what is attended to."""
        p = self.params
        q = x @ (p["Q"] * np.float32(DIM ** -0.5))
        far = first + np.arange(x.shape[1])[:, None] - np.arange(keys.shape[1])[None, :]
        s = q @ keys.transpose(0, 2, 1)
        s += np.where(far >= 0, p["D"][np.clip(far, 0, SPAN - 1)], np.float32(-1e9))
        if hide is not None:
            s[hide, :, :first] = -1e9
        with np.errstate(over="ignore"):  # caught below
            a = np.exp(s)
        total = a.sum(axis=2, keepdims=True)
        if not np.isfinite(total).all() or (total == 0).any():
            a = np.exp(s - s.max(axis=2, keepdims=True))
            total = a.sum(axis=2, keepdims=True)
        c = a @ values
        c /= total
        return q, far, a, total, c

    def _logits(self, x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden layer and logits of the classes."""
        p = self.params
        h = x @ p["X"]
        h += c @ p["C"]
        h += p["h"]
        np.maximum(h, 0, out=h)
        z = h @ p["U"]
        z += p["u"]
        return h, z

    def step(self, ids: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss in nats over windows of ids, and gradients."""
        p = self.params
        inp, target = self.input_of[ids[:, :-1]], self.class_of[ids[:, 1:]].ravel()
        b, t = inp.shape
        x = p["E"][inp]
        k, v = x @ p["K"], x @ p["V"]
        q, far, a, total, c = self._attend(x, k, v, 0)
        a /= total
        h, e = self._logits(x.reshape(-1, DIM), c.reshape(-1, DIM))
        e -= e.max(axis=1, keepdims=True)
        np.exp(e, out=e)
        e /= e.sum(axis=1, keepdims=True)
        at = np.arange(len(target))
        loss = float(-np.log(e[at, target] + 1e-30).mean())
        e[at, target] -= 1
        e /= np.float32(len(target))
        g = {"U": h.T @ e, "u": e.sum(axis=0)}
        dh = (e @ p["U"].T) * (h > 0)
        flat = x.reshape(-1, DIM)
        g |= {"X": flat.T @ dh, "C": c.reshape(-1, DIM).T @ dh, "h": dh.sum(axis=0)}
        dx = (dh @ p["X"].T).reshape(b, t, DIM)
        dc = (dh @ p["C"].T).reshape(b, t, DIM)
        da = dc @ v.transpose(0, 2, 1)
        dv = a.transpose(0, 2, 1) @ dc
        ds = a * (da - (da * a).sum(axis=2, keepdims=True))
        ok = far >= 0
        g["D"] = np.bincount(far[ok], weights=ds.sum(axis=0)[ok], minlength=SPAN).astype(np.float32)
        dq = ds @ k * np.float32(DIM ** -0.5)
        dk = ds.transpose(0, 2, 1) @ q
        for name, d in (("Q", dq), ("K", dk), ("V", dv)):
            g[name] = flat.T @ d.reshape(-1, DIM)
            dx += d @ p[name].T
        order = np.argsort(inp.ravel(), kind="stable")
        rows, start = np.unique(inp.ravel()[order], return_index=True)
        g["E"] = np.zeros_like(p["E"])
        g["E"][rows] = np.add.reduceat(dx.reshape(-1, DIM)[order], start, axis=0)
        return loss, g

    def train(self, windows: np.ndarray, steps: int, batch: int = 96, rate: float = 6e-3,
              seed: int = 0, adam: Adam | None = None) -> list[float]:
        """Adam over windows of ids, drawn at random; the losses."""
        rng = np.random.default_rng(seed)
        adam = Adam.new(self.params) if adam is None else adam
        losses = []
        for n in range(1, steps + 1):
            loss, g = self.step(windows[rng.integers(0, len(windows), batch)])
            losses.append(loss)
            adam.update(self.params, g, rate * min(1, n / 20) * (0.05 + 0.95 * (1 - n / (steps + 1))))
        return losses

    def train_once(self, windows: np.ndarray, adam: Adam, rate: float, batch: int = 96) -> None:
        """Adam over each of the windows once, in an order drawn at random."""
        order = np.random.default_rng(adam.n).permutation(len(windows))
        for lo in range(0, len(windows), batch):
            _, g = self.step(windows[order[lo:lo + batch]])
            adam.update(self.params, g, rate)

    def log_probs(self, rows: list[np.ndarray], most: int = 64) -> list[np.ndarray]:
        """For each sequence of ids: log probability (nats) of the class of each
        id but the first, given those before it.

        Sequences are cut into windows of ``HALF`` scored places, each with the
        ``HALF`` places before as context, so that every id is scored once.
        Windows of all sequences share batches of ``most``, whatever their length.
        """
        p = self.params
        blocks = [-(-(len(r) - 1) // HALF) for r in rows]
        total = sum(blocks)
        inp = np.full((total + 1) * HALF, INPUTS + CLASSES - 1, np.int64)
        target = np.zeros((total + 1) * HALF, np.int64)
        opens = np.zeros(total + 1, bool)
        at = 0
        for r, n in zip(rows, blocks, strict=True):
            if n:
                lo = at * HALF
                inp[lo:lo + len(r) - 1] = self.input_of[r[:-1]]
                target[lo:lo + len(r) - 1] = self.class_of[r[1:]]
                opens[at] = True
                at += n
        out = np.empty(total * HALF, np.float32)
        for lo in range(0, total, most):
            hi = min(total, lo + most)
            pre = max(0, lo - 1)
            x = p["E"][inp[pre * HALF:hi * HALF]]
            k = (x @ p["K"]).reshape(-1, HALF, DIM)
            v = (x @ p["V"]).reshape(-1, HALF, DIM)
            x = x.reshape(-1, HALF, DIM)
            if lo == 0:  # the first window of all has nothing before it
                k, v = (np.concatenate([y[:1], y]) for y in (k, v))
                x = np.concatenate([x[:1], x])
            both = lambda y: np.concatenate([y[:-1], y[1:]], axis=1)
            x = x[1:]
            *_, c = self._attend(x, both(k), both(v), HALF, opens[lo:hi])
            _, z = self._logits(x.reshape(-1, DIM), c.reshape(-1, DIM))
            want = z[np.arange(len(z)), target[lo * HALF:hi * HALF]]
            with np.errstate(over="ignore"):  # caught below
                sums = np.exp(z).sum(axis=1)
            if not np.isfinite(sums).all() or (sums == 0).any():
                high = z.max(axis=1)
                sums, want = np.exp(z - high[:, None]).sum(axis=1), want - high
            out[lo * HALF:hi * HALF] = want - np.log(sums)
        got, at = [], 0
        for r, n in zip(rows, blocks, strict=True):
            got.append(out[at * HALF:at * HALF + max(0, len(r) - 1)])
            at += n
        return got
