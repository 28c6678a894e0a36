"""A character-level bidirectional LSTM with a CRF on top, in numpy: training and batched decoding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MARKS = "@.+-()[]_%:/=\"'#,;!?\\"
#: Classes of characters: other, white space, line feed, digit, letters without case, marks, letters beyond ASCII.
N_CLASSES = 4 + 26 + len(MARKS) + 1


def _class_table() -> np.ndarray:
    table = np.zeros(128, np.int64)
    table[[9, 11, 12, 13, 32]] = 1
    table[10] = 2
    table[ord("0"):ord("9") + 1] = 3
    for first in "aA":
        table[ord(first):ord(first) + 26] = np.arange(4, 30)
    for k, mark in enumerate(MARKS):
        table[ord(mark)] = 30 + k
    return table


TABLE = _class_table()


def classes(texts: list[str], width: int) -> np.ndarray:
    """One row of character classes per text; shorter texts are filled up with spaces."""
    points = np.frombuffer("".join(t[:width].ljust(width) for t in texts).encode("utf-32-le"), np.uint32)
    points = points.reshape(len(texts), width)
    return np.where(points < 128, TABLE[np.minimum(points, 127)], N_CLASSES - 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Tagger:
    """Weights by name: input, recurrent of either direction, emission, transitions, first tag."""

    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, n_tags: int, hidden: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        weights: dict[str, np.ndarray] = {}
        for side in "fb":
            weights["x" + side] = rng.normal(0, 0.3, (N_CLASSES, 4 * hidden))
            weights["x" + side][:, hidden:2 * hidden] += 1  # remember at first
            weights["h" + side] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
        weights["out"] = rng.normal(0, 0.1, (2 * hidden + 1, n_tags))
        weights["next"] = np.zeros((n_tags, n_tags))
        weights["first"] = np.zeros(n_tags)
        return cls({k: v.astype(np.float32) for k, v in weights.items()})

    def _run(self, x: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """Hidden states by place (time, row, unit). Places run in the direction of the side."""
        into, back = self.weights["x" + side], self.weights["h" + side]
        n, hidden = len(x), back.shape[0]
        h, c = np.zeros((n, hidden), np.float32), np.zeros((n, hidden), np.float32)
        out = np.empty((x.shape[1], n, hidden), np.float32)
        for t in range(x.shape[1]) if side == "f" else range(x.shape[1] - 1, -1, -1):
            z = into[x[:, t]] + h @ back
            gates, fresh = _sigmoid(z[:, :3 * hidden]), np.tanh(z[:, 3 * hidden:])
            i, f, o = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
            before, h_before = c, h
            c = f * c + i * fresh
            bent = np.tanh(c)
            h = o * bent
            out[t] = h
            if keep is not None:
                keep.append((t, i, f, o, fresh, before, bent, h_before))
        return out

    def _unroll(self, x: np.ndarray, side: str, keep: list, grad: np.ndarray, into: dict) -> None:
        back = self.weights["h" + side]
        hidden = back.shape[0]
        dh = dc = np.zeros((len(x), hidden), np.float32)
        dx, dback = np.zeros_like(self.weights["x" + side]), np.zeros_like(back)
        for t, i, f, o, fresh, before, bent, h_before in reversed(keep):
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - bent * bent)
            dz = np.concatenate([
                dc * fresh * i * (1 - i), dc * before * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - fresh * fresh),
            ], axis=1)
            np.add.at(dx, x[:, t], dz)
            dback += h_before.T @ dz
            dh, dc = dz @ back.T, dc * f
        into["x" + side], into["h" + side] = dx, dback

    def _scores(self, forward: np.ndarray, backward: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ones = np.ones((*forward.shape[:2], 1), np.float32)
        states = np.concatenate([forward, backward, ones], axis=2)
        return states, states @ self.weights["out"]

    def gradients(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tag sequences, and its gradient, by forward and backward sums."""
        kept: dict[str, list] = {"f": [], "b": []}
        states, e = self._scores(self._run(x, "f", kept["f"]), self._run(x, "b", kept["b"]))
        steps, n, k = e.shape
        follow, first = self.weights["next"], self.weights["first"]

        def total(a: np.ndarray, axis: int) -> np.ndarray:
            top = a.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))

        ahead, behind = np.empty_like(e), np.zeros_like(e)
        ahead[0] = first + e[0]
        for t in range(1, steps):
            ahead[t] = total(ahead[t - 1][:, :, None] + follow, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            behind[t] = total(follow + (e[t + 1] + behind[t + 1])[:, None, :], 2)
        log_z = total(ahead[-1], 1)
        share = np.exp(ahead + behind - log_z[None, :, None])
        y = tags.T
        rows = np.arange(n)
        loss = -(first[y[0]] + e[0, rows, y[0]])
        d_next = np.zeros_like(follow)
        for t in range(1, steps):
            loss -= follow[y[t - 1], y[t]] + e[t, rows, y[t]]
            pair = ahead[t - 1][:, :, None] + follow + (e[t] + behind[t])[:, None, :] - log_z[:, None, None]
            d_next += np.exp(pair).sum(axis=0)
            np.add.at(d_next, (y[t - 1], y[t]), -1)
        share[np.arange(steps)[:, None], rows, y] -= 1
        share /= n
        grads = {"next": d_next / n, "first": share[0].sum(axis=0),
                 "out": np.einsum("tns,tnk->sk", states, share)}
        d_states = share @ self.weights["out"].T
        hidden = self.weights["hf"].shape[0]
        self._unroll(x, "f", kept["f"], d_states[..., :hidden], grads)
        self._unroll(x, "b", kept["b"], d_states[..., hidden:2 * hidden], grads)
        return float((loss + log_z).mean()), grads

    def train(self, x: np.ndarray, tags: np.ndarray, steps: int, batch: int, rate: float, seed: int) -> float:
        """Adam with a falling rate; the mean loss of the last steps."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        losses = []
        for step in range(1, steps + 1):
            part = rng.choice(len(x), min(batch, len(x)), replace=False)
            loss, grads = self.gradients(x[part], tags[part])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = (g * min(1.0, 5 / (norm + 1e-9))).astype(np.float32)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                now = rate * (1 - 0.9 * step / steps)
                move = now * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-6)
                self.weights[k] = (self.weights[k] - move).astype(np.float32)
        return float(np.mean(losses[-20:])) if losses else 0.0

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tag sequence of each row (Viterbi), and by how much each place's score beats that of tag 0."""
        _, e = self._scores(self._run(x, "f"), self._run(x, "b"))
        steps, n, k = e.shape
        follow = self.weights["next"]
        best, came = self.weights["first"] + e[0], np.zeros((steps, n, k), np.int8)
        for t in range(1, steps):
            all_ways = best[:, :, None] + follow
            came[t] = all_ways.argmax(axis=1)
            best = np.take_along_axis(all_ways, came[t].astype(np.int64)[:, None, :], 1)[:, 0] + e[t]
        tags = np.empty((n, steps), np.int64)
        tags[:, -1] = best.argmax(axis=1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = came[t, rows, tags[:, t]]
        margin = np.take_along_axis(e, tags.T[:, :, None], 2)[..., 0] - e[..., 0]
        return tags, margin.T
