"""A character-level bidirectional LSTM with CRF transitions, in NumPy."""

from __future__ import annotations

import numpy as np

LABELS = 9          # outside, then begin and inside of each of four kinds
EMBED, HIDDEN = 10, 14
CHARACTERS = 100    # printable ASCII, then: line break or tab, letter, anything else, nothing (padding)
PADDING = 98


def encode(text: str) -> list[int]:
    return [o - 32 if 32 <= (o := ord(c)) < 127 else 95 if c in "\n\t\r" else 96 if c.isalpha() else 97 for c in text]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Weights and the passes over them. Both directions run as one stack of two, the second on reversed windows."""

    def __init__(self, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)

        def start(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.weights = {
            "embed": start(CHARACTERS, EMBED, scale=0.3),
            "input": start(2, EMBED, 4 * HIDDEN, scale=EMBED ** -0.5),
            "recur": start(2, HIDDEN, 4 * HIDDEN, scale=HIDDEN ** -0.5),
            "bias": np.zeros((2, 1, 4 * HIDDEN), dtype=np.float32),
            "out": start(2 * HIDDEN, LABELS, scale=0.2), "out_bias": np.zeros(LABELS, dtype=np.float32),
            "move": np.zeros((LABELS, LABELS), dtype=np.float32)}
        self.weights["bias"][:, :, HIDDEN:2 * HIDDEN] = 1.0  # remember, to begin with

    def _lstm(self, x: np.ndarray, keep: bool):
        """x: (time, 2, batch, EMBED). Hidden states (time, 2, batch, HIDDEN), and what the backward pass needs."""
        w = self.weights
        gates = x @ w["input"] + w["bias"]
        h = np.zeros((2, x.shape[2], HIDDEN), dtype=np.float32)
        c = np.zeros_like(h)
        states, kept = np.empty((len(x), *h.shape), dtype=np.float32), []
        for t in range(len(x)):
            z = gates[t] + h @ w["recur"]
            s = 1.0 / (1.0 + np.exp(-z[..., :3 * HIDDEN]))
            i, f, o = s[..., :HIDDEN], s[..., HIDDEN:2 * HIDDEN], s[..., 2 * HIDDEN:]
            g = np.tanh(z[..., 3 * HIDDEN:])
            before = c
            c = f * c + i * g
            th = np.tanh(c)
            if keep:
                kept.append((h, before, i, f, o, g, th))
            h = o * th
            states[t] = h
        return states, kept

    def emissions(self, ids: np.ndarray, keep: bool = False):
        """ids: (batch, time). Label scores (batch, time, LABELS)."""
        both = np.stack([ids, ids[:, ::-1]])                       # 2, batch, time
        x = self.weights["embed"][both].transpose(2, 0, 1, 3)      # time, 2, batch, embed
        states, kept = self._lstm(np.ascontiguousarray(x), keep)
        h = np.concatenate([states[:, 0], states[::-1, 1]], axis=-1).transpose(1, 0, 2)
        scores = h @ self.weights["out"] + self.weights["out_bias"]
        return (scores, (both, x, states, kept, h)) if keep else scores

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Best label path of each window."""
        return self.best_paths(self.emissions(ids), np.full(len(ids), ids.shape[1]))

    def best_paths(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best label path (Viterbi) of each sequence of scores, of which the first `lengths` count; zeros behind."""
        move, (batch, time) = self.weights["move"], e.shape[:2]
        score, back = e[:, 0], np.zeros((batch, time, LABELS), dtype=np.int8)
        last = np.where(lengths == 1, score.argmax(axis=1), 0)
        for t in range(1, time):
            each = score[:, :, None] + move[None]
            back[:, t] = each.argmax(axis=1)
            score = each.max(axis=1) + e[:, t]
            ends = lengths == t + 1
            last[ends] = score[ends].argmax(axis=1)
        path = np.zeros((batch, time), dtype=np.int8)
        path[np.arange(batch), lengths - 1] = last
        for t in range(time - 1, 0, -1):
            inside = t < lengths
            before = np.take_along_axis(back[:, t], path[:, t, None].astype(np.int64), axis=1)[:, 0]
            path[inside, t - 1] = before[inside]
        return path

    def _crf(self, e: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean negative log likelihood per window, and its gradients by emissions and by transitions."""
        move, (batch, time) = self.weights["move"], labels.shape
        ahead, behind = np.empty_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for t in range(1, time):
            ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + move[None], 1) + e[:, t]
        for t in range(time - 2, -1, -1):
            behind[:, t] = _log_sum(move[None] + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        total = _log_sum(ahead[:, -1], 1)
        marginal = np.exp(ahead + behind - total[:, None, None])
        grad_move = np.zeros_like(move)
        for t in range(1, time):
            pair = ahead[:, t - 1, :, None] + move[None] + (e[:, t] + behind[:, t])[:, None, :] - total[:, None, None]
            grad_move += np.exp(pair).sum(axis=0)
        np.subtract.at(grad_move, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1.0)
        rows, cols = np.indices(labels.shape)
        right = e[rows, cols, labels].sum() + move[labels[:, :-1], labels[:, 1:]].sum()
        marginal[rows, cols, labels] -= 1.0
        return float(total.sum() - right) / batch, marginal / batch, grad_move / batch

    def gradients(self, ids: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        w = self.weights
        e, (both, x, states, kept, h) = self.emissions(ids, keep=True)
        loss, de, dmove = self._crf(e, labels)
        grads = {"move": dmove, "out_bias": de.sum(axis=(0, 1)),
                 "out": h.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, LABELS)}
        dh_all = (de @ w["out"].T).transpose(1, 0, 2)              # time, batch, 2 * hidden
        dh_all = np.stack([dh_all[..., :HIDDEN], dh_all[::-1, :, HIDDEN:]], axis=1)
        dgates = np.empty(x.shape[:3] + (4 * HIDDEN,), dtype=np.float32)
        dh_next, dc_next = np.zeros_like(states[0]), np.zeros_like(states[0])
        grads["recur"] = np.zeros_like(w["recur"])
        recur_t = w["recur"].transpose(0, 2, 1)
        for t in range(len(x) - 1, -1, -1):
            before_h, before_c, i, f, o, g, th = kept[t]
            dh = dh_all[t] + dh_next
            dc = dc_next + dh * o * (1 - th * th)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * th * o * (1 - o),
                                 dc * i * (1 - g * g)], axis=-1)
            dgates[t] = dz
            grads["recur"] += before_h.transpose(0, 2, 1) @ dz
            dh_next, dc_next = dz @ recur_t, dc * f
        grads["bias"] = dgates.sum(axis=(0, 2))[:, None, :]
        grads["input"] = np.einsum("tdbe,tdbg->deg", x, dgates, optimize=True)
        dx = dgates @ w["input"].transpose(0, 2, 1)                # time, 2, batch, embed
        grads["embed"] = np.zeros_like(w["embed"])
        np.add.at(grads["embed"], both.transpose(2, 0, 1).ravel(), dx.reshape(-1, EMBED))
        return loss, grads

    def train(self, ids: np.ndarray, labels: np.ndarray, steps: int, batch: int, rate: float = 0.02, seed: int = 1) -> None:
        """Adam on random batches, the rate falling to a tenth. One seed, one result."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            at = rng.integers(0, len(ids), batch)
            _, grads = self.gradients(ids[at], labels[at])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            now = rate * (1.0 - 0.9 * step / steps)
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                self.weights[k] -= (now * (mean[k] / (1 - 0.9 ** step))
                                    / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
