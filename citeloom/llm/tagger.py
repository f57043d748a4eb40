"""A character tagger in numpy: bidirectional LSTM with a linear-chain CRF, trained by exact gradients."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tagger:
    """Parameters by name; ``symbols`` input classes (0 is padding), ``hidden`` units a direction, ``tags`` output classes."""

    symbols: int
    hidden: int
    tags: int
    params: dict[str, np.ndarray]

    @classmethod
    def new(cls, symbols: int, hidden: int, tags: int, seed: int = 0) -> Tagger:
        """Small random weights; forget gates start open."""
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0] ** 0.8)).astype(np.float32)
        params = {}
        for side in "fb":
            params[f"in_{side}"] = draw(symbols, 4 * hidden)
            params[f"rec_{side}"] = draw(hidden, 4 * hidden)
            params[f"bias_{side}"] = np.repeat(np.float32([0, 1, 0, 0]), hidden)
        params |= {"out": draw(2 * hidden, tags), "out_bias": np.zeros(tags, np.float32), "move": draw(tags, tags), "begin": np.zeros(tags, np.float32)}
        return cls(symbols, hidden, tags, params)

    def _run(self, x: np.ndarray, side: str, trace: bool):
        """States over time (T, B, H) of one direction, with what the backward pass needs."""
        p, h_n = self.params, self.hidden
        steps, batch = x.shape[1], x.shape[0]
        h, c = np.zeros((batch, h_n), np.float32), np.zeros((batch, h_n), np.float32)
        states, kept = np.empty((steps, batch, h_n), np.float32), []
        w_in, w_rec = p[f"in_{side}"] + p[f"bias_{side}"], p[f"rec_{side}"]
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = w_in[x[:, t]] + h @ w_rec
            gates = 1 / (1 + np.exp(-z[:, : 3 * h_n]))
            cell = np.tanh(z[:, 3 * h_n :])
            old_h, old_c = h, c
            c = gates[:, h_n : 2 * h_n] * old_c + gates[:, :h_n] * cell
            tc = np.tanh(c)
            h = gates[:, 2 * h_n :] * tc
            states[t] = h
            if trace:
                kept.append((t, gates, cell, old_h, old_c, tc))
        return states, kept

    def emissions(self, x: np.ndarray, trace: bool = False):
        """Scores (T, B, tags) of symbols ``x`` (B, T)."""
        forward, kept_f = self._run(x, "f", trace)
        backward, kept_b = self._run(x, "b", trace)
        both = np.concatenate([forward, backward], axis=2)
        scores = both @ self.params["out"] + self.params["out_bias"]
        return (scores, both, kept_f, kept_b) if trace else scores

    def _back(self, x: np.ndarray, side: str, kept: list, d_states: np.ndarray, grads: dict) -> None:
        p, n = self.params, self.hidden
        rec = p[f"rec_{side}"]
        d_rec, d_in = np.zeros_like(rec), np.zeros_like(p[f"in_{side}"])
        d_h = np.zeros((x.shape[0], n), np.float32)
        d_c = np.zeros_like(d_h)
        for t, gates, cell, old_h, old_c, tc in reversed(kept):
            d_h = d_h + d_states[t]
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            d_c = d_c + d_h * o * (1 - tc * tc)
            dz = np.concatenate([d_c * cell * i * (1 - i), d_c * old_c * f * (1 - f), d_h * tc * o * (1 - o), d_c * i * (1 - cell * cell)], axis=1)
            d_rec += old_h.T @ dz
            np.add.at(d_in, x[:, t], dz)
            d_h, d_c = dz @ rec.T, d_c * f
        grads[f"rec_{side}"], grads[f"in_{side}"], grads[f"bias_{side}"] = d_rec, d_in, d_in.sum(axis=0)

    def loss_and_gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of tags ``y`` (B, T), and its gradients."""
        scores, both, kept_f, kept_b = self.emissions(x, trace=True)
        move, begin = self.params["move"], self.params["begin"]
        steps, batch, k = scores.shape
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0] + begin
        for t in range(1, steps):
            alpha[t] = scores[t] + _log_sum(alpha[t - 1][:, :, None] + move, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _log_sum(move + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        log_z = _log_sum(alpha[-1], 1)
        d_scores = np.exp(alpha + beta - log_z[None, :, None])
        rows = np.arange(batch)
        d_move, d_begin = np.zeros_like(move), d_scores[0].sum(axis=0)
        np.add.at(d_begin, y[:, 0], -1)
        path = scores[0, rows, y[:, 0]] + begin[y[:, 0]]
        for t in range(1, steps):
            pair = alpha[t - 1][:, :, None] + move + (scores[t] + beta[t])[:, None, :] - log_z[:, None, None]
            d_move += np.exp(pair).sum(axis=0)
            path = path + scores[t, rows, y[:, t]] + move[y[:, t - 1], y[:, t]]
        np.add.at(d_move, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        for t in range(steps):
            d_scores[t, rows, y[:, t]] -= 1
        grads = {"move": d_move, "begin": d_begin, "out_bias": d_scores.sum(axis=(0, 1))}
        grads["out"] = both.reshape(-1, both.shape[2]).T @ d_scores.reshape(-1, k)
        d_both = d_scores @ self.params["out"].T
        self._back(x, "f", kept_f, d_both[:, :, : self.hidden], grads)
        self._back(x, "b", kept_b, d_both[:, :, self.hidden :], grads)
        return float((log_z - path).mean()), {n: g / batch for n, g in grads.items()}

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.02, seed: int = 0) -> float:
        """Adam over shuffled batches; returns the last epoch's mean loss."""
        rng = np.random.default_rng(seed)
        first = {n: np.zeros_like(v) for n, v in self.params.items()}
        second = {n: np.zeros_like(v) for n, v in self.params.items()}
        step, loss = 0, 0.0
        total = epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order, losses = rng.permutation(len(x)), []
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                loss, grads = self.loss_and_gradients(x[rows], y[rows])
                losses.append(loss)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                now = rate * (1 - step / total) + 1e-4
                step += 1
                for n, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    first[n] = 0.9 * first[n] + 0.1 * g
                    second[n] = 0.99 * second[n] + 0.01 * g * g
                    scaled = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-6)
                    self.params[n] = (self.params[n] - now * scaled).astype(np.float32)
            loss = float(np.mean(losses))
        return loss

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (B, T), and each position's emission lead over tag 0."""
        scores = self.emissions(x)
        move = self.params["move"]
        steps, batch, k = scores.shape
        best, back = scores[0] + self.params["begin"], np.empty((steps, batch, k), np.int8)
        for t in range(1, steps):
            ways = best[:, :, None] + move
            back[t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[t]
        tags = np.empty((batch, steps), np.int64)
        tags[:, -1] = best.argmax(axis=1)
        rows = np.arange(batch)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t, rows, tags[:, t]]
        lead = np.take_along_axis(scores, tags.T[:, :, None], axis=2)[:, :, 0] - scores[:, :, 0]
        return tags, lead.T


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))
