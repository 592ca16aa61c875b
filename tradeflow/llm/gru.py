"""A bidirectional gated recurrent network with attention pooling, in numpy."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_params(inputs: int, hidden: int, rng: np.random.Generator) -> Params:
    def normal(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    p = {"pool_in": normal(2 * hidden, hidden), "pool_bias": np.zeros(hidden, np.float32)}
    p |= {"pool_out": normal(hidden), "out": normal(2 * hidden), "bias": np.zeros(1, np.float32)}
    for side in ("ahead", "back"):
        p[f"{side}_in"] = normal(inputs, 3 * hidden)
        p[f"{side}_bias"] = np.zeros(3 * hidden, np.float32)
        p[f"{side}_own"] = normal(hidden, 3 * hidden)
    return p


def _steps(projected: np.ndarray, own: np.ndarray, keep: bool):
    """Hidden states of the gates' inputs (time, batch, 3 hidden), and what backward needs.

    A row of zeros as input leaves a state of zeros as it is, so padding in front
    of the first word has no effect.
    """
    t, n, width = projected.shape
    h = width // 3
    state = np.zeros((n, h), np.float32)
    states = np.empty((t, n, h), np.float32)
    kept = []
    for k in range(t):
        mine = state @ own
        gates = sigmoid(projected[k, :, : 2 * h] + mine[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(projected[k, :, 2 * h :] + r * mine[:, 2 * h :])
        if keep:
            kept.append((z, r, new, state, mine[:, 2 * h :]))
        state = new + z * (state - new)
        states[k] = state
    return states, kept


def _steps_backward(d_states: np.ndarray, own: np.ndarray, kept):
    """Gradients of the gates' inputs and of the recurrent weights."""
    t, n, h = d_states.shape
    d_projected = np.empty((t, n, 3 * h), np.float32)
    d_own = np.zeros_like(own)
    carried = np.zeros((n, h), np.float32)
    for k in range(t - 1, -1, -1):
        z, r, new, before, mine = kept[k]
        d = d_states[k] + carried
        d_new = d * (1 - z) * (1 - new * new)
        d_z = d * (before - new) * z * (1 - z)
        d_r = d_new * mine * r * (1 - r)
        d_projected[k] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_mine = np.concatenate([d_z, d_r, d_new * r], axis=1)
        d_own += before.T @ d_mine
        carried = d * z + d_mine @ own.T
    return d_projected, d_own


def forward(p: Params, ahead: np.ndarray, back: np.ndarray, filled: np.ndarray, keep: bool = False):
    """Logits of windows. ``ahead`` and ``back`` are projected inputs (time, batch, 3
    hidden), ``filled`` (time, batch) marks words."""
    left, kept_left = _steps(ahead, p["ahead_own"], keep)
    right, kept_right = _steps(back[::-1], p["back_own"], keep)
    states = np.concatenate([left, right[::-1]], axis=2)
    inner = np.tanh(states @ p["pool_in"] + p["pool_bias"])
    score = np.where(filled, inner @ p["pool_out"], np.float32(-1e9))
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", weight, states)
    logits = pooled @ p["out"] + p["bias"][0]
    return (logits, (states, inner, weight, pooled, kept_left, kept_right)) if keep else logits


def backward(p: Params, saved, d_logits: np.ndarray):
    """Gradients of the parameters above the inputs, and of the projected inputs."""
    states, inner, weight, pooled, kept_left, kept_right = saved
    g = {"out": pooled.T @ d_logits, "bias": d_logits.sum(keepdims=True)}
    d_pooled = d_logits[:, None] * p["out"]
    d_weight = np.einsum("bh,tbh->tb", d_pooled, states)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_inner = d_score[:, :, None] * p["pool_out"] * (1 - inner * inner)
    g["pool_out"] = np.einsum("tb,tbh->h", d_score, inner)
    g["pool_in"] = np.einsum("tbi,tbo->io", states, d_inner)
    g["pool_bias"] = d_inner.sum(axis=(0, 1))
    d_states = weight[:, :, None] * d_pooled + d_inner @ p["pool_in"].T
    h = d_states.shape[2] // 2
    d_ahead, g["ahead_own"] = _steps_backward(d_states[:, :, :h], p["ahead_own"], kept_left)
    d_back, g["back_own"] = _steps_backward(d_states[::-1, :, h:], p["back_own"], kept_right)
    return g, d_ahead, d_back[::-1]


class Adam:
    """Adam over dense arrays and, row by row, over the touched rows of tables."""

    def __init__(self, rate: float):
        self.rate, self.step, self.state = rate, 0, {}

    def update(self, p: Params, g: Params, rows: dict[str, np.ndarray] | None = None) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for name, d in g.items():
            m, v = self.state.setdefault(name, (np.zeros_like(p[name]), np.zeros_like(p[name])))
            at = rows[name] if rows and name in rows else ...
            m[at] = 0.9 * m[at] + 0.1 * d
            v[at] = 0.999 * v[at] + 0.001 * d * d
            p[name][at] -= (scale * m[at] / (np.sqrt(v[at]) + 1e-8)).astype(np.float32)
