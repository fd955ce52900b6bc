"""A small bidirectional LSTM that labels sequences, in numpy: training by backpropagation through time."""

from __future__ import annotations

import numpy as np

HIDDEN = 16


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def start(width: int, rng: np.random.Generator, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    """Weights by name: input, recurrent and bias for each direction, and the output's."""
    out = {}
    for d in ("f", "b"):
        out[f"x{d}"] = rng.normal(0, 1 / np.sqrt(width), (width, 4 * hidden))
        out[f"h{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
        out[f"c{d}"] = np.r_[np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]
    return out | {"o": rng.normal(0, 0.1, (2 * hidden, 1)), "p": np.zeros(1)}


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(x, mask) with x[time, sequence, feature]."""
    longest = max(map(len, sequences))
    x, mask = np.zeros((longest, len(sequences), sequences[0].shape[1])), np.zeros((longest, len(sequences)))
    for i, s in enumerate(sequences):
        x[: len(s), i], mask[: len(s), i] = s, 1
    return x, mask


def _run(w: dict, d: str, x: np.ndarray, mask: np.ndarray, tape: list | None) -> np.ndarray:
    """Hidden states of one direction; a masked step keeps its state."""
    steps, n, _ = x.shape
    size = w[f"h{d}"].shape[0]
    inputs = x @ w[f"x{d}"] + w[f"c{d}"]
    h, c, out = np.zeros((n, size)), np.zeros((n, size)), np.zeros((steps, n, size))
    for t in range(steps) if d == "f" else reversed(range(steps)):
        z = inputs[t] + h @ w[f"h{d}"]
        i, f, o, g = _sigmoid(z[:, :size]), _sigmoid(z[:, size : 2 * size]), _sigmoid(z[:, 2 * size : 3 * size]), np.tanh(z[:, 3 * size :])
        m = mask[t][:, None]
        new = f * c + i * g
        squashed = np.tanh(new)
        if tape is not None:
            tape.append((t, h, c, i, f, o, g, squashed, m))
        c, h = m * new + (1 - m) * c, m * o * squashed + (1 - m) * h
        out[t] = h
    return out


def _back(w: dict, d: str, x: np.ndarray, tape: list, dh_all: np.ndarray) -> dict[str, np.ndarray]:
    size = w[f"h{d}"].shape[0]
    dz_all, dwh = np.zeros((*x.shape[:2], 4 * size)), np.zeros_like(w[f"h{d}"])
    dh, dc = np.zeros((x.shape[1], size)), np.zeros((x.shape[1], size))
    for t, h, c, i, f, o, g, squashed, m in reversed(tape):
        dh = dh + dh_all[t]
        inner = m * dh
        dnew = m * dc + inner * o * (1 - squashed**2)
        dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), inner * squashed * o * (1 - o), dnew * i * (1 - g**2)], axis=1)
        dwh += h.T @ dz
        dz_all[t] = dz
        dh, dc = dz @ w[f"h{d}"].T + (1 - m) * dh, dnew * f + (1 - m) * dc
    flat = dz_all.reshape(-1, 4 * size)
    return {f"x{d}": x.reshape(-1, x.shape[2]).T @ flat, f"h{d}": dwh, f"c{d}": flat.sum(axis=0)}


def probabilities(w: dict, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    both = np.concatenate([_run(w, "f", x, mask, None), _run(w, "b", x, mask, None)], axis=2)
    return _sigmoid(both @ w["o"] + w["p"])[:, :, 0]


def train(sequences: list[np.ndarray], labels: list[np.ndarray], seed: int = 7, epochs: int = 10, rate: float = 0.01, batch: int = 32) -> dict[str, np.ndarray]:
    """Adam on the mean cross-entropy of all labels."""
    rng = np.random.default_rng(seed)
    w = start(sequences[0].shape[1], rng)
    mean, square, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    by_length = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
    groups = [by_length[i : i + batch] for i in range(0, len(by_length), batch)]
    for _ in range(epochs):
        for k in rng.permutation(len(groups)):
            x, mask = padded([sequences[i] for i in groups[k]])
            y = padded([labels[i][:, None].astype(float) for i in groups[k]])[0][:, :, 0]
            forward, backward = [], []
            both = np.concatenate([_run(w, "f", x, mask, forward), _run(w, "b", x, mask, backward)], axis=2)
            error = (_sigmoid(both @ w["o"] + w["p"])[:, :, 0] - y) * mask / mask.sum()
            dh = error[:, :, None] * w["o"][:, 0]
            size = dh.shape[2] // 2
            grad = _back(w, "f", x, forward, dh[:, :, :size]) | _back(w, "b", x, backward, dh[:, :, size:])
            grad |= {"o": both.reshape(-1, 2 * size).T @ error.reshape(-1, 1), "p": np.array([error.sum()])}
            step += 1
            for name, g in grad.items():
                g = np.clip(g, -1, 1)
                mean[name] += 0.1 * (g - mean[name])
                square[name] += 0.001 * (g * g - square[name])
                w[name] = w[name] - rate * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
    return w
