"""Bidirectional gated recurrent network with attention pooling, in numpy.

Arrays carry the direction first: 0 reads a window forwards, 1 backwards.
"""

from __future__ import annotations

import numpy as np

Weights = dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_weights(inputs: int, hidden: int, random: np.random.Generator) -> Weights:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    return {
        "input": normal(2, inputs, 3 * hidden, scale=inputs**-0.5),
        "input_bias": np.zeros((2, 3 * hidden), np.float32),
        "state": normal(2, hidden, 3 * hidden, scale=hidden**-0.5),
        "state_bias": np.zeros((2, hidden), np.float32),
        "attend": normal(2 * hidden, hidden, scale=(2 * hidden) ** -0.5),
        "attend_bias": np.zeros(hidden, np.float32),
        "attend_out": normal(hidden, scale=hidden**-0.5),
        "out": normal(2 * hidden, scale=(2 * hidden) ** -0.5),
        "out_bias": np.zeros(1, np.float32),
    }


def projected(weights: Weights, features: np.ndarray) -> np.ndarray:
    """What each row of features adds to the gates, by direction."""
    return features @ weights["input"] + weights["input_bias"][:, None, :]


def forward(weights: Weights, inputs: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows; inputs: (2, time, windows, 3 hidden), in reading order of the direction.

    mask: (time, windows), true where there is a word. With `keep`, also what `backward` needs.
    """
    _, steps, count, wide = inputs.shape
    hidden = wide // 3
    state = np.zeros((2, count, hidden), np.float32)
    states = np.empty((2, steps, count, hidden), np.float32)
    kept = []
    for t in range(steps):
        here = np.stack((mask[t], mask[steps - 1 - t]))[:, :, None]
        gates = inputs[:, t]
        own = state @ weights["state"]
        both = sigmoid(gates[..., : 2 * hidden] + own[..., : 2 * hidden])
        update, reset = both[..., :hidden], both[..., hidden:]
        inner = own[..., 2 * hidden :] + weights["state_bias"][:, None, :]
        new = np.tanh(gates[..., 2 * hidden :] + reset * inner)
        if keep:
            kept.append((state, update, reset, inner, new, here))
        state = np.where(here, new + update * (state - new), state)
        states[0, t], states[1, steps - 1 - t] = state[0], state[1]
    joined = np.concatenate((states[0], states[1]), axis=2)
    shown = np.tanh(joined @ weights["attend"] + weights["attend_bias"])
    energy = np.where(mask, shown @ weights["attend_out"], -1e9)
    energy = np.exp(energy - energy.max(axis=0)) * mask
    share = energy / np.maximum(energy.sum(axis=0), 1e-9)
    context = np.einsum("tn,tnh->nh", share, joined)
    logits = context @ weights["out"] + weights["out_bias"][0]
    return (logits, (kept, joined, shown, share, context)) if keep else logits


def backward(weights: Weights, inputs: np.ndarray, mask: np.ndarray, kept, slope: np.ndarray):
    """Gradients of the weights and of the inputs, for the gradient of each logit."""
    steps_kept, joined, shown, share, context = kept
    _, steps, count, wide = inputs.shape
    hidden = wide // 3
    grads = {name: np.zeros_like(w) for name, w in weights.items()}
    grads["out"] = context.T @ slope
    grads["out_bias"][0] = slope.sum()
    to_context = slope[:, None] * weights["out"]
    to_joined = share[:, :, None] * to_context
    to_share = np.einsum("nh,tnh->tn", to_context, joined)
    to_energy = share * (to_share - (share * to_share).sum(axis=0))
    grads["attend_out"] = np.einsum("tn,tnh->h", to_energy, shown)
    to_shown = to_energy[:, :, None] * weights["attend_out"] * (1 - shown**2)
    grads["attend_bias"] = to_shown.sum(axis=(0, 1))
    grads["attend"] = np.einsum("tni,tnh->ih", joined, to_shown)
    to_joined += to_shown @ weights["attend"].T
    to_inputs = np.zeros_like(inputs)
    to_state = np.zeros((2, count, hidden), np.float32)
    for t in reversed(range(steps)):
        state, update, reset, inner, new, here = steps_kept[t]
        to_state += np.stack((to_joined[t, :, :hidden], to_joined[steps - 1 - t, :, hidden:]))
        arriving = np.where(here, to_state, 0)
        to_new = arriving * (1 - update) * (1 - new**2)
        to_update = arriving * (state - new) * update * (1 - update)
        to_reset = to_new * inner * reset * (1 - reset)
        to_gates = np.concatenate((to_update, to_reset, to_new), axis=2)
        to_own = np.concatenate((to_update, to_reset, to_new * reset), axis=2)
        to_inputs[:, t] = to_gates
        grads["state"] += state.transpose(0, 2, 1) @ to_own
        grads["state_bias"] += (to_new * reset).sum(axis=1)
        to_state = np.where(here, arriving * update, to_state) + to_own @ weights["state"].transpose(0, 2, 1)
    return grads, to_inputs


class Adam:
    """Step sizes from running means of gradients and their squares."""

    def __init__(self, rate: float):
        self.rate, self.step = rate, 0
        self.means: Weights = {}
        self.squares: Weights = {}

    def update(self, weights: Weights, grads: Weights) -> None:
        self.step += 1
        for name, grad in grads.items():
            mean = self.means.setdefault(name, np.zeros_like(grad))
            square = self.squares.setdefault(name, np.zeros_like(grad))
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad * grad - square)
            scale = np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
            weights[name] -= (self.rate * scale) * mean / (np.sqrt(square) + 1e-8)
