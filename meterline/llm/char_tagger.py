"""A bidirectional LSTM over characters with a conditional random field, in numpy.

Characters are read as classes. Each direction is one LSTM layer; a linear layer gives the
score of each tag, and the field adds scores of tags that follow each other. Training is
gradient descent on the likelihood of the labelled windows, by backpropagation through time
and the forward-backward algorithm; decoding is Viterbi's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 12
EPOCHS = 14
LEAST_STEPS = 600  # few windows are seen more often
BATCH = 64
RATE = 0.02


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


@dataclass
class Tagger:
    """``weights`` holds, for each direction, input rows and recurrent weights of the four
    gates (in, forget, out, new), and the output layer; then the field."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(symbols: int, tags: int, rng: np.random.Generator) -> Tagger:
        w = {}
        for side in ("ahead", "back"):
            w[f"{side}_in"] = rng.normal(0, 0.3, (symbols, 4 * HIDDEN))
            w[f"{side}_in"][:, HIDDEN : 2 * HIDDEN] += 1  # remember at first
            w[f"{side}_loop"] = rng.normal(0, 0.3 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w[f"{side}_out"] = rng.normal(0, 0.3, (HIDDEN, tags))
        w |= {"bias": np.zeros(tags), "follow": np.zeros((tags, tags)), "first": np.zeros(tags)}
        return Tagger({name: value.astype(np.float32) for name, value in w.items()})

    def run(self, symbols: np.ndarray, side: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states of time, window and unit; ``symbols`` is of time and window."""
        rows, loop = self.weights[f"{side}_in"], self.weights[f"{side}_loop"]
        steps, windows = symbols.shape
        h = np.zeros((windows, HIDDEN), np.float32)
        c = np.zeros_like(h)
        hidden, kept = np.empty((steps, windows, HIDDEN), np.float32), [None] * steps
        for t in range(steps) if side == "ahead" else range(steps - 1, -1, -1):
            z = rows[symbols[t]] + h @ loop
            gates = sigmoid(z[:, : 3 * HIDDEN])
            new = np.tanh(z[:, 3 * HIDDEN :])
            before_c, before_h = c, h
            c = gates[:, HIDDEN : 2 * HIDDEN] * c + gates[:, :HIDDEN] * new
            squeezed = np.tanh(c)
            h = gates[:, 2 * HIDDEN :] * squeezed
            hidden[t] = h
            if keep:
                kept[t] = gates, new, before_c, before_h, squeezed
        return hidden, kept

    def scores(self, symbols: np.ndarray) -> np.ndarray:
        """Scores of time, window and tag."""
        w = self.weights
        ahead, _ = self.run(symbols, "ahead", False)
        back, _ = self.run(symbols, "back", False)
        return ahead @ w["ahead_out"] + back @ w["back_out"] + w["bias"]

    def decode(self, windows: np.ndarray) -> np.ndarray:
        """The best tags of each window; ties go to the smaller tag."""
        scores = self.scores(np.ascontiguousarray(windows.T))
        follow = self.weights["follow"]
        steps, n, tags = scores.shape
        best, origin = scores[0] + self.weights["first"], np.zeros((steps, n, tags), np.int8)
        for t in range(1, steps):
            # A few tags: compare them one by one rather than in a cube.
            top = best[:, :1] + follow[0]
            came = origin[t]
            for tag in range(1, tags):
                other = best[:, tag : tag + 1] + follow[tag]
                better = other > top
                top = np.where(better, other, top)
                came[better] = tag
            best = top + scores[t]
        found = np.empty((steps, n), np.int8)
        found[-1] = best.argmax(axis=1)
        every = np.arange(n)
        for t in range(steps - 1, 0, -1):
            found[t - 1] = origin[t][every, found[t]]
        return found.T

    def gradients(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of some windows and its gradients."""
        w, symbols, wanted = self.weights, np.ascontiguousarray(windows.T), tags.T
        states = {side: self.run(symbols, side, True) for side in ("ahead", "back")}
        scores = w["bias"] + sum(states[s][0] @ w[f"{s}_out"] for s in states)
        loss, d_scores, grads = self.field_gradients(scores, wanted)
        grads["bias"] = d_scores.sum(axis=(0, 1))
        for side, (hidden, kept) in states.items():
            flat = d_scores.reshape(-1, d_scores.shape[2])
            grads[f"{side}_out"] = hidden.reshape(-1, HIDDEN).T @ flat
            d_hidden = d_scores @ w[f"{side}_out"].T
            grads |= self.lstm_gradients(symbols, side, d_hidden, kept)
        return loss, grads

    def field_gradients(self, scores: np.ndarray, wanted: np.ndarray):
        follow, first = self.weights["follow"], self.weights["first"]
        steps, n, tags = scores.shape
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0] + first
        for t in range(1, steps):
            ahead[t] = log_sum(ahead[t - 1][:, :, None] + follow, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            behind[t] = log_sum(follow + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        total = log_sum(ahead[-1], 1)
        chance = np.exp(ahead + behind - total[:, None])
        gold = np.eye(tags, dtype=np.float32)[wanted]
        d_follow = np.zeros_like(follow)
        gold_follow = np.zeros_like(follow)
        for t in range(1, steps):
            pair = ahead[t - 1][:, :, None] + follow + (scores[t] + behind[t])[:, None, :]
            d_follow += np.exp(pair - total[:, None, None]).sum(axis=0)
            np.add.at(gold_follow, (wanted[t - 1], wanted[t]), 1)
        reached = (scores * gold).sum() + (follow * gold_follow).sum() + first[wanted[0]].sum()
        loss = float(total.sum() - reached) / n
        grads = {
            "follow": (d_follow - gold_follow) / n,
            "first": (chance[0] - gold[0]).sum(axis=0) / n,
        }
        return loss, (chance - gold) / n, grads

    def lstm_gradients(self, symbols, side: str, d_hidden: np.ndarray, kept: list):
        rows, loop = self.weights[f"{side}_in"], self.weights[f"{side}_loop"]
        steps, n = symbols.shape
        d_rows, d_loop = np.zeros_like(rows), np.zeros_like(loop)
        d_h, d_c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1) if side == "ahead" else range(steps):
            gates, new, before_c, before_h, squeezed = kept[t]
            take, forget, out = (gates[:, i * HIDDEN : (i + 1) * HIDDEN] for i in range(3))
            d_h = d_h + d_hidden[t]
            d_c = d_c + d_h * out * (1 - squeezed**2)
            d_gates = np.concatenate([d_c * new, d_c * before_c, d_h * squeezed], axis=1)
            d_z = np.concatenate([d_gates * gates * (1 - gates), d_c * take * (1 - new**2)], axis=1)
            np.add.at(d_rows, symbols[t], d_z)
            d_loop += before_h.T @ d_z
            d_h, d_c = d_z @ loop.T, d_c * forget
        return {f"{side}_in": d_rows, f"{side}_loop": d_loop}


def train(windows: np.ndarray, tags: np.ndarray, symbols: int, kinds: int, seed: int = 3) -> Tagger:
    """A tagger of labelled windows, of one length each, by gradient descent with momentum."""
    rng = np.random.default_rng(seed)
    tagger = Tagger.fresh(symbols, kinds, rng)
    mean = {name: np.zeros_like(value) for name, value in tagger.weights.items()}
    square = {name: np.zeros_like(value) for name, value in tagger.weights.items()}
    batches = -(-len(windows) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    step, steps = 0, epochs * batches
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            _, grads = tagger.gradients(windows[some], tags[some])
            size = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            shrink = min(1.0, 5.0 / (size + 1e-9))
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for name, g in grads.items():
                g = g.astype(np.float32) * shrink
                mean[name] += 0.1 * (g - mean[name])
                square[name] += 0.01 * (g * g - square[name])
                lean = mean[name] / (1 - 0.9**step)
                spread = square[name] / (1 - 0.99**step)
                tagger.weights[name] -= rate * lean / (np.sqrt(spread) + 1e-8)
    return tagger
