"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its hashed embedding beside the mean of the embeddings of its
hashed character sequences. Two gated recurrent layers read a window both ways; attention weighs
their states, and a linear layer gives the window's logit. Inputs are projected to
the gates once per distinct word, so a step in time is a gather, one small product
and the gates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

WORD_ROWS, CHAR_ROWS = 1 << 14, 1 << 14
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 4, 12, 8, 8


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Lexicon:
    """Distinct words: a row of the word table, and rows of the character table."""

    word_rows: np.ndarray
    char_rows: np.ndarray
    char_counts: np.ndarray

    def only(self, at: np.ndarray) -> Lexicon:
        begin = np.cumsum(self.char_counts) - self.char_counts
        counts = self.char_counts[at]
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        rows = self.char_rows[np.repeat(begin[at], counts) + place]
        return Lexicon(self.word_rows[at], rows, counts)


def _sum_rows(rows: np.ndarray, values: np.ndarray, number: int) -> np.ndarray:
    """Values of equal rows added up."""
    return np.stack(
        [np.bincount(rows, weights=v, minlength=number) for v in values.T], axis=1
    ).astype(np.float32)


@dataclass
class BiGru:
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = 4) -> BiGru:
        rng = np.random.default_rng(seed)
        n = WORD_DIM + CHAR_DIM
        shapes = {
            "word": (WORD_ROWS, WORD_DIM),
            "char": (CHAR_ROWS, CHAR_DIM),
            "in": (2, n, 3 * HIDDEN),
            "rec": (2, HIDDEN, 3 * HIDDEN),
            "bias": (2, 3 * HIDDEN),
            "att": (2 * HIDDEN, ATTENTION),
            "att_out": (ATTENTION,),
            "out": (2 * HIDDEN,),
            "out_bias": (1,),
        }
        scale = {"word": 0.1, "char": 0.3, "in": 0.4, "rec": 0.3, "att": 0.4, "att_out": 0.5, "out": 0.5}
        return cls(
            {k: (scale.get(k, 0.0) * rng.normal(size=s)).astype(np.float32) for k, s in shapes.items()}
        )

    def inputs(self, words: Lexicon) -> np.ndarray:
        """The input of each distinct word."""
        begin = np.cumsum(words.char_counts) - words.char_counts
        chars = np.add.reduceat(self.p["char"][words.char_rows], begin, axis=0)
        chars /= words.char_counts[:, None]
        return np.concatenate([self.p["word"][words.word_rows], chars], axis=1)

    def forward(self, x: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows ``index`` (windows x steps) into rows of ``x``."""
        number, steps = index.shape
        states = np.zeros((steps, number, 2 * HIDDEN), np.float32)
        past = []
        for way in (0, 1):
            gates_in = x @ self.p["in"][way] + self.p["bias"][way]
            rec_rz, rec_c = self.p["rec"][way][:, : 2 * HIDDEN], self.p["rec"][way][:, 2 * HIDDEN :]
            h = np.zeros((number, HIDDEN), np.float32)
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                a = gates_in[index[:, t]]
                rz = _sigmoid(a[:, : 2 * HIDDEN] + h @ rec_rz)
                r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
                c = np.tanh(a[:, 2 * HIDDEN :] + (r * h) @ rec_c)
                m = mask[:, t, None]
                new = h + m * (1 - z) * (c - h)
                if keep:
                    past.append((way, t, h, r, z, c, m))
                h = new
                states[t, :, way * HIDDEN : (way + 1) * HIDDEN] = h
        inner = np.tanh(states @ self.p["att"])
        energy = inner @ self.p["att_out"] + (mask.T - 1) * 1e9
        energy -= energy.max(axis=0)
        alpha = np.exp(energy)
        alpha /= alpha.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", alpha, states)
        logits = pooled @ self.p["out"] + self.p["out_bias"][0]
        return logits, (states, inner, alpha, pooled, past) if keep else None

    def backward(self, x, words: Lexicon, index, cache, grad, hidden) -> dict[str, np.ndarray]:
        """Gradients of the parameters where ``grad`` is that of the logits.

        ``hidden`` marks words whose word embedding took no part.
        """
        states, inner, alpha, pooled, past = cache
        p = self.p
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"], g["out_bias"] = grad @ pooled, np.array([grad.sum()], np.float32)
        d_pooled = grad[:, None] * p["out"]
        d_states = alpha[..., None] * d_pooled
        d_alpha = np.einsum("nh,tnh->tn", d_pooled, states)
        d_energy = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        g["att_out"] = np.einsum("tn,tnk->k", d_energy, inner)
        d_inner = d_energy[..., None] * p["att_out"] * (1 - inner**2)
        g["att"] = np.einsum("tnh,tnk->hk", states, d_inner)
        d_states += d_inner @ p["att"].T
        d_x = np.zeros_like(x)
        for way in (0, 1):
            rec_rz, rec_c = p["rec"][way][:, : 2 * HIDDEN], p["rec"][way][:, 2 * HIDDEN :]
            steps = np.zeros((index.shape[1], index.shape[0], 3 * HIDDEN), np.float32)
            carry = np.zeros((index.shape[0], HIDDEN), np.float32)
            for _, t, h, r, z, c, m in reversed([s for s in past if s[0] == way]):
                dh = carry + d_states[t, :, way * HIDDEN : (way + 1) * HIDDEN]
                d_c = m * dh * (1 - z) * (1 - c**2)
                d_z = m * dh * (h - c) * z * (1 - z)
                back = d_c @ rec_c.T
                d_r = back * h * r * (1 - r)
                d_rz = np.concatenate([d_r, d_z], axis=1)
                g["rec"][way][:, : 2 * HIDDEN] += h.T @ d_rz
                g["rec"][way][:, 2 * HIDDEN :] += (r * h).T @ d_c
                steps[t] = np.concatenate([d_rz, d_c], axis=1)
                carry = dh * (1 - m * (1 - z)) + back * r + d_rz @ rec_rz.T
            d_gates = _sum_rows(index.T.ravel(), steps.reshape(-1, 3 * HIDDEN), len(x))
            g["in"][way] = x.T @ d_gates
            g["bias"][way] = d_gates.sum(axis=0)
            d_x += d_gates @ p["in"][way].T
        d_x[hidden, :WORD_DIM] = 0
        g["word"] = _sum_rows(words.word_rows, d_x[:, :WORD_DIM], WORD_ROWS)
        spread = np.repeat(d_x[:, WORD_DIM:] / words.char_counts[:, None], words.char_counts, axis=0)
        g["char"] = _sum_rows(words.char_rows, spread, CHAR_ROWS)
        return g


class Adam:
    def __init__(self, rate: float):
        self.rate, self.step = rate, 0
        self.mean: dict[str, np.ndarray] = {}
        self.power: dict[str, np.ndarray] = {}

    def update(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.step += 1
        fix = np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, grad in g.items():
            m = self.mean.setdefault(k, np.zeros_like(grad))
            v = self.power.setdefault(k, np.zeros_like(grad))
            m += 0.1 * (grad - m)
            v += 0.001 * (grad**2 - v)
            p[k] -= (self.rate * fix * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
