"""A small bidirectional gated recurrent classifier in numpy: forward, backward, training.

A word is represented by its embedding and by the last states of a bidirectional recurrent
network over its characters. A second bidirectional network runs over the words of a
window; attention weighs its states, and their weighted mean gives the window's logit.
"""

from __future__ import annotations

import numpy as np

#: Characters are told apart by their code modulo this; 0 stands for none.
CHARACTERS = 96
#: A longer word is represented by consecutive pieces of this length.
WORD_CHARS = 16
WINDOW, STRIDE = 24, 12
CHAR_EMBEDDING, CHAR_STATE = 8, 8
WORD_EMBEDDING, WORD_STATE, ATTENTION = 12, 8, 8


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gru(x: np.ndarray, u: np.ndarray, mask: np.ndarray):
    """States (time, rows, size) from inputs (time, rows, 3 * size); a masked step keeps the state."""
    steps, rows, width = x.shape
    size = width // 3
    h = np.zeros((rows, size), dtype=x.dtype)
    states, kept = np.empty((steps, rows, size), dtype=x.dtype), []
    for t in range(steps):
        hu = h @ u
        gates = sigmoid(x[t, :, : 2 * size] + hu[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        n = np.tanh(x[t, :, 2 * size :] + r * hu[:, 2 * size :])
        m = mask[t][:, None]
        kept.append((h, z, r, n, hu[:, 2 * size :], m))
        h = h + m * (1 - z) * (n - h)
        states[t] = h
    return states, kept


def gru_last(x: np.ndarray, u: np.ndarray, mask: np.ndarray, collect: np.ndarray | None = None) -> np.ndarray:
    """The last state, without what training needs; ``collect`` receives all states."""
    steps, rows, width = x.shape
    size = width // 3
    h = np.zeros((rows, size), dtype=x.dtype)
    for t in range(steps):
        hu = h @ u
        gates = hu[:, : 2 * size]
        gates += x[t, :, : 2 * size]
        np.negative(gates, out=gates)
        np.clip(gates, -30, 30, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        n = hu[:, 2 * size :]
        n *= gates[:, size:]
        n += x[t, :, 2 * size :]
        np.tanh(n, out=n)
        n -= h
        n *= 1 - gates[:, :size]
        n *= mask[t][:, None]
        h = h + n
        if collect is not None:
            collect[t] = h
    return h


def gru_back(d_states: np.ndarray, kept: list, u: np.ndarray):
    """Gradients of the inputs and of ``u``."""
    steps, rows, size = d_states.shape
    dx = np.empty((steps, rows, 3 * size), dtype=d_states.dtype)
    du, dh = np.zeros_like(u), np.zeros((rows, size), dtype=d_states.dtype)
    for t in reversed(range(steps)):
        h, z, r, n, hun, m = kept[t]
        dh = dh + d_states[t]
        go = dh * m
        dn = go * (1 - z) * (1 - n * n)
        dz = go * (h - n) * z * (1 - z)
        dr = dn * hun * r * (1 - r)
        dhu = np.concatenate((dz, dr, dn * r), axis=1)
        dx[t] = np.concatenate((dz, dr, dn), axis=1)
        du += h.T @ dhu
        dh = dh - go * (1 - z) + dhu @ u.T
    return dx, du


def new_parameters(vocabulary: int, seed: int = 2) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    c, s, e, h = CHAR_EMBEDDING, CHAR_STATE, WORD_EMBEDDING, WORD_STATE
    shapes = {
        "char": (CHARACTERS, c), "word": (vocabulary, e),
        "cw_f": (c, 3 * s), "cw_b": (c, 3 * s), "cu_f": (s, 3 * s), "cu_b": (s, 3 * s),
        "ww_f": (e + 2 * s, 3 * h), "ww_b": (e + 2 * s, 3 * h), "wu_f": (h, 3 * h), "wu_b": (h, 3 * h),
        "att": (2 * h, ATTENTION), "out": (2 * h,), "pick": (ATTENTION,),
    }
    p = {k: (rng.standard_normal(v) / np.sqrt(max(v[0], 4) if k not in ("char", "word") else 4)).astype(np.float32) for k, v in shapes.items()}
    p["word"] *= 0.2
    for k, width in (("cb_f", 3 * s), ("cb_b", 3 * s), ("wb_f", 3 * h), ("wb_b", 3 * h), ("att_b", ATTENTION), ("out_b", 1)):
        p[k] = np.zeros(width, dtype=np.float32)
    return p


def spell(words: list[str]) -> np.ndarray:
    """Character numbers (length of the longest, words); 0 beyond a word's end."""
    codes = np.zeros((len(words), max(map(len, words), default=1)), dtype=np.int64)
    joined = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(words) else lengths
    row = np.repeat(np.arange(len(words)), lengths)
    codes[row, np.arange(len(joined)) - np.repeat(starts, lengths)] = joined % (CHARACTERS - 1) + 1
    return codes.T.copy()


def word_inputs(p: dict, numbers: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """What a word adds to the gates of both directions: (words, 6 * WORD_STATE)."""
    mask = (codes > 0).astype(np.float32)
    forward = gru_last((p["char"] @ p["cw_f"] + p["cb_f"])[codes], p["cu_f"], mask)
    backward = gru_last((p["char"] @ p["cw_b"] + p["cb_b"])[codes[::-1]], p["cu_b"], mask[::-1])
    x = np.concatenate((p["word"][numbers], forward, backward), axis=1)
    return np.concatenate((x @ p["ww_f"] + p["wb_f"], x @ p["ww_b"] + p["wb_b"]), axis=1)


def window_logits(p: dict, inputs: np.ndarray, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logits of windows; ``ids`` (WINDOW, windows) are rows of ``inputs``, ``mask`` is 0 beyond the end."""
    half = 3 * WORD_STATE
    states = np.empty((len(ids), ids.shape[1], 2 * WORD_STATE), dtype=np.float32)
    gru_last(inputs[:, :half][ids], p["wu_f"], mask, states[:, :, :WORD_STATE])
    gru_last(inputs[:, half:][ids[::-1]], p["wu_b"], mask[::-1], states[::-1, :, WORD_STATE:])
    scores = np.tanh(states @ p["att"] + p["att_b"]) @ p["pick"]
    weight = np.exp(np.clip(scores, -30, 30)) * mask
    value = states @ p["out"]
    return (weight * value).sum(axis=0) / np.maximum(weight.sum(axis=0), 1e-6) + p["out_b"][0]


def loss_gradients(p: dict, numbers, codes, ids, mask, target, weight) -> tuple[float, dict]:
    """Mean weighted cross entropy of a batch and its gradients. ``ids`` point into the batch's distinct words."""
    g = {}
    c_mask = (codes > 0).astype(np.float32)
    sides = []
    for side, chars, m in (("f", codes, c_mask), ("b", codes[::-1], c_mask[::-1])):
        states, kept = gru((p["char"] @ p[f"cw_{side}"] + p[f"cb_{side}"])[chars], p[f"cu_{side}"], m)
        sides.append((side, chars, states, kept))
    x = np.concatenate((p["word"][numbers], sides[0][2][-1], sides[1][2][-1]), axis=1)
    runs = []
    for side, order in (("f", slice(None)), ("b", slice(None, None, -1))):
        own = (x @ p[f"ww_{side}"] + p[f"wb_{side}"])[ids[order]]
        states, kept = gru(own, p[f"wu_{side}"], mask[order])
        runs.append((side, order, states, kept))
    states = np.concatenate((runs[0][2], runs[1][2][::-1]), axis=2)
    hidden = np.tanh(states @ p["att"] + p["att_b"])
    share = np.exp(np.clip(hidden @ p["pick"], -30, 30)) * mask
    share = share / np.maximum(share.sum(axis=0), 1e-6)
    value = states @ p["out"]
    logit = (share * value).sum(axis=0) + p["out_b"][0]
    chance = sigmoid(logit)
    total = weight.sum()
    loss = float(-(weight * (target * np.log(chance + 1e-7) + (1 - target) * np.log(1 - chance + 1e-7))).sum() / total)

    d_logit = (weight * (chance - target) / total).astype(np.float32)
    g["out_b"] = np.array([d_logit.sum()], dtype=np.float32)
    d_value = share * d_logit
    d_share = share * (value - (share * value).sum(axis=0)) * d_logit
    g["out"] = np.einsum("tb,tbh->h", d_value, states)
    g["pick"] = np.einsum("tb,tba->a", d_share, hidden)
    d_hidden = d_share[:, :, None] * p["pick"] * (1 - hidden * hidden)
    flat = lambda a: a.reshape(-1, a.shape[-1])
    g["att"], g["att_b"] = flat(states).T @ flat(d_hidden), flat(d_hidden).sum(axis=0)
    d_states = d_value[:, :, None] * p["out"] + d_hidden @ p["att"].T
    dx = np.zeros_like(x)
    for (side, order, _, kept), part in zip(runs, (d_states[:, :, :WORD_STATE], d_states[::-1, :, WORD_STATE:])):
        d_in, g[f"wu_{side}"] = gru_back(part, kept, p[f"wu_{side}"])
        d_own = np.zeros((len(x), d_in.shape[2]), dtype=np.float32)
        np.add.at(d_own, ids[order].ravel(), flat(d_in))
        g[f"ww_{side}"], g[f"wb_{side}"] = x.T @ d_own, d_own.sum(axis=0)
        dx += d_own @ p[f"ww_{side}"].T
    g["word"] = np.zeros_like(p["word"])
    np.add.at(g["word"], numbers, dx[:, :WORD_EMBEDDING])
    g["char"] = np.zeros_like(p["char"])
    for (side, chars, c_states, kept), start in zip(sides, (WORD_EMBEDDING, WORD_EMBEDDING + CHAR_STATE)):
        d_last = np.zeros_like(c_states)
        d_last[-1] = dx[:, start : start + CHAR_STATE]
        d_in, g[f"cu_{side}"] = gru_back(d_last, kept, p[f"cu_{side}"])
        by_char = np.stack([np.bincount(chars.ravel(), flat(d_in)[:, k], CHARACTERS) for k in range(d_in.shape[2])], axis=1)
        by_char = by_char.astype(np.float32)
        g[f"cw_{side}"], g[f"cb_{side}"] = p["char"].T @ by_char, by_char.sum(axis=0)
        g["char"] += by_char @ p[f"cw_{side}"].T
    return loss, g


class Adam:
    def __init__(self, p: dict, rate: float = 0.01):
        self.p, self.rate, self.step = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def __call__(self, g: dict) -> None:
        self.step += 1
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        scale = min(1.0, 5.0 / max(norm, 1e-9))
        for k, x in g.items():
            x = x * scale
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.001 * (x * x - self.v[k])
            m = self.m[k] / (1 - 0.9**self.step)
            v = self.v[k] / (1 - 0.999**self.step)
            self.p[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
