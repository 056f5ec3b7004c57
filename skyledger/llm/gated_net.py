"""A bidirectional gated recurrent network with attention pooling, in numpy.

The network reads windows of words.  A word's input is its own embedding (words that
were not learned share one) beside the mean of the embeddings of its character n-grams,
which are hashed, so any word of any corpus has an input.  A gated recurrent layer runs over the window
in either direction, an attention layer weighs the positions, and the weighted state
gives the window's log odds.  A document's log odds are those of its highest window.

Training is plain back-propagation with Adam over documents (each a bag of windows).
"""

from __future__ import annotations

import numpy as np

VOCABULARY = 1 << 15   # bound of the words with an embedding of their own
KNOWN_FROM = 3         # documents of the fit sample that must hold such a word
CHAR_BITS = 17
NGRAMS = (3, 4, 5)
WORD_DIM = CHAR_DIM = 8
HIDDEN = 12
ATTENTION = 8
EPOCHS = 4
BATCH_DOCS = 48
RATE = 0.02
SOFT_EPOCHS = 2     # epochs in which all windows of a document share its error
DECAY = 0.02        # of the embeddings, by step and rate: what few documents show fades
PSEUDO = 3.0        # documents added to the counts behind the starting log odds


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def _tanh(x: np.ndarray) -> np.ndarray:
    return 2 * _sigmoid(2 * x) - 1


def known_words(words: list[str], held: list[np.ndarray]) -> dict[str, int]:
    """Rows (from 1) of the words that ``KNOWN_FROM`` documents or more hold, the most
    frequent first, ``VOCABULARY`` - 1 at most; row 0 is for all others."""
    n = np.bincount(np.concatenate(held), minlength=len(words))
    order = sorted(np.flatnonzero(n >= KNOWN_FROM), key=lambda i: (-n[i], words[i]))
    return {words[i]: row for row, i in enumerate(order[:VOCABULARY - 1], 1)}


def word_rows(known: dict[str, int], words: list[str]) -> np.ndarray:
    return np.fromiter((known.get(w, 0) for w in words), np.int64, len(words))


def char_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of each word (with its ends marked), one word
    after another, and the start of each word's."""
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), np.uint32) \
        .astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    found, owners = [], []
    for n in NGRAMS:
        if len(codes) < n:
            continue
        end = len(codes) - n + 1
        h = np.full(end, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(1_000_003) + codes[j:end + j]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        inside = owner[:end] == owner[n - 1:]
        found.append((h[inside] >> np.uint64(64 - CHAR_BITS)).astype(np.int64))
        owners.append(owner[:end][inside])
    buckets, own = (np.concatenate(found), np.concatenate(owners)) if found else \
        (np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = np.argsort(own, kind="stable")
    return buckets[order], np.append(0, np.cumsum(np.bincount(own, minlength=len(words))))


def segment_means(rows: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Means of consecutive rows; every segment has one row or more."""
    return np.add.reduceat(rows, start[:-1], axis=0) / np.diff(start)[:, None]


def initial(word_odds: np.ndarray, char_odds: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Random weights; the first dimension of either table starts as given log odds."""
    rng = np.random.default_rng(seed)

    def normal(*shape, scale=0.1):
        return rng.normal(0, scale, shape).astype(np.float32)

    dim, h = WORD_DIM + CHAR_DIM, HIDDEN
    net = {"word": normal(len(word_odds), WORD_DIM), "char": normal(len(char_odds), CHAR_DIM)}
    for side in ("f", "b"):
        net["x" + side] = normal(dim, 3 * h, scale=0.4)
        net["u" + side] = normal(h, 3 * h, scale=0.3)
        net["c" + side] = np.zeros(3 * h, np.float32)
        net["n" + side] = np.zeros(h, np.float32)
    net.update(aw=normal(2 * h, ATTENTION, scale=0.4), ab=np.zeros(ATTENTION, np.float32),
               av=normal(ATTENTION, scale=0.4), ow=normal(2 * h, scale=0.4),
               ob=np.zeros(1, np.float32))
    net["word"][:, 0], net["char"][:, 0] = word_odds, char_odds
    return net


def inputs(net: dict, words: np.ndarray, buckets: np.ndarray, start: np.ndarray) -> np.ndarray:
    return np.concatenate([net["word"][words], segment_means(net["char"][buckets], start)], 1)


def _direction(net, side, projected, index, filled, keep):
    """States (windows, steps, hidden) of one direction; with ``keep``, also what the
    way back needs.  Padding leaves the state as it is."""
    u, bias, size = net["u" + side], net["n" + side], HIDDEN
    windows, steps = index.shape
    state = np.zeros((windows, size), np.float32)
    states = np.empty((windows, steps, size), np.float32)
    held = []
    for t in (range(steps) if side == "f" else range(steps - 1, -1, -1)):
        x, a = projected[index[:, t]], state @ u
        gates = _sigmoid(x[:, :2 * size] + a[:, :2 * size])
        z, r = gates[:, :size], gates[:, size:]
        c = a[:, 2 * size:] + bias
        n = _tanh(x[:, 2 * size:] + r * c)
        new = n + z * (state - n)
        m = filled[:, t, None]
        new = np.where(m, new, state)
        if keep:
            held.append((t, state, z, r, c, n, m))
        state = new
        states[:, t] = state
    return states, held


def project(net: dict, vectors: np.ndarray) -> dict[str, np.ndarray]:
    """What each word adds to the gates of either direction."""
    return {side: (vectors @ net["x" + side] + net["c" + side]).astype(np.float32)
            for side in "fb"}


def forward(net: dict, projected: dict[str, np.ndarray], index: np.ndarray, filled: np.ndarray,
            keep: bool = False):
    """Log odds of windows: ``index`` (windows, steps) into the projected words, ``filled``
    says which steps hold a word (one at least)."""
    sides = {side: _direction(net, side, projected[side], index, filled, keep) for side in "fb"}
    both = np.concatenate([sides["f"][0], sides["b"][0]], 2)
    u = _tanh(both @ net["aw"] + net["ab"])
    e = np.where(filled, u @ net["av"], -np.inf)
    weight = np.exp(e - e.max(1, keepdims=True))
    weight /= weight.sum(1, keepdims=True)
    pooled = np.matmul(weight[:, None, :], both)[:, 0]
    logit = pooled @ net["ow"] + net["ob"][0]
    return (logit, (sides, both, u, weight, pooled)) if keep else logit


def backward(net: dict, vectors: np.ndarray, index: np.ndarray, kept, d_logit: np.ndarray) \
        -> tuple[dict, np.ndarray]:
    """Gradients of the weights and of ``vectors`` for the errors ``d_logit``."""
    sides, both, u, weight, pooled = kept
    grad = {"ow": pooled.T @ d_logit, "ob": np.array([d_logit.sum()], np.float32)}
    d_pooled = d_logit[:, None] * net["ow"]
    d_both = weight[:, :, None] * d_pooled[:, None, :]
    d_weight = np.einsum("bth,bh->bt", both, d_pooled)
    d_e = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
    d_u = d_e[:, :, None] * net["av"] * (1 - u * u)
    flat = both.reshape(-1, both.shape[2])
    grad["av"] = np.einsum("bt,bta->a", d_e, u)
    grad["aw"] = flat.T @ d_u.reshape(-1, d_u.shape[2])
    grad["ab"] = d_u.sum((0, 1))
    d_both += d_u @ net["aw"].T
    size, positions = HIDDEN, index.reshape(-1)
    order = np.argsort(positions, kind="stable")
    first = np.flatnonzero(np.diff(positions[order], prepend=-1))
    d_vectors = np.zeros_like(vectors)
    for at, side in enumerate("fb"):
        d_states = d_both[:, :, at * size:(at + 1) * size]
        weights = net["u" + side]
        d_x = np.zeros((*index.shape, 3 * size), np.float32)
        d_u_side, d_n = np.zeros_like(weights), np.zeros(size, np.float32)
        d_h = np.zeros((len(index), size), np.float32)
        for t, state, z, r, c, n, m in reversed(sides[side][1]):
            d_h = d_h + d_states[:, t]
            d_new = np.where(m, d_h, 0)
            d_in = d_new * (1 - z) * (1 - n * n)
            d_c = d_in * r
            d_a = np.concatenate([d_new * (state - n) * z * (1 - z), d_in * c * r * (1 - r), d_c], 1)
            d_x[:, t, :2 * size], d_x[:, t, 2 * size:] = d_a[:, :2 * size], d_in
            d_u_side += state.T @ d_a
            d_n += d_c.sum(0)
            d_h = np.where(m, d_new * z, d_h) + d_a @ weights.T
        rows = np.add.reduceat(d_x.reshape(-1, 3 * size)[order], first, axis=0)
        used = positions[order][first]
        grad["u" + side], grad["n" + side] = d_u_side, d_n
        grad["x" + side], grad["c" + side] = vectors[used].T @ rows, rows.sum(0)
        d_vectors[used] += rows @ net["x" + side].T
    return grad, d_vectors


class Adam:
    def __init__(self, net: dict, rate: float) -> None:
        self.rate, self.steps = rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in net.items()}
        self.square = {k: np.zeros_like(v) for k, v in net.items()}

    def step(self, net: dict, grad: dict) -> None:
        self.steps += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.steps) / (1 - 0.9 ** self.steps)
        for k, g in grad.items():
            m, s = self.mean[k], self.square[k]
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            net[k] -= (scale * m / (np.sqrt(s) + 1e-6)).astype(np.float32)
            if k in ("word", "char"):
                net[k] *= 1 - self.rate * DECAY


def log_odds(buckets: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Smoothed log odds of each bucket by the documents that hold it, kept small."""
    n = [np.zeros(size), np.zeros(size)]
    for own, label in zip(buckets, labels):
        n[label][own] += 1
    sizes = [max((labels == i).sum(), 1) for i in (0, 1)]
    share = [(c + PSEUDO * m / sum(sizes)) / (m + PSEUDO) for c, m in zip(n, sizes)]
    return np.clip(0.3 * np.log(share[1] / share[0]), -1.5, 1.5).astype(np.float32)


def _scatter(rows: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Sum of ``rows`` by ``at`` (size, width)."""
    return np.stack([np.bincount(at, rows[:, d], size) for d in range(rows.shape[1])], 1)


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, words: list[str],
          epochs: int = EPOCHS, seed: int = 7) -> tuple[dict[str, np.ndarray], dict[str, int]]:
    """A network, and the words it knows, from documents given as (index, filled) of
    their windows, with indices into ``words``, and 0/1 labels (both must occur)."""
    from .bpe import gather
    held = [np.unique(index[filled]) for index, filled in docs]
    known = known_words(words, held)
    own_words, (chars, start) = word_rows(known, words), char_buckets(words)
    net = initial(log_odds([np.unique(own_words[h]) for h in held], labels, len(known) + 1),
                  log_odds([np.unique(gather(chars, start, h)[0]) for h in held], labels,
                           1 << CHAR_BITS), seed)
    adam, rng = Adam(net, RATE), np.random.default_rng(seed)
    for epoch in range(epochs):
        if epoch == epochs - 1:
            adam.rate = RATE / 4
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH_DOCS):
            batch = order[at:at + BATCH_DOCS]
            index = np.concatenate([docs[i][0] for i in batch])
            filled = np.concatenate([docs[i][1] for i in batch])
            sizes = np.array([len(docs[i][0]) for i in batch])
            used, place = np.unique(index, return_inverse=True)
            place = place.reshape(index.shape)
            own_chars, lengths = gather(chars, start, used)
            bounds = np.append(0, np.cumsum(lengths))
            vectors = inputs(net, own_words[used], own_chars, bounds)
            logit, kept = forward(net, project(net, vectors), place, filled, keep=True)
            # a document's windows share its error: by softmax first, then the highest alone
            first = np.append(0, np.cumsum(sizes)[:-1])
            top = np.repeat(np.maximum.reduceat(logit, first), sizes)
            share = np.exp(logit - top) if epoch < SOFT_EPOCHS else (logit == top).astype(np.float32)
            share = share / np.repeat(np.add.reduceat(share, first), sizes)
            score = np.add.reduceat(share * logit, first)
            error = (_sigmoid(score) - labels[batch]) / len(batch)
            d_logit = (np.repeat(error, sizes) * share).astype(np.float32)
            grad, d_vectors = backward(net, vectors, place, kept, d_logit)
            grad["word"] = _scatter(d_vectors[:, :WORD_DIM], own_words[used], len(net["word"]))
            grad["char"] = _scatter(np.repeat(d_vectors[:, WORD_DIM:] / lengths[:, None], lengths, 0),
                                    own_chars, 1 << CHAR_BITS)
            adam.step(net, grad)
    return net, known
