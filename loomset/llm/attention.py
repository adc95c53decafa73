"""A small causal self-attention model over subword ids, trained and run in numpy.

Positions come in blocks. The window of a block is the block itself and the one before it, so
windows overlap by half and each position is scored once, with between one and two blocks of
context. A block attends to both by a batched product under a causal mask with a learned bias per
distance. Every id has an embedding of its own. The output is the class of the next id; it starts from the log-probabilities of classes
after the last id, which are counted over the whole training corpus, and attention corrects them.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import cached_property

import numpy as np

BLOCK = 32
WIDTH = 16
HIDDEN = 24
#: Blocks that are run at once; their intermediate results stay in a core's cache.
SLAB = 64
#: Scores within this of 0 are raised as they are; others by what they lack to the largest.
SAFE = 40.0
#: How far back a key of the window lies from each position of its second block; the last number is for
#: keys that lie ahead.
_BACK = BLOCK + np.arange(BLOCK)[:, None] - np.arange(2 * BLOCK)
_BACK[_BACK < 0] = 2 * BLOCK


@dataclass
class AttentionModel:
    """Weights; ``prior`` and ``kind`` are fixed, the rest is learned."""

    prior: np.ndarray  # (ids + 1, classes): log probabilities; the last row is the text's start
    kind: np.ndarray  # (ids + 1,): class of an id; the text's start has one of its own
    embed: np.ndarray  # (ids + 1, width)
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    distance: np.ndarray  # (2 * block,): added to the product by how far back the key lies
    mix: np.ndarray  # (2 * width, hidden)
    out: np.ndarray  # (hidden, classes)
    bias: np.ndarray

    @classmethod
    def fresh(cls, prior: np.ndarray, kind: np.ndarray, seed: int = 11) -> AttentionModel:
        rng = np.random.default_rng(seed)
        classes = prior.shape[1]

        def draw(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        return cls(
            prior.astype(np.float32), kind, rng.normal(0, 0.5, (len(kind), WIDTH)).astype(np.float32),
            draw(WIDTH, WIDTH), draw(WIDTH, WIDTH), draw(WIDTH, WIDTH),
            np.linspace(0, -2, 2 * BLOCK).astype(np.float32), draw(2 * WIDTH, HIDDEN),
            np.zeros((HIDDEN, classes), np.float32), np.zeros(classes, np.float32),
        )

    def learned(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self) if f.name not in ("prior", "kind")]

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.learned()])

    def with_flat(self, flat: np.ndarray) -> AttentionModel:
        parts, at = [], 0
        for w in self.learned():
            parts.append(flat[at : at + w.size].reshape(w.shape).astype(np.float32))
            at += w.size
        return AttentionModel(self.prior, self.kind, *parts)

    @cached_property
    def chances(self) -> np.ndarray:
        """The prior as probabilities."""
        return np.exp(self.prior)

    def _asking(self) -> np.ndarray:
        """Weights of the query, scaled, and of an id's own part of the hidden layer."""
        return np.concatenate([self.query * np.float32(1 / np.sqrt(WIDTH)), self.mix[:WIDTH]], 1)

    def _asked(self) -> np.ndarray:
        return np.concatenate([self.key, self.value], 1)

    def tables(self) -> list[np.ndarray]:
        """What each id contributes by itself: query and its own part of the hidden layer; key and value."""
        return [self.embed @ self._asking(), self.embed @ self._asked()]

    def _weights(self, q: np.ndarray, k: np.ndarray, real_before: np.ndarray) -> np.ndarray:
        """Weights of the keys for each query, not yet divided by their sums."""
        weight = np.matmul(q, k.transpose(0, 2, 1))
        if max(weight.max(), -weight.min()) + np.abs(self.distance).max() < SAFE:
            np.exp(weight, out=weight)
            weight *= np.append(np.exp(self.distance), self.distance.dtype.type(0))[_BACK]
        else:
            weight += np.append(self.distance, self.distance.dtype.type(-1e9))[_BACK]
            left = weight[:, :, :BLOCK]
            left += np.where(real_before, np.float32(0), np.float32(-1e9))[:, None, :]
            weight -= weight.max(2, keepdims=True)
            np.exp(weight, out=weight)
        # Real positions come first in a block, so that those which are not real lie ahead of them.
        for cut in np.flatnonzero(~real_before.all(1)).tolist():
            weight[cut, :, :BLOCK] *= real_before[cut]
        return weight

    def _raised(self, asking: np.ndarray, asked: np.ndarray, seen: np.ndarray, real_before: np.ndarray):
        """Corrections of class scores per position, chances raised by them, their sums, and what led to them."""
        weight = self._weights(asking[:, :, :WIDTH], asked[:, :, :WIDTH], real_before)
        total = weight.reshape(-1, 2 * BLOCK) @ np.ones(2 * BLOCK, weight.dtype)
        read = np.matmul(weight, asked[:, :, WIDTH:]).reshape(-1, WIDTH)
        read /= total[:, None]
        # The last column of ones carries the bias.
        hidden = np.ones((len(read), HIDDEN + 1), read.dtype)
        inner = read @ self.mix[WIDTH:]
        inner += asking.reshape(len(read), -1)[:, WIDTH:]
        np.tanh(inner, out=hidden[:, :HIDDEN])
        last = np.concatenate([self.out, self.bias[None]])
        more = hidden @ last
        if np.abs(last).sum(0).max() >= SAFE:
            more -= more.max(1, keepdims=True)
        raised = np.exp(more)
        raised *= np.take(self.chances, seen.ravel(), axis=0)
        return more, raised, raised @ np.ones(raised.shape[1], raised.dtype), (weight, total, read, hidden)

    def _gathered(self, seen: np.ndarray, before: np.ndarray, tables: list[np.ndarray]) -> list[np.ndarray]:
        return [np.take(t, ids, axis=0) for t, ids in zip(tables, (seen, np.concatenate([before, seen], 1)))]

    def forward(self, seen: np.ndarray, before: np.ndarray, real: np.ndarray, real_before: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Log-probabilities (blocks, block, classes) of the class after each seen id.

        ``seen``: input ids of each block; ``before``: those of the block before it; ``real`` tells
        which of them exist, those of a block first. ``tables`` as :meth:`tables` gives them.
        """
        more, _, total, _ = self._raised(*self._gathered(seen, before, tables), seen, real_before)
        return (more + self.prior[seen.ravel()] - np.log(total)[:, None]).reshape(*seen.shape, -1)

    def picked(self, seen: np.ndarray, before: np.ndarray, real: np.ndarray, real_before: np.ndarray, tables: list[np.ndarray], following: np.ndarray) -> np.ndarray:
        """Log-probabilities of the classes of the following ids only."""
        more, _, total, _ = self._raised(*self._gathered(seen, before, tables), seen, real_before)
        return self._of(more, total, seen, self.kind[following]).reshape(seen.shape)

    def _of(self, more: np.ndarray, total: np.ndarray, seen: np.ndarray, classes: np.ndarray) -> np.ndarray:
        seen, classes = seen.ravel(), classes.ravel()
        return more[np.arange(len(seen)), classes] + self.prior[seen, classes] - np.log(total)

    def gradients(self, seen, before, real, real_before, following) -> tuple[float, list[np.ndarray]]:
        """Mean loss of ``following`` over real positions, and its gradients."""
        grads, (more, total, classes, share) = self._slopes(seen, before, real, real_before, following)
        return float(-self._of(more, total, seen, classes) @ share), grads

    def _slopes(self, seen, before, real, real_before, following):
        """Gradients, and what the loss is made of."""
        ids = np.concatenate([before, seen], 1)
        both = np.take(self.embed, ids, axis=0)
        flat, x = both.reshape(-1, WIDTH), both[:, BLOCK:].reshape(-1, WIDTH)
        to_ask, to_be_asked = self._asking(), self._asked()
        asking = (x @ to_ask).reshape(*seen.shape, -1)
        asked = (flat @ to_be_asked).reshape(*ids.shape, -1)
        more, d, total, (weight, sums, read, hidden) = self._raised(asking, asked, seen, real_before)
        classes, share = self.kind[following].ravel(), real.ravel() * more.dtype.type(1 / max(1, np.count_nonzero(real)))
        d *= (share / total)[:, None]
        d[np.arange(len(d)), classes] -= share
        g_last = hidden.T @ d
        hidden = hidden[:, :HIDDEN]
        # Gradients of what a position asks by and of what it is asked for lie side by side.
        d_asking = np.empty_like(asking)
        dh = d @ self.out.T
        dh *= 1 - hidden * hidden
        d_asking.reshape(len(dh), -1)[:, WIDTH:] = dh
        da = dh @ self.mix[WIDTH:].T
        da /= sums[:, None]
        ds = np.matmul(da.reshape(*seen.shape, WIDTH), asked[:, :, WIDTH:].transpose(0, 2, 1))
        ds -= np.einsum("nw,nw->n", da, read).reshape(*seen.shape, 1)
        ds *= weight
        g_distance = np.bincount(_BACK.ravel(), np.ones(len(ds), ds.dtype) @ ds.reshape(len(ds), -1))[:-1]
        np.matmul(ds, asked[:, :, :WIDTH], out=d_asking[:, :, :WIDTH])
        d_asked = np.empty_like(asked)
        np.matmul(ds.transpose(0, 2, 1), asking[:, :, :WIDTH], out=d_asked[:, :, :WIDTH])
        np.matmul(weight.transpose(0, 2, 1), da.reshape(*seen.shape, WIDTH), out=d_asked[:, :, WIDTH:])
        d_asking, d_asked = d_asking.reshape(len(x), -1), d_asked.reshape(len(flat), -1)
        g_asking, g_asked = x.T @ d_asking, flat.T @ d_asked
        d_both = (d_asked @ to_be_asked.T).reshape(both.shape)
        d_both[:, BLOCK:] += (d_asking @ to_ask.T).reshape(*seen.shape, WIDTH)
        places = ids.reshape(-1, 1) * WIDTH + np.arange(WIDTH)
        g_embed = np.bincount(places.ravel(), d_both.ravel(), self.embed.size).reshape(self.embed.shape)
        g_query = g_asking[:, :WIDTH] * np.float32(1 / np.sqrt(WIDTH))
        g_mix = np.concatenate([g_asking[:, WIDTH:], read.T @ dh])
        grads = [g_embed, g_query, g_asked[:, :WIDTH], g_asked[:, WIDTH:], g_distance, g_mix, g_last[:-1], g_last[-1]]
        return grads, (more, total, classes, share)


def blocks(ids: np.ndarray, sizes: np.ndarray, start: int):
    """Cut texts into blocks: seen and following ids, the block before, and which are real.

    ``ids`` holds all texts one after the other, ``sizes`` their lengths. ``start`` is what is seen
    before a text's first id.
    """
    ends = np.cumsum(sizes)
    begins = ends - sizes
    parts = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    place = nth[:, None] * BLOCK + np.arange(BLOCK)
    real = place < sizes[owner, None]
    at = np.where(real, begins[owner, None] + place, 0)
    following = ids[at] if len(ids) else at
    shifted = np.concatenate([[start], ids[:-1]]) if len(ids) else ids
    seen = np.where(real, np.where(place == 0, start, shifted[at]), start)
    before, real_before = np.full_like(seen, start), np.zeros_like(real)
    later = nth > 0
    before[later] = seen[np.flatnonzero(later) - 1]
    real_before[later] = True
    return owner, seen, before, real, real_before, following


def score(model: AttentionModel, within: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural log-probability of each text's ids; every position is scored once.

    ``within[previous, id]`` is the log of what an id's share of its class is after another id.
    """
    total = np.zeros(len(sizes))
    owner, seen, before, real, real_before, following = blocks(ids, sizes, len(model.kind) - 1)
    tables = model.tables()
    for at in range(0, len(owner), SLAB):
        part = slice(at, at + SLAB)
        picked = model.picked(seen[part], before[part], real[part], real_before[part], tables, following[part])
        picked = picked + within[seen[part], following[part]]
        total += np.bincount(owner[part], np.where(real[part], picked, 0).sum(1), len(sizes))
    return total


def train(model: AttentionModel, ids: np.ndarray, sizes: np.ndarray, rate: float = 0.01, batch: int = 16, seed: int = 1) -> AttentionModel:
    """One pass of Adam over all blocks in random order."""
    _, seen, before, real, real_before, following = blocks(ids, sizes, len(model.kind) - 1)
    order = np.random.default_rng(seed).permutation(len(seen))
    # All weights lie in one array, so that a step goes over all of them at once.
    weights, at = model.flat(), 0
    for f in fields(model):
        if f.name not in ("prior", "kind"):
            w = getattr(model, f.name)
            setattr(model, f.name, weights[at : at + w.size].reshape(w.shape))
            at += w.size
    first, second, moved, grad = (np.zeros_like(weights) for _ in range(4))
    for step, at in enumerate(range(0, len(order), batch), 1):
        rows = order[at : at + batch]
        grads, _ = model._slopes(seen[rows], before[rows], real[rows], real_before[rows], following[rows])
        np.concatenate([g.ravel() for g in grads], out=grad, casting="same_kind")
        clip = min(1.0, 1.0 / max(float(np.sqrt(grad @ grad)), 1e-8))
        # A tenth of the gradient moves the mean; its square is the hundredth that moves the mean of squares.
        np.multiply(grad, 0.1 * clip, out=moved)
        first *= 0.9
        first += moved
        np.multiply(moved, moved, out=moved)
        second *= 0.99
        second += moved
        level = (1 - 0.99**step) ** 0.5
        np.sqrt(second, out=moved)
        moved += 1e-6 * level
        np.divide(first, moved, out=moved)
        moved *= rate * level / (1 - 0.9**step)
        weights -= moved
    return model
