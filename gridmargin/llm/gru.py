"""A gated recurrent language model in numpy, with a class-factored output.

Frequent words (the head) have slots in classes of equal size and a softmax in their class.
All other words belong to a tail class, in which the chance of a word is its share of the
counts. The network predicts the class from everything read so far, and the word in a head
class. Inputs are head slots and tail classes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HEAD_CLASSES, CLASS_SIZE, TAIL_CLASSES = 32, 32, 24
HEAD = HEAD_CLASSES * CLASS_SIZE
INPUTS, CLASSES = HEAD + TAIL_CLASSES, HEAD_CLASSES + TAIL_CLASSES
EMBEDDED, HIDDEN = 24, 32
WINDOW = 32
LEAST_LANES, SAME_LANES = 16, 16  # batches grow from so many documents, doubled after so many
_NEVER = -1e9
_SHAPES = {
    "embed": (INPUTS, EMBEDDED),
    "wx": (EMBEDDED, 3 * HIDDEN),
    "b": (3 * HIDDEN,),
    "wh": (HIDDEN, 3 * HIDDEN),
    "wc": (HIDDEN, CLASSES),
    "bc": (CLASSES,),
    "ww": (HEAD_CLASSES, HIDDEN, CLASS_SIZE),
    "bw": (HEAD_CLASSES, CLASS_SIZE),
}
SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())


@dataclass
class Parameters:
    """All weights as one flat array, with named views into it."""

    flat: np.ndarray

    def __post_init__(self) -> None:
        at = 0
        for name, shape in _SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size


def initial(head_counts: np.ndarray, tail_counts: np.ndarray, seed: int = 0) -> Parameters:
    """Small random weights; the biases make the model predict the counts at first."""
    rng = np.random.default_rng(seed)
    p = Parameters((rng.standard_normal(SIZE) * 0.08).astype(np.float32))
    words = np.zeros(HEAD)
    words[: len(head_counts)] = head_counts
    words = words.reshape(HEAD_CLASSES, CLASS_SIZE)
    classes = np.concatenate([words.sum(axis=1), tail_counts + 0.5])
    with np.errstate(divide="ignore"):
        p.bw[:] = np.maximum(np.log(words) - np.log(np.maximum(words.sum(axis=1, keepdims=True), 1)), _NEVER)
        p.bc[:] = np.maximum(np.log(classes) - np.log(classes.sum()), _NEVER)
    p.b[:] = 0
    p.b[HIDDEN : 2 * HIDDEN] = 1.0  # remember by default
    p.ww[:] *= 0.3
    p.wc[:] *= 0.3
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function, in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _log_sums(x: np.ndarray) -> np.ndarray:
    """Log of the summed exponentials of each row; bounded weights can't overflow it."""
    np.minimum(x, 80, out=x)
    return np.log(np.exp(x).sum(axis=1))


def _softmax(x: np.ndarray) -> np.ndarray:
    """Chances of each row, in place; bounded weights can't overflow them."""
    np.exp(np.minimum(x, 80, out=x), out=x)
    x *= 1 / x.sum(axis=1, keepdims=True)
    return x


def _by_class(targets: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Head classes that occur among targets, with the rows of each."""
    head = np.flatnonzero(targets < HEAD)
    classes = targets[head] // CLASS_SIZE
    order = np.argsort(classes, kind="stable")
    cuts = np.searchsorted(classes[order], np.arange(HEAD_CLASSES + 1))
    return [
        (c, head[order[cuts[c] : cuts[c + 1]]]) for c in range(HEAD_CLASSES) if cuts[c] < cuts[c + 1]
    ]


def class_of(targets: np.ndarray) -> np.ndarray:
    return np.where(targets < HEAD, targets // CLASS_SIZE, targets - HEAD + HEAD_CLASSES)


def log_likelihoods(p: Parameters, docs: list[np.ndarray], lanes: int = 512) -> np.ndarray:
    """Natural log of the class and head-word probabilities of every whole document.

    ``docs`` holds arrays of inputs, each ending with the end token (slot 0), which is also
    what comes before a text. The state is carried from window to window.
    """
    out = np.zeros(len(docs))
    gates = p.embed @ p.wx + p.b
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    for at in range(0, len(order), lanes):
        some = order[at : at + lanes]
        lengths = np.array([len(docs[i]) for i in some])
        h = np.zeros((len(some), HIDDEN), np.float32)
        last = np.zeros(len(some), np.int64)
        for start in range(0, int(lengths[0]), WINDOW):
            active = int(np.searchsorted(-lengths, -start))  # lengths fall
            steps = min(WINDOW, int(lengths[0]) - start)
            targets = np.zeros((steps, active), np.int64)
            real = np.zeros((steps, active), bool)
            for j in range(active):
                piece = docs[some[j]][start : start + steps]
                targets[: len(piece), j] = piece
                real[: len(piece), j] = True
            h, last = h[:active], last[:active]
            states = np.empty((steps, active, HIDDEN), np.float32)
            for t in range(steps):
                gx, gh = gates[last], h @ p.wh
                rz = _sigmoid(gx[:, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN])
                new = gh[:, 2 * HIDDEN :]
                new *= rz[:, :HIDDEN]
                new += gx[:, 2 * HIDDEN :]
                np.tanh(new, out=new)
                h = h - new
                h *= rz[:, HIDDEN:]
                h += new
                states[t] = h
                last = targets[t]
            chance = np.zeros((steps, active))
            chance[real] = _token_logs(p, states[real], targets[real])
            out[some[:active]] += chance.sum(axis=0)
    return out


def _token_logs(p: Parameters, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    logits = states @ p.wc + p.bc
    logs = logits[np.arange(len(targets)), class_of(targets)] - _log_sums(logits)
    for c, rows in _by_class(targets):
        logits = states[rows] @ p.ww[c] + p.bw[c]
        logs[rows] += logits[np.arange(len(rows)), targets[rows] % CLASS_SIZE] - _log_sums(logits)
    return logs


def batch_sizes(n: int, lanes: int) -> list[int]:
    """Sizes of the batches that ``n`` documents are read in: small first, up to ``lanes``.

    Many small steps at first let few documents teach something, too; the rule is the same
    for any number of documents.
    """
    sizes = []
    while n > 0:
        sizes.append(min(n, lanes, LEAST_LANES << (len(sizes) // SAME_LANES)))
        n -= sizes[-1]
    return sizes


def train(
    p: Parameters, docs: list[np.ndarray], lanes: int = 256, rate: float = 4e-3, seed: int = 0
) -> tuple[Parameters, int]:
    """Truncated backpropagation through time, once over ``docs``; new weights and tokens read.

    Documents of like length share a batch. The state runs on from window to window, gradients
    stop at a window's start. The result depends on the documents alone, not on their order.
    """
    p = Parameters(p.flat.copy())
    rng = np.random.default_rng(seed)
    first, second = np.zeros(SIZE, np.float32), np.zeros(SIZE, np.float32)
    fixed = p.flat <= _NEVER / 2  # slots without a word stay impossible
    step = tokens = 0
    docs = sorted((d for d in docs if len(d)), key=lambda d: (len(d), d.tobytes()))
    sizes = batch_sizes(len(docs), lanes)
    # Batches take random places among the documents sorted by length.
    places = rng.permutation(len(sizes))
    ends = np.cumsum([sizes[b] for b in places])
    end_of = dict(zip(places.tolist(), ends.tolist(), strict=True))
    for b, size in enumerate(sizes):
        batch = docs[end_of[b] - size : end_of[b]][::-1]
        h = np.zeros((size, HIDDEN), np.float32)
        last = np.zeros(size, np.int64)
        for start in range(0, len(batch[0]), WINDOW):
            pieces = [d[start : start + WINDOW] for d in batch if len(d) > start]
            h, last = h[: len(pieces)], last[: len(pieces)]
            gradient, h, last, read = _window_gradient(p, pieces, h, last)
            step += 1
            tokens += read
            norm = float(np.sqrt(gradient @ gradient))
            gradient *= min(1.0, 1.0 / (norm + 1e-9))
            gradient[fixed] = 0
            first += 0.1 * (gradient - first)
            second += 0.01 * (gradient**2 - second)
            p.flat -= (rate / (1 - 0.9**step)) * first / (
                np.sqrt(second / (1 - 0.99**step)) + 1e-8
            )
    return p, tokens


def _window_gradient(
    p: Parameters, pieces: list[np.ndarray], h: np.ndarray, last: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    steps, lanes = len(pieces[0]), len(pieces)
    targets, real = np.zeros((steps, lanes), np.int64), np.zeros((steps, lanes), bool)
    for j, piece in enumerate(pieces):
        targets[: len(piece), j] = piece
        real[: len(piece), j] = True
    inputs = np.concatenate([last[None], targets[:-1]])
    gates = p.embed @ p.wx + p.b
    before = np.empty((steps, lanes, HIDDEN), np.float32)
    opened = np.empty((steps, lanes, 2 * HIDDEN), np.float32)
    news, news_h, states = np.empty_like(before), np.empty_like(before), np.empty_like(before)
    for t in range(steps):
        gx, gh = gates[inputs[t]], h @ p.wh
        rz = _sigmoid(gx[:, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN])
        new = np.tanh(gx[:, 2 * HIDDEN :] + rz[:, :HIDDEN] * gh[:, 2 * HIDDEN :])
        before[t], opened[t], news[t], news_h[t] = h, rz, new, gh[:, 2 * HIDDEN :]
        h = new + rz[:, HIDDEN:] * (h - new)
        states[t] = h

    grad = Parameters(np.zeros(SIZE, np.float32))
    d_states = np.zeros_like(states)
    s, y = states[real], targets[real]
    n = len(y)
    error = _softmax(s @ p.wc + p.bc)
    error[np.arange(n), class_of(y)] -= 1
    error *= np.float32(1 / n)
    grad.wc[:], grad.bc[:] = s.T @ error, error.sum(axis=0)
    ds = error @ p.wc.T
    for c, rows in _by_class(y):
        some = s[rows]
        inside = _softmax(some @ p.ww[c] + p.bw[c])
        inside[np.arange(len(rows)), y[rows] % CLASS_SIZE] -= 1
        inside *= np.float32(1 / n)
        grad.ww[c], grad.bw[c] = some.T @ inside, inside.sum(axis=0)
        ds[rows] += inside @ p.ww[c].T
    d_states[real] = ds

    # What the last step of the chain rule multiplies the gradient of a state by, for all steps.
    r, z = opened[:, :, :HIDDEN], opened[:, :, HIDDEN:]
    by_new = (1 - z) * (1 - news**2)
    by_r = by_new * news_h * r * (1 - r)
    by_z = (before - news) * z * (1 - z)
    d_gx = np.empty((steps, lanes, 3 * HIDDEN), np.float32)
    d_gh = np.empty_like(d_gx)
    dh = np.zeros((lanes, HIDDEN), np.float32)
    back = np.ascontiguousarray(p.wh.T)
    for t in range(steps - 1, -1, -1):
        dh += d_states[t]
        x = d_gx[t]
        np.multiply(dh, by_r[t], out=x[:, :HIDDEN])
        np.multiply(dh, by_z[t], out=x[:, HIDDEN : 2 * HIDDEN])
        np.multiply(dh, by_new[t], out=x[:, 2 * HIDDEN :])
        d_gh[t] = x
        d_gh[t][:, 2 * HIDDEN :] *= r[t]
        dh = dh * z[t] + d_gh[t] @ back
    grad.wh[:] = before.reshape(-1, HIDDEN).T @ d_gh.reshape(-1, 3 * HIDDEN)
    # Gradients of equal inputs are added up first; few of the inputs occur often.
    flat, order = d_gx.reshape(-1, 3 * HIDDEN), np.argsort(inputs.ravel(), kind="stable")
    used, firsts = np.unique(inputs.ravel()[order], return_index=True)
    sums = np.add.reduceat(flat[order], firsts, axis=0)
    grad.wx[:] = p.embed[used].T @ sums
    grad.b[:] = sums.sum(axis=0)
    grad.embed[used] = sums @ p.wx.T
    # The state of a finished lane is never read again.
    return grad.flat, h, targets[-1], n
