"""A gated recurrent network over words with a class-factored output, in numpy."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

F4 = np.float32
HIDDEN = 24
_OFTEN = 8
PARTS = ("x", "u", "class_w", "class_b", "word_w", "word_b")


@dataclass
class Network:
    """Parameters; token ids are in order of frequency, so that each class is a range of ids.

    ``x`` holds what each token adds to the update gate, the reset gate and the candidate, ``u`` what the state adds.
    """

    starts: np.ndarray
    end: int
    x: np.ndarray
    u: np.ndarray
    class_w: np.ndarray
    class_b: np.ndarray
    word_w: np.ndarray
    word_b: np.ndarray

    @staticmethod
    def of_counts(counts: np.ndarray, end: int, classes: int = 64, seed: int = 0) -> Network:
        """A network that predicts by frequency alone, whatever the state; ``counts`` fall.

        Classes hold about equal sums of the counts' square roots, and so few frequent words or many rare ones.
        """
        n = len(counts)
        share = np.cumsum(np.sqrt(counts))
        cuts = np.searchsorted(share, share[-1] * np.arange(1, classes) / classes) + 1
        starts = np.unique(np.concatenate(([0], np.minimum(cuts, n), [n])))
        sums = np.add.reduceat(counts, starts[:-1])
        of = np.repeat(np.arange(len(sums)), np.diff(starts))
        rng = np.random.default_rng(seed)
        return Network(
            starts, end,
            (rng.standard_normal((n, 3 * HIDDEN)) * 0.3).astype(F4),
            (rng.standard_normal((HIDDEN, 3 * HIDDEN)) / np.sqrt(HIDDEN)).astype(F4),
            np.zeros((HIDDEN, len(sums)), F4), np.log(sums / sums.sum()).astype(F4),
            np.zeros((n, HIDDEN), F4), np.log(counts / sums[of]).astype(F4),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, p).ravel() for p in PARTS])

    def with_flat(self, values: np.ndarray) -> Network:
        parts, at = {}, 0
        for p in PARTS:
            shape = getattr(self, p).shape
            size = int(np.prod(shape))
            parts[p] = values[at : at + size].reshape(shape).astype(F4)
            at += size
        return Network(self.starts, self.end, **parts)

    def frequency_log_p(self, targets: np.ndarray) -> np.ndarray:
        """Natural log probabilities by the biases alone; those of a new network are the counts' shares."""
        of = np.searchsorted(self.starts, targets, side="right") - 1
        return self.class_b[of] + self.word_b[targets]

    def joint(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of classes and of words, each with the biases, which a unit that is always 1 multiplies."""
        return np.vstack((self.class_w, self.class_b)), np.column_stack((self.word_w, self.word_b))

    def log_p(self, states: np.ndarray, targets: np.ndarray, gradients: dict | None = None) -> np.ndarray:
        """Natural log probabilities of the targets; fills in gradients of their negative sum where asked for."""
        result, found = log_p(self.starts, *self.joint(), states, targets, gradients is not None)
        if gradients is not None:
            of_classes, of_words, gradients["states"] = found
            gradients["class_w"], gradients["class_b"] = of_classes[:-1], of_classes[-1]
            gradients["word_w"], gradients["word_b"] = of_words[:, :-1], of_words[:, -1]
        return result


def _in_range(sums: np.ndarray) -> bool:
    """Whether sums of exponentials are far from the ends of single precision."""
    return not len(sums) or bool(sums.min() > 1e-20 and sums.max() < 1e30)


def log_p(
    starts: np.ndarray, classes: np.ndarray, words: np.ndarray, states: np.ndarray, targets: np.ndarray, learn: bool
) -> tuple[np.ndarray, tuple[np.ndarray, ...] | None]:
    """Natural log probabilities of the targets; where asked for, gradients of their negative sum by classes, words and states.

    Rows are sorted by class, and the words' logits of all rows lie in one array, so that only products are taken class by
    class. Logits are lowered by their greatest only where their exponentials would leave the range of single precision.
    """
    n, widths = len(targets), np.diff(starts)
    of = np.repeat(np.arange(len(widths), dtype=np.int16 if len(widths) < 1 << 15 else np.int64), widths)[targets]
    order = np.argsort(of, kind="stable")
    of, targets, rows = of[order], targets[order], np.arange(n)
    own = np.ones((n, HIDDEN + 1), F4)
    own[:, :-1] = states.take(order, axis=0)
    with np.errstate(over="ignore"):
        logits = own @ classes
        found = logits[rows, of]
        p = np.exp(logits)
        total = p @ np.ones(len(widths), F4)
        if not _in_range(total):
            greatest = logits.max(axis=1)
            found -= greatest
            p = np.exp(logits - greatest[:, None])
            total = p.sum(axis=1)
        found -= np.log(total)

        # A class of one word gives it for certain.
        wide = np.flatnonzero(widths[of] > 1)
        sizes = widths[of[wide]]
        at = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), F4)
        ends, blocks, filled = np.searchsorted(of, np.arange(len(starts))).tolist(), [], 0
        for first, last, low, high in zip(ends, ends[1:], starts.tolist(), starts[1:].tolist()):
            if first < last and low + 1 < high:
                block = flat[filled : filled + (last - first) * (high - low)].reshape(last - first, high - low)
                blocks.append((block, slice(first, last), slice(low, high)))
                filled += block.size

        def fill() -> None:
            for block, some, its in blocks:
                np.dot(own[some], words[its].T, out=block)

        fill()
        mine = at + targets[wide] - starts[of[wide]]
        word = flat[mine]
        sums = np.add.reduceat(np.exp(flat, out=flat), at) if len(at) else word
        if not _in_range(sums):
            fill()
            greatest = np.maximum.reduceat(flat, at)
            word -= greatest
            flat -= np.repeat(greatest, sizes)
            sums = np.add.reduceat(np.exp(flat, out=flat), at)
        found[wide] += word - np.log(sums)
    result = np.empty(n, F4)
    result[order] = found
    if not learn:
        return result, None
    p /= total[:, None]
    p[rows, of] -= 1
    of_words, of_states = np.zeros_like(words), p @ classes.T
    flat *= np.repeat(1 / sums, sizes)
    flat[mine] -= 1
    for block, some, its in blocks:
        np.dot(block.T, own[some], out=of_words[its])
        of_states[some] += np.dot(block, words[its])
    back = np.empty(n, np.int64)
    back[order] = rows
    return result, (own.T @ p, of_words, of_states.take(back, axis=0)[:, :-1])


class Lanes:
    """Texts dealt out to lanes of about equal length, read side by side in windows."""

    def __init__(self, texts: Sequence[np.ndarray], end: int, lanes: int):
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        heap = [(0, k) for k in range(min(lanes, len(texts)))]
        dealt: list[list[int]] = [[] for _ in heap]
        for i in order:
            load, k = heap[0]
            dealt[k].append(i)
            heapq.heapreplace(heap, (load + len(texts[i]) + 1, k))
        loads = [sum(len(texts[i]) + 1 for i in d) for d in dealt]
        dealt = [dealt[k] for k in sorted(range(len(dealt)), key=lambda k: -loads[k])]
        self.loads = np.array(sorted(loads, reverse=True), np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.loads)))[:-1]
        self.texts = [i for d in dealt for i in d]
        stop = np.array([end], np.int32)
        self.targets = np.concatenate([part for i in self.texts for part in (texts[i], stop)])
        self.inputs = np.concatenate((stop, self.targets[:-1]))
        lengths = np.array([len(texts[i]) + 1 for i in self.texts])
        self.text_starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]

    def windows(self, steps: int):
        """Places of the tokens of each window (steps × lanes still going) and which of them are there.

        Windows grow longer, up to 16 times, as lanes end, so that each holds about as many tokens.
        """
        at = 0
        while at < int(self.loads[0]):
            going = int(np.searchsorted(-self.loads, -at, side="left"))
            size = steps * min(16, len(self.loads) // going)
            offsets = at + np.arange(min(size, int(self.loads[0]) - at))[:, None]
            there = offsets < self.loads[None, :going]
            yield np.where(there, self.first[None, :going] + offsets, self.first[None, :going]), there
            at += size


def _run(net: Network, inputs: np.ndarray, state: np.ndarray, keep: bool) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """States (steps, units, lanes) after each token of a window; a state starts anew at a text's start.

    Units come before lanes, so that the numbers of a gate lie together. Also, if they are to be kept, what backpropagation
    needs of each step: the states before, what they add, the gates and the candidate.
    """
    steps, lanes = inputs.shape
    add = np.ascontiguousarray(net.x.take(inputs, axis=0).transpose(0, 2, 1))
    goes_on = (inputs != net.end).astype(F4)
    weights = net.u.T.copy()
    weights[: 2 * HIDDEN] *= -1
    result = np.empty((steps, HIDDEN, lanes), F4)
    kept = tuple(np.empty((steps if keep else 1, k * HIDDEN, lanes), F4) for k in (1, 3, 2, 1))
    with np.errstate(over="ignore"):
        for t in range(steps):
            before, own, gates, candidate = (k[t if keep else 0] for k in kept)
            np.multiply(state, goes_on[t], out=before)
            np.dot(weights, before, out=own)
            np.subtract(own[: 2 * HIDDEN], add[t, : 2 * HIDDEN], out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.divide(1, gates, out=gates)
            np.multiply(gates[HIDDEN:], own[2 * HIDDEN :], out=candidate)
            candidate += add[t, 2 * HIDDEN :]
            np.tanh(candidate, out=candidate)
            state = np.subtract(before, candidate, out=result[t])
            state *= gates[:HIDDEN]
            state += candidate
    return result, kept


def _rows(values: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Numbers (steps, units, lanes) as a row for each token that is there."""
    rows = values.transpose(0, 2, 1)
    return rows.reshape(-1, values.shape[1]) if there.all() else rows[there]


def score_texts(net: Network, texts: Sequence[np.ndarray], lanes: int = 384, steps: int = 32) -> np.ndarray:
    """Natural log probability of each text with its end; the state is carried across windows."""
    if not texts:
        return np.empty(0)
    dealt = Lanes(texts, net.end, lanes)
    classes, words = net.joint()
    found = np.empty(len(dealt.targets))
    state = np.zeros((HIDDEN, len(dealt.loads)), F4)
    for places, there in dealt.windows(steps):
        states, _ = _run(net, dealt.inputs[places], state[:, : places.shape[1]], keep=False)
        state = states[-1]
        at = places[there]
        found[at], _ = log_p(net.starts, classes, words, _rows(states, there), dealt.targets[at], learn=False)
    sums = np.add.reduceat(found, dealt.text_starts)
    result = np.empty(len(texts))
    result[dealt.texts] = sums
    return result


def train(net: Network, texts: Sequence[np.ndarray], lanes: int = 128, steps: int = 16, rate: float = 0.1) -> Network:
    """One pass of stochastic gradient descent with truncated backpropagation; steps adapt to each parameter's past gradients.

    Gradients go back to the start of a window; the state is carried across.
    """
    if not texts:
        return net
    dealt = Lanes(texts, net.end, lanes)
    net = net.with_flat(net.flat())
    classes, words = net.joint()
    moved = (net.u, classes, words)
    past = [np.full_like(values, 1e-2) for values in moved]
    past_x = np.full_like(net.x, 1e-2)
    state = np.zeros((HIDDEN, len(dealt.loads)), F4)
    for places, there in dealt.windows(steps):
        inputs = dealt.inputs[places]
        states, kept = _run(net, inputs, state[:, : places.shape[1]], keep=True)
        state = states[-1]
        _, (of_classes, of_words, of_states) = log_p(net.starts, classes, words, _rows(states, there), dealt.targets[places[there]], learn=True)
        if there.all():
            d_out = of_states.reshape(*places.shape, HIDDEN)
        else:
            d_out = np.zeros((*places.shape, HIDDEN), F4)
            d_out[there] = of_states
        d_x, d_u = _gradients(net, inputs, np.ascontiguousarray(d_out.transpose(0, 2, 1)), *kept)
        scale = 1 / float(np.sqrt(there.sum()))
        for values, sums, d in zip(moved, past, (d_u, of_classes, of_words)):
            d *= scale
            np.clip(d, -5, 5, out=d)
            sums += d * d
            d *= rate
            d /= np.sqrt(sums)
            values -= d
        seen, d = _by_token(inputs[there], _rows(d_x, there))
        d *= scale
        sums = past_x.take(seen, axis=0) + d * d
        past_x[seen] = sums
        net.x[seen] -= rate * d / np.sqrt(sums)
    parts = (net.x, net.u, classes[:-1], classes[-1], words[:, :-1], words[:, -1])
    return net.with_flat(np.concatenate([part.ravel() for part in parts]))


def _by_token(tokens: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens, and the sum of the rows of each."""
    order = np.argsort(tokens.astype(np.int16 if tokens.max() < 1 << 15 else np.int32), kind="stable")
    tokens, values = tokens[order], values.take(order, axis=0)
    starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    sizes = np.diff(np.append(starts, len(tokens)))
    # Rows of frequent tokens are added up whole; of those that come a few times, the first ones, the second ones and so on.
    sums = values.take(starts, axis=0)
    for k in range(1, min(int(sizes.max()), _OFTEN)):
        more = np.flatnonzero((sizes > k) & (sizes <= _OFTEN))
        sums[more] += values.take(starts[more] + k, axis=0)
    for i in np.flatnonzero(sizes > _OFTEN).tolist():
        sums[i] = values[starts[i] : starts[i] + sizes[i]].sum(axis=0)
    return tokens[starts], sums


def _gradients(
    net: Network, inputs: np.ndarray, d_out: np.ndarray, before: np.ndarray, own: np.ndarray, gates: np.ndarray, candidate: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Gradients by what the tokens of a window add (steps, units, lanes) and by the weights of the state, from those by its states."""
    steps, lanes = inputs.shape
    update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
    goes_on = (inputs != net.end).astype(F4)
    # What a state's gradient is multiplied by for the update gate, the reset gate and the candidate.
    through = np.empty((steps, 3, HIDDEN, lanes), F4)
    stay = 1 - update
    to_candidate = (1 - candidate * candidate) * stay
    np.multiply((before - candidate) * update, stay, out=through[:, 0])
    np.multiply(to_candidate, reset, out=through[:, 2])
    np.multiply(through[:, 2] * own[:, 2 * HIDDEN :], 1 - reset, out=through[:, 1])
    d_states, d_state = d_out, np.zeros((HIDDEN, lanes), F4)
    for t in range(steps - 1, -1, -1):
        d = d_states[t]
        d += d_state
        through[t] *= d
        d_state = np.dot(net.u, through[t].reshape(3 * HIDDEN, lanes))
        d_state += d * update[t]
        d_state *= goes_on[t]
    d_own = through.reshape(steps, 3 * HIDDEN, lanes)
    d_u = np.matmul(before, d_own.transpose(0, 2, 1)).sum(axis=0)
    np.multiply(d_states, to_candidate, out=through[:, 2])
    return d_own, d_u
