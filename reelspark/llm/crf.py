"""Linear-chain conditional random field in numpy: training by forward-backward, decoding by Viterbi, both in batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np

Features = Sequence[Sequence[str]]


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


@dataclass
class Crf:
    """Weights: `emit[feature, label]` and `move[label, label]`; `index` numbers the features seen in training."""

    labels: list[str]
    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray

    def scores(self, sentence: Features) -> np.ndarray:
        """Emission scores, tokens by labels. Features unseen in training weigh nothing."""
        out = np.zeros((len(sentence), len(self.labels)))
        for k, names in enumerate(sentence):
            ids = [i for i in map(self.index.get, names) if i is not None]
            if ids:
                out[k] = self.emit[ids].sum(0)
        return out

    def decode(self, sentences: list[Features], cells: int = 1 << 16) -> list[list[str]]:
        """Best label sequences. Sentences of like length go through Viterbi together, `cells` tokens at most, or one
        sentence alone."""
        return self.decode_scores(sentences, cells, self.scores)

    def decode_scores(self, sentences: list, cells: int = 1 << 16, scores: Callable = lambda s: s) -> list[list[str]]:
        """The same from emission scores of each sentence, or from what `scores` makes them of."""
        out: list[list[str]] = [[] for _ in sentences]
        order = sorted((k for k in range(len(sentences)) if len(sentences[k])), key=lambda k: len(sentences[k]))
        while order:
            longest = len(sentences[order[-1]])
            some = order[-max(1, cells // longest):]
            del order[-len(some):]
            for k, path in zip(some, self._viterbi([scores(sentences[k]) for k in some])):
                out[k] = [self.labels[i] for i in path]
        return out

    def _viterbi(self, scores: list[np.ndarray]) -> list[list[int]]:
        lengths = np.array([len(s) for s in scores])
        batch = np.zeros((len(scores), lengths.max(), len(self.labels)))
        for k, s in enumerate(scores):
            batch[k, :len(s)] = s
        best, back = batch[:, 0], []
        for t in range(1, batch.shape[1]):
            through = best[:, :, None] + self.move
            back.append(through.argmax(1))
            # a sentence that has ended keeps its scores
            best = np.where((t < lengths)[:, None], through.max(1) + batch[:, t], best)
        paths = []
        for k, n in enumerate(lengths):
            path = [int(best[k].argmax())]
            for t in range(n - 2, -1, -1):
                path.append(int(back[t][k, path[-1]]))
            paths.append(path[::-1])
        return paths


def train(
    sentences: list[Features], tags: list[list[str]], allowed: Callable[[str, str], bool],
    rounds: int = 200, rate: float = 0.1, decay: float = 0.02,
) -> Crf:
    """Fit by full-batch Adam on the conditional log-likelihood with an L2 penalty. Deterministic. Moves between labels
    that `allowed` excludes get no probability."""
    labels = sorted({t for tag in tags for t in tag}, key=lambda x: (x != "O", x))
    index = {f: i for i, f in enumerate(sorted({f for s in sentences for names in s for f in names}))}
    n, width = len(sentences), max(map(len, sentences))
    size = len(labels)
    mask = np.zeros((n, width), bool)
    gold = np.zeros((n, width), int)
    rows, cols = [], []
    for k, (s, tag) in enumerate(zip(sentences, tags)):
        mask[k, :len(s)] = True
        gold[k, :len(s)] = [labels.index(t) for t in tag]
        for t, names in enumerate(s):
            rows += [k * width + t] * len(names)
            cols += [index[f] for f in names]
    rows, cols = np.array(rows), np.array(cols)
    barred = np.array([[0.0 if allowed(a, b) else -1e4 for b in labels] for a in labels])
    emit, move = np.zeros((len(index), size)), np.zeros((size, size))
    state = [np.zeros_like(x) for x in (emit, emit, move, move)]
    both = mask[:, 1:] & mask[:, :-1]
    for step in range(1, rounds + 1):
        scores = np.zeros((n * width, size))
        np.add.at(scores, rows, emit[cols])
        scores = scores.reshape(n, width, size)
        moves = move + barred
        ahead, behind = [scores[:, 0]], [np.zeros((n, size))]
        for t in range(1, width):
            nxt = _logsumexp(ahead[-1][:, :, None] + moves, 1) + scores[:, t]
            ahead.append(np.where(mask[:, t, None], nxt, ahead[-1]))
        total = _logsumexp(ahead[-1], 1)
        for t in range(width - 2, -1, -1):
            prev = _logsumexp(moves + (scores[:, t + 1] + behind[-1])[:, None, :], 2)
            behind.append(np.where(mask[:, t + 1, None], prev, behind[-1]))
        a, b = np.stack(ahead, 1), np.stack(behind[::-1], 1)
        seen = np.exp(a + b - total[:, None, None]) * mask[:, :, None]
        pairs = a[:, :-1, :, None] + moves + (scores[:, 1:] + b[:, 1:])[:, :, None, :] - total[:, None, None, None]
        pairs = np.exp(np.minimum(pairs, 0)) * both[:, :, None, None]
        wanted = np.eye(size)[gold] * mask[:, :, None]
        grad_emit = np.zeros_like(emit)
        np.add.at(grad_emit, cols, (wanted - seen).reshape(-1, size)[rows])
        grad_move = -pairs.sum((0, 1))
        np.add.at(grad_move, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        for x, g, m, v in ((emit, grad_emit, *state[:2]), (move, grad_move, *state[2:])):
            g -= decay * x
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Crf(labels, index, emit, move + barred)
