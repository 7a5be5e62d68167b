"""All segmentations of a word into vocabulary pieces, and sums over them in log space."""

from __future__ import annotations

from math import exp, inf, log, log1p, prod

import numpy as np

VOCABULARY = "piece_bpe_32k.model"
SPACE_PIECE = "▁"  # stands before every word


class Lattice:
    """Pieces of a public vocabulary, with byte pieces for characters that it lacks.

    An arc (start, end, pieces) covers a part of a word. Every character can be passed, by
    its own piece or by its bytes, so every word has a probability.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.scores = np.array([model.get_score(i) for i in range(self.size)])
        self.end = model.eos_id()
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not model.is_control(i) and not model.is_unknown(i):
                self.ids[piece] = i
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, ((i,), len(piece)))
        self.automaton.make_automaton()
        self.letters = {p for p in self.ids if len(p) == 1}

    def prior(self) -> np.ndarray:
        """Piece probabilities from the vocabulary's own scores.

        Scores fall by one from merge to merge, a rank; probabilities follow it by the
        usual law of ranks. Bytes and the end stand behind all others.
        """
        rank = np.where(self.scores > -1e8, -self.scores, self.size)
        rank[[*self.bytes, self.end]] = self.size
        weight = 1.0 / (rank + 10.0)
        used = {*self.ids.values(), *self.bytes, self.end}
        weight[[i for i in range(self.size) if i not in used]] = 0
        return weight / weight.sum()

    def arcs(self, word: str) -> list[tuple[int, int, tuple[int, ...]]]:
        """Arcs by end: all pieces that end at each place, and bytes of characters without a piece."""
        out = [(end + 1 - n, end + 1, piece) for end, (piece, n) in self.automaton.iter(word)]
        if not self.letters.issuperset(word):
            out += [(i, i + 1, tuple(self.bytes[b] for b in c.encode("utf-8", "surrogatepass"))) for i, c in enumerate(word) if c not in self.letters]
            out.sort()
            out.sort(key=lambda arc: arc[1])
        return out


def forward(n: int, arcs: list, logs: list[float]) -> list[float]:
    """Log probability, summed over all segmentations, of each prefix."""
    alpha = [-inf] * (n + 1)
    alpha[0] = 0.0
    for i, j, piece in arcs:
        x = alpha[i] + (logs[piece[0]] if len(piece) == 1 else sum(logs[p] for p in piece))
        y = alpha[j]
        if y == -inf:
            alpha[j] = x
        elif x > y:
            alpha[j] = x + log1p(exp(y - x))
        else:
            alpha[j] = y + log1p(exp(x - y))
    return alpha


def forward_plain(n: int, arcs: list, shares: list[float]) -> float:
    """The same sum for a whole short word with plain probabilities; 0 if they get too small for a float."""
    alpha = [0.0] * (n + 1)
    alpha[0] = 1.0
    for i, j, piece in arcs:
        alpha[j] += alpha[i] * (shares[piece[0]] if len(piece) == 1 else prod(shares[p] for p in piece))
    return alpha[n]


def expected(n: int, arcs: list, logs: list[float], times: float, into: np.ndarray) -> float:
    """Adds the expected uses of each piece in ``times`` such words; returns the word's log probability."""
    alpha = forward(n, arcs, logs)
    beta = [-inf] * (n + 1)
    beta[n] = 0.0
    for i, j, piece in reversed(arcs):
        x = beta[j] + sum(logs[p] for p in piece)
        y = beta[i]
        beta[i] = x if y == -inf else (x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y)))
    total = alpha[n]
    for i, j, piece in arcs:
        share = times * exp(alpha[i] + sum(logs[p] for p in piece) + beta[j] - total)
        for p in piece:
            into[p] += share
    return total


def expected_plain(n: int, arcs: list, shares: list[float], times: float, into: list[float]) -> bool:
    """The same uses with plain probabilities, for short words; False, and nothing added, if they get too small."""
    alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
    alpha[0] = beta[n] = 1.0
    weighed = [(i, j, piece, shares[piece[0]] if len(piece) == 1 else prod(shares[p] for p in piece)) for i, j, piece in arcs]
    for i, j, _, x in weighed:
        alpha[j] += alpha[i] * x
    if alpha[n] < 1e-290:
        return False
    for i, j, _, x in reversed(weighed):
        beta[i] += beta[j] * x
    scale = times / alpha[n]
    for i, j, piece, x in weighed:
        use = alpha[i] * x * beta[j] * scale
        for p in piece:
            into[p] += use
    return True


def log_table(p: np.ndarray) -> list[float]:
    return [log(x) if x > 0 else -inf for x in p.tolist()]
