"""A hidden Markov model over symbols: Baum-Welch counts and scaled forward recursion.

Sequences step together, longest first, so every step works on all sequences that still have
symbols and nothing is padded. Symbols are laid out step by step, states as rows, so a step reads
and writes whole rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SCALE_STEPS = 8  # eight emissions of 1e-30 are still far from the smallest double


@dataclass
class Hmm:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states, columns sum to 1

    @property
    def states(self) -> int:
        return len(self.start)


@dataclass
class Counts:
    """Expected starts, moves and emissions."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def zero(cls, symbols: int, states: int) -> Counts:
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states)))

    def fade(self, share: float) -> None:
        """Keep a share of all counts."""
        self.start *= share
        self.move *= share
        self.emit *= share

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, rows): emissions by symbol, then moves, then starts."""
        used = np.flatnonzero(self.emit.any(axis=1))
        symbols, states = self.emit.shape
        return (np.concatenate((used, symbols + np.arange(states + 1))),
                np.concatenate((self.emit[used], self.move, self.start[None, :])))

    @classmethod
    def from_rows(cls, numbers: np.ndarray, rows: np.ndarray, symbols: int, states: int) -> Counts:
        whole = np.zeros((symbols + states + 1, states))
        whole[numbers] = rows
        return cls(whole[-1], whole[symbols:-1], whole[:symbols])


def estimate(counts: Counts, prior: np.ndarray) -> Hmm:
    """Parameters from expected counts; ``prior`` (symbols) keeps every symbol possible."""
    start = counts.start + 0.1
    move = counts.move + 0.1
    emit = counts.emit + prior[:, None]
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True),
               emit / emit.sum(axis=0))


def first_guess(prior: np.ndarray, states: int, seed: int = 7) -> Hmm:
    """States that mostly stay, with the overall emissions shaken at random."""
    random = np.random.default_rng(seed)
    emit = prior[:, None] * random.uniform(0.2, 1.8, (len(prior), states))
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9)
    return Hmm(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True),
               emit / emit.sum(axis=0))


def _in_step(symbols: np.ndarray, lengths: np.ndarray) -> tuple[
        np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the sequences, how many have a symbol at each step, where the steps begin, and the
    symbols step by step."""
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths.max()) if len(lengths) else 0
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    at = np.cumsum(active) - active
    place = np.repeat(np.arange(longest), active)
    rank = np.arange(len(place)) - at[place]
    return order, active, at, symbols[begins[rank] + place]


def log10_likelihoods(model: Hmm, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Exact log10 probability of each sequence; ``symbols`` holds them end to end.

    States are rows and sequences columns, scaled every ``SCALE_STEPS`` steps and where one ends.
    """
    order, active, at, stepwise = _in_step(symbols, lengths)
    seen = np.ascontiguousarray(model.emit.T)[:, stepwise]
    move = np.ascontiguousarray(model.move.T)
    total = np.zeros(len(lengths))
    forward = np.repeat(model.start[:, None], len(lengths), axis=1)
    ending = np.append(np.diff(active) < 0, True) | (np.arange(len(active)) % SCALE_STEPS == 0)
    for t, (n, k, scaled) in enumerate(zip(active.tolist(), at.tolist(), ending.tolist())):
        if n < forward.shape[1]:
            forward = forward[:, :n]
        forward = (move @ forward if t else forward) * seen[:, k:k + n]
        if scaled:
            scale = forward.sum(axis=0)
            forward /= scale
            total[order[:n]] += np.log10(scale)
    return total


def expect(model: Hmm, symbols: np.ndarray, lengths: np.ndarray, counts: Counts) -> None:
    """Add the expected counts of the sequences (forward-backward).

    States are rows and sequences columns, scaled every ``SCALE_STEPS`` steps.
    """
    order, active, at, stepwise = _in_step(symbols, lengths)
    if not len(stepwise):
        return
    seen = np.ascontiguousarray(model.emit.T)[:, stepwise]
    forwards = np.empty_like(seen)
    ahead_of = np.ascontiguousarray(model.move.T)
    scales = {}
    steps = list(enumerate(zip(active.tolist(), at.tolist())))
    forward = np.repeat(model.start[:, None], active[0], axis=1)
    for t, (n, k) in steps:
        forward = np.multiply(ahead_of @ forward[:, :n] if t else forward, seen[:, k:k + n],
                              out=forwards[:, k:k + n])
        if t % SCALE_STEPS == 0:
            scales[t] = forward.sum(axis=0)
            forward /= scales[t]
    # Posteriors of a sequence sum to 1 if its backward recursion starts at 1 / (last forward sum).
    lasts = at[lengths[order][:active[0]] - 1] + np.arange(active[0])
    backward = np.repeat((1 / forwards[:, lasts].sum(axis=0))[None, :], model.states, axis=0)
    moves = np.zeros_like(model.move)
    for t, (n, k) in reversed(steps):
        here, now = backward[:, :n], seen[:, k:k + n]
        ahead = now * here
        # No longer needed as emission: now the posterior.
        np.multiply(forwards[:, k:k + n], here, out=now)
        if t:
            if t in scales:
                ahead /= scales[t]
            before = at[t - 1]
            moves += forwards[:, before:before + n] @ ahead.T
            np.matmul(model.move, ahead, out=here)
    counts.move += moves * model.move
    counts.start += seen[:, :active[0]].sum(axis=1)
    for k in range(model.states):
        counts.emit[:, k] += np.bincount(stepwise, seen[k], len(counts.emit))
