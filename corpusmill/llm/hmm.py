"""Hidden Markov model over symbol sequences in numpy: scaled forward, forward-backward, starting clusters.

Sequences are advanced together, one symbol a step, the longest first. All sums
run over states in a fixed order, each sequence for itself, and what is added up
over sequences are whole numbers: results do not depend on which sequences are
worked on together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Units of the whole numbers that expected counts, likelihoods and the two factors of moves are added up in.
COUNT, LOG, LEFT, RIGHT = 1 << 20, 1 << 12, 1 << 20, 1 << 16
LOW = 24


@dataclass
class Hmm:
    """``emit[symbol, state]``, ``move[from, to]``, ``begin`` at a text's start."""

    begin: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _through(x: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Columns of ``x`` (state, sequence) times ``matrix``; a product of BLAS would depend on the number of columns."""
    return np.add.reduce(matrix[:, :, None] * x[:, None, :], axis=0)


def _total(x: np.ndarray) -> np.ndarray:
    """Sums over states, one after the other also where there is one column."""
    return np.add.reduce(x, axis=0) if x.shape[1] > 1 else np.add.accumulate(x, axis=0)[-1]


@dataclass
class _Steps:
    """Symbols step by step: step t has ``running[t]`` sequences from ``offset[t]`` on, the first of ``order``."""

    order: np.ndarray
    running: np.ndarray
    offset: np.ndarray
    rank: np.ndarray
    symbols: np.ndarray


def _steps(symbols: np.ndarray, bounds: np.ndarray) -> _Steps:
    length = np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    first, length = bounds[:-1][order], length[order]
    running = np.searchsorted(-length, -np.arange(1, length.max(initial=0) + 1), side="right")
    offset = np.concatenate([[0], np.cumsum(running)]).astype(np.int64)
    rank = np.arange(offset[-1]) - np.repeat(offset[:-1], running)
    return _Steps(order, running, offset, rank, symbols[first[rank] + np.repeat(np.arange(len(running)), running)])


def log10_forward(m: Hmm, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """log10 probability of each whole sequence ``symbols[bounds[i]:bounds[i + 1]]``; 0 of an empty one."""
    s = _steps(symbols, bounds)
    emit = np.ascontiguousarray(m.emit.T)
    total = np.zeros(len(s.order))
    alpha = m.begin[:, None]
    for t, n in enumerate(s.running):
        a = _through(alpha[:, :n], m.move) if t else alpha
        a = a * np.take(emit, s.symbols[s.offset[t]:s.offset[t] + n], axis=1)
        scale = _total(a)
        alpha = a / scale
        total[:n] += np.log10(scale)
    out = np.empty(len(total))
    out[s.order] = total
    return out


def expected_sums(m: Hmm, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whole numbers that add up over sequences: begin, likelihood, moves (high and low parts), emissions by symbol."""
    k, size = len(m.begin), len(m.emit)
    out = np.zeros((2 + 2 * k + size, k), dtype=np.int64)
    s = _steps(symbols, bounds)
    if not len(s.symbols):
        return out
    move, back = m.move.astype(np.float32), np.ascontiguousarray(m.move.T, dtype=np.float32)
    emit = np.take(np.ascontiguousarray(m.emit.T, dtype=np.float32), s.symbols, axis=1)
    alpha, scale = np.empty_like(emit), np.empty(emit.shape[1], dtype=np.float32)
    span = [slice(a, b) for a, b in zip(s.offset[:-1], s.offset[1:], strict=True)]
    for t, n in enumerate(s.running):
        a = _through(alpha[:, s.offset[t - 1]:s.offset[t - 1] + n], move) if t else m.begin.astype(np.float32)[:, None]
        a = a * emit[:, span[t]]
        scale[span[t]] = _total(a)
        np.divide(a, scale[span[t]], out=alpha[:, span[t]])
    gamma = alpha.copy()
    beta = np.ones((k, len(s.order)), dtype=np.float32)
    emit /= scale
    for t in range(len(s.running) - 1, 0, -1):
        gamma[:, span[t]] *= beta[:, :s.running[t]]
        emit[:, span[t]] *= beta[:, :s.running[t]]
        beta[:, :s.running[t]] = _through(emit[:, span[t]], back)
    gamma[:, span[0]] *= beta[:, :s.running[0]]
    gamma /= _total(gamma)
    gamma *= np.float32(COUNT)
    np.rint(gamma, out=gamma)
    out[0] = gamma[:, span[0]].astype(np.float64).sum(axis=1)
    logs = np.bincount(s.rank, weights=np.log10(scale.astype(np.float64)))
    out[1, 0] = np.rint(logs * LOG).sum()
    moved = np.zeros((k, k), dtype=np.int64)
    later = np.arange(s.running[0], len(s.symbols))
    earlier = later - np.repeat(s.running[:-1], s.running[1:])
    for i in range(0, len(later), 1 << 11):  # so few that sums of whole numbers stay exact
        left = np.rint(alpha[:, earlier[i:i + (1 << 11)]].astype(np.float64) * LEFT)
        right = np.rint(emit[:, later[i:i + (1 << 11)]].astype(np.float64) * RIGHT)
        moved += (left @ right.T).astype(np.int64)
    out[2:2 + k], out[2 + k:2 + 2 * k] = moved >> LOW, moved & ((1 << LOW) - 1)
    for j in range(k):
        out[2 + 2 * k:, j] = np.bincount(s.symbols, weights=gamma[j], minlength=size)
    return out


def counts_of(m: Hmm, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts (begin, move, emit) and log10 likelihood from added ``expected_sums`` under ``m``."""
    k = len(m.begin)
    sums = sums.astype(float)
    moved = (sums[2:2 + k] * (1 << LOW) + sums[2 + k:2 + 2 * k]) / (LEFT * RIGHT)
    return sums[0] / COUNT, moved * m.move, sums[2 + 2 * k:] / COUNT, sums[1, 0] / LOG


def expected(m: Hmm, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts (begin, move, emit) of whole sequences, and their log10 likelihood."""
    return counts_of(m, expected_sums(m, symbols, bounds))


def maximise(begin: np.ndarray, move: np.ndarray, emit: np.ndarray, plain: np.ndarray, strength: float) -> Hmm:
    """The model of expected counts, each state's emissions drawn to the distribution ``plain``."""
    def rows(x: np.ndarray) -> np.ndarray:
        return (x + 1.0) / (x + 1.0).sum(axis=-1, keepdims=True)
    emit = emit + strength * plain[:, None]
    return Hmm(rows(begin), rows(move), emit / emit.sum(axis=0))


def cluster_sums(emit: np.ndarray, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whole numbers: symbols of each state when every sequence belongs to states by its own symbols alone."""
    length = np.diff(bounds)
    owner = np.repeat(np.arange(len(length)), length)
    logs = np.stack([np.bincount(owner, weights=column[symbols], minlength=len(length)) for column in np.log(emit).T])
    # Tempered, or a long text would belong to one cluster from the first round on.
    logs /= np.maximum(1.0, length / 20)
    share = np.exp(logs - logs.max(axis=0))
    share = np.rint(share / _total(share) * COUNT)
    return np.stack([np.bincount(symbols, weights=s[owner], minlength=len(emit)) for s in share], axis=1).astype(np.int64)


def mixture(emit: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Emissions of clusters with these counts."""
    emit = emit + 50 * plain[:, None]
    return emit / emit.sum(axis=0)


def sticky(emit: np.ndarray) -> Hmm:
    """The start: states that tend to stay, with these emissions."""
    states = emit.shape[1]
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9)
    return Hmm(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit)
