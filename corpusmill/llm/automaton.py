"""Levenshtein automata intersected with a trie of terms, as one table of transitions.

A state of the intersection is a set of (trie node, edits so far). The sets
that can be reached are numbered once on the driver; their number depends on
the lexicon alone. Texts then only look transitions up, for all words at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np

#: What a word turns out to be, strongest first; 0 is nothing.
NOTHING, WORD, STEM, WORD_1, WORD_2, STEM_1 = range(6)


def edits_allowed(term: str) -> int:
    """Longer terms may differ in more letters: none below 5, one below 8, then two."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


@dataclass(frozen=True)
class Automaton:
    """``step[state, symbol]``, state 0 dead and 1 the start; ``verdict[state]`` and ``term[state]`` at a word's end.

    ``final`` states are not left again, whatever letters follow.
    """

    symbols: str
    step: np.ndarray
    verdict: np.ndarray
    term: np.ndarray
    final: np.ndarray


def build(words: Sequence[str], stems: Sequence[str], strict: Iterable[str] = (),
          harmless: Iterable[str] = ()) -> Automaton:
    """Automaton of whole words and stems (any ending), numbered in this order.

    Terms in ``strict`` have to be met letter by letter; ``harmless`` words are
    never taken for a misspelling.
    """
    children: list[dict[str, int]] = [{}]
    ends: list[set[tuple[str, int, int]]] = [set()]
    strict = set(strict)

    def add(term: str, kind: str, edits: int, number: int = -1) -> None:
        node = 0
        for c in term:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                ends.append(set())
            node = children[node][c]
        ends[node].add((kind, 0 if term in strict else edits, number))

    for i, w in enumerate(words):
        add(w, "word", edits_allowed(w), i)
    for i, s in enumerate(stems):
        add(s, "stem", min(1, edits_allowed(s)), len(words) + i)
    for w in harmless:
        add(w, "harmless", 0)
    reach = [0] * len(children)  # the most edits of any term below a node
    for node in range(len(children) - 1, -1, -1):
        reach[node] = max([e for _, e, _ in ends[node]] + [reach[c] for c in children[node].values()], default=0)

    def closed(items: set[tuple[int, int]]) -> frozenset:
        todo, out = list(items), set(items)
        while todo:
            node, e = todo.pop()
            if node < 0:  # past the end of stem -1 - node
                continue
            for kind, most, term in ends[node]:
                if kind == "stem" and e <= most:
                    out.add((-1 - term, e))
            for child in children[node].values():  # a letter that the text leaves out
                if e < reach[child] and (child, e + 1) not in out:
                    out.add((child, e + 1))
                    todo.append((child, e + 1))
        best: dict[int, int] = {}
        for node, e in out:
            best[node] = min(e, best.get(node, e))
        return frozenset(best.items())

    def moved(state: frozenset, c: str | None) -> frozenset:
        out = set()
        for node, e in state:
            if node < 0:
                out.add((node, e))
                continue
            for letter, child in children[node].items():
                if letter == c:
                    out.add((child, e))
                elif e < reach[child]:
                    out.add((child, e + 1))
            if e < reach[node]:
                out.add((node, e + 1))
        return closed(out) if out else frozenset()

    def verdict(state: frozenset) -> tuple[int, int]:
        found = [(9, -1)]
        for node, e in state:
            if node < 0:
                found.append((STEM if e == 0 else STEM_1, -1 - node))
                continue
            for kind, most, term in ends[node]:
                if kind == "harmless" and e == 0:
                    found.append((0, -1))
                if kind == "word" and e <= most:
                    found.append(((WORD, WORD_1, WORD_2)[e], term))
        exact = [f for f in found if f[0] in (WORD, STEM)]
        return min(exact or found) if min(exact or found)[0] < 9 else (NOTHING, -1)

    symbols = "".join(sorted({c for node in children for c in node}))
    number, states, rows = {frozenset(): 0}, [frozenset()], []
    start = closed({(0, 0)})
    number[start] = 1
    states.append(start)
    i = 0
    while i < len(states):
        row = []
        for c in [None, *symbols]:
            to = moved(states[i], c) if i else frozenset()
            if to not in number:
                number[to] = len(states)
                states.append(to)
            row.append(number[to])
        rows.append(row)
        i += 1
    told = np.array([verdict(s) for s in states], dtype=np.int32)
    final = np.array([not s or any(n < 0 and e == 0 for n, e in s) for s in states])
    return Automaton(symbols, np.array(rows, dtype=np.int32), told[:, 0], told[:, 1], final)


def judge(a: Automaton, symbol: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verdict and term of each word ``symbol[start:end]``, all words one letter at a time."""
    state = np.ones(len(start), dtype=np.int32)
    live, t = np.arange(len(start)), 0
    while len(live):
        state[live] = a.step[state[live], symbol[start[live] + t]]
        t += 1
        live = live[~a.final[state[live]] & (start[live] + t < end[live])]
    return a.verdict[state], a.term[state]
