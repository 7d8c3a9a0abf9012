"""Levenshtein automata with transpositions (optimal string alignment), made deterministic step by step and shared by all texts.

A state is a set of positions (offset, edits, swapped) relative to a base in the text. What a character does to a state
depends only on at which of the next few places of the text it stands; so transitions are found once for each state and
pattern of places, and then looked up, whatever the text.
"""

from __future__ import annotations


class Automaton:
    """All states for one number of edits; the same for every text."""

    def __init__(self, edits: int) -> None:
        self.edits = edits
        self.window = (1 << (2 * edits + 2)) - 1
        self.positions: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.next: list[dict[int, tuple[int, int]]] = []
        self.start = self._state({(0, 0, False)})[0]

    def _state(self, positions: set[tuple]) -> tuple[int, int]:
        """(number, shift of the base) of a set of positions, without those that others make needless."""
        kept = [p for p in positions if not any(not q[2] and q[1] < p[1] and p[1] - q[1] >= abs(p[0] - q[0]) for q in positions if not p[2])]
        base = min(p[0] for p in kept)
        key = tuple(sorted((i - base, e, s) for i, e, s in kept))
        if key not in self.number:
            self.number[key] = len(self.positions)
            self.positions.append(key)
            self.next.append({})
        return self.number[key], base

    def step(self, state: int, places: int) -> tuple[int, int]:
        """(state, shift) after a character that stands at the places (bits) behind the base; state -1 if no text is near."""
        known = self.next[state]
        if places in known:
            return known[places]
        reached = set()
        for i, e, swapped in self.positions[state]:
            at = places >> i
            if swapped:
                if at & 1:
                    reached.add((i + 2, e, False))
                continue
            if at & 1:
                reached.add((i + 1, e, False))
            if e < self.edits:
                reached |= {(i, e + 1, False), (i + 1, e + 1, False)}
                if at & 2:
                    reached.add((i, e + 1, True))
                reached |= {(i + k + 1, e + k, False) for k in range(1, self.edits - e + 1) if at >> k & 1}
        known[places] = self._state(reached) if reached else (-1, 0)
        return known[places]

    def distance(self, state: int, left: int) -> int | None:
        """Edits of a whole word that ended in state with left characters of the text behind the base; None if too many."""
        ends = [e + left - i for i, e, swapped in self.positions[state] if not swapped and i <= left]
        return min(ends) if ends and min(ends) <= self.edits else None


_KNOWN: dict[int, Automaton] = {}


def automaton(edits: int) -> Automaton:
    if edits not in _KNOWN:
        _KNOWN[edits] = Automaton(edits)
    return _KNOWN[edits]
