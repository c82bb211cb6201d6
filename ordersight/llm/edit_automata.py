"""Words one edit apart, as accepted pairs of a composition of finite-state machines.

``Acceptor`` is the minimal acyclic automaton of sorted words, with one initial transition per
group of words. Composed with a transducer that copies letters and edits exactly one, and with
the acceptor again, it accepts the pairs of words one edit apart. Before the edit both copies of
the acceptor are in the same state, as it is deterministic; after it they go on together as
long as they have a letter in common.
"""

from __future__ import annotations

from collections.abc import Iterator


class Acceptor:
    """A minimal acyclic automaton; equal states are shared by all groups."""

    def __init__(self) -> None:
        self.moves: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        self._edits: dict[int, list[tuple[str, str]]] = {}

    def _new(self) -> int:
        self.moves.append({})
        self.final.append(False)
        return len(self.moves) - 1

    def add_group(self, words: list[str]) -> int:
        """The initial state of ``words``, sorted and different."""
        root, before = self._new(), ""
        path: list[tuple[int, str, int]] = []

        def settle(depth: int) -> None:
            while len(path) > depth:
                parent, letter, child = path.pop()
                self.moves[parent][letter] = self._shared(child)

        for word in words:
            common = 0
            while common < min(len(word), len(before)) and word[common] == before[common]:
                common += 1
            settle(common)
            state = path[-1][2] if path else root
            for letter in word[common:]:
                child = self._new()
                self.moves[state][letter] = child
                path.append((state, letter, child))
                state = child
            self.final[state] = True
            before = word
        settle(0)
        return self._shared(root)

    def _shared(self, state: int) -> int:
        """An equal state that is there already, or this one."""
        return self._known.setdefault((self.final[state], *self.moves[state].items()), state)

    def _both(self, p: int, q: int, x: str, y: str) -> Iterator[tuple[str, str]]:
        """x and y followed by every word that is accepted from p as well as from q."""
        stack = [(p, q, "")]
        while stack:
            p, q, tail = stack.pop()
            if self.final[p] and self.final[q]:
                yield x + tail, y + tail
            more = self.moves[q]
            for letter, child in self.moves[p].items():
                if letter in more:
                    stack.append((child, more[letter], tail + letter))

    def _edits_at(self, state: int) -> list[tuple[str, str]]:
        """Pairs of endings from ``state`` whose first letters are the edit: (u, v), v the longer or larger.

        A letter is inserted before another one only, so each pair has one edit.
        """
        if state not in self._edits:
            moves, pairs = self.moves[state], []
            for b, child in moves.items():
                for a, other in moves.items():
                    if a < b:
                        pairs += self._both(other, child, a, b)
                    if a != b and a in self.moves[child]:
                        pairs += self._both(other, self.moves[child][a], a, b + a)
                if self.final[state] and self.final[child]:
                    pairs.append(("", b))
            self._edits[state] = pairs
        return self._edits[state]

    def near_pairs(self, initial: int) -> Iterator[tuple[str, str]]:
        """Every two words of a group that are one edit apart, once: (u, v), v the longer or larger."""
        stack = [(initial, "")]
        while stack:
            state, head = stack.pop()
            for u, v in self._edits_at(state):
                yield head + u, head + v
            for letter, child in self.moves[state].items():
                stack.append((child, head + letter))
