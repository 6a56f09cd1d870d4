"""Suffix automaton of one or more lists of words."""

from __future__ import annotations

from collections.abc import Hashable, Iterator


class SuffixAutomaton:
    """All runs of words of the lists it was built from; each state knows the lists that hold its runs, if they have labels."""

    def __init__(self, *lists: list[str], labels: list[Hashable] | None = None) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.owners: list[set] = []
        for line in lists:
            last = 0
            for w in line:
                last = self._extend(last, w)
        if labels is not None:
            self.owners = [set() for _ in self.link]
            for line, label in zip(lists, labels):
                state = 0
                for w in line:
                    state = self.next[state][w]
                    at = state
                    while at > 0 and label not in self.owners[at]:
                        self.owners[at].add(label)
                        at = self.link[at]

    def _state(self, edges: dict[str, int], link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _twin(self, p: int, q: int, w: str) -> int:
        """``q`` as reached from ``p``: itself if no longer runs end there, else a copy for the shorter runs."""
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = twin
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, w: str) -> int:
        if w in self.next[last]:  # another list has this run already
            return self._twin(last, self.next[last][w], w)
        cur = self._state({}, 0, self.length[last] + 1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            self.link[cur] = self._twin(p, self.next[p][w], w)
        return cur

    def matches(self, line: list[str]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest run of the lists that ends at each word of ``line``."""
        state = size = 0
        for w in line:
            edges = self.next[state]
            while state and w not in edges:
                state = self.link[state]
                size = self.length[state]
                edges = self.next[state]
            if w in edges:
                state = edges[w]
                size += 1
            yield state, size

    def covered(self, line: list[str], least: int) -> int:
        """How many words of ``line`` lie in runs of ``least`` words or more that are here too."""
        total = done = 0
        for i, (_, size) in enumerate(self.matches(line), 1):
            if size >= least:
                start = max(done, i - size)
                total += i - start
                done = i
        return total

    def holders(self, state: int, least: int) -> set:
        """Labels of the lists that hold the last ``least`` words of a match in ``state``."""
        while self.length[self.link[state]] >= least:
            state = self.link[state]
        return self.owners[state]
