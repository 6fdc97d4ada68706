"""Suffix automata."""

from __future__ import annotations


class SuffixAutomaton:
    """Of several sequences; built online."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def matching(self, tokens: list[int]) -> list[int]:
        """At each place, the length of the longest run ending there that occurs in what was added."""
        state = have = 0
        out = []
        nxt, link, length = self.next, self.link, self.length
        for t in tokens:
            while t not in nxt[state] and state:
                state = link[state]
                have = length[state]
            if t in nxt[state]:
                state = nxt[state][t]
                have += 1
            out.append(have)
        return out

    def add(self, tokens: list[int]) -> None:
        last = 0
        for t in tokens:
            last = self._extend(last, t)

    def _extend(self, last: int, t: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        there = nxt[last].get(t)
        if there is not None and length[there] == length[last] + 1:
            return there
        if there is None:
            new = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
        else:
            new = -1
        p = last
        while there is None and p != -1 and t not in nxt[p]:
            nxt[p][t] = new
            p = link[p]
        if p == -1:
            return new
        q = nxt[p][t]
        if length[q] == length[p] + 1:
            link[new] = q
            return new
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p != -1 and nxt[p].get(t) == q:
            nxt[p][t] = clone
            p = link[p]
        link[q] = clone
        if new == -1:
            return clone
        link[new] = clone
        return new
