"""A generalised suffix automaton over sequences of integers, and the windows that it can report."""

from __future__ import annotations


class SuffixAutomaton:
    """All substrings of the items fed in. State 0 is the empty string."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, state: int, symbol: int, target: int) -> int:
        """A copy of ``target`` for the strings no longer than those of ``state`` plus the symbol."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        while state != -1 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def extend(self, last: int, symbol: int) -> int:
        """The state of the item read so far plus the symbol; ``last`` is the state before it (0 at its start)."""
        if symbol in self.next[last]:
            target = self.next[last][symbol]
            return target if self.length[target] == self.length[last] + 1 else self._split(last, symbol, target)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state != -1 and symbol not in self.next[state]:
            self.next[state][symbol] = new
            state = self.link[state]
        if state != -1:
            target = self.next[state][symbol]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, symbol, target)
        return new

    def step(self, state: int, matched: int, symbol: int) -> tuple[int, int]:
        """State and length of the longest suffix of what was read, plus the symbol, that the items contain."""
        while state and symbol not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        if symbol in self.next[state]:
            return self.next[state][symbol], matched + 1
        return 0, 0


class WindowAutomaton:
    """Finds where windows of items end in a stream of symbols.

    Windows are ``width`` consecutive symbols of an item, or a whole shorter item. ``whole[s]`` has the
    items that contain the window of full width in state s, ``short[s]`` the (length, items) of short
    items that end in s, and ``report[s]`` the nearest state up the suffix links, s included, with
    something of either kind.
    """

    def __init__(self, items: list[tuple[object, list[int]]], width: int):
        self.width = width
        self.automaton = a = SuffixAutomaton()
        for _, symbols in items:
            state = 0
            for s in symbols:
                state = a.extend(state, s)
        self.whole: dict[int, set] = {}
        self.short: dict[int, dict[int, set]] = {}
        for item, symbols in items:
            state = matched = 0
            for n, s in enumerate(symbols, 1):
                state, matched = a.step(state, matched, s)
                if n >= width:
                    # the ancestor that holds the string of exactly `width` symbols
                    while a.length[a.link[state]] >= width:
                        state = a.link[state]
                    matched = min(matched, a.length[state])
                    self.whole.setdefault(state, set()).add(item)
            if 0 < len(symbols) < width:
                self.short.setdefault(state, {}).setdefault(len(symbols), set()).add(item)
        self.shortest = min((min(len(s), width) for _, s in items if s), default=width)
        self.report = self._reports()

    def _reports(self) -> list[int]:
        a, report = self.automaton, [-1] * len(self.automaton.length)
        for state in sorted(range(len(report)), key=a.length.__getitem__):
            up = a.link[state]
            report[state] = state if state in self.whole or state in self.short else report[up] if up >= 0 else -1
        return report

    def stream(self, symbols: list[int]):
        """(end, length of the longest window that ends there, items of all windows that end there) by position."""
        a, state, matched = self.automaton, 0, 0
        for end, symbol in enumerate(symbols, 1):
            state, matched = a.step(state, matched, symbol)
            at, length, found = self.report[state], 0, None
            while at > 0:
                if at in self.whole and (at != state or matched >= self.width):
                    length, found = max(length, self.width), (found or set()) | self.whole[at]
                for n, items in self.short.get(at, {}).items():
                    if at != state or matched >= n:
                        length, found = max(length, n), (found or set()) | items
                at = self.report[a.link[at]]
            if length:
                yield end, length, found
