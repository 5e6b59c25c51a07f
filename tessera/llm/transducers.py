"""Weighted finite-state transducers over a small alphabet of word classes, their composition, and the machines of a clause.

An arc reads a symbol and writes one, with a factor; a path's factor for a symbol is the product of those of the machines
it went through. A run over weighted symbols adds up weight times factor for every HIT that a path writes. Several paths
may be under way, where a machine guesses what is yet to come; one that guessed wrong has no arc and ends.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator

SYMBOLS = ("WORD", "INSULT", "THREAT", "INTENT", "TARGET", "NEGATION", "CONTRAST", "REPORT", "QUOTE", "COMMA", "COLON", "END", "PARAGRAPH", "HIT")
ENDS = ("END", "PARAGRAPH")
Arc = tuple[str, float, Hashable]  # what is written, the factor, the next state


class Transducer:
    def __init__(self, start: Hashable, arcs: dict[tuple[Hashable, str], list[Arc]]):
        self.start, self.arcs = start, arcs

    @classmethod
    def of(cls, states: Iterable[Hashable], start: Hashable, rule: Callable[[Hashable, str], list[Arc]]) -> Transducer:
        """Every arc by rule(state, symbol)."""
        return cls(start, {(s, x): rule(s, x) for s in states for x in SYMBOLS})

    def compose(self, other: Transducer) -> Transducer:
        """What other makes of what this one writes; only pairs of states that can be reached."""
        start = (self.start, other.start)
        arcs, todo, seen = {}, [start], {start}
        while todo:
            pair = p, q = todo.pop()
            for x in SYMBOLS:
                out = [(z, u * v, (p2, q2)) for y, u, p2 in self.arcs[p, x] for z, v, q2 in other.arcs[q, y]]
                arcs[pair, x] = out
                for _, _, nxt in out:
                    if nxt not in seen:
                        seen.add(nxt)
                        todo.append(nxt)
        return Transducer(start, arcs)

    def numbered(self) -> Transducer:
        """The same with numbers for states."""
        number = {s: k for k, s in enumerate(dict.fromkeys([self.start, *(s for s, _ in self.arcs)]))}
        return Transducer(number[self.start], {(number[s], x): [(y, u, number[n]) for y, u, n in out] for (s, x), out in self.arcs.items()})

    def clauses(self, stream: Iterable[tuple[str, float]]) -> Iterator[float]:
        """The weight of each clause, up to its END or PARAGRAPH: of the paths that reach it the heaviest."""
        live = {self.start: 0.0}
        for symbol, weight in stream:
            after: dict[Hashable, float] = {}
            for state, total in live.items():
                for out, factor, nxt in self.arcs[state, symbol]:
                    value = total + weight * factor if out == "HIT" else total
                    if value > after.get(nxt, -1.0):
                        after[nxt] = value
            live = after
            if symbol in ENDS:
                yield max(live.values())
                live = dict.fromkeys(live, 0.0)


def insult() -> Transducer:
    return Transducer.of([0], 0, lambda s, x: [("HIT" if x == "INSULT" else x, 1.0, 0)])


def threat(scope: int, alone: float) -> Transducer:
    """A threatening verb within `scope` words of an intent ("will", "going to") hits in full, one by itself by `alone`."""

    def rule(left: int, x: str) -> list[Arc]:
        if x == "INTENT":
            return [("WORD", 1.0, scope)]
        if x == "THREAT":
            return [("HIT", 1.0 if left else alone, left)]
        if x in ENDS or x == "CONTRAST":
            return [(x, 1.0, 0)]
        return [(x, 1.0, left if x in ("COMMA", "QUOTE") else max(0, left - 1))]

    return Transducer.of(range(scope + 1), 0, rule)


def negation(scope: int, factor: float) -> Transducer:
    """A negation reaches `scope` words on, past commas and quotation marks, and up to a contrast ("but") or the end."""

    def rule(left: int, x: str) -> list[Arc]:
        if x == "NEGATION":
            return [("WORD", 1.0, scope)]
        if x in ENDS or x in ("CONTRAST", "COLON"):
            return [(x, 1.0, 0)]
        return [(x, factor if left and x == "HIT" else 1.0, left if x in ("COMMA", "QUOTE") else max(0, left - 1))]

    return Transducer.of(range(scope + 1), 0, rule)


def report(factor: float) -> Transducer:
    """Reported speech: from a verb of speech, past colons and commas, to the end of the clause; or between quotation
    marks, past ends of clauses, but not of paragraphs, which close a quotation that was left open."""

    def rule(state: str, x: str) -> list[Arc]:
        if x == "PARAGRAPH":
            return [(x, 1.0, "told")]
        if x == "QUOTE":
            return [(x, 1.0, "told" if state == "quoted" else "quoted")]
        if x == "END":
            return [(x, 1.0, "quoted" if state == "quoted" else "told")]
        if x == "REPORT":
            return [("WORD", 1.0, "quoted" if state == "quoted" else "reported")]
        return [(x, factor if x == "HIT" and state != "told" else 1.0, state)]

    return Transducer.of(("told", "reported", "quoted"), "told", rule)


def target(factor: float) -> Transducer:
    """A clause that addresses somebody, before or after what hits: whether it does is guessed where it begins."""

    def rule(state: str, x: str) -> list[Arc]:
        if state == "begin":
            return [arc for guess in ("plain", "wanted") for arc in rule(guess, x)]
        if x in ENDS:
            return [(x, 1.0, "begin")] if state != "wanted" else []
        if x == "TARGET":
            return [] if state == "plain" else [("WORD", 1.0, "found")]
        return [(x, factor if x == "HIT" and state != "plain" else 1.0, state)]

    return Transducer.of(("begin", "plain", "wanted", "found"), "begin", rule)


def machines(scope: int, intent: int, alone: float, negated: float, reported: float, targeted: float) -> list[Transducer]:
    return [insult(), threat(intent, alone), negation(scope, negated), report(reported), target(targeted)]


def clause_machine(*options: float) -> Transducer:
    first, *rest = machines(*options)
    for t in rest:
        first = first.compose(t)
    return first.numbered()
