"""Small weighted finite-state transducers over word classes.

A transducer reads one symbol at a time and emits one symbol with a weight. Composition feeds
the output of one machine to the next and multiplies the weights of the arcs;
``Scorer`` turns the result into a table and weighs symbol sequences with it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

Arc = tuple[str, float, int]  # emitted symbol, weight, next state


@dataclass
class Transducer:
    """``arcs[state][symbol]`` lists the arcs; symbols without one copy through
    to ``otherwise[state]``. ``final[state]`` weighs a path that ends there."""

    arcs: list[dict[str, list[Arc]]] = field(default_factory=lambda: [{}])
    otherwise: dict[int, int] = field(default_factory=dict)
    final: dict[int, float] = field(default_factory=lambda: {0: 1.0})

    def state(self, final: float | None = 1.0) -> int:
        self.arcs.append({})
        if final is not None:
            self.final[len(self.arcs) - 1] = final
        return len(self.arcs) - 1

    def arc(self, at: int, reads: str, emits: str, weight: float, to: int) -> None:
        self.arcs[at].setdefault(reads, []).append((emits, weight, to))

    def step(self, at: int, symbol: str) -> list[Arc]:
        found = self.arcs[at].get(symbol)
        if found is None:
            to = self.otherwise.get(at)
            return [] if to is None else [(symbol, 1.0, to)]
        return found


def compose(first: Transducer, second: Transducer, alphabet: list[str]) -> Transducer:
    """The machine that reads like ``first`` and passes its output to ``second``."""
    out = Transducer(final={})
    index = {(0, 0): 0}
    todo = [(0, 0)]
    while todo:
        pair = todo.pop()
        here = index[pair]
        if pair[0] in first.final and pair[1] in second.final:
            out.final[here] = first.final[pair[0]] * second.final[pair[1]]
        for symbol in alphabet:
            for middle, w1, to1 in first.step(pair[0], symbol):
                for emitted, w2, to2 in second.step(pair[1], middle):
                    nxt = (to1, to2)
                    if nxt not in index:
                        index[nxt] = out.state(final=None)
                        todo.append(nxt)
                    out.arc(here, symbol, emitted, w1 * w2, index[nxt])
    return out


class Scorer:
    """Weights of clauses under a deterministic transducer, as a table.

    ``scored`` lists the emitted symbols that count, each apart from the others."""

    def __init__(self, machine: Transducer, scored: str, alphabet: list[str]):
        self._table = []
        for state in range(len(machine.arcs)):
            row = {}
            for symbol in alphabet:
                ((emitted, weight, to),) = machine.step(state, symbol)
                row[symbol] = (scored.find(emitted), weight, to)
            self._table.append(row)

    def add(self, clause: list[tuple[str, float]], sums: list[float]) -> None:
        """Add arc weight times strength to the sum of each emitted scored symbol.

        Each item of the clause is a symbol and its strength."""
        state = 0
        for symbol, strength in clause:
            place, weight, state = self._table[state][symbol]
            if place >= 0:
                sums[place] += weight * strength
