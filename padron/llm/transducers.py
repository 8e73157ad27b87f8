"""Weighted finite-state transducers over a small alphabet of symbols, and their composition."""

from dataclasses import dataclass, field

#: Any symbol that a state has no arc of its own for; written out as it was read.
ANY = "*"


@dataclass
class Transducer:
    """Deterministic: a state and a symbol give the next state, the symbol written and a weight.

    Weights add up along a path. `arcs[state, ANY]` holds for the symbols without an arc of their
    own; a state without it stays where it is.
    """

    start: object = 0
    arcs: dict = field(default_factory=dict)

    def arc(self, state, symbol: str, to, writes: str | None = None, weight: float = 0.0) -> None:
        self.arcs[state, symbol] = (to, writes or symbol, weight)

    def step(self, state, symbol: str) -> tuple[object, str, float]:
        found = self.arcs.get((state, symbol)) or self.arcs.get((state, ANY))
        if found is None:
            return state, symbol, 0.0
        to, writes, weight = found
        return to, symbol if writes == ANY else writes, weight

    def run(self, symbols: list[str]) -> list[tuple[str, float]]:
        state, out = self.start, []
        for symbol in symbols:
            state, writes, weight = self.step(state, symbol)
            out.append((writes, weight))
        return out


def compose(first: Transducer, second: Transducer, alphabet: list[str]) -> Transducer:
    """One machine that writes what `second` writes about the output of `first`.

    Its states are the pairs that can be reached by symbols of the alphabet.
    """
    machine = Transducer((first.start, second.start))
    waiting, seen = [machine.start], {machine.start}
    while waiting:
        a, b = waiting.pop()
        for symbol in alphabet:
            to_a, middle, one = first.step(a, symbol)
            to_b, writes, two = second.step(b, middle)
            machine.arc((a, b), symbol, (to_a, to_b), writes, one + two)
            if (to_a, to_b) not in seen:
                seen.add((to_a, to_b))
                waiting.append((to_a, to_b))
    return machine


def tabulate(machine: Transducer, alphabet: list[str]) -> list[dict[str, tuple[int, str, float]]]:
    """The machine with its states numbered from 0, its start: for each, the arcs by symbol."""
    number, waiting, table = {machine.start: 0}, [machine.start], []
    for state in waiting:
        row = {}
        for symbol in alphabet:
            to, writes, weight = machine.step(state, symbol)
            if to not in number:
                number[to] = len(number)
                waiting.append(to)
            row[symbol] = (number[to], writes, weight)
        table.append(row)
    return table
