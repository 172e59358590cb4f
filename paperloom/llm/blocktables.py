"""Cost tables for repairing a row of turns, a block of turns at a time.

Roles that are left must read ``(s?(ua)+)?``. What is still to be paid from each of the four
states of that pattern is a vector; without its smallest entry only few such vectors occur. So
the step over one turn is a table from vector and symbol to vector and offset, and the step over
any block of ``BLOCK`` turns is such a table too, made once from the steps.
"""

from functools import cache

import numpy as np

#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
STATES = 4
#: Where one more user or assistant turn leads, and which of the two it is.
NEXT = (2, 2, 3, 2)
SAYS = "uuau"
#: Where a kept turn leads, by kind (system, user, assistant, other).
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Twice the kind, plus one for a truncated turn; a turn that must go has no kind.
MUST_GO = 8
SYMBOLS = 9
#: Turns of a block.
BLOCK = 4
FAR = 1 << 20
#: What is left to pay at the end, and the turns inserted there.
END = (0, 10, 5, 0)
TAILS = (("", ""), ("II", "ua"), ("I", "a"), ("", ""))


def _taken(symbol: int, state: int) -> dict[str, tuple[int, int]]:
    """Cost and next state of each edit that takes the turn."""
    if symbol == MUST_GO:
        return {"D": (DELETE, state)}
    kind, extra = symbol // 2, TRUNCATED * (symbol % 2)
    edits = {"D": (DELETE, state), "R": (REROLE + extra, NEXT[state])}
    if state in KEPT[kind]:
        edits["K"] = (KEEP + extra, KEPT[kind][state])
    return edits


def _before(symbol: int, after: tuple[int, ...]) -> list[int]:
    """What is to be paid before a turn, from what is to be paid after it."""
    paid = [min(c + after[t] for c, t in _taken(symbol, s).values()) for s in range(STATES)]
    for _ in range(2):
        paid = [min(p, INSERT + paid[NEXT[s]]) for s, p in enumerate(paid)]
    return [min(p, FAR) for p in paid]


def _normal(vector: list[int]) -> tuple[tuple[int, ...], int]:
    least = min(vector)
    return tuple(v - least if v < FAR else FAR for v in vector), least


class Tables:
    """``step`` and ``block`` give the vector's number and the offset; ``edits`` the choice."""

    def __init__(self):
        self.vectors = [END, *[tuple(0 if s == t else FAR for s in range(STATES)) for t in range(STATES)]]
        self.number = {v: i for i, v in enumerate(self.vectors)}
        step, offset, at = [], [], 0
        while at < len(self.vectors):
            made = [_normal(_before(symbol, self.vectors[at])) for symbol in range(SYMBOLS)]
            for vector, _ in made:
                if vector not in self.number:
                    self.number[vector] = len(self.vectors)
                    self.vectors.append(vector)
            step.append([self.number[v] for v, _ in made])
            offset.append([o for _, o in made])
            at += 1
        self.step, self.offset = np.array(step), np.array(offset)
        self.values = np.array(self.vectors)
        # Blocks by their symbols as digits, the first turn in front; the last turn is stepped over first.
        block, paid = np.arange(len(self.vectors))[:, None], np.zeros((len(self.vectors), 1), dtype=np.int64)
        for _ in range(BLOCK):
            # A further turn in front of what the table covers so far.
            paid = (paid[:, None, :] + self.offset.T[:, block].transpose(1, 0, 2)).reshape(len(self.vectors), -1)
            block = self.step.T[:, block].transpose(1, 0, 2).reshape(len(self.vectors), -1)
        self.block, self.paid = block, paid
        self._choices()

    def _choices(self) -> None:
        """For each vector after a turn, symbol and state: edits, what is said, cost and next state."""
        shape = (len(self.vectors), SYMBOLS, STATES)
        self.edits, self.said = np.zeros(shape, dtype=object), np.zeros(shape, dtype=object)
        self.cost, self.next = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
        for v, after in enumerate(self.vectors):
            for symbol in range(SYMBOLS):
                before = _before(symbol, after)
                for state in range(STATES):
                    self._choose(v, symbol, state, after, before)

    def _choose(self, v: int, symbol: int, state: int, after: tuple[int, ...], before: list[int]) -> None:
        """The cheapest edits up to and over the turn, the ASCII-least ones of equal cost."""
        edits, said, cost, at = "", "", 0, state
        while before[state] < FAR:
            taken = {e: (c, t) for e, (c, t) in _taken(symbol, at).items() if c + after[t] == before[at]}
            inserted = INSERT + before[NEXT[at]] == before[at]
            edit = min([*taken, *(["I"] if inserted else [])])
            edits += edit
            if edit == "I":
                said, cost, at = said + SAYS[at], cost + INSERT, NEXT[at]
                continue
            said += {"D": "", "K": "k", "R": SAYS[at].upper()}[edit]
            cost, at = cost + taken[edit][0], taken[edit][1]
            break
        self.edits[v, symbol, state], self.said[v, symbol, state] = edits, said
        self.cost[v, symbol, state], self.next[v, symbol, state] = cost, at


@cache
def tables() -> Tables:
    return Tables()


def right_vectors(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of the vector after each turn; the vector before the first one and its offset.

    ``starts`` and ``lengths`` are the rows of turns in ``symbols``, ``last`` the vectors at their
    ends. Blocks are looked up from the end; then all blocks are expanded backward at once.
    """
    t = tables()
    ends, blocks = starts + lengths, lengths // BLOCK
    weights = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
    current, paid = last.copy(), np.zeros(len(last), dtype=np.int64)
    edge, where = [], []
    for turn in range(int(blocks.max()) if len(blocks) else 0):
        rows = np.flatnonzero(blocks > turn)
        stop = ends[rows] - BLOCK * turn
        code = symbols[stop[:, None] + np.arange(-BLOCK, 0)] @ weights
        edge.append(current[rows])
        where.append(stop)
        paid[rows] += t.paid[current[rows], code]
        current[rows] = t.block[current[rows], code]
    after = np.zeros(len(symbols), dtype=np.int64)
    if edge:
        vector, place = np.concatenate(edge), np.concatenate(where) - 1
        for _ in range(BLOCK):
            after[place] = vector
            vector, place = t.step[vector, symbols[place]], place - 1
    # What is left in front is shorter than a block.
    rest = lengths - BLOCK * blocks
    for turn in range(BLOCK - 1):
        rows = np.flatnonzero(rest > turn)
        place = starts[rows] + rest[rows] - 1 - turn
        after[place] = current[rows]
        paid[rows] += t.offset[current[rows], symbols[place]]
        current[rows] = t.step[current[rows], symbols[place]]
    return after, current, paid


def trace(symbols: np.ndarray, after: np.ndarray, starts: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The state before each turn on the way from the given states, and the states at the ends."""
    t = tables()
    states, state = np.zeros(len(symbols), dtype=np.int64), state.copy()
    order = np.argsort(-lengths, kind="stable")
    longer = np.searchsorted(-lengths[order], -np.arange(int(lengths.max()) if len(lengths) else 0), side="left")
    for turn, count in enumerate(longer.tolist()):
        rows = order[:count]
        place = starts[rows] + turn
        states[place] = state[rows]
        state[rows] = t.next[after[place], symbols[place], state[rows]]
    return states, state
