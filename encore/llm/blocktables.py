"""Four-Russians tables for the repair of role sequences.

A conversation is repaired to roles that read (s?(ua)+)?, s for system, u for user, a for assistant. A row is one of the
symbols below. Where the cheapest repair stands is one of four states; what the rows still to come cost from each state
is a vector of four numbers. Taken from its smallest number, such a vector is one of few, since an insertion of cost 3
leads from state to state. So a row maps (vector) to (vector, cost to add), and so does any block of rows: the table of
all blocks of ``BLOCK`` rows is made from that of single rows by doubling.
"""

from __future__ import annotations

from functools import cache

import numpy as np

KEEP, CHANGE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
BLOCK = 4
START, SYSTEM, USER, ASSISTANT = range(4)
#: from a state, the role that follows by insertion or change, and the state it leads to
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ENDS = (START, ASSISTANT)
INITIALS = "sua?"  # the last for every other role
#: initial, fault: 0 none, 1 truncated; one more symbol for rows that must go
SYMBOLS = [(i, cut) for i in INITIALS for cut in (0, 1)] + [("", 2)]
GONE = len(SYMBOLS) - 1


def edits(state: int, symbol: int) -> list[tuple[str, int, int, str]]:
    """(edit, cost, next state, role written) that take a row, from a state."""
    initial, cut = SYMBOLS[symbol]
    out = [("D", DELETE, state, "")]
    if symbol != GONE:
        role, after = NEXT[state]
        if state == START and initial == "s":
            out.append(("K", KEEP + CUT * cut, SYSTEM, "s"))
        if initial == role:
            out.append(("K", KEEP + CUT * cut, after, role))
        else:
            out.append(("R", CHANGE + CUT * cut, after, role))
    return out


def closed(costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs with insertions before the next row: what is cheaper from another state costs an insertion to get there."""
    out = list(costs)
    for _ in range(3):
        out = [min(out[q], INSERT + out[NEXT[q][1]]) for q in range(4)]
    return tuple(out)


def before_row(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs of all that comes from here on, with one more row in front."""
    return closed(tuple(min(c + costs[to] for _, c, to, _ in edits(q, symbol)) for q in range(4)))


LAST = closed(tuple(0 if q in ENDS else 10**6 for q in range(4)))


@cache
def tables():
    """Normalised vectors, and (next vector, cost) of every vector under one symbol and under every block of symbols.

    Blocks are numbered with the first row as the highest digit. Vector 0 is that of the end.
    """
    low = min(LAST)
    vectors, number = [tuple(c - low for c in LAST)], {}
    number[vectors[0]] = 0
    to, cost = [], []
    for vector in vectors:  # grows while it is read
        row_to, row_cost = [], []
        for symbol in range(len(SYMBOLS)):
            made = before_row(vector, symbol)
            least = min(made)
            made = tuple(c - least for c in made)
            if made not in number:
                number[made] = len(vectors)
                vectors.append(made)
            row_to.append(number[made])
            row_cost.append(least)
        to.append(row_to)
        cost.append(row_cost)
    one_to, one_cost = np.array(to, np.int32).T.copy(), np.array(cost, np.int32).T.copy()
    many_to, many_cost, length = one_to, one_cost, 1
    while length < BLOCK:
        # the first half comes after the second one, as costs run from the end
        size = len(many_to)
        first, second = np.divmod(np.arange(size * size), size)
        middle = many_to[second]
        many_cost = many_cost[second] + np.take_along_axis(many_cost[first], middle, 1)
        many_to = np.take_along_axis(many_to[first], middle, 1)
        length *= 2
    return np.array(vectors), low, one_to, one_cost, many_to, many_cost


def split_blocks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The odd rows in front, and the numbers of the whole blocks behind them."""
    odd = len(symbols) % BLOCK
    weights = len(SYMBOLS) ** np.arange(BLOCK - 1, -1, -1)
    return symbols[:odd], symbols[odd:].reshape(-1, BLOCK) @ weights


def through(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every vector after these rows, the vector before them and the cost added: a table look-up a block."""
    vectors, _, one_to, one_cost, many_to, many_cost = tables()
    at, total = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    odd, blocks = split_blocks(symbols)
    for table_to, table_cost, numbers in ((many_to, many_cost, blocks), (one_to, one_cost, odd)):
        for n in numbers[::-1]:
            total += table_cost[n][at]
            at = table_to[n][at]
    return at, total


def borders(symbols: np.ndarray, vector: int) -> tuple[list[int], int]:
    """The vectors before the odd rows, before each block and after the last one; and the cost added."""
    _, _, one_to, one_cost, many_to, many_cost = tables()
    odd, blocks = split_blocks(symbols)
    out, total = [vector], 0
    for n in blocks[::-1]:
        total += int(many_cost[n, vector])
        vector = int(many_to[n, vector])
        out.append(vector)
    for n in odd[::-1]:
        total += int(one_cost[n, vector])
        vector = int(one_to[n, vector])
    if len(odd):
        out.append(vector)
    return out[::-1], total


def trace(symbols: np.ndarray, vector: int, state: int, last: bool) -> tuple[list[tuple[str, str, str]], str, int]:
    """The cheapest edits from ``state``, the ASCII-least of them, if ``vector`` stands after the rows.

    One (roles inserted before the row, edit, role written) a row, the roles inserted after all rows if these are the
    ``last`` ones, and the state reached. A block is expanded backward from the vector at its end to the vectors
    between its rows; forward through these only edits that lie on a cheapest path are taken, the least letter first.
    """
    vectors, low, one_to, one_cost, _, _ = tables()
    stops, _ = borders(symbols, vector)
    odd = len(symbols) % BLOCK
    pieces = ([symbols[:odd]] if odd else []) + [symbols[i:i + BLOCK] for i in range(odd, len(symbols), BLOCK)]
    out = []
    for piece, after in zip(pieces, stops[1:]):
        inner = [after]
        for n in piece[::-1]:
            inner.append(int(one_to[n, inner[-1]]))
        inner.reverse()
        for i, n in enumerate(piece.tolist()):
            here, then = vectors[inner[i]], vectors[inner[i + 1]]
            base = int(one_cost[n, inner[i + 1]])  # here + base is the true cost over ``then``
            inserted = ""
            while True:
                need = int(here[state]) + base
                taken = next((e for e in edits(state, n)[:1] if e[1] + then[e[2]] == need), None)
                role, to = NEXT[state]
                if taken is None and INSERT + here[to] == here[state]:
                    inserted += role
                    state = to
                    continue
                if taken is None:
                    taken = next(e for e in edits(state, n)[1:] if e[1] + then[e[2]] == need)
                break
            out.append((inserted, taken[0], taken[3]))
            state = taken[2]
    tail = ""
    if last:
        while state not in ENDS:
            role, state = NEXT[state]
            tail += role
    return out, tail, state
