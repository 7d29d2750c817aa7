"""The packing plan over a histogram of lengths: its size follows the capacity, not the number of items."""

from __future__ import annotations

import bisect

import numpy as np

GROUPS = 96
SHARE = 4  # items longer than a fourth of the capacity are grouped, the others fill what is left


def linear_groups(counts: list[int], least: int, groups: int = GROUPS) -> list[list[tuple[int, int]]]:
    """The items of ``least`` and longer in descending order, cut into groups of equal cardinality.

    Each group is a list of (length, count); its first length is the size that all its items are rounded up to.
    """
    total = sum(counts[least:])
    if not total:
        return []
    each = -(-total // groups)
    out, room = [], 0
    for length in range(len(counts) - 1, least - 1, -1):
        left = counts[length]
        while left:
            if not room:
                out.append([])
                room = each
            take = min(left, room)
            out[-1].append((length, take))
            left -= take
            room -= take
    return out


def best_pattern(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within the capacity that is worth most (knapsack, copies taken in doubling lots)."""
    best = np.zeros(capacity + 1)
    steps = []
    for j, size in enumerate(sizes):
        if values[j] <= 1e-12:
            continue
        lot, room = 1, capacity // size
        while room > 0:
            take = min(lot, room)
            shift, worth = take * size, take * values[j]
            with_it = best[:-shift] + worth
            better = with_it > best[shift:] + 1e-12
            steps.append((j, take, shift, better))
            best[shift:] = np.where(better, with_it, best[shift:])
            room -= take
            lot *= 2
    at = int(best.argmax())
    value, pattern = float(best[at]), np.zeros(len(sizes))
    for j, take, shift, better in reversed(steps):
        if at >= shift and better[at - shift]:
            pattern[j] += take
            at -= shift
    return value, pattern


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, rounded down, from the linear program over few sizes (column generation)."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    used = inverse @ np.array(demand, float)
    for _ in range(60 * k):
        value, column = best_pattern(sizes, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-7:
            break
        move = inverse @ column
        ratios = np.full(k, np.inf)
        falls = move > 1e-9
        ratios[falls] = used[falls] / move[falls]
        leaves = int(ratios.argmin())
        basis[:, leaves] = column
        step = ratios[leaves]
        used = used - step * move
        used[leaves] = step
        row = inverse[leaves] / move[leaves]
        inverse = inverse - np.outer(move, row)
        inverse[leaves] = row
    left, out = np.array(demand), []
    for j in np.argsort(-used):
        pattern = basis[:, j].round().astype(int)
        times = int(used[j] + 1e-6)
        held = pattern > 0
        times = min([times, *(left[held] // pattern[held]).tolist()])
        if times > 0:
            left = left - times * pattern
            out.append((pattern, times))
    return out


class Plan:
    """Sequences in classes that hold the same lengths.

    A class is [count, first sequence, filled, rows]; a row [start, per, length, offset] says that the items at places
    start, start + 1, .. lie in the class's sequences in order, ``per`` in each, the first at ``offset``. Items of a
    length are interchangeable, so a class of any number of sequences is one entry: the number of classes is bounded by
    the number of different lengths and patterns.
    """

    def __init__(self, counts: list[int], capacity: int):
        self.capacity = capacity
        self.next_place, place = [0] * (capacity + 1), 0
        for length in range(1, capacity + 1):
            self.next_place[length] = place
            place += counts[length]
        self.classes: list[list] = []
        self.open: dict[int, list[list]] = {}
        self.residuals: list[int] = []
        self.sequences = 0

    def take(self, length: int, count: int) -> int:
        start = self.next_place[length]
        self.next_place[length] += count
        return start

    def add(self, made: list) -> None:
        residual = self.capacity - made[2]
        if residual <= 0:
            self.classes.append(made)
            return
        if residual not in self.open:
            self.open[residual] = []
            bisect.insort(self.residuals, residual)
        self.open[residual].append(made)

    def create(self, count: int, lengths: list[tuple[int, int]]) -> None:
        """``count`` sequences, each with so many (number, length) items of the next places."""
        rows, filled = [], 0
        for per, length in lengths:
            rows.append([self.take(length, per * count), per, length, filled])
            filled += per * length
        self.add([count, self.sequences, filled, rows])
        self.sequences += count

    def split(self, whole: list, count: int) -> tuple[list, list]:
        """The first ``count`` sequences of a class and the rest of them."""
        number, first, filled, rows = whole
        rest = [[start + count * per, per, length, offset] for start, per, length, offset in rows]
        return [count, first, filled, rows], [number - count, first + count, filled, rest]

    def fill(self, made: list, per: int, length: int) -> None:
        made[3].append([self.take(length, made[0] * per), per, length, made[2]])
        made[2] += per * length
        self.add(made)

    def best_fit(self, length: int, count: int) -> None:
        """Put items where the least room stays; a sequence that holds several takes them one after another."""
        while count:
            at = bisect.bisect_left(self.residuals, length)
            if at == len(self.residuals):
                per = self.capacity // length
                if count >= per:
                    self.create(count // per, [(per, length)])
                if count % per:
                    self.create(1, [(count % per, length)])
                return
            residual = self.residuals[at]
            made = self.open[residual].pop()
            if not self.open[residual]:
                del self.open[residual], self.residuals[at]
            per = min(residual // length, count)
            here = min(made[0], count // per)
            if here < made[0]:
                made, rest = self.split(made, here)
                self.add(rest)
            self.fill(made, per, length)
            count -= here * per

    def rows(self) -> np.ndarray:
        """start, per, length, offset, first sequence of all rows, by start."""
        every = self.classes + [made for held in self.open.values() for made in held]
        flat = [(*row, made[1]) for made in every for row in made[3]]
        table = np.array(flat, np.int64).reshape(len(flat), 5)
        return table[table[:, 0].argsort(kind="stable")]


def make_plan(counts: list[int], capacity: int, groups: int = GROUPS) -> Plan:
    """A plan for ``counts[length]`` items of each length from 1 to ``capacity``.

    Items longer than a fourth of the capacity are cut into groups of equal cardinality and rounded up to the longest
    of their group. A linear program over these few sizes chooses how often each configuration is used. Actual items
    take the rounded ones' places; then what the rounding down left, and the shorter items, go where they fit best,
    longest first.
    """
    plan = Plan(counts, capacity)
    if counts[capacity]:
        plan.create(counts[capacity], [(1, capacity)])
    loose = list(counts)
    loose[capacity] = 0
    least = capacity // SHARE + 1
    grouped = linear_groups(loose, least, groups)
    sizes = [g[0][0] for g in grouped]
    queues = [[list(run) for run in g] for g in grouped]
    if sizes:
        # equal sizes would make the program degenerate: groups of one length are one size with more items
        distinct = sorted(set(sizes), reverse=True)
        member = [distinct.index(s) for s in sizes]
        merged: list[list] = [[] for _ in distinct]
        for j, queue in zip(member, queues):
            merged[j].extend(queue)
        demand = [sum(n for _, n in queue) for queue in merged]
        for pattern, times in configurations(distinct, demand, capacity):
            slots = [j for j in range(len(distinct)) for _ in range(pattern[j])]
            while times:
                # items at the heads of the groups, as long as no group's run of one length ends
                heads: dict[int, int] = {}
                for j in slots:
                    heads[j] = heads.get(j, 0) + 1
                count = min([times, *(merged[j][0][1] // n for j, n in heads.items())])
                if count:
                    plan.create(count, [(n, merged[j][0][0]) for j, n in heads.items()])
                    for j, n in heads.items():
                        _shorten(merged[j], n * count)
                    times -= count
                    continue
                # a run ends inside one sequence: that one takes its items one by one
                plan.create(1, [(1, _shorten(merged[j], 1)) for j in slots])
                times -= 1
        remaining = [0] * (capacity + 1)
        for queue in merged:
            for length, n in queue:
                remaining[length] += n
        for length in range(least, capacity):
            loose[length] = remaining[length]
    for length in range(capacity - 1, 0, -1):
        if loose[length]:
            plan.best_fit(length, loose[length])
    return plan


def _shorten(queue: list, count: int) -> int:
    """Take ``count`` items off a queue's first run; returns their length."""
    length = queue[0][0]
    queue[0][1] -= count
    if not queue[0][1]:
        queue.pop(0)
    return length
