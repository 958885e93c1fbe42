"""Fewest bins for items of whole-number sizes, by bin completion on a table of sizes.

There are at most as many different sizes as the bin has units, however many items there are, so a
packing is a list of fillings (the sizes in a bin) with the number of bins that are filled so.

`Search` goes bin by bin: around the largest size that is left it lists the fillings of the gap that no other
dominates, tries the one with the least waste first, in as many bins as the table allows, and comes
back for fewer bins and other fillings. A branch is cut if its waste proves that it needs as many bins as the
best packing known. Those are best-fit packings of what is left, from the start and along the way.
The search ends when the best reaches a lower bound, or after a stated number of steps; the best packing
stands in either case and holds every item.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

Filling = tuple[int, ...]
Packing = list[tuple[Filling, int]]

#: Steps of the search, fillings looked at for a bin, and steps between two best-fit packings.
STEPS, WIDTH, EVERY = 4_000, 60, 100


def best_fit(counts: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing: each item goes where the least room is left that still holds it. Bins alike are
    handled together; an item that fits again into the bin just used fits it best."""
    rooms: dict[int, list[tuple[Filling, int]]] = {}
    order: list[int] = []

    def put(room: int, filling: Filling, bins: int) -> None:
        if room not in rooms:
            rooms[room] = []
            insort(order, room)
        rooms[room].append((filling, bins))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in order[bisect_right(order, size - 1) :]:
            fits, made = room // size, []
            while left and rooms[room]:
                filling, bins = rooms[room].pop()
                each = min(fits, left)
                used = min(bins, left // each)
                left -= used * each
                if bins > used:
                    rooms[room].append((filling, bins - used))
                made.append((room - each * size, filling + (size,) * each, used))
            if not rooms[room]:
                del rooms[room]
                order.remove(room)
            for x in made:
                put(*x)
        while left:
            each = min(capacity // size, left)
            used = left // each
            left -= used * each
            put(capacity - each * size, (size,) * each, used)
    return [x for room in order for x in rooms[room]]


def bins_of(packing: Packing) -> int:
    return sum(n for _, n in packing)


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: items above half a bin need one each, and the larger of them leave no room for items of
    a threshold and more (Martello and Toth's L2, over all thresholds)."""
    sizes = sorted(x for x in counts if counts[x])
    if not sizes:
        return 0
    best = -(-sum(x * counts[x] for x in sizes) // capacity)
    over = sum(counts[x] for x in sizes if 2 * x > capacity)
    big = [x for x in sizes if 2 * x > capacity]
    small = [x for x in sizes if 2 * x <= capacity]
    # bins of items above capacity - t are full for items of t and more; those of the others have room
    held = sum(x * counts[x] for x in big)
    rest = sum(x * counts[x] for x in small)
    with_room = sum(counts[x] for x in big)
    top = len(big) - 1
    for t in [0, *small]:
        while top >= 0 and big[top] > capacity - t:
            held -= big[top] * counts[big[top]]
            with_room -= counts[big[top]]
            top -= 1
        need = rest - (with_room * capacity - held)
        best = max(best, over + max(0, -(-need // capacity)))
        if t:
            rest -= t * counts[t]
    return best


def dominates(one: Filling, two: Filling) -> bool:
    """Whether the sizes of ``two`` can be put into bins of the sizes of ``one``, so that ``one`` in
    place of ``two`` never needs more bins."""

    def fits(at: int, rooms: list[int]) -> bool:
        if at == len(two):
            return True
        tried = set()
        for i, room in enumerate(rooms):
            if room >= two[at] and room not in tried:
                tried.add(room)
                rooms[i] -= two[at]
                if fits(at + 1, rooms):
                    return True
                rooms[i] += two[at]
        return False

    return fits(0, list(one))


class Search:
    def __init__(self, counts: dict[int, int], capacity: int, steps: int = STEPS):
        self.capacity, self.steps = capacity, steps
        self.counts = {x: n for x, n in counts.items() if n > 0}
        if any(not 0 < x <= capacity for x in self.counts):
            raise ValueError("sizes must lie between 1 and the capacity")
        self.sizes = sorted(self.counts)
        self.total = sum(x * n for x, n in self.counts.items())
        self.bound = least_bins(self.counts, capacity)
        self.best = best_fit(self.counts, capacity)
        self.proved = bins_of(self.best) <= self.bound

    # --- the table of what is left -----------------------------------------------------

    def _change(self, filling: Filling, bins: int) -> None:
        """Take ``bins`` bins of a filling out of the table; give them back if negative."""
        for x in filling:
            before = self.counts.get(x, 0)
            self.counts[x] = before - bins
            if not before:
                insort(self.sizes, x)
            elif before == bins:
                del self.counts[x]
                del self.sizes[bisect_right(self.sizes, x) - 1]
        self.total -= bins * sum(filling)

    def _times(self, filling: Filling) -> int:
        return min(self.counts[x] // filling.count(x) for x in set(filling))

    # --- fillings ----------------------------------------------------------------------

    def fillings(self) -> list[Filling]:
        """Undominated fillings around the largest size that is left, the least waste first."""
        largest = self.sizes[-1]
        found: list[Filling] = []
        looked = 0

        def more(gap: int, at_most: int, chosen: list[int]) -> bool:
            """Add sizes, largest first, until nothing fits; False stops the listing."""
            nonlocal looked
            place = bisect_right(self.sizes, min(gap, at_most))
            full = True
            while place:
                size = self.sizes[place - 1]
                if chosen.count(size) < self.counts[size]:
                    full = False
                    if not more(gap - size, size, [*chosen, size]):
                        return False
                    if gap == size:
                        return True  # any other choice here is held by this one size
                place -= 1
            if full:
                looked += 1
                # with a larger size that would still fit, the filling is part of another one
                beyond = self.sizes[bisect_right(self.sizes, at_most) : bisect_right(self.sizes, gap)]
                if not any(chosen.count(s) < self.counts[s] for s in beyond):
                    found.append(tuple(chosen))
            return looked < WIDTH

        more(self.capacity - largest, largest, [largest])
        found.sort(key=lambda f: (-sum(f), len(f), tuple(-x for x in f)))
        kept: list[Filling] = []
        for filling in found:
            if not any(dominates(k, filling) for k in kept):
                kept.append(filling)
        return kept

    def _choices(self) -> Iterator[tuple[Filling, int]]:
        for filling in self.fillings():
            for bins in range(self._times(filling), 0, -1):
                yield filling, bins

    # --- the search --------------------------------------------------------------------

    def _cut(self, used: int) -> bool:
        """No packing of the rest can be better than the best known."""
        return used - (-self.total // self.capacity) >= bins_of(self.best)

    def _offer(self, packing: Packing) -> None:
        if bins_of(packing) < bins_of(self.best):
            self.best = packing
        self.proved = self.proved or bins_of(self.best) <= self.bound

    def run(self) -> Packing:
        if self.proved or not self.sizes:
            return self.best
        path: Packing = []
        used, steps = 0, 0
        open_choices = [self._choices()]
        while open_choices and steps < self.steps and not self.proved:
            choice = next(open_choices[-1], None)
            if choice is None:
                open_choices.pop()
                if path:
                    filling, bins = path.pop()
                    used -= bins
                    self._change(filling, -bins)
                continue
            steps += 1
            filling, bins = choice
            self._change(filling, bins)
            path.append(choice)
            used += bins
            if not self.sizes:
                self._offer(list(path))
            elif not self._cut(used):
                if steps % EVERY == 0:
                    self._offer([*path, *best_fit(self.counts, self.capacity)])
                open_choices.append(self._choices())
                continue
            path.pop()
            used -= bins
            self._change(filling, -bins)
        self.proved = self.proved or not open_choices
        return self.best


def complete(counts: dict[int, int], capacity: int, steps: int = STEPS) -> Packing:
    """A packing of all items: ``counts[size]`` items of each size, in bins of ``capacity``."""
    return Search(counts, capacity, steps).run()
