"""Seating customer by customer, the plain sampler that the law of table counts is held against."""

import numpy as np


class Seats:
    """Tables of many dishes at once: ``size`` lists the tables of dish 0,
    then of dish 1 ...; ``count`` says how many each dish has.  The plain
    sampler, customer by customer, that ``table_counts`` is held against."""

    def __init__(self, size: np.ndarray, count: np.ndarray):
        self.size, self.count = size.astype(np.int64), count.astype(np.int64)

    def _pick(self, weight: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """One table per dish, with probability in proportion to its weight."""
        with np.errstate(divide="ignore"):
            race = np.where(weight > 0, rng.exponential(size=len(weight)) / weight, np.inf)
        first = np.concatenate(([0], np.cumsum(self.count)[:-1]))
        best = np.minimum.reduceat(race, first)
        return np.flatnonzero(race == np.repeat(best, self.count))

    def reseat(self, new_weight: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        """One random customer of every dish leaves and is seated anew: at an
        old table by its size less the discount, at a new one by ``new_weight``."""
        if not len(self.count):
            return
        dish = np.repeat(np.arange(len(self.count)), self.count)
        customers = np.add.reduceat(self.size, np.concatenate(([0], np.cumsum(self.count)[:-1])))
        left = self._pick(self.size.astype(np.float64), rng)
        self.size[left] -= 1
        empty = np.zeros(len(self.count), dtype=bool)
        empty[dish[left]] = self.size[left] == 0
        old = customers - 1 - discount * (self.count - empty)
        opens = rng.random(len(old)) * (old + new_weight) < new_weight
        opens |= (self.count - empty) == 0
        stays = ~opens
        if stays.any():
            weight = np.where((self.size > 0) & stays[dish], self.size - discount, 0.0)
            weight[stays[dish] & (weight <= 0) & (self.size > 0)] = 1e-12
            seat = self._pick(weight, rng)
            seat = seat[weight[seat] > 0]
            self.size[seat] += 1
        # An emptied table is the new one where the customer opens one.
        place = np.full(len(self.count), -1)
        place[dish[left]] = left
        again = opens & empty
        self.size[place[again]] = 1
        fresh = np.flatnonzero(opens & ~empty)
        ends = np.cumsum(self.count)
        gone = place[empty & ~opens]
        keep = np.ones(len(self.size), dtype=bool)
        keep[gone] = False
        size = np.insert(self.size, ends[fresh], 1)
        keep = np.insert(keep, ends[fresh], True)
        self.size = size[keep]
        self.count = self.count + (opens & ~empty) - (empty & ~opens)

    def follow(self, customers: np.ndarray, new_weight: float, discount: float, rng: np.random.Generator) -> None:
        """Customers come (seated by the rule) and leave (at random) until each
        dish has the given number."""
        have = np.add.reduceat(self.size, np.concatenate(([0], np.cumsum(self.count)[:-1]))) if len(self.count) else self.count
        change = customers - have
        moved = np.flatnonzero(change)
        if not len(moved):
            return
        first = np.concatenate(([0], np.cumsum(self.count)[:-1]))
        seated = []
        for start, n, more in zip(first[moved].tolist(), self.count[moved].tolist(), change[moved].tolist()):
            tables = self.size[start:start + n].tolist()
            total = sum(tables)
            for x in rng.random(abs(more)).tolist():
                if more > 0:
                    x *= total - discount * len(tables) + new_weight
                    if x < new_weight or not tables:
                        tables.append(1)
                    else:
                        x -= new_weight
                        k = 0
                        while k < len(tables) - 1 and x >= tables[k] - discount:
                            x -= tables[k] - discount
                            k += 1
                        tables[k] += 1
                    total += 1
                else:
                    x *= total
                    k = 0
                    while k < len(tables) - 1 and x >= tables[k]:
                        x -= tables[k]
                        k += 1
                    tables[k] -= 1
                    total -= 1
                    if not tables[k]:
                        tables.pop(k)
            seated.append(tables)
        changed = np.zeros(len(self.count), dtype=bool)
        changed[moved] = True
        same = self.size[~np.repeat(changed, self.count)]
        self.count[moved] = [len(t) for t in seated]
        place = np.repeat(changed, self.count)
        self.size = np.empty(len(place), dtype=np.int64)
        self.size[~place] = same
        self.size[place] = [x for t in seated for x in t]
