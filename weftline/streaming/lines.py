"""Rows that wait in state, in order, of which a step only touches the ends.

``Runs`` are sorted rows, written once and merged as they fall due. A ``Line`` is a queue open at both ends. Its rows lie in state by
rank, ``SIZE`` rows an entry; only the last, unfinished entry and the two ends are kept with the rest of a key's memory. So pushing and taking rows costs in proportion to those rows,
however many are waiting. Rows are lists that JSON can hold.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator

SIZE = 256
#: Entries that are remembered as read or written.
_SEEN = 64


class Runs:
    """Sorted rows, each run in entries of its own. ``held`` is a dictionary that the caller keeps: of every run the first and last entry,
    how many rows of the first are gone, and what ``head`` says of the row then first."""

    def __init__(self, parts, held: dict, head: Callable[[list], int | float]):
        self.parts, self.held, self.head = parts, held, head
        if not held:
            held.update(made=0, runs={})

    def __len__(self) -> int:
        return len(self.held["runs"])

    def first(self) -> int | float:
        return min(run[3] for run in self.held["runs"].values())

    def add(self, rows: list[list]) -> None:
        name = str(self.held["made"])
        self.held["made"] += 1
        starts = range(0, len(rows), SIZE)
        for number, at in enumerate(starts):
            self.parts.updateValue((f"{name}:{number}",), (json.dumps(rows[at : at + SIZE]),))
        self.held["runs"][name] = [0, len(starts), 0, self.head(rows[0])]

    def take(self, until: int | float, read: Callable, key: Callable) -> Iterator:
        """All rows up to ``until``, as ``read`` gives them, merged by ``key``; equal ones in the order in which they were added."""
        due = [name for name, run in self.held["runs"].items() if run[3] <= until]
        yield from heapq.merge(*[self._taken(name, until, read) for name in due], key=key)

    def _taken(self, name: str, until: int | float, read: Callable) -> Iterator:
        run = self.held["runs"][name]
        while run[0] < run[1]:
            rows = json.loads(self.parts.getValue((f"{name}:{run[0]}",))[0])
            for at in range(run[2], len(rows)):
                if self.head(rows[at]) > until:
                    run[2:] = at, self.head(rows[at])
                    return
                yield read(rows[at])
            self.parts.removeKey((f"{name}:{run[0]}",))
            run[0] += 1
            run[2] = 0
        del self.held["runs"][name]


class Store:
    """Entries of all lines of a key, by name, over a map state (or a dictionary, in tests); ``key`` stands before the names."""

    def __init__(self, parts, *key: str):
        self.parts = parts
        self.key = key
        self.seen: dict[str, list] = {}

    def _note(self, name: str, rows: list) -> None:
        if len(self.seen) >= _SEEN:
            del self.seen[next(iter(self.seen))]
        self.seen[name] = rows

    def get(self, name: str) -> list:
        if name not in self.seen:
            self._note(name, json.loads(self.parts.getValue((*self.key, name))[0]))
        return self.seen[name]

    def put(self, name: str, rows: list) -> None:
        self._note(name, rows)
        self.parts.updateValue((*self.key, name), (json.dumps(rows),))

    def drop(self, name: str) -> None:
        self.seen.pop(name, None)
        self.parts.removeKey((*self.key, name))


class Line:
    """``ends`` is a dictionary that the caller keeps; it is changed in place."""

    def __init__(self, store: Store, name: str, ends: dict):
        self.store, self.name, self.ends = store, name, ends
        if not ends:
            ends.update(first=0, skip=0, last=0, tail=[])

    def __len__(self) -> int:
        e = self.ends
        return (e["last"] - e["first"]) * SIZE + len(e["tail"]) - e["skip"]

    def _entry(self, number: int) -> list:
        return self.ends["tail"] if number == self.ends["last"] else self.store.get(f"{self.name}:{number}")

    def __getitem__(self, i: int) -> list:
        """The row at this place from the head."""
        at = self.ends["skip"] + i
        return self._entry(self.ends["first"] + at // SIZE)[at % SIZE]

    def __iter__(self) -> Iterator[list]:
        return (self[i] for i in range(len(self)))

    def push(self, row) -> None:
        e = self.ends
        e["tail"].append(row)
        if len(e["tail"]) == SIZE:
            self.store.put(f"{self.name}:{e['last']}", e["tail"])
            e["last"] += 1
            e["tail"] = []

    def take(self) -> list:
        """The head, which leaves."""
        e = self.ends
        row = self[0]
        e["skip"] += 1
        if e["first"] == e["last"]:
            if 2 * e["skip"] > len(e["tail"]) and (e["skip"] > 32 or e["skip"] == len(e["tail"])):
                # places of the tail start anew
                del e["tail"][: e["skip"]]
                e["skip"] = 0
        elif e["skip"] == SIZE:
            self.store.drop(f"{self.name}:{e['first']}")
            e["first"] += 1
            e["skip"] = 0
        return row

    def pop(self) -> list:
        """The newest row, which leaves."""
        e = self.ends
        if not e["tail"]:
            e["last"] -= 1
            e["tail"] = list(self.store.get(f"{self.name}:{e['last']}"))
            self.store.drop(f"{self.name}:{e['last']}")
        row = e["tail"].pop()
        if not len(self):
            e.update(skip=0, tail=[])
        return row

    def newest(self) -> list:
        return self[len(self) - 1]

    def clear(self) -> None:
        for number in range(self.ends["first"], self.ends["last"]):
            self.store.drop(f"{self.name}:{number}")
        self.ends.update(first=0, skip=0, last=0, tail=[])


class Lines:
    """The lines of a key by name, made as they are asked for."""

    def __init__(self, store: Store, ends: dict[str, dict]):
        self.store, self.ends = store, ends
        self.made: dict[str, Line] = {}

    def __getitem__(self, name: str) -> Line:
        if name not in self.made:
            self.made[name] = Line(self.store, name, self.ends.setdefault(name, {}))
        return self.made[name]
