"""Cheapest edits of a run of turns: an auction for the shortest path through a lattice of rows and role states."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWING = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
CLASS_OF = {USER: "u", ASSISTANT: "a"}
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
FAR = 1 << 60
# What a conversation that is in a state when its rows are over still costs, and the edits that end it.
END = (0, 2 * INSERT, INSERT, 0)
TAIL = ("", "II", "I", "")
SETTLED_EVERY = 16

# A row is one character: "-" has to be deleted; else the class of its role (s, u, a or x), as a capital if truncated.
GONE = "-"


def least_cost(code: str) -> int:
    """No edit of the row costs less."""
    return DELETE if code == GONE or code.isupper() else REROLE if code == "x" else 0


class Lattice:
    """Nodes (row, state); ``price`` is at most each node's distance to the exits, and equal to it once settled.

    ``exits`` is what each state costs when the last row is passed; FAR where that is no way out. Insertions after the
    last row belong to what follows.
    """

    def __init__(self, codes: str, exits: Sequence[int]):
        self.codes, self.exits = codes, tuple(exits)
        n = len(codes)
        only_early = min(exits[USER], exits[ASSISTANT]) >= FAR  # then a state without way back must not be entered
        self.allowed = [not only_early, not only_early, not only_early, not only_early] if not only_early else [True, exits[SYSTEM] < FAR, False, False]
        rest = min(exits)
        self.price = [[0] * 4 for _ in range(n)] + [list(exits)]
        for i in range(n - 1, -1, -1):
            rest += least_cost(codes[i])
            self.price[i] = [rest] * 4
        self.settled = [[False] * 4 for _ in range(n)] + [[True] * 4]

    def arcs(self, i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
        """(letter, cost, row, state) of the edits possible at a node, by letter."""
        code = self.codes[i]
        following = FOLLOWING[q]
        yield "D", DELETE, i + 1, q
        if self.allowed[following]:
            yield "I", INSERT, i, following
        if code != GONE:
            extra = TRUNCATED if code.isupper() else 0
            if code in "sS" and q == START and self.allowed[SYSTEM]:
                yield "K", extra, i + 1, SYSTEM
            elif code.lower() == CLASS_OF[following] and self.allowed[following]:
                yield "K", extra, i + 1, following
            if self.allowed[following]:
                yield "R", REROLE + extra, i + 1, following

    def settle(self, i: int, q: int) -> int:
        """The node's distance to the exits, by auction.

        A path grows from the node along arcs that are tight for the prices. Where its end has none, the end's price
        rises to the least that any arc offers, and the path loses its end. It is done at an exit, or at a node whose
        distance is known: then every price on the path is its distance.
        """
        path = [(i, q)]
        while not self.settled[path[-1][0]][path[-1][1]]:
            i, q = path[-1]
            best, to = FAR, None
            for _, cost, j, r in self.arcs(i, q):
                offer = cost + self.price[j][r]
                if offer < best:
                    best, to = offer, (j, r)
            if best > self.price[i][q] or to is None:
                self.price[i][q] = best
                if best >= FAR:
                    self.settled[i][q] = True
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        for i, q in path:
            self.settled[i][q] = True
        return self.price[path[0][0]][path[0][1]]

    def distance(self, q: int) -> int:
        """Cheapest edits of all rows from state ``q`` on. Starts near the exits come first, which keeps paths short."""
        if not self.allowed[q]:
            return FAR
        for i in range((len(self.codes) - 1) // SETTLED_EVERY * SETTLED_EVERY, 0, -SETTLED_EVERY):
            for r in range(4):
                if self.allowed[r]:
                    self.settle(i, r)
        return self.settle(0, q)

    def trace(self, q: int) -> tuple[str, int]:
        """(edits, last state): of the paths of tight arcs to an exit the one whose letters sort first."""
        self.distance(q)
        i, letters = 0, []
        while i < len(self.codes):
            for letter, cost, j, r in self.arcs(i, q):
                if self.price[i][q] == cost + self.settle(j, r):
                    letters.append(letter)
                    i, q = j, r
                    break
        return "".join(letters), q


def between(codes: str) -> list[int]:
    """Costs from each state before the rows to each state after them, as 16 numbers."""
    out = [FAR] * 16
    for exit_ in range(4):
        lattice = Lattice(codes, [0 if q == exit_ else FAR for q in range(4)])
        for q in range(4):
            out[4 * q + exit_] = min(FAR, lattice.distance(q))
    return out


def replay(audit: str, classes: Sequence[str]) -> Iterator[tuple[int | None, str | None]]:
    """(row, new role) of each turn that the edits leave: no row for an insertion, no role where the row keeps its own."""
    i, q = 0, START
    for letter in audit:
        if letter == "I":
            q = FOLLOWING[q]
            yield None, ROLE[q]
            continue
        if letter == "K":
            q = SYSTEM if classes[i] == "s" else FOLLOWING[q]
            yield i, None
        elif letter == "R":
            q = FOLLOWING[q]
            yield i, ROLE[q]
        i += 1
