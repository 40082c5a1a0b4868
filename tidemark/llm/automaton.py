"""Merges compiled into a deterministic automaton over tokens.

The automaton accepts just the token sequences that the merges make. It starts with one state for
each symbol and an arc from every state under every symbol; a state is known by the token read last.
Each merge (u, v) -> w, in order, is one gadget:

* the arc from u under v goes, as that pair is merged from now on;
* a new label w leaves every state that u could follow, so w enters where u did;
* its state w has the arcs that v's state has, as what follows w followed v;
* if u = v, the leftmost pair is merged first, so the arc from u under w goes as well.

Written out, the arcs would be the square of the vocabulary. A gadget instead stores what it changes:
w takes over the arcs into u and out of v as they are at that time, and removed arcs are listed with
the gadget that removed them. An arc is looked up along these references and then kept in a table.

A string has one accepted path, and so has each prefix, so a word is read from left to right with one
token kept for each position: the arc from the token that ends there decides on the next ones.
"""

from __future__ import annotations

from array import array

from tidemark.llm.vocab import Vocab, byte_letters

_SHIFT = 20
#: Arcs kept after their look-up; the table starts anew when it is full.
ARCS = 1 << 20


class Automaton:
    def __init__(self, vocab: Vocab):
        letters = byte_letters()
        size = max(vocab.ids.values()) + 1
        self.labels = [""] * size
        for label, i in vocab.ids.items():
            self.labels[i] = label
        self.born, self.into, self.out = array("i", [0]) * size, array("i", [-1]) * size, array("i", [-1]) * size
        self.gone: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        unread, used = set(), set()
        for time, (u, v, w) in enumerate(vocab.merges, 1):
            used |= {u, v}
            if self.born[w] or w in used:
                raise ValueError(f"merge {time} uses a token that is made later, or makes one again")
            if u in unread or v in unread or not self.follows(u, v, time - 1):
                unread.add(w)  # an earlier merge keeps u and v apart
            self.born[w], self.into[w], self.out[w] = time, u, v
            self.gone[u << _SHIFT | v] = time
            if u == v:
                self.gone[u << _SHIFT | w] = time
        self._read(vocab, letters, unread)
        self.arcs.clear()

    def _read(self, vocab: Vocab, letters: list[str], unread: set[int]) -> None:
        """Transitions by symbol with the token read there; 256 more symbols are bytes that end their word."""
        number = {c: b for b, c in enumerate(letters)}
        ending = 256 if vocab.suffix else 0
        self.start: dict = {}
        for label, i in vocab.ids.items():
            if i in unread:
                continue
            last = bool(vocab.suffix) and label.endswith(vocab.suffix)
            symbols = [number[c] for c in (label[: -len(vocab.suffix)] if last else label)]
            if last:
                symbols[-1] += ending
            node = self.start
            for s in symbols[:-1]:
                node = node.setdefault(s, [{}, -1])[0]
            node.setdefault(symbols[-1], [{}, -1])[1] = i
        self.ending = ending

    def follows(self, x: int, y: int, time: int) -> bool:
        """Whether the arc from x under y is there after the first ``time`` gadgets."""
        born, gone = self.born, self.gone
        while True:
            removed = gone.get(x << _SHIFT | y)
            if removed is not None and removed <= time:
                return False
            newer = max(born[x], born[y])
            if not newer:
                return True
            # What the newer token took over, as it was when its gadget came.
            x, y, time = (
                self.out[x] if born[x] == newer else x,
                self.into[y] if born[y] == newer else y,
                newer - 1,
            )

    def arc(self, x: int, y: int) -> bool:
        key = x << _SHIFT | y
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            found = self.arcs[key] = self.follows(x, y, 1 << 30)
        return found

    def encode(self, word: bytes) -> list[int]:
        """The tokens of the one accepted path that reads ``word``."""
        n = len(word)
        if not n:
            return []
        symbols = list(word)
        symbols[-1] += self.ending
        start, arcs = self.start, self.arcs
        last, origin = [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            before = last[i]
            if before < 0 and i:
                raise ValueError("no path reads this word: a byte is missing from the vocabulary")
            node = start
            for j in range(i, n):
                found = node.get(symbols[j])
                if found is None:
                    break
                node, t = found
                if t >= 0:
                    if i:
                        there = arcs.get(before << _SHIFT | t)
                        if there or there is None and self.arc(before, t):
                            last[j + 1], origin[j + 1] = t, i
                    else:
                        last[j + 1] = t
        if last[n] < 0:
            raise ValueError("no path reads this word: a byte is missing from the vocabulary")
        out, at = [], n
        while at:
            out.append(last[at])
            at = origin[at]
        return out[::-1]

    def decode(self, ids: list[int], special: dict[int, str]) -> list[str]:
        """The labels of the arcs along ``ids``."""
        labels = self.labels
        if special:
            return [special[i] if i in special else labels[i] for i in ids]
        return [labels[i] for i in ids]
