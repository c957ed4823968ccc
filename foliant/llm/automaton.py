"""A byte-pair tokenization automaton, compiled merge by merge.

The automaton reads tokens; it accepts exactly the token sequences that the
merges produce.  It begins as one state with a loop for every base symbol.  The
gadget of a merge ``left right -> token``: the state that ``left`` leads to is
copied without its ``right`` arc, ``left`` arcs now lead to the copy, and every
state with a ``left`` arc gains a ``token`` arc to where ``right`` led.  All
arcs of one label lead to one state, so states are stored as (parent, removed
label, age) and an arc's presence follows from the age of state and label; the
answers are kept in a transition table.

Encoding follows the automaton from the start state along a word's symbols,
one table look-up for each arc it tries.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from functools import lru_cache


@lru_cache(1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Automaton:
    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix, self.letters = suffix, byte_letters()
        self.labels = {i: t for t, i in vocabulary.items()}
        size = max(self.labels) + 1
        self.left = [-1] * size  # the label's left part; -1: a base symbol
        self.age = [0] * size
        self.live = [True] * size
        self.target = [0] * size  # the state that the label leads to
        self.parent, self.removed, self.born = [-1], [-1], [0]
        self.table: dict[int, bool] = {}
        self.paths: dict[int, tuple] = {}
        self.size = size
        for time, (a, b) in enumerate(merges, 1):
            left, right, token = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.left[token], self.age[token] = left, time
            state = self.target[left]
            self.live[token] = self.live[left] and self.live[right] and self._has(state, right)
            if not self.live[token]:
                continue
            self.target[token] = self.target[right]
            self.parent.append(state)
            self.removed.append(right)
            self.born.append(time)
            self.target[left] = len(self.parent) - 1
        self.paths.clear()
        #: Words of the trie: node -> {letter: (node, token or -1)}
        self.trie: list[dict] = [{}]
        for text, token in vocabulary.items():
            if self.live[token]:
                self._add(text, token)

    @classmethod
    def load(cls, path: str) -> "Automaton":
        """From a tokenizer file of the ``tokenizers`` library."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        return cls(model["vocab"], merges, model.get("end_of_word_suffix") or "")

    def _has(self, state: int, label: int) -> bool:
        """Whether the state has an arc of that label.

        A copy made before the label has it if it has the label's left part; a
        later copy has it if no copy on the way removed it.
        """
        born, removed = self._path(state)
        upto = len(born)
        while True:
            if removed.get(label, upto) < upto:
                return False
            age = self.age[label]
            if age == 0:
                return True
            upto = bisect_right(born, age, 0, upto)
            label = self.left[label]

    def _path(self, state: int):
        """Ages of the copies from the root to the state, and the place where each label went."""
        found = self.paths.get(state)
        if found is None:
            chain = []
            x = state
            while x >= 0:
                chain.append(x)
                x = self.parent[x]
            chain.reverse()
            found = self.paths[state] = [self.born[x] for x in chain], {self.removed[x]: k for k, x in enumerate(chain) if self.removed[x] >= 0}
        return found

    def _symbols(self, text: str) -> list[str]:
        s = self.suffix
        if s and text.endswith(s) and len(text) > len(s):
            body = text[: -len(s)]
            return [*body[:-1], body[-1] + s]
        return list(text)

    def _add(self, text: str, token: int) -> None:
        node, symbols = 0, self._symbols(text)
        for k, x in enumerate(symbols):
            nodes = self.trie[node]
            to, found = nodes.get(x, (0, -1))
            if not to:
                self.trie.append({})
                to = len(self.trie) - 1
            nodes[x] = (to, token if k == len(symbols) - 1 else found)
            node = to

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word: the automaton's one accepting path, longest arcs tried first.

        An accepted path to a position is the only one, so a position that leads nowhere is never entered again.
        """
        letters, trie, target, table, size = self.letters, self.trie, self.target, self.table, self.size
        symbols = [letters[b] for b in word]
        n = len(symbols)
        if not n:
            return []
        symbols[-1] += self.suffix
        out: list[int] = []
        ends = [0]
        dead: set[int] = set()
        at, state = 0, 0
        while at < n:
            node, i, arcs = 0, at, []
            while i < n and (step := trie[node].get(symbols[i])) is not None:
                node, token = step
                i += 1
                if token >= 0:
                    arcs.append((token, i))
            for token, to in reversed(arcs):
                if to in dead:
                    continue
                if out:
                    key = state * size + token
                    ok = table.get(key)
                    if ok is None:
                        if len(table) > 2_000_000:
                            table.clear()
                        ok = table[key] = self._has(state, token)
                    if not ok:
                        continue
                out.append(token)
                ends.append(to)
                break
            else:
                if not out:
                    raise ValueError(f"no token begins {symbols[0]!r}")
                dead.add(at)
                out.pop()
                ends.pop()
            at, state = ends[-1], target[out[-1]] if out else 0
        return out

    def decode(self, ids) -> str:
        """The arcs' labels in order, as the library joins them without a decoder: by one space."""
        labels = self.labels
        return " ".join([labels[i] for i in ids])
