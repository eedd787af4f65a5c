"""Merge tokenizers (byte-pair models) as deterministic transducers.

It rests on one fact about merge tokenizers: a sequence of tokens is the tokenization of its text
exactly if every two neighbours are that of theirs (no merge crosses a border in the whole text
that would not cross it in the pair alone). So the last token of a prefix is the one piece ending
there that fits behind the last token at its start, and a state needs only the open starts: the
places from which the text so far may grow into a longer piece, each with the token before it and
how many tokens fewer it had. A transition carries the tokens it emits, which is negative where
pieces merge, and the last token. Transitions are compiled when an input first asks for them and
kept in arrays; texts run through them side by side, one lane for each stretch between resets.
"""

from __future__ import annotations

import numpy as np

#: States, and bytes of the table of transitions, that a worker keeps before it compiles anew.
MAX_STATES, MAX_BYTES = 250_000, 256 << 20
#: Least characters of a lane (it ends at the next reset).
LANE = 256


class Overflow(Exception):
    """The table of transitions would outgrow its bound: the input is to be run in smaller parts."""


class MergeTransducer:
    """``scores``: token -> priority, the highest merges first, the leftmost among equals.
    ``classes``: for each character that may occur in a longer token its class, as ``alphabet``
    lists them; characters outside always stand alone, by ``alone`` (class -> a character)."""

    def __init__(self, scores: dict[str, float], alone: list[str] = ()):
        self.scores = scores
        long = [p for p in scores if len(p) > 1]
        self.prefixes = {p[:k] for p in long for k in range(1, len(p))}
        self.growing = {c for p in long for c in p}
        self.chars = sorted(self.growing | (set(scores) - set(long))) + list(alone)
        self.class_of = {c: k for k, c in enumerate(self.chars)}
        self._fits: dict[tuple, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self._fits.clear()
        self.states: dict[tuple, int] = {}
        self.entries: list[tuple] = []
        self.columns = np.full(len(self.chars), -1, np.int32)  # classes get a column when first met
        self.by_column: list[str] = []
        self.moves = np.full((1024, 32), -1, np.int32)  # next state * 256 + emitted + 128
        self.entered: dict[str, set[int]] = {}  # by the character that leads there
        self.start = self._state((("", None, 0),))

    def _state(self, entries: tuple) -> int:
        if (found := self.states.get(entries)) is None:
            found = self.states[entries] = len(self.entries)
            self.entries.append(entries)
            if found >= len(self.moves):
                self._grow(len(self.moves) * 3 // 2, self.moves.shape[1])
        return found

    def _grow(self, rows: int, cols: int) -> None:
        if 4 * rows * cols > MAX_BYTES:
            raise Overflow
        new = np.full((rows, cols), -1, np.int32)
        new[: self.moves.shape[0], : self.moves.shape[1]] = self.moves
        self.moves = new

    def weight(self, token: str) -> int:
        """Tokens that a final piece counts as."""
        return 1 if token in self.scores else len(token.encode())

    def merge(self, text: str) -> list[str]:
        """The defining procedure, for texts of at most two tokens."""
        parts = list(text)
        while True:
            at, best = -1, None
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    at, best = i, score
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, before: str | None, token: str) -> bool:
        key = (before, token)
        if (found := self._fits.get(key)) is None:
            if before and self.fits(None, token) and not self._meet(before, token):
                found = True
            else:
                found = self.merge((before or "") + token) == ([before, token] if before else [token])
            self._fits[key] = found
        return found

    def _meet(self, before: str, token: str) -> bool:
        """Whether any piece could be made across the border; if not, no merge need be tried."""
        for i in range(len(before)):
            if (end := before[i:]) in self.prefixes:
                for k in range(1, len(token) + 1):
                    if end + token[:k] in self.scores:
                        return True
        return False

    def _matters(self, before: str | None, begun: str) -> bool:
        """Whether a piece across the border could stop a token that starts with ``begun``."""
        for i in range(len(before or "")):
            if (end := before[i:]) in self.prefixes and (end + begun in self.prefixes or any(end + begun[:k] in self.scores for k in range(1, len(begun) + 1))):
                return True
        return False

    def step(self, state: int, char: str) -> tuple[int, int]:
        """Compiles one transition: the next state and the tokens emitted."""
        for begun, before, fewer in self.entries[state]:
            token = begun + char
            if (len(token) == 1 or token in self.scores) and self.fits(before, token):
                emitted = fewer + self.weight(token)
                break
        else:
            raise AssertionError("no token ends here")
        new = [(g, before if self._matters(before, g) else None, fewer - emitted) for begun, before, fewer in self.entries[state] if (g := begun + char) in self.prefixes]
        new.append(("", token if char in self.growing else None, 0))
        to = self._state(tuple(new))
        self.entered.setdefault(char, set()).add(to)
        return to, emitted

    def _compile(self, states: np.ndarray, columns: np.ndarray) -> None:
        width = self.moves.shape[1]
        for key in np.unique(states * width + columns).tolist():
            s, c = divmod(key, width)
            to, emitted = self.step(s, self.by_column[c])
            self.moves[s, c] = 256 * to + emitted + 128

    def _columns(self, classes: np.ndarray) -> np.ndarray:
        met = np.flatnonzero(np.bincount(classes, minlength=len(self.chars)))
        for k in met[self.columns[met] < 0].tolist():
            self.columns[k] = len(self.by_column)
            self.by_column.append(self.chars[k])
        if len(self.by_column) > self.moves.shape[1]:
            self._grow(len(self.moves), len(self.by_column) * 5 // 4)
        return self.columns[classes]

    def run(self, classes: np.ndarray, resets: np.ndarray) -> np.ndarray:
        """``classes``: of all characters of a batch; ``resets``: whether the tokenization starts
        anew at each (the first has to). The tokens emitted at each character."""
        if len(self.entries) > MAX_STATES or 2 * self.moves.nbytes > MAX_BYTES:
            self._reset()
        n = len(classes)
        out = np.zeros(n, np.int8)
        if not n:
            return out
        columns = self._columns(classes)
        at = np.flatnonzero(resets)
        cuts = at[np.unique(np.minimum(np.searchsorted(at, np.arange(0, n, LANE)), len(at) - 1))]
        lengths = np.diff(np.append(cuts, n))
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = cuts[order], lengths[order]
        live = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # lanes longer than p
        state = np.full(len(starts), self.start, np.int64)
        for p in range(lengths[0]):
            k = live[p]
            where = starts[:k] + p
            now, col = state[:k], columns[where]
            now[resets[where]] = self.start
            move = self.moves.ravel().take(now * self.moves.shape[1] + col)
            if (new := move < 0).any():
                self._compile(now[new], col[new])
                move = self.moves.ravel().take(now * self.moves.shape[1] + col)
            out[where] = (move & 255) - 128
            state[:k] = move >> 8
        return out

    def maps(self, blocks: list[np.ndarray], before: list[str | None]) -> list[dict[int, tuple[int, int]]]:
        """For each block of classes its map: entry state -> exit state, tokens emitted. ``before`` is
        the character ahead of each (None: the block begins at ``start``). The entries are all states
        that this character is known to lead to, whatever text led there; blocks don't wait for each
        other, and all run side by side. Entries that reach the same state go on as one."""
        owner, state, members = [], [], []  # of each lane: its block, its state, (entry, tokens ahead)
        for b, char in enumerate(before):
            for entry in [self.start] if char is None else sorted(self.entered.get(char, {self.start})):
                owner.append(b)
                state.append(entry)
                members.append([(entry, 0)])
        tokens = [0] * len(owner)
        chars = [[self.chars[k] for k in block.tolist()] for block in blocks]
        live, known = list(range(len(owner))), {}
        for p in range(max(map(len, chars), default=0)):
            at: dict[tuple[int, int], int] = {}
            kept = []
            for lane in live:
                if p >= len(chars[owner[lane]]):
                    continue
                key = (state[lane], chars[owner[lane]][p])
                if (move := known.get(key)) is None:
                    move = known[key] = self.step(*key)
                state[lane] = move[0]
                tokens[lane] += move[1]
                first = at.setdefault((owner[lane], move[0]), lane)
                if first == lane:
                    kept.append(lane)
                else:
                    members[first] += [(entry, n + tokens[lane] - tokens[first]) for entry, n in members[lane]]
                    members[lane] = []
            live = kept
        out: list[dict[int, tuple[int, int]]] = [{} for _ in blocks]
        for lane, own in enumerate(members):
            for entry, n in own:
                out[owner[lane]][entry] = (state[lane], tokens[lane] + n)
        return out
