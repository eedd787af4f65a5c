"""Token counts by finite-state tokenizer compilation.

A SentencePiece byte-pair model (with byte fallback) is compiled into a deterministic transducer
whose transitions carry emitted-token counts (see transducer.py). Texts are cut into chunks. Where
no piece of the vocabulary spans a border (before a run of blanks, around a line break) every state
leads to the same one, so the map of a chunk is constant: (exit state, tokens emitted). A stretch
without such a border is cut into blocks by length. Each block's map is made without waiting for the
block before it, over all entry states that the character ahead of it is known to lead to. Maps
compose associatively, and a parallel prefix scan over them gives the counts of whole texts: for
constant maps it is a cumulative sum. A state that no text has led to so far can turn up as an
entry only then; the block's map is completed by it before it is used.

Texts are worked on in parts of bounded size, cut at borders, so neither a long text nor a batch of
many needs more memory; the transitions kept are bounded by bytes. Null and empty texts have 0 bytes
and 0 tokens. An empty table gives no rows. Repeated rows and ties need nothing; other columns do
not pass through, so none can clash.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.llm.common import map_texts, read
from fleetmill.llm.transducer import MergeTransducer, Overflow

BLANK = "▁"
#: A stretch of more characters without a border is counted by composing the maps of its blocks.
LONG = 8192
BLOCK = 4096
#: Characters that are worked on at a time, but for a longer stretch without a border.
PART = 1 << 19

StateMap = dict[int, tuple[int, int]]  # entry state -> exit state, tokens emitted
#: Completes the map of block ``i`` by an entry.
Complete = Callable[[int, int], tuple[int, int]]


def compose(first: StateMap, then: StateMap, last: int, complete: Complete) -> StateMap:
    """``then`` ends with block ``last``; what its domain lacks is found by walking its blocks."""
    return {s: (step[0], n + step[1]) for s, (t, n) in first.items() for step in (then.get(t) or complete(last, t),)}


def prefix_scan(maps: list[StateMap], complete: Callable[[int, int, int], tuple[int, int]]) -> list[StateMap]:
    """The compositions of all prefixes, by doubling: in round k each map takes in the one 2^k
    places before it, so a round's compositions are independent of each other. ``complete(first,
    last, entry)`` runs blocks first to last from an entry that their map lacks."""
    out, step = list(maps), 1
    while step < len(out):
        out = [compose(out[i - step], m, i, lambda last, entry, step=step: complete(max(0, last - step + 1), last, entry)) if i >= step else m for i, m in enumerate(out)]
        step *= 2
    return out


class PieceCounter:
    def __init__(self, scores: dict[str, float]):
        long = [p for p in scores if len(p) > 1]
        if any("\n" in p or BLANK in p.lstrip(BLANK) for p in long):
            raise ValueError("pieces span the borders at which texts are cut")
        met = {c for p in scores for c in p}
        # characters of no piece fall back to their bytes: one class for each length
        alone = [next(chr(c) for c in range(low, high) if chr(c) not in met) for low, high in ((1, 0x80), (0x80, 0x800), (0x800, 0xD800), (0x10000, 0x110000))]
        self.transducer = MergeTransducer(scores, alone)
        base = len(self.transducer.chars) - 4
        self.classes = np.full(0x110000, base + 3, np.int16)
        self.classes[:0x10000], self.classes[:0x800], self.classes[:0x80] = base + 2, base + 1, base
        for c, k in self.transducer.class_of.items():
            self.classes[ord(c)] = k
        self.break_tokens = self.transducer.weight("\n")

    @classmethod
    def from_model(cls, path: str) -> PieceCounter:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces):
            raise ValueError("only models without normalization are compiled")
        if any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not compiled")
        return cls({p.piece: p.score for p in model.pieces if p.type == 1})

    def long_run(self, classes: np.ndarray) -> int:
        """Tokens of a stretch without borders, by block maps and a prefix scan."""
        t = self.transducer
        blocks = [classes[i : i + BLOCK] for i in range(0, len(classes), BLOCK)]
        maps = t.maps(blocks, [None, *(t.chars[b[-1]] for b in blocks[:-1])])

        def complete(first: int, last: int, entry: int) -> tuple[int, int]:
            state, total = entry, 0
            for k in range(first, last + 1):
                if state not in maps[k]:
                    maps[k][state] = self._sequential(blocks[k], state)
                state, n = maps[k][state]
                total += n
            return state, total

        return prefix_scan(maps, complete)[-1][t.start][1]

    def _sequential(self, classes: np.ndarray, state: int) -> tuple[int, int]:
        n = 0
        for k in classes.tolist():
            state, emitted = self.transducer.step(state, self.transducer.chars[k])
            n += emitted
        return state, n

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text, by parts of at most about PART characters."""
        totals = [0] * len(texts)
        held: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in _parts(f"{BLANK}{text}".replace(" ", BLANK)) if text else ():
                held.append((i, part))
                size += len(part)
                if size >= PART:
                    self._add(held, totals)
                    held, size = [], 0
        self._add(held, totals)
        return totals

    def _add(self, parts: list[tuple[int, str]], totals: list[int]) -> None:
        if not parts:
            return
        try:
            counts = self._run([p for _, p in parts])
        except Overflow:
            self.transducer._reset()
            if len(parts) > 1:
                self._add(parts[: len(parts) // 2], totals)
                self._add(parts[len(parts) // 2 :], totals)
                return
            smaller = list(_parts(parts[0][1], max(256, len(parts[0][1]) // 4)))
            if len(smaller) > 1:
                for p in smaller:
                    self._add([(parts[0][0], p)], totals)
                return
            counts = [self.long_run(self.classes[np.frombuffer(smaller[0].encode("utf-32-le"), np.uint32)])]
        for (i, _), n in zip(parts, counts, strict=True):
            totals[i] += n

    def _run(self, parts: list[str]) -> list[int]:
        # each part begins at a border and ends with a line break, so there is one on both sides
        joined = "".join(f"{t}\n" for t in parts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = self.classes[points]
        lengths = np.array([len(t) + 1 for t in parts])
        ends = np.cumsum(lengths)
        before = np.concatenate(([10], points[:-1]))
        resets = (before == 10) | (points == 10) | ((points == ord(BLANK)) & (before != ord(BLANK)))
        at = np.append(np.flatnonzero(resets), len(points))
        extra = np.zeros(len(parts), np.int64)
        keep = np.ones(len(points), bool)
        for k in np.flatnonzero(np.diff(at) > LONG).tolist():
            extra[np.searchsorted(ends, at[k], side="right")] += self.long_run(classes[at[k] : at[k + 1]])
            keep[at[k] : at[k + 1]] = False
        emitted = np.zeros(len(points), np.int64)
        emitted[keep] = self.transducer.run(classes[keep], resets[keep])
        scan = np.concatenate(([0], np.cumsum(emitted)))  # the prefix scan of the constant maps
        return (scan[ends] - scan[ends - lengths] - self.break_tokens + extra).tolist()


BORDER = re.compile(f"\n|(?<!{BLANK}){BLANK}")


def _parts(text: str, size: int = PART) -> Iterator[str]:
    """Parts of about ``size`` characters, cut at borders only."""
    at = 0
    while at < len(text):
        m = BORDER.search(text, at + size) if at + size < len(text) else None
        end = m.start() if m else len(text)
        yield text[at:end]
        at = end


_compiled: dict[str, PieceCounter] = {}


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` of each row. ``model``: a name that the package of
    public tokenizers knows; each worker loads it there."""

    def rows(cols: dict[str, list]) -> dict[str, list]:
        import public_tokenizers

        path = public_tokenizers.path(model)
        if path not in _compiled:
            _compiled[path] = PieceCounter.from_model(path)
        tokens = _compiled[path].count(cols["text"])
        return {key: cols["key"], "n_bytes": [len(t.encode()) if t else 0 for t in cols["text"]], "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}

    kind = dict(docs.dtypes)[key]
    return map_texts(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), rows, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))
