"""Best-fit-decreasing packing of token sequences.

Every piece has a whole length of at most ``capacity`` tokens, so best-fit decreasing over any
number of pieces is decided by how many pieces there are of each length: pieces of one length are
interchangeable, and so are open bins with the same room. The driver gets that histogram (at most
``capacity`` rows, whatever the input) and runs best-fit decreasing on it exactly, each time
finding the tightest open bin by descending a segment tree over the remaining capacities. Its plan
is a list of runs: pieces number a to b of a length go, so many to a bin, into consecutive bins.
Spark then numbers the pieces of each length (offsets by partition, so no length is gathered in
one task) and looks up their runs.

Texts are tokenized once, into a written table of pieces that keeps the partition each was made in.
Both passes number by that column, so they agree whatever has become of the executors; if the pieces
placed were not those planned, the query fails rather than lose any. A null or empty text has only
the end token. Very long texts are cut into pieces of full size, the first shorter. Repeated rows are
packed each; ties go by partition and the order of columns, any is right. An empty table gives no
rows. ``best_fit`` keeps all columns of its pieces, whatever their names (``sequence_id`` and
``offset`` are set anew); ``pack`` reads doc_id and text only.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from array import array

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmill.llm.common import Tables, free_names, map_texts, read

CAPACITY = 2048
#: Words whose ids a worker keeps.
KEPT = 1_000_000
END = 0


class SegmentTree:
    """Counts over 0..size-1; finds the first index not below a bound that has any."""

    def __init__(self, size: int):
        self.base = 1 << max(1, (size - 1).bit_length())
        self.tree = [0] * (2 * self.base)

    def __getitem__(self, i: int) -> int:
        return self.tree[self.base + i]

    def add(self, i: int, n: int) -> None:
        i += self.base
        while i:
            self.tree[i] += n
            i >>= 1

    def first_from(self, low: int) -> int | None:
        i = low + self.base
        if low >= self.base:
            return None
        while not self.tree[i]:
            while i & 1:
                i >>= 1
                if i <= 1:
                    return None
            i += 1
        while i < self.base:
            i = 2 * i if self.tree[2 * i] else 2 * i + 1
        return i - self.base


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first number, end number, first bin, pieces to a bin, offset of the first)
    that place ``histogram[length]`` pieces of each length by best-fit decreasing. Open bins are
    ranges [first, end) with the same room; a piece goes to the tightest, and the next of its
    length then fits that same bin, tighter still, until it is full."""
    open_bins: dict[int, list[tuple[int, int]]] = {}
    room, runs, used = SegmentTree(capacity + 1), [], 0

    def put(left: int, first: int, end: int) -> None:
        if end > first and left:
            open_bins.setdefault(left, []).append((first, end))
            room.add(left, end - first)

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError("lengths are 1 to the capacity")
        at, n = 0, histogram[length]
        while at < n:
            left = room.first_from(length)
            if left is None:
                left, first, end = capacity, used, used + -(-(n - at) // (capacity // length))
                used = end
            else:
                first, end = open_bins[left].pop()
                room.add(left, first - end)
            each = left // length
            full = min(end - first, (n - at) // each)
            if full:
                runs.append((length, at, at + full * each, first, each, capacity - left))
                put(left - each * length, first, first + full)
                at, first = at + full * each, first + full
            if first < end and at < n:  # fewer than a binful are left
                runs.append((length, at, n, first, n - at, capacity - left))
                put(left - (n - at) * length, first, first + 1)
                at, first = n, first + 1
            put(left, first, end)
    return runs


class _Irregular(Exception):
    pass


class _Words(dict):
    """Word -> ids of a blank and the word, learnt when first asked for."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if not word or word != word.strip():
            raise _Irregular
        found = self[word] = array("I", self.encode(" " + word)).tobytes()
        return found


def ranks_of(file: str, ranks: str) -> dict[bytes, int] | None:
    """The rank file's table, if it is there and says the same as the tokenizer's own file: the same
    tokens under the same ids, each made by a merge of its own, in the order of ids, the same split
    of texts, and nothing done to texts before. Else None."""
    if not os.path.exists(ranks):
        return None
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(file, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t["content"] for t in spec["added_tokens"]}
    own = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
    made = [spec["model"]["vocab"][m] for m in merges]
    split = spec["pre_tokenizer"]
    same_split = split["type"] == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"] and spec["normalizer"] is None
    return table if own == table and made == sorted(set(made)) and len(made) == len(own) - 256 and same_split else None


class TokenIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, as the tokenizer of a file gives them.
    Where a rank file says the same (ranks_of), a quicker engine reads that; tests hold the two
    against each other. The splitting rule never joins what stands before a single blank between two
    words with what follows it, so words are looked up; texts with other blanks are encoded whole."""

    def __init__(self, tokenizer: str, ranks: str, special: str = "<|endoftext|>"):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = public_tokenizers.path(tokenizer)
        library = Tokenizer.from_file(path)
        table = ranks_of(path, public_tokenizers.path(ranks))
        if table is not None:
            import tiktoken

            self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        else:
            self.encode = lambda text: library.encode(text, add_special_tokens=False).ids
        self.special = special
        self.special_id = array("I", [library.token_to_id(special)]).tobytes()
        self.words = _Words(self.encode)

    def section(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            if first != first.rstrip():
                raise _Irregular
            return array("I", self.encode(first)).tobytes() + b"".join(map(self.words.__getitem__, rest))
        except _Irregular:
            return array("I", self.encode(text)).tobytes()

    def ids(self, text: str | None) -> bytes:
        if len(self.words) > KEPT:
            self.words.clear()
        return self.special_id.join(map(self.section, (text or "").split(self.special)))


_loaded: dict[str, TokenIds] = {}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, but for the first."""
    head = n % capacity or capacity
    return [(0, min(n, head)), *((s, capacity) for s in range(head, n, capacity))]


def token_pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k", capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``, each document closed by the end token.
    ``tokenizer``: a name in the package of public tokenizers, there as .json and as .tiktoken."""

    def rows(cols: dict[str, list]) -> dict[str, list]:
        if tokenizer not in _loaded:
            _loaded[tokenizer] = TokenIds(f"{tokenizer}.json", f"{tokenizer}.tiktoken")
        ids_of = _loaded[tokenizer].ids
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc_id, text in zip(cols["doc_id"], cols["text"], strict=True):
            ids = ids_of(text) + END.to_bytes(4, "little")
            for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                for name, value in zip(out, (doc_id, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])), strict=True):
                    out[name].append(value)
        return out

    return map_texts(docs.select("doc_id", "text"), rows, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length``. The rows are written once,
    each with the partition it was in: both passes number by that column, as the partitions of a
    scan change with the number of executors."""
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    part, n, rank, before, first, end, bin_, each, place = free_names(pieces, "part", "n", "rank", "before", "first", "end", "bin", "each", "place")
    tables = Tables()
    at = tables.put(pieces.withColumn(part, F.spark_partition_id()))
    counts = tables.put(at.groupBy("length", part).agg(F.count(F.lit(1)).alias(n)))
    runs = plan({r["length"]: r[n] for r in counts.groupBy("length").agg(F.sum(n).alias(n)).collect()}, capacity)
    table = spark.createDataFrame(runs, f"length long, `{first}` long, `{end}` long, `{bin_}` long, `{each}` long, `{place}` long")
    ahead = F.sum(n).over(W.partitionBy("length").orderBy(part).rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("length", part, F.coalesce(ahead, F.lit(0)).alias(before))
    within = F.row_number().over(W.partitionBy(part, "length").orderBy(*pieces.columns)) - 1
    # outer joins: a piece without a place would fail below, not vanish
    numbered = at.withColumn(rank, within).join(offsets, ["length", part], "left").withColumn(rank, F.col(rank) + F.col(before))
    # runs: a few for each of at most `capacity` lengths
    fits = (numbered["length"] == table["length"]) & (F.col(rank) >= F.col(first)) & (F.col(rank) < F.col(end))
    placed = numbered.join(F.broadcast(table), fits, "left").withColumn(bin_, F.coalesce(bin_, F.raise_error(F.lit("a piece has no place")).cast("long")))
    step = F.col(rank) - F.col(first)
    where = {"sequence_id": F.col(bin_) + F.floor(step / F.col(each)).cast("long"), "offset": F.col(place) + step % F.col(each) * numbered["length"]}
    return tables.finish(placed.select(*[numbered[c] for c in pieces.columns], *(c.alias(name) for name, c in where.items())))


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k", capacity: int = CAPACITY) -> DataFrame:
    """Tokenizes, cuts and packs ``docs(doc_id, text)``; one row per piece."""
    return best_fit(token_pieces(docs, tokenizer, capacity), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
