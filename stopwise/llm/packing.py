"""Best-fit packing with a swap-based local search.

Documents become pieces of at most ``size`` tokens. Pieces are dealt at random into groups that one task packs: best fit
by descending length, then a search over the underfull bins that exchanges pieces one for one, two for one, or moves
them, whenever that increases the sum of squared fills, until bins are empty. The pieces of bins that stay underfull are
dealt anew in the next round, until one group is left.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.common import claim, require, shared_root, with_workers, written

END = 1
#: Pieces that one task packs.
GROUP = 1 << 14
#: Bins at least this full are closed in every round.
CLOSED = 0.995
#: Words in each of a worker's two generations of remembered ones, and the longest of them.
CACHE, CACHED_BYTES = 200_000, 48
#: Words looked up together.
PART = 1 << 16
#: A mark between a letter and white space.
_POINT = re.compile(r"(?<=[A-Za-zß-öø-ÿ])([.,;:!?])(?=\s)")


class WordTokens:
    """Ids of white-space separated words, as bytes, remembered in two generations; one per worker process.

    The vocabulary splits at white space before anything else and lower-cases, so words encode alike alone and in their
    text. It also splits between a letter and a mark, so that closing marks are words of their own.
    """

    _open: dict[str, WordTokens] = {}

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    @classmethod
    def get(cls, path: str) -> WordTokens:
        mine = claim(cls)
        if path not in mine:
            mine[path] = cls(path)
        return mine[path]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; the words of some of them are looked up together."""
        out: list[list[bytes]] = [[] for _ in texts]
        group: list[tuple[int, list[bytes]]] = []
        held = 0
        for k, text in enumerate(texts):
            if any(t in text for t in self.special):  # one token wherever it stands
                out[k].append(np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
                continue
            words = _POINT.sub(r" \1", text).encode().lower().split()
            for at in range(0, len(words), PART):
                group.append((k, words[at : at + PART]))
                held += len(group[-1][1])
                if held >= PART:
                    self._add(group, out)
                    group, held = [], 0
        self._add(group, out)
        return [b"".join(parts) for parts in out]

    def _add(self, group: list[tuple[int, list[bytes]]], out: list[list[bytes]]) -> None:
        table = self._table(set(chain.from_iterable(words for _, words in group)))
        for k, words in group:
            out[k].append(b"".join(map(table.__getitem__, words)))

    def _table(self, own: set[bytes]) -> dict[bytes, bytes]:
        """Ids of the words ``own``, among others."""
        if len(self.known) > CACHE:
            self.before, self.known = self.known, {}
        missing = own.difference(self.known)
        here = {w: self.before[w] for w in missing if w in self.before}
        new = [w for w in missing if w not in here]
        here.update(zip(new, self._encode_all(new), strict=True))
        self.known.update((w, ids) for w, ids in here.items() if len(w) <= CACHED_BYTES)
        if any(len(w) > CACHED_BYTES for w in missing):
            return {w: self.known[w] for w in own if w in self.known} | here
        return self.known

    def _encode_all(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. Words of letters only have one last token each, so they are encoded in one call and cut behind those."""
        texts = [w.decode() for w in words]
        plain = [k for k, t in enumerate(texts) if t.isalpha()]
        out: list[bytes] = [b""] * len(words)
        ids = np.array(self.model.encode_batch_fast([" ".join([texts[k] for k in plain])], add_special_tokens=False)[0].ids, "<u4")
        cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(cuts) == len(plain):
            raw = ids.tobytes()
            for k, a, b in zip(plain, [0, *cuts], cuts, strict=False):
                out[k] = raw[a:b]
        else:
            plain = []
        rest = sorted(set(range(len(words))).difference(plain))
        for k, e in zip(rest, self.model.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False), strict=True):
            out[k] = np.array(e.ids, "<u4").tobytes()
        return out


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of indexes, each piece into the fullest bin that has room, in descending order of length."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(room, (lengths[i], -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        if free > lengths[i]:
            insort(room, (free - lengths[i], b))
    return bins


def local_search(bins: list[list[int]], lengths: list[int], size: int) -> list[list[int]]:
    """Empty the least filled bins into the free space of fuller ones.

    A step takes one piece, two pieces or none from a fuller bin in exchange for one or two of the donor's, so that the
    fuller bin gains as much as fits. As it is at least as full as the donor, the sum of squared fills rises with every
    step, and the search ends.
    """
    length = np.array(lengths, np.int64)
    owner = np.empty(len(lengths), np.int64)
    for b, members in enumerate(bins):
        owner[members] = b
    bins = [set(b) for b in bins]
    fill = np.array([length[list(b)].sum() for b in bins], np.int64)
    least = -(-int(length.sum()) // size)
    stuck: set[int] = set()
    while np.count_nonzero(fill) > max(least, 1):
        donors = [b for b in np.argsort(fill, kind="stable") if fill[b] and b not in stuck]
        if not donors or fill[donors[0]] == size:
            break
        donor = int(donors[0])
        moved = False
        while bins[donor]:
            step = _step(donor, bins, length, owner, fill, size)
            if step is None:
                break
            give, take, to = step
            for x in give:
                bins[donor].remove(x), bins[to].add(x)
                owner[x] = to
            for x in take:
                bins[to].remove(x), bins[donor].add(x)
                owner[x] = donor
            gain = int(length[list(give)].sum() - length[list(take)].sum())
            fill[to] += gain
            fill[donor] -= gain
            moved = True
        if bins[donor]:
            stuck.add(donor)
        elif moved:
            stuck = {b for b in stuck if fill[b] and b == donor}
    return [sorted(b) for b in bins if b]


def _step(donor, bins, length, owner, fill, size) -> tuple[tuple[int, ...], tuple[int, ...], int] | None:
    """The exchange after which the receiving bin gains most: pieces given, pieces taken back, receiving bin."""
    room = np.where((fill >= fill[donor]) & (fill < size), size - fill, 0)
    room[donor] = 0
    if not room.any():
        return None
    mine = sorted(bins[donor], key=lambda i: -length[i])
    best, gained = None, 0
    roomy = int(np.argmax(room))
    # Moves: the largest piece that some bin has room for, into the tightest such bin.
    for x in mine:
        if length[x] <= room[roomy]:
            fits = np.flatnonzero(room >= length[x])
            best, gained = ((x,), (), int(fits[np.argmin(room[fits])])), int(length[x])
            break
    others = np.flatnonzero((room[owner] > 0) & (length < (length[mine[0]] + (length[mine[1]] if len(mine) > 1 else 0))))
    if len(others):
        theirs, limit = length[others], room[owner[others]]
        # What the donor may give, by total: one or two pieces. Equal lengths are one choice, so there are fewer than ``size`` totals.
        kinds = {int(length[x]): x for x in mine}
        pairs = {int(length[x] + length[y]): (x, y) for x, y in _pairs(mine, length)}
        gives = pairs | {n: (x,) for n, x in kinds.items()}  # one piece rather than two
        totals = np.array(sorted(gives), np.int64)
        # Each of the others takes the largest total that its bin has room for once it has left.
        at = np.searchsorted(totals, theirs + limit, "right") - 1
        gain = np.where(at >= 0, totals[at] - theirs, 0)
        k = int(np.argmax(gain))
        if gain[k] > gained:
            best = (gives[int(totals[at[k]])], (int(others[k]),), int(owner[others[k]]))
    return best


def _pairs(mine: list[int], length: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of pieces of ``mine`` (by length) that cover all sums of two; of each length at most two are looked at."""
    seen: dict[int, int] = {}
    few: list[int] = []
    for x in mine:
        n = int(length[x])
        seen[n] = seen.get(n, 0) + 1
        if seen[n] <= 2:
            few.append(x)
    return combinations(few, 2)


_PIECE = {"doc_id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}
_DDL = ", ".join(f"{n} {t}" for n, t in _PIECE.items())


def pieces(docs: DataFrame, vocabulary: str, size: int = 4096, keep_ids: bool = False) -> DataFrame:
    """The documents' tokens, each with a final ``END``, cut into pieces of at most ``size``.

    ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, with ``keep_ids``, the ids as little-endian bytes.
    """
    require(docs, "doc_id", "text")
    with_workers(docs)
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = WordTokens.get(vocabulary)
        for batch in batches:
            out: list[tuple] = []
            own_ids = chain.from_iterable(model.encode([t.as_py() or "" for t in batch.column(1).slice(i, 256)]) for i in range(0, batch.num_rows, 256))
            for doc, ids in zip(batch.column(0), own_ids, strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    own = ids[at : at + 4 * size]
                    out.append((doc.as_py(), k, at // 4, len(own) // 4, zlib.crc32(own), *([own] if keep_ids else [])))
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if keep_ids else [])]
            names = [*_PIECE, *(["ids"] if keep_ids else [])]
            columns = list(zip(*out, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(_DDL).fields[1:]]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    return docs.select("doc_id", "text").mapInArrow(cut, T.StructType(fields))


def _pack_group(size: int, last: bool):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["length"].tolist()
        bins = local_search(best_fit(lengths, size), lengths, size)
        number, offset, closed = (np.zeros(len(frame), t) for t in (np.int32, np.int64, bool))
        for b, members in enumerate(bins):
            own = [lengths[i] for i in members]
            number[members] = b
            offset[members] = np.cumsum([0, *own[:-1]])
            closed[members] = last or sum(own) >= CLOSED * size
        return frame.assign(bin=number, offset=offset, closed=closed)

    return pack


def pack(docs: DataFrame, vocabulary: str, size: int = 4096, group: int = GROUP, keep_ids: bool = False, folder: str | None = None) -> DataFrame:
    """Pieces of all rows of ``docs`` with their ``sequence_id`` and ``offset``; sequences hold at most ``size`` tokens.

    Null and empty texts are the one token ``END``. Only documents over ``size`` tokens are cut; every row counts, also
    repeated ones and those without id. Other columns are ignored. Sequence numbers are unique but not dense.
    """
    spark = docs.sparkSession
    folder = folder or shared_root(spark)
    todo = written(pieces(docs, vocabulary, size, keep_ids), folder, "pieces")
    left, rounds, done = todo.count(), 0, []
    while left:
        groups = -(-left // group)
        dealt = todo.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(rounds)), F.lit(groups)))
        kind = T.StructType([*dealt.schema.fields, *T.StructType.fromDDL("bin int, offset long, closed boolean").fields])
        packed = dealt.repartition(groups, "grp").groupBy("grp").applyInPandas(_pack_group(size, False), kind)
        packed = written(packed, folder, f"round-{rounds}")
        before, left = left, packed.where(~F.col("closed")).count() if groups > 1 else 0
        last = left == 0 or left > 0.9 * before  # what no other company helps stays as it is
        here = packed if last else packed.where("closed")
        id_ = (F.lit(rounds) * F.lit(1 << 52) + F.col("grp") * F.lit(1 << 20) + F.col("bin")).cast("long")
        done.append(here.select(*todo.columns, id_.alias("sequence_id"), "offset"))
        if last:
            break
        todo, rounds = packed.where(~F.col("closed")).select(*todo.columns), rounds + 1
    if not done:
        return todo.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
