"""Cross-tokenizer alignment by skipping along diagonals.

Two public tokenizers cut the same bytes; where both end a token, the text falls into groups. The arrays of token ends
are compared at the current index shift: probes of doubling length jump over stretches where the tokens correspond one
to one; at the first difference the irregular group is resolved token by token and gives the new shift.

Both tokenizers encode what follows a lone space as if it began the text, so texts are cut there and each stretch is
encoded and aligned once for as long as a worker remembers it; the same holds at lone line feeds and before marks after
letters, as no piece crosses them. For the same reason new stretches are encoded many in one text, and one by one only
where a tokenizer doesn't give that text back.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.common import claim, require, shared_root, with_workers, written

MARK = "▁"
#: Stretches in each of a worker's two generations of remembered ones, and the longest of them in characters.
CACHE, CACHED_CHARS = 60_000, 32
#: Stretches of a text taken at a time, so that a very long text isn't held as a list of all its stretches' results.
PART = 1 << 18
#: Characters of texts whose stretches are looked up together, and new stretches encoded as one text.
TOGETHER, JOINED = 1 << 17, 64
#: A space, or a lone line feed, between two characters that no tokenizer takes for white space.
_CUT = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")
_BLANK = re.compile(r"[ \n]\s|\s[ \n]")
#: A mark between a letter and white space. Stands before a mark that is cut off; a character of private use.
_POINT = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ɏ])([.,;:!?])(?=[ \n]|\Z)")
GLUED = "\ue000"
#: In place of the result of a stretch that a tokenizer changes.
LOST = (b"", b"", -1, -1)


def stretches_of(text: str) -> list[str]:
    """The text cut where both tokenizers begin anew: at lone spaces, which go, and before lone line feeds.

    ``GLUED`` stands before a stretch without a space before it. Where there is no longer white space, marks after
    letters are cut off as well.
    """
    if _BLANK.search(text) or text[0].isspace() or text[-1] in " \n":
        first, *others = _CUT.split(" " + text)
        return [first[1:], *(GLUED + s if s[0] == "\n" else s for s in others)]
    return _POINT.sub(f" {GLUED}\\1", text).replace("\n", f" {GLUED}\n").split(" ")


def diagonal_runs(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Starts ``i``, starts ``j`` and lengths of runs with ``a[i + k] == b[j + k]``, of two ascending lists that end alike."""
    starts_a, starts_b, lengths = [], [], []
    i = j = 0
    size_a, size_b = len(a), len(b)
    while i < size_a and j < size_b:
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        starts_a.append(i)
        starts_b.append(j)
        first, step = i, 1
        i, j = i + 1, j + 1
        while i < size_a and j < size_b and a[i] == b[j]:
            step *= 2
            if a[i : i + step] == b[j : j + step]:
                most = min(step, size_a - i, size_b - j)  # equal slices are as long as each other
            else:
                most = step = 1
            i, j = i + most, j + most
        lengths.append(i - first)
    return starts_a, starts_b, lengths


def shared_ends(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Index pairs ``(i, j)`` with ``a[i] == b[j]`` of two ascending lists that end alike."""
    return [(i + k, j + k) for i, j, n in zip(*diagonal_runs(a, b), strict=True) for k in range(n)]


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies print for bytes: printable Latin-1 as itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Both tokenizers, their tokens' bytes, and remembered stretches; one per worker process."""

    _open: dict[tuple[str, str], Pair] = {}

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        if any(" " in t.lstrip(b" ").decode("utf-8", "replace") for t in self.b_bytes):
            raise ValueError("a piece crosses the start of a word")
        if any(re.search(r"\n|[A-Za-zÀ-ÖØ-öø-ɏ][.,;:!?]", p) for p in pieces):
            raise ValueError("a piece crosses the end of a word")
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        # Ids as text with what follows them: A ids inside and at the end of a group, then B ids.
        names = [f"{i}{sign}".encode() for of, signs in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for sign in signs for i in range(len(of))]
        self.names, self.name_sizes = np.array(names, object), np.array([len(n) for n in names], np.int64)
        self.known: dict[str, tuple[bytes, bytes, int, int]] = {}
        self.before: dict[str, tuple[bytes, bytes, int, int]] = {}
        self.points = {}
        for point in ".,;:!?":
            i, j = self.a.token_to_id(point), self.b.piece_to_id(point)
            self.points[GLUED + point] = (f"{i}|{j}".encode(), np.array([i << 32 | j], np.int64).tobytes(), 1, 1)

    @classmethod
    def get(cls, a_path: str, b_path: str) -> Pair:
        mine = claim(cls)
        if (a_path, b_path) not in mine:
            mine[a_path, b_path] = cls(a_path, b_path)
        return mine[a_path, b_path]

    def pairs(self) -> np.ndarray:
        """Codes of all id pairs that can end together, ascending: one token's bytes must end the other's.

        That bounds them by the bytes of both vocabularies, whatever the corpus.
        """
        found: set[int] = set()
        by_a: dict[bytes, list[int]] = {}
        by_b: dict[bytes, list[int]] = {}
        for i, t in enumerate(self.a_bytes):
            by_a.setdefault(t, []).append(i)
        for i, t in enumerate(self.b_bytes):
            by_b.setdefault(t, []).append(i)
        for i, t in enumerate(self.a_bytes):
            found.update(i << 32 | j for k in range(len(t)) for j in by_b.get(t[k:], ()))
        for j, t in enumerate(self.b_bytes):
            found.update(i << 32 | j for k in range(len(t)) for i in by_a.get(t[k:], ()))
        return np.array(sorted(found), np.int64)

    def _fits(self, raw: bytes, ids_a: list[int], ids_b: list[int], ends: np.ndarray) -> bool:
        """Whether both tokenizers give ``raw`` back, with a token's end at each of the ``ends``."""
        if not raw == b"".join(map(self.a_bytes.__getitem__, ids_a)) == b"".join(map(self.b_bytes.__getitem__, ids_b)):
            return False
        return all(np.isin(ends, np.cumsum(sizes[ids])).all() for sizes, ids in ((self.a_sizes, ids_a), (self.b_sizes, ids_b)))

    def _results(self, parts: list[str], plain: bool = False) -> list[tuple[bytes, bytes, int, int]]:
        """For each stretch: groups as text, codes of its links, numbers of tokens.

        ``LOST`` for a stretch that a tokenizer doesn't give back. ``plain``: the sign ``GLUED`` is a text's own.
        """
        parts = list(parts)
        glued = [not plain and p[:1] == GLUED for p in parts]
        single = [plain or p[:1].isspace() or p[-1:].isspace() for p in parts]
        order = sorted((k for k, x in enumerate(single) if not x), key=glued.__getitem__)
        units = [order[at : at + JOINED] for at in range(0, len(order), JOINED)]
        for unit in units:
            if glued[unit[0]]:  # it follows a word, as any
                unit.insert(0, len(parts))
                parts.append("a")
                glued.append(False)
        units += [[k] for k, x in enumerate(single) if x]
        out: list = [LOST] * len(parts)
        while units:
            lost = self._align(units, parts, glued, out)
            units = [[k] for unit in lost if len(unit) > 1 for k in unit]
        return out[: len(single)]

    def _align(self, units: list[list[int]], parts: list[str], glued: list[bool], out: list) -> list[list[int]]:
        """Put the results of the stretches into ``out``, each unit encoded as one text; the units that get lost.

        All are aligned in one go: their ends are laid behind each other, so that a stretch's end is a shared one.
        """
        texts = ["".join(parts[k][1:] if glued[k] else " " + parts[k] for k in unit) for unit in units]
        of_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        alone = [glued[unit[0]] for unit in units]
        of_b = self.b.encode([t if g else t[1:] for t, g in zip(texts, alone, strict=True)], num_threads=1)
        of_b = [ids[1:] if g else ids for ids, g in zip(of_b, alone, strict=True)]  # without the space that the model puts in front
        raw = [t.encode() for t in texts]
        sizes = [[len(parts[k].encode()) + (1 - len((" " + GLUED).encode()) if glued[k] else 1) for k in unit] for unit in units]
        join = chain.from_iterable
        ends = np.cumsum(list(join(sizes)))
        lost: list[list[int]] = []
        if not self._fits(b"".join(raw), list(join(of_a)), list(join(of_b)), ends):
            fine = [self._fits(*x[:3], np.cumsum(x[3])) for x in zip(raw, of_a, of_b, sizes, strict=True)]
            lost = [unit for unit, x in zip(units, fine, strict=True) if not x]
            units, of_a, of_b, sizes = ([v for v, x in zip(of, fine, strict=True) if x] for of in (units, of_a, of_b, sizes))
            ends = np.cumsum(list(join(sizes)), dtype=np.int64)
        a, b = np.fromiter(join(of_a), np.int64), np.fromiter(join(of_b), np.int64)
        ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        of_i, of_j, lengths = (np.array(x, np.int64) for x in diagonal_runs(ends_a.tolist(), ends_b.tolist()))
        step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        i, j = np.repeat(of_i, lengths) + step, np.repeat(of_j, lengths) + step
        codes = (a[i] << 32 | b[j]).tobytes()
        # Groups as text: the A ids of a group, then its B ids.
        name = np.empty(len(a) + len(b), np.int64)
        of_group = np.searchsorted(i, np.arange(len(a)))
        name[np.arange(len(a)) + np.concatenate([[0], j + 1])[of_group]] = a + len(self.a_bytes) * (i[of_group] == np.arange(len(a)))
        of_group = np.searchsorted(j, np.arange(len(b)))
        name[np.arange(len(b)) + i[of_group] + 1] = b + 2 * len(self.a_bytes) + len(self.b_bytes) * (j[of_group] == np.arange(len(b)))
        groups = b"".join(self.names[name].tolist())
        n_a, n_b = np.searchsorted(ends_a, ends, "right"), np.searchsorted(ends_b, ends, "right")
        place = np.concatenate([[0], np.cumsum(self.name_sizes[name])])[n_a + n_b].tolist()
        last = np.searchsorted(i, n_a).tolist()  # groups that begin before a stretch's end
        n_a, n_b = np.diff(n_a, prepend=0).tolist(), np.diff(n_b, prepend=0).tolist()
        first = start = 0
        for k, end, stop, of_a_k, of_b_k in zip(join(units), last, place, n_a, n_b, strict=True):
            out[k] = (groups[start : stop - 1], codes[8 * first : 8 * end], of_a_k, of_b_k)
            first, start = end, stop
        return lost

    def _learn(self, own: list[str], found: list) -> None:
        """Fill the gaps of ``found``, from the older generation or by encoding; the newer one becomes the older when full."""
        gaps = [k for k, x in enumerate(found) if x is None]
        missing = {own[k] for k in gaps}
        here = {p: self.points.get(p) or self.before.get(p) for p in missing}
        new = [p for p, x in here.items() if x is None]
        if new:
            here.update(zip(new, self._results(new), strict=True))
        for k in gaps:
            found[k] = here[own[k]]
        if len(self.known) > CACHE:
            self.before, self.known = self.known, {}
        self.known.update((p, x) for p, x in here.items() if len(p) <= CACHED_CHARS)

    def document(self, text: str) -> tuple[int, int, str, bytes]:
        """Numbers of tokens, digest of the groups and codes of the links; all empty if a tokenizer loses something."""
        if GLUED in text:  # a text that holds the sign itself is one stretch
            return _joined([self._results([text], plain=True)])
        stretches = stretches_of(text) if text else []
        return _joined(self._found(stretches[at : at + PART]) for at in range(0, len(stretches), PART))

    def documents(self, texts: Iterable[str | None]) -> Iterator[tuple[int, int, str, bytes]]:
        """``document`` of every text, those of some ``TOGETHER`` characters looked up together; null counts as empty."""
        some: list[str] = []
        size = 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1])
            if size > TOGETHER:
                yield from self._group(some)
                some, size = [], 0
        yield from self._group(some)

    def _group(self, texts: list[str]) -> Iterator[tuple[int, int, str, bytes]]:
        apart = [not t or len(t) > TOGETHER or GLUED in t for t in texts]
        lists = [[] if x else stretches_of(t) for t, x in zip(texts, apart, strict=True)]
        found = self._found(list(chain.from_iterable(lists)))
        at = 0
        for text, own, x in zip(texts, lists, apart, strict=True):
            yield self.document(text) if x else _joined([found[at : at + len(own)]])
            at += len(own)

    def _found(self, own: list[str]) -> list[tuple[bytes, bytes, int, int]]:
        found = list(map(self.known.get, own))
        if None in found:
            self._learn(own, found)
        return found


def _joined(parts: Iterable[list[tuple[bytes, bytes, int, int]]]) -> tuple[int, int, str, bytes]:
    """The results of a text's stretches as one, a part of them at a time; without any, or with a lost one, all empty."""
    n_a = n_b = 0
    digest, links, joint = hashlib.sha256(), [], b""
    for found in parts:
        groups, codes, of_a, of_b = zip(*found, strict=True)
        if min(of_a) < 0:
            return 0, 0, "", b""
        digest.update(joint + b";".join(groups))
        joint = b";"
        links.append(b"".join(codes))
        n_a, n_b = n_a + sum(of_a), n_b + sum(of_b)
    return n_a, n_b, digest.hexdigest() if links else "", b"".join(links)


_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for each row of ``docs``: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256`` and ``links``.

    ``links`` holds a little-endian long for each link: the A id above 32 bits, the B id below.
    """
    require(docs, "doc_id", "text")
    with_workers(docs)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair.get(a_path, b_path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at, rows, size = 0, [], 0
            for k, (n_a, n_b, digest, links) in enumerate(pair.documents(t.as_py() for t in texts), 1):
                n = len(links) // 8
                rows.append((n_a, n_b, n, n, digest, links))
                size += len(links)
                if size > 1 << 25 or k == len(texts):  # bounded by bytes, not rows
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([ids.slice(at, len(rows)), *columns], _NAMES)
                    at, rows, size = k, [], 0

    longs = [T.StructField(n, T.LongType()) for n in _NAMES[1:5]]
    kind = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *longs, T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType())])
    return docs.select("doc_id", "text").mapInArrow(align, kind)


def link_counts(links: DataFrame) -> DataFrame:
    """``code``, ``n``: links of every id pair over the whole corpus; each task sends every pair once."""
    with_workers(links)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            for some in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                new, n = np.unique(np.frombuffer(b"".join(some.column(0).to_pylist()), np.int64), return_counts=True)
                every, inverse = np.unique(np.concatenate([codes, new]), return_inverse=True)
                codes, counts = every, np.bincount(inverse, np.concatenate([counts, n]), len(every)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])

    return links.select("links").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, folder: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: how the tokens of two vocabularies correspond, and how usual its links are.

    ``a_path``: a byte-level vocabulary, which encodes a space and the text; ``b_path``: a piece model that adds the
    space itself. ``n_a``, ``n_b`` tokens; ``n_groups``: stretches between offsets where both end a token; ``n_links``:
    token pairs that end together; ``n_best``: links whose pair is the most frequent one of their B id over the corpus,
    ties included; ``count_sum``: the corpus-wide numbers of the links' pairs, added up; ``groups_sha256``; ``links``.

    Null and empty texts, and texts that a tokenizer doesn't give back byte for byte, have no tokens: zeros and an
    empty digest. Repeated rows count again and stay repeated; rows without id are kept. Very long texts are taken whole,
    a stretch without spaces as one. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or shared_root(spark)
    rows = written(aligned(docs, a_path, b_path), folder, "aligned")
    counted = written(link_counts(rows), folder, "pairs")
    # Bounded by the vocabularies: one token's bytes end the other's (``Pair.pairs``).
    table = counted.orderBy("code").toPandas()
    codes, counts = table["code"].to_numpy(np.int64), table["n"].to_numpy(np.int64)
    of_b = codes & 0xFFFFFFFF
    highest = np.zeros(int(of_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, of_b, counts)
    best = counts == highest[of_b]
    shared = spark.sparkContext.broadcast((codes, counts, best))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = shared.value
        for batch in batches:
            n_best, sums = [], []
            for links in batch.column("links"):
                at = np.searchsorted(codes, np.frombuffer(links.as_buffer() or b"", np.int64))
                n_best.append(int(best[at].sum()))
                sums.append(int(counts[at].sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n_best, pa.int64()), pa.array(sums, pa.int64())], [*_NAMES, "n_best", "count_sum"]
            )

    kind = T.StructType([*rows.schema.fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return rows.mapInArrow(weigh, kind)
