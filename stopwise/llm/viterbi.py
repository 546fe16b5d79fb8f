"""SentencePiece encoding and decoding with a batched numpy Viterbi.

The pieces of a public model are scored as a unigram model does. Text is cut where no piece can cross, before a word's
marks; words of equal length advance together, one position at a time: hashes of the substrings that end there probe
the sorted piece keys, and a vectorised maximum stores the backpointers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.common import claim, fresh, require, with_workers

MARK = "▁"
#: Added to the least score for characters that are no piece. Fixed value of the model's library.
UNKNOWN_PENALTY = -10.0
#: Words whose ids a worker keeps in each of two generations, the longest of them, and the characters that advance together.
CACHE, CACHED_CHARS, BATCH = 200_000, 48, 1 << 19
#: Words looked up together.
PART = 1 << 16
#: Stands where a text is cut; a character of private use. Texts that hold it are cut by pattern.
CUT = "\ue000"
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(44)


class Pieces:
    """Piece keys sorted by hash, with scores; one per worker process."""

    _open: dict[str, Pieces] = {}

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.bytes = [-1] * 256
        for i in range(n):
            if model.is_byte(i):
                self.bytes[int(self.text[i][3:5], 16)] = i
        self.byte_of = {i: b for b, i in enumerate(self.bytes) if i >= 0}
        self.unknown = model.unk_id()
        self.longest = max((len(self.text[i]) for i in plain), default=1)
        if any(MARK in self.text[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece crosses the start of a word")
        chars = np.zeros((len(plain), self.longest), np.uint32)
        for row, i in zip(chars, plain, strict=True):
            row[: len(self.text[i])] = np.frombuffer(self.text[i].encode("utf-32-le"), np.uint32)
        lengths = np.array([len(self.text[i]) for i in plain])
        keys = np.zeros(len(plain), np.uint64)
        for k in range(self.longest):
            keys = np.where(k < lengths, keys * _BASE + chars[:, k] + np.uint64(1), keys)
        keys ^= lengths.astype(np.uint64) << np.uint64(58)
        order = np.argsort(keys, kind="stable")
        self.keys, self.chars, self.ids = keys[order], chars[order], np.array(plain)[order]
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces have one hash")
        self.some = np.zeros(1 << (64 - int(_TOP)), bool)  # first bits of all keys
        self.some[self.keys >> _TOP] = True
        self.scores = np.array([model.get_score(int(i)) for i in self.ids])
        self.least = float(self.scores.min(initial=0.0)) + UNKNOWN_PENALTY
        self.powers = _BASE ** np.arange(self.longest + 1, dtype=np.uint64)
        #: What a piece decodes to, and where words may be cut.
        self.raw = [bytes([self.byte_of[i]]) if i in self.byte_of else t.encode() for i, t in enumerate(self.text)]
        apart = not any(re.search("[A-Za-zÀ-ÖØ-öø-ɏ][.,;:!?]", self.text[i]) for i in plain)
        self.point = re.compile(f"(?<=[A-Za-zÀ-ÖØ-öø-ɏ])([.,;:!?])(?={MARK}|\\Z)") if apart else None
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    @classmethod
    def get(cls, path: str) -> Pieces:
        mine = claim(cls)
        if path not in mine:
            mine[path] = cls(path)
        return mine[path]

    # ---- encoding

    def best_paths(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length ``n``, all advancing together."""
        n = len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), n)
        prefix = np.zeros((len(words), n + 1), np.uint64)
        for k in range(n):
            prefix[:, k + 1] = prefix[:, k] * _BASE + chars[:, k] + np.uint64(1)
        best = np.full((len(words), n + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((len(words), n + 1), np.int32)
        piece = np.full((len(words), n + 1), -1, np.int32)
        line = np.arange(len(words))
        for end in range(1, n + 1):
            reach = min(end, self.longest)
            sizes = np.arange(reach, 0, -1)  # the longest first: it wins ties
            starts = end - sizes
            keys = (prefix[:, end, None] - prefix[:, starts] * self.powers[sizes]) ^ (sizes.astype(np.uint64) << np.uint64(58))
            rows, cols = np.nonzero(self.some[keys >> _TOP])  # the others are no key
            own = keys[rows, cols]
            at = np.searchsorted(self.keys, own)
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == own
            rows, cols, at = rows[hit], cols[hit], at[hit]
            same = self._verified(chars, rows, starts[cols], sizes[cols], at)
            rows, cols, at = rows[same], cols[same], at[same]
            score = np.full(keys.shape, -np.inf)
            score[rows, cols] = best[rows, starts[cols]] + self.scores[at]
            found = np.full(keys.shape, -1, np.int32)
            found[rows, cols] = self.ids[at]
            lone = found[:, -1] < 0  # a character that is no piece by itself
            score[lone, -1] = best[lone, end - 1] + self.least
            pick = np.argmax(score, axis=1)
            best[:, end], back[:, end], piece[:, end] = score[line, pick], starts[pick], found[line, pick]
        return self._trace(words, back, piece)

    def _verified(self, chars, rows, starts, sizes, at) -> np.ndarray:
        """Whether substrings are the pieces their hashes found."""
        same = np.ones(len(rows), bool)
        for k in range(int(sizes.max(initial=0))):
            live = k < sizes
            same[live] &= chars[rows[live], starts[live] + k] == self.chars[at[live], k]
        return same

    def _trace(self, words: list[str], back: np.ndarray, piece: np.ndarray) -> list[bytes]:
        """The words' ids as little-endian 32-bit integers: all words go back together, a piece at a time."""
        n = len(words[0])
        end, line = np.full(len(words), n), np.arange(len(words))
        ids = np.full(piece.shape, -1, np.int32)  # a piece stands where it ends
        lone = np.zeros(len(words), bool)
        while len(line):
            found = piece[line, end]
            ids[line, end] = found
            lone[line[found < 0]] = True
            end = back[line, end]
            line, end = line[end > 0], end[end > 0]
        taken = ids >= 0
        flat, cuts = ids[taken].astype("<i4").tobytes(), (4 * np.cumsum(taken.sum(1))).tolist()
        out = [flat[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        for k in np.flatnonzero(lone).tolist():
            out[k] = self._with_fallback(words[k], back[k].tolist(), piece[k].tolist())
        return out

    def _with_fallback(self, word: str, starts: list[int], ids: list[int]) -> bytes:
        """The path of a word some of whose characters are no piece."""
        path: list[int] = []
        end = len(word)
        while end:
            path += [ids[end]] if ids[end] >= 0 else self._fallback(word[starts[end] : end])
            end = starts[end]
        return np.array(path[::-1], "<i4").tobytes()

    def _fallback(self, char: str) -> list[int]:
        found = [self.bytes[b] for b in reversed(char.encode())]
        return found if min(found) >= 0 else [self.unknown]

    def words(self, own: set[str]) -> dict[str, bytes]:
        """Ids of the words ``own``, among others; long words advance in batches of their own."""
        if len(self.known) > CACHE:
            self.before, self.known = self.known, {}
        missing = own.difference(self.known)
        here = {w: self.before[w] for w in missing if w in self.before}
        groups: dict[int, list[str]] = {}
        for w in missing:
            if w not in here:
                groups.setdefault(len(w), []).append(w)
        for n, group in groups.items():
            step = max(1, BATCH // (n * 16))
            for at in range(0, len(group), step):
                part = group[at : at + step]
                here.update(zip(part, self.best_paths(part), strict=True))
        self.known.update((w, ids) for w, ids in here.items() if len(w) <= CACHED_CHARS)
        if any(len(w) > CACHED_CHARS for w in missing):
            return {w: self.known[w] for w in own if w in self.known} | here
        return self.known

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts; the words of some of them advance together."""
        out: list[list[bytes]] = [[] for _ in texts]
        group: list[tuple[int, list[str]]] = []
        held = 0
        for k, text in enumerate(texts):
            words = self._split(text) if text else []
            for at in range(0, len(words), PART):
                group.append((k, words[at : at + PART]))
                held += len(group[-1][1])
                if held >= PART:
                    self._add(group, out)
                    group, held = [], 0
        self._add(group, out)
        return [np.frombuffer(b"".join(parts), "<i4") for parts in out]

    def _split(self, text: str) -> list[str]:
        """Words no piece crosses the ends of."""
        marked = MARK + text.replace(" ", MARK)
        if self.point is None or CUT in text or MARK * 2 in marked or marked[-1] == MARK:
            return _WORDS.findall(marked)
        # Each mark begins a word, and a closing point is one of its own.
        return self.point.sub(rf"{CUT}\1", marked).replace(MARK, CUT + MARK)[1:].split(CUT)

    def _add(self, group: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        table = self.words(set(chain.from_iterable(words for _, words in group)))
        for k, words in group:
            out[k].append(b"".join(map(table.__getitem__, words)))

    # ---- decoding

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: runs of byte pieces are UTF-8, the mark that encoding puts in front is dropped."""
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


_RESULT = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])


def encode_column(text: Column, model: str) -> Column:
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    @F.arrow_udf(_RESULT)
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = Pieces.get(model)
        for texts in batches:
            flat: list[np.ndarray] = []
            decoded: list[str] = []
            for at in range(0, len(texts), 256):
                own = vocabulary.encode([t or "" for t in texts.slice(at, 256).to_pylist()])
                flat += own
                decoded += map(vocabulary.decode, own)
            offsets = np.concatenate([[0], np.cumsum([len(ids) for ids in flat])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, np.concatenate([*flat, np.empty(0, "<i4")]))
            yield pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], fields=list(kind))

    return pieces.asNondeterministic()(text)


def encode_documents(docs: DataFrame, model: str, into: str = "pieces") -> DataFrame:
    """``docs`` with a struct ``into``: ``ids`` and ``decoded``, the text that the ids give back.

    Null and empty texts have no ids. The mark's own character decodes to a space, as spaces become marks; every other
    text comes back whole. Repeated rows and ties: of equal scores the path with the longer last piece wins. Other
    columns are passed on; one named like ``into`` is replaced.
    """
    require(docs, "text")
    with_workers(docs)
    out = fresh(docs.drop(into), "__pieces")
    return docs.drop(into).withColumn(out, encode_column(F.col("text"), model)).withColumnRenamed(out, into)
