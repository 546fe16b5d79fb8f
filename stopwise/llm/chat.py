"""Chat formatting by token-level assembly.

Every text is encoded on its own, so no control token can arise from content, and reserved ids are spliced in between.
The loss mask is the prefix sum of +1 where an assistant's text starts and -1 where it ends. Control strings occurring
in content are escaped, so the decoded text is as unambiguous as the ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.common import claim, require, with_workers

#: Control strings and their reserved ids, above the vocabulary's. The template: a user's turn between ``[INST]`` and
#: ``[/INST]``, a system's between ``<<SYS>>`` and ``<</SYS>>``, an assistant's between ``<s>`` and ``</s>``; any other
#: role between ``<role>`` and ``</role>``, followed by its text up to ``</s>``.
CONTROL = {"<s>": 50300, "</s>": 50301, "[INST]": 50302, "[/INST]": 50303, "<<SYS>>": 50304, "<</SYS>>": 50305, "<role>": 50306, "</role>": 50307}
TURNS = {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": ("<s>", "</s>")}
ESCAPE = "\\"
_RAW = re.compile("|".join(f"({re.escape(c[0])})({re.escape(ESCAPE)}*)({re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile("|".join(f"({re.escape(c[0])})({re.escape(ESCAPE)}+)({re.escape(c[1:])})" for c in CONTROL))


def escape(text: str) -> str:
    """Put one more mark behind the first character of each control string, marked or not."""
    return _RAW.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


class Codec:
    """Byte-level ids of ordinary text, and back; one per worker process."""

    _open: dict[str, Codec] = {}

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.model = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.names = {v: k for k, v in CONTROL.items()}

    @classmethod
    def get(cls, path: str) -> Codec:
        mine = claim(cls)
        if path not in mine:
            mine[path] = cls(path)
        return mine[path]

    def encode(self, text: str) -> list[int]:
        return self.model.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return self.model.decode_bytes(ids).decode()


def turn_tokens(role: str, text: str, codec: Codec) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of a turn."""
    body = codec.encode(escape(text))
    if role in TURNS:
        start, end = TURNS[role]
        head = [CONTROL[start]]
    else:
        head, end = [CONTROL["<role>"], *codec.encode(escape(role)), CONTROL["</role>"]], "</s>"
    ids = np.array([*head, *body, CONTROL[end]], np.int32)
    edges = np.zeros(len(ids) + 1, np.int8)
    if role == "assistant":
        edges[len(head)] += 1
        edges[len(head) + len(body)] -= 1
    return ids, np.cumsum(edges[:-1], dtype=np.int8)


def format_turns(turns: DataFrame, vocabulary: str) -> DataFrame:
    """``conv_id``, ``turn``, ``place``, ``ids``, ``loss`` for every row of ``turns``; no shuffle.

    A conversation is its rows by turn; rows of one turn go by role and text, which ``place`` holds for sorting. Null
    roles and texts are empty; rows without ``conv_id`` are one conversation. Other columns are ignored.
    """
    require(turns, "conv_id", "turn", "role", "text")
    with_workers(turns)
    kind = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("place", pa.string()), ("ids", pa.list_(pa.int32())), ("loss", pa.list_(pa.int8()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.get(vocabulary)
        for batch in batches:
            rows = []
            for conv, turn, role, text in zip(*batch.columns, strict=True):
                role, text = role.as_py() or "", text.as_py() or ""
                ids, loss = turn_tokens(role, text, codec)
                place = role + "\0" + hashlib.sha256(text.encode()).hexdigest()
                rows.append((conv.as_py(), turn.as_py(), place, ids, loss))
            columns = list(zip(*rows, strict=True)) or [[] for _ in kind]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    plain = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return plain.mapInArrow(encode, "conv_id long, turn long, place string, ids array<int>, loss array<tinyint>")


def assemble(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``input_ids``, ``loss_mask``: one training row for each conversation (in one task: conversations are
    what a model reads at once; use ``read_back``'s order for streams of any length)."""
    rows = F.array_sort(F.collect_list(F.struct("turn", "place", "ids", "loss")))
    out = formatted.groupBy("conv_id").agg(rows.alias("r"))
    return out.select("conv_id", F.flatten("r.ids").alias("input_ids"), F.flatten("r.loss").alias("loss_mask"))


class _Reader:
    """Reads the ids of one conversation, turn by turn, and keeps digests only."""

    def __init__(self, codec: Codec) -> None:
        self.codec, self.turns, self.loss_chars, self.chars = codec, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.part: list[int] = []
        self.masked: list[int] = []
        self.opener, self.role = "", ""

    def feed(self, ids: list[int], mask: list[int]) -> None:
        closers = {start: end for start, end in TURNS.values()} | {"</role>": "</s>"}
        roles = {start: role for role, (start, _) in TURNS.items()}
        for token, lossy in zip(ids, mask, strict=True):
            name = self.codec.names.get(token)
            if name is None:
                self.part.append(token)
                if lossy:
                    self.masked.append(token)
                continue
            text = self._text(self.part)
            self.chars += len(text) + len(name)
            if self.masked:
                own = unescape(self.codec.decode(self.masked))
                self.loss.update(own.encode())
                self.loss_chars += len(own)
            self.part, self.masked = [], []
            if name == closers.get(self.opener):
                self.all.update(f"{self.role}\n{unescape(text)}\n".encode())
                self.turns, self.opener = self.turns + 1, ""
            elif name == "</role>" and self.opener == "<role>":
                self.opener, self.role = name, unescape(text)
            elif not self.opener and not text and (name in roles or name == "<role>"):
                self.opener, self.role = name, roles.get(name, "")
            else:
                raise ValueError(f"{name} doesn't fit behind {self.opener or 'the start of a turn'}")

    def _text(self, ids: list[int]) -> str:
        return self.codec.decode(ids) if ids else ""

    def row(self, conv: int | None) -> tuple:
        if self.opener or self.part:
            raise ValueError("a turn isn't closed")
        return conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_READ = {"conv_id": "long", "n_turns": "long", "turns_sha256": "string", "loss_chars": "long", "loss_sha256": "string", "formatted_chars": "long"}


def read_back(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """Parse the ids and masks of ``format_turns`` again, one row for each conversation.

    Sorted rows stream through a task that keeps digests only, so a conversation may have any number of turns.
    """
    kinds = {"long": pa.int64(), "string": pa.string()}
    kind = pa.schema([(n, kinds[t]) for n, t in _READ.items()])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, reader, current = Codec.get(vocabulary), None, None
        rows: list[tuple] = []
        for batch in batches:
            for conv, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ids", "loss")), strict=True):
                if reader is None or conv != current:
                    if reader is not None:
                        rows.append(reader.row(current))
                    reader, current = _Reader(codec), conv
                reader.feed(ids, mask)
            if rows:
                yield _batch(rows, kind)
                rows = []
        if reader is not None:
            yield _batch([reader.row(current)], kind)

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "place")
    return dealt.select("conv_id", "ids", "loss").mapInArrow(read, ", ".join(f"{n} {t}" for n, t in _READ.items()))


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)
