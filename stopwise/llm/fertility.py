"""Quality rules over tokeniser fertility.

A public vocabulary encodes the words of a text; characters per token, the share of byte-fallback tokens and the
entropy of the tokens are held against bands of the text's language (or script, where no language is given). The bands
are medians and quartile distances over all documents of the group, so they need no labels.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.common import SPACE, claim, require, shared_root, with_workers, written

#: Characters that count as symbols. Fixed value of the rule.
SYMBOLS = "#*$%&|<>"
SPAN = 8
#: Words with ids that a worker keeps, and the longest of them; beyond that it starts anew.
CACHE, CACHED_BYTES = 250_000, 48
#: Words of a text encoded at a time.
PART = 1 << 20


@dataclass(frozen=True)
class FertilityConfig:
    """``model``: path of a public vocabulary with byte fallback, readable on every worker.

    A band reaches ``width`` quartile distances, at least ``floor``, from the median, upwards ``up`` times as far,
    plus ``slack`` over the root of the number of tokens, as short texts scatter more. All of it is ``1 + few / n`` times
    as wide in a group of ``n`` documents, as its quartiles are less sure; every group and every text has a band.
    """

    model: str
    width: float = 4.0
    floor_chars: float = 0.02
    floor_share: float = 0.01
    floor_entropy: float = 0.6
    slack_chars: float = 7.0
    slack_share: float = 2.0
    slack_entropy: float = 0.0
    up_chars: float = 1.0
    up_share: float = 1.0
    up_entropy: float = 2.5
    few: float = 8.0
    min_words: int = 20
    most_repeated: int = 30


class Vocabulary:
    """Words to token ids with a bounded cache, one per worker process."""

    _open: dict[str, Vocabulary] = {}

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(n)])
        self.known: dict[bytes, bytes] = {}

    @classmethod
    def get(cls, path: str) -> Vocabulary:
        mine = claim(cls)
        if path not in mine:
            mine[path] = cls(path)
        return mine[path]

    def encode(self, words: list[bytes]) -> np.ndarray:
        """Ids of the words, each encoded on its own with a word-start mark."""
        new = [w for w in set(words) if w not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = list(set(words))
        extra: dict[bytes, bytes] = {}
        lists = self.model.encode([w.decode() for w in new], num_threads=1)
        flat = np.fromiter(chain.from_iterable(lists), "<i4").tobytes()
        start = 0
        for word, ids in zip(new, lists, strict=True):
            end = start + 4 * len(ids)
            (self.known if len(word) <= CACHED_BYTES else extra)[word] = flat[start:end]
            start = end
        known = self.known if not extra else {**{w: self.known[w] for w in set(words) if w in self.known}, **extra}
        return np.frombuffer(b"".join(map(known.__getitem__, words)), "<i4")


def repeated_words(words: list[bytes], span: int = SPAN) -> int:
    """Words inside windows of ``span`` words that occur at least twice.

    Windows are compared exactly: numbers of words are doubled to numbers of pairs, fours and eights.
    """
    n = len(words) - span + 1
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(set(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    size = 1
    while size < span:
        if ids.max() == len(ids) - 1 and size > 1:  # all different already
            return 0
        ids = np.unique(ids[:-size] * (ids.max() + 1) + ids[size:], return_inverse=True)[1]
        size *= 2
    twice = np.bincount(ids)[ids] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + span, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    seen: set[str] = set()
    count = 0
    for line in text.split("\n"):
        if line.encode().strip():
            count += line in seen
            seen.add(line)
    return count


_FIELDS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "n_tokens": "long", "chars_per_token": "double", "byte_share": "double", "token_entropy": "double", "script": "string",
}


def measure(text: str | None, vocabulary: Vocabulary) -> tuple:
    """The values of ``_FIELDS`` for a text. Ratios of texts without tokens are null."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # ASCII white space
    chars = len(text) - sum(map(text.count, SPACE))
    counts: np.ndarray = np.zeros(0, np.int64)
    for at in range(0, len(words), PART):
        got = np.bincount(vocabulary.encode(words[at : at + PART]), minlength=len(vocabulary.is_byte))
        counts = got if not len(counts) else counts + got
    tokens = int(counts.sum())
    share = counts[counts > 0] / tokens if tokens else counts
    return (
        len(words), chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeated_words(words), tokens,
        chars / tokens if tokens else None,
        float(counts[vocabulary.is_byte].sum() / tokens) if tokens else None,
        float(-(share * np.log2(share)).sum()) + 0.0 if tokens else None,
        script(text),
    )


_SCRIPTS: dict[str, str] = {}


def script(text: str) -> str:
    """The commonest first word of the letters' Unicode names (``LATIN``, ``CYRILLIC`` …); ties by name, ``NONE`` without letters."""
    found: dict[str, int] = {}
    for letter in set(text):
        if letter.isalpha():
            if letter not in _SCRIPTS:
                _SCRIPTS[letter] = unicodedata.name(letter, "NONE").split()[0]
            name = _SCRIPTS[letter]
            found[name] = found.get(name, 0) + text.count(letter)
    return min(found, key=lambda k: (-found[k], k)) if found else "NONE"


def measures(text: Column, model: str) -> Column:
    spark_type = T.StructType().fromDDL(", ".join(f"{n} {t}" for n, t in _FIELDS.items()))
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    arrow = pa.struct([(n, kinds[t]) for n, t in _FIELDS.items()])

    @F.arrow_udf(spark_type)
    def fertility(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = Vocabulary.get(model)
        for texts in batches:
            rows = [measure(t.as_py(), vocabulary) for t in texts]
            columns = zip(*rows, strict=True) if rows else [[] for _ in _FIELDS]
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], fields=list(arrow))

    return fertility.asNondeterministic()(text)  # so that no filter evaluates it once more


#: Steps a unit of the binned values; medians and quartiles are exact on that grid.
GRID = 1000
_BANDED = {"chars_per_token": "chars", "byte_share": "share", "token_entropy": "entropy"}


def bands(measured: DataFrame, group: Column, cfg: FertilityConfig) -> DataFrame:
    """By ``grp`` and ``octave``: ``<m>_mid`` and ``<m>_iqr`` of each measure over all documents that pass the base rules, and their number ``<m>_n``.

    Values go to a fixed grid and are counted first, so what is gathered for a group is bounded by the grid.
    """
    told = measured.where((F.col("m.n_tokens") > 0) & ~base_failed("m", cfg))
    by = [group.alias("grp"), length_class().alias("octave")]
    out = None
    for name in _BANDED:
        bins = told.groupBy(*by, F.round(F.col(f"m.{name}") * GRID).cast("long").alias("bin")).count()
        quartiles = F.percentile("bin", F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75)]), F.col("count")).alias("q")
        q = bins.groupBy("grp", "octave").agg(quartiles, F.sum("count").alias(f"{name}_n"))
        mid, iqr = F.col("q")[1] / GRID, (F.col("q")[2] - F.col("q")[0]) / GRID
        part = q.select("grp", "octave", mid.alias(f"{name}_mid"), iqr.alias(f"{name}_iqr"), f"{name}_n")
        out = part if out is None else out.join(part, ["grp", "octave"])
    return out


def length_class() -> Column:
    """Texts are compared with those of the same octave of length: the entropy of tokens grows with their number."""
    return F.floor(F.log2(F.greatest(F.col("m.n_tokens"), F.lit(1)))).cast("int")


def base_failed(m: str, cfg: FertilityConfig) -> Column:
    n = F.col(f"{m}.n_words")
    return (n < cfg.min_words) | (100 * F.col(f"{m}.n_repeat_words") > cfg.most_repeated * n)


def outside(name: str, cfg: FertilityConfig) -> Column:
    """Whether a measure lies outside its group's band. Without tokens, or where all of the group fail the base rules, it doesn't."""
    kind = _BANDED[name]
    half = cfg.width * F.greatest(F.col(f"{name}_iqr"), F.lit(getattr(cfg, f"floor_{kind}")))
    half = half + getattr(cfg, f"slack_{kind}") / F.sqrt(F.greatest(F.col("m.n_tokens"), F.lit(1)))
    half = half * (1 + cfg.few / F.col(f"{name}_n"))
    away = F.col(f"m.{name}") - F.col(f"{name}_mid")
    off = (-away > half) | (away > half * getattr(cfg, f"up_{kind}"))
    return F.coalesce(off, F.lit(False))


def rate(docs: DataFrame, cfg: FertilityConfig, folder: str | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``failed`` (names of the measures outside their band) and ``kept``.

    The group of a text is its ``lang``, or its script where ``lang`` is null, blank or no column. Null and empty texts
    have no words, fail the base rules and are not kept. All rows count, repeated ones as often as they occur; an empty
    table gives an empty result; very long texts are measured whole, some words at a time; a value on a band's edge is
    inside. Other columns are passed on, those named like a result are replaced.
    """
    require(docs, "text")
    with_workers(docs)
    spark = docs.sparkSession
    results = [*_FIELDS, "base_failed", "failed", "kept"]
    base = docs.drop(*results)
    if not keep_text:
        base = base.select("doc_id", "text", *[c for c in ("lang",) if c in base.columns])
    folder = folder or shared_root(spark)
    columns = [c for c in base.columns if keep_text or c != "text"]
    raw = base.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("d"), measures(F.col("text"), cfg.model).alias("m"))
    measured = written(raw, folder, "measured")
    lang = F.nullif(F.trim(F.col("d.lang").cast("string")), F.lit("")) if "lang" in columns else F.lit(None).cast("string")
    group = F.coalesce(lang, F.concat(F.lit("script "), F.col("m.script")))
    told = written(bands(measured, group, cfg), folder, "bands")
    out = measured.withColumn("grp", group).withColumn("octave", length_class()).join(told, ["grp", "octave"], "left")
    failed = F.array_compact(F.array(*[F.when(outside(n, cfg), F.lit(n)) for n in _BANDED]))
    out = out.withColumn("bf", base_failed("m", cfg)).withColumn("ff", failed)
    return out.select(
        *[F.col(f"d.`{c}`").alias(c) for c in columns], *[F.col(f"m.{n}").alias(n) for n in _FIELDS],
        F.col("bf").alias("base_failed"), F.col("ff").alias("failed"), (~F.col("bf") & (F.size("ff") == 0)).alias("kept"),
    )
