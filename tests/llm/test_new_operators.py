"""Alignment, collocations and the Jaccard join against plain versions; nulls, empty tables, repeats, ties, long texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from stopwise.llm import alignment, collocations, group_join, queries

SMALL = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(x) for x in (queries.BYTE_LEVEL, queries.PIECES))
DDL = "doc_id long, text string, lang string, n long, row string, phrase string, links string, root string, prefix string"


def table(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, lang, 1, "r", "p", "l", "x", "y") for d, t, lang in rows], DDL)


ODD = [(1, None, None), (2, "", "en"), (3, " \t\n ", "en"), (None, "a b c", "en"), (5, "a b c", "en"), (5, "a b c", "en"), (7, "word", None)]


# ---- alignment


@pytest.fixture(scope="module")
def codecs():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), alignment.Pair(A, B)


def plain_alignment(codecs, text):
    a, b, pair = codecs
    if not text:
        return 0, 0, [], ""
    x, y, raw = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
    of_x, of_y = [pair.a_bytes[i] for i in x], [pair.b_bytes[i] for i in y]
    if b"".join(of_x) != raw or b"".join(of_y) != raw:
        return 0, 0, [], ""
    place = {int(e): j for j, e in enumerate(np.cumsum([len(t) for t in of_y]))}
    links = [(i, place[int(e)]) for i, e in enumerate(np.cumsum([len(t) for t in of_x])) if int(e) in place]
    groups, i0, j0 = [], 0, 0
    for i, j in links:
        groups.append(",".join(map(str, x[i0 : i + 1])) + "|" + ",".join(map(str, y[j0 : j + 1])))
        i0, j0 = i + 1, j + 1
    return len(x), len(y), [(x[i], y[j]) for i, j in links], hashlib.sha256(";".join(groups).encode()).hexdigest()


def check_alignment(codecs, docs, got):
    plain = [(d, plain_alignment(codecs, t)) for d, t in docs]
    counts = Counter(link for _, (_, _, links, _) in plain for link in links)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    want = [
        (d, n_a, n_b, len(links), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for d, (n_a, n_b, links, digest) in plain
    ]
    key = lambda r: (r[0] is None, r)
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted((tuple(r[n] for n in names) for r in got), key=key) == sorted(want, key=key)


def test_alignment_query(spark, codecs):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SMALL, "documents").collect()]
    check_alignment(codecs, docs, queries.QUERIES["op11_cross_tokenizer_alignment"](spark, SMALL).collect())


def test_alignment_of_odd_texts(spark, codecs):
    pick = random.Random(3)
    letters = ["a", "word", " ", "  ", "\n", "\t", "é", "日本", "▁", "</s>", "<|endoftext|>", ".", "'s", "12", "　", "\x1c", "😀", "\r\n", "\ue000"]
    rows = [(k, "".join(pick.choices(letters, k=pick.randint(1, 25))), "x") for k in range(300)]
    rows += [(1000 + k, t, lang) for k, (_, t, lang) in enumerate(ODD)] + [(None, "no id", None), (3000, "\ue000.\ue000\n", "x"), (2000, "wordwithoutspaces" * 20_000, None)]
    got = alignment.align_documents(table(spark, rows), A, B).collect()
    check_alignment(codecs, [(d, t) for d, t, _ in rows], got)
    assert alignment.align_documents(table(spark, []), A, B).count() == 0


def test_shared_ends():
    pick = random.Random(5)
    for _ in range(500):
        a, b = (sorted({*pick.sample(range(1, 60), pick.randint(0, 40)), 60}) for _ in range(2))
        both = sorted({*a} & {*b})
        assert alignment.shared_ends(a, b) == [(a.index(x), b.index(x)) for x in both]
    assert alignment.shared_ends([], []) == []


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, inner):
        self.inner, self.texts = inner, 0

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        return self.inner.encode_batch_fast(texts, **more)


def test_new_stretches_are_encoded_together(codecs):
    """Few texts for a tokenizer, the same results; a stretch that one of them changes loses its own text only."""
    pick = random.Random(11)
    texts = [" ".join(f"{pick.choice(['', 'é', '日', '(', '<s>'])}w{pick.randint(0, 3000)}{pick.choice(['', '.', chr(10) + 'x', 's'])}" for _ in range(60)) for _ in range(120)]
    pair = alignment.Pair(A, B)
    pair.a = Counted(pair.a)
    got = list(pair.documents([*texts, None, ""]))
    stretches = {s for t in texts for s in alignment.stretches_of(t)}
    assert len(stretches) > 3000 and pair.a.texts < len(stretches) / 20
    texts += ["a\u2581b c", " lead", "\nline one\ntwo", "tail \t", "\ue000.", "\nx", "only", "w1 " * 400_000]
    texts = [*texts[100:], *texts[:100]]
    for t, (n_a, n_b, digest, links) in zip([*texts, ""], alignment.Pair(A, B).documents([*texts, None]), strict=True):
        a, b, pairs, want = plain_alignment(codecs, t)
        assert (n_a, n_b, digest, links) == (a, b, want, np.array([x << 32 | y for x, y in pairs], np.int64).tobytes())
    assert len(got) == 122 and got[-2:] == [(0, 0, "", b"")] * 2


def test_links_are_bounded_by_the_vocabularies(spark, codecs):
    possible = codecs[2].pairs()
    out = alignment.aligned(queries.table(spark, SMALL, "documents"), A, B)
    found = {r.code for r in alignment.link_counts(out).collect()}
    assert found <= set(possible.tolist()) and len(possible) < 400_000


# ---- collocations


def plain_phrases(rows, least=10, within=50, top=2000, longest=3):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        scored = []
        many = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in many.items():
            if any(len(q) > len(p) and 100 * b >= within * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in many.items()):
                continue
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            s, _, left, right = min(cuts)
            scored.append((-s, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def phrases(df):
    return sorted(tuple(r[n] for n in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def some_texts(seed, n):
    pick = random.Random(seed)
    words = ["the", "The", "of", "a", "b", "new", "york", "city", "é", "日本", "x\xa0y", "\x1f", "w" * 60]
    gaps = [" ", " ", " ", "\t", "  ", " \t ", ", ", ".", "\n", "\r\n", "! ", " ;x "]
    langs = [None, "en", "en", "fr", "a b", "a\nb", ""]
    return [(k, "".join(pick.choice(words) + pick.choice(gaps) for _ in range(pick.randint(0, 60))), pick.choice(langs)) for k in range(n)]


def test_phrases_against_a_plain_version(spark):
    rows = some_texts(1, 400) + ODD
    cfg = collocations.PhraseConfig()
    assert phrases(collocations.mine(table(spark, rows), cfg)) == plain_phrases(rows)


def test_phrases_of_many_tries_and_other_settings(spark):
    rows = some_texts(2, 300)
    cfg = collocations.PhraseConfig(longest=4, least=5, within=80, top=20, keys=50)
    assert phrases(collocations.mine(table(spark, rows), cfg)) == plain_phrases(rows, 5, 80, 20, 4)


def test_tries_of_a_pass_hold_ranges(spark, monkeypatch):
    """Few passes for many tries; parts stay bounded where many phrases begin alike, and lose none."""
    keys = [(lang, f"{first} {k}") for lang in ("en", "a\nb") for first in ("common begin", "zeta", "b") for k in range(100)]
    candidates = spark.createDataFrame([(a.encode(), b.encode()) for a, b in keys], "lang binary, phrase binary")
    out, n = collocations.dealt(candidates, 50)
    rows = out.collect()
    assert sorted((bytes(r.lang).decode(), bytes(r.phrase).decode()) for r in rows) == sorted(keys)
    sizes = Counter(r.part for r in rows)
    assert set(sizes) <= set(range(n)) and n <= 20 and max(sizes.values()) <= 90
    passes, counts = [], collocations.counts
    monkeypatch.setattr(collocations, "counts", lambda texts, parts: passes.append(1) or counts(texts, parts))
    words = [f"w{k}" for k in range(60)]
    texts = [(k, " ".join(words), "en") for k in range(10)]
    cfg = collocations.PhraseConfig(keys=12)
    assert phrases(collocations.mine(table(spark, texts), cfg)) == plain_phrases(texts)
    assert len(passes) <= 4


def test_passes_do_not_grow_with_the_tries(spark, monkeypatch):
    """The texts are read once for the words, once for each size of phrases and once for the windows, however many tries there are."""
    rows = some_texts(4, 300) + [(900 + k, "b c d e, c d e", lang) for k in range(12) for lang in ("a", "a\nb c", "a\nb c d")]
    passes, seen, kind = [], [], type(spark.range(0))
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: passes.append(self.columns) or plain(self, *a, **b))
    for keys in (200_000, 5):
        passes.clear()
        assert phrases(collocations.mine(table(spark, rows), collocations.PhraseConfig(keys=keys))) == plain_phrases(rows)
        seen.append(passes.count(["lang", "text"]))
    assert seen == [4, 4]


def test_windows_hold_every_possible_phrase():
    """A phrase occurs as often as windows begin with it."""
    rows = [(t, lang) for _, t, lang in some_texts(6, 60) if lang]
    words = collocations.Words([t.encode() for t, _ in rows], [lang.encode() for _, lang in rows])
    full = np.full(collocations.BITS // 8, 255, np.uint8)
    begun = Counter()
    for size, at, n in collocations.windows(words, [full] * 3):
        for lang, phrase, times in zip(words.lang[at], words.phrases(at, size), n, strict=True):
            for k in range(2, size + 1):
                begun[lang, k, b" ".join(phrase.split(b" ")[:k])] += times
    want = Counter()
    for size in (2, 3):
        fine = [i for i in range(len(words.start) - size + 1) if words.joined[i : i + size - 1].all()]
        want.update((words.lang[i], size, p) for i, p in zip(fine, words.phrases(np.array(fine), size), strict=True))
    assert begun == want


def test_equal_numbers_are_of_equal_words():
    pick = random.Random(7)
    every = [bytes(pick.choices(b"xy", k=pick.choice([1, 7, 8, 9, 16, 63, 64, 65, 200]))) for _ in range(60)]
    every += [w[:-1] + b"z" for w in every]
    words = collocations.Words([b" ".join(pick.choices(every, k=1000)) for _ in range(3)], [b"en", b"en", b"fr"])
    own = collocations.phrase_hashes(words.hashes(), collocations._lang_hashes(words), 1)
    spoken = [*zip(words.lang.tolist(), words.phrases(np.arange(len(words.start)), 1), strict=True)]
    assert len({*zip(words.ids(own).tolist(), spoken, strict=True)}) == len(set(spoken)) == len(set(words.ids(own).tolist()))
    for hashes in (own % np.uint64(16), own & np.uint64(0)):  # many words share one
        ids = words.ids(hashes).tolist()
        assert len({*zip(ids, spoken, strict=True)}) == len(set(ids)) > len(set(spoken))
        assert len(set(ids)) < len(ids)
        for size in (1, 2, 40):  # the numbers of 40 words don't fit 64 bits
            first = np.arange(len(spoken) - 39)
            at, n = collocations._distinct(words.ids(own), first, size)
            want = Counter(tuple(spoken[i : i + size]) for i in first)
            assert Counter({tuple(spoken[i : i + size]): k for i, k in zip(first[at], n, strict=True)}) == want and len(at) == len(want)


def test_tables_grow_with_the_phrases(spark):
    codes = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 5000)
    frame = spark.createDataFrame([(int(c),) for c in codes], "code long")
    for n, bits in ((5000, collocations.BITS), (collocations.BITS // 16, collocations.BITS * 2), (1 << 40, collocations.MOST_BITS)):
        table = collocations.bit_table(frame, n)
        assert 8 * len(table) == bits and collocations._holds(table, codes.view(np.uint64)).all()


def test_phrases_of_small_chunks_and_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(collocations, "STEP", 64)
    rows = some_texts(3, 40) + [(99, "new york city hall\t" * 50_000, "en")]
    assert phrases(collocations.mine(table(spark, rows))) == plain_phrases(rows)


def test_phrases_of_nothing(spark):
    assert collocations.mine(table(spark, [])).count() == 0
    assert collocations.mine(table(spark, ODD[:3])).count() == 0


def test_scores_are_exact(spark):
    a, left, right = 3_000_000_019, 3_000_000_021, 9_000_000_000_000_000
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations.score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert row.first().s == 10**6 * a * a // (left * right)


def test_trie_finds_its_keys_only():
    pick = random.Random(9)
    keys = sorted({bytes(pick.choices(b"abcdefgh \xc3\xa9", k=pick.randint(1, 12))) for _ in range(20_000)})
    trie = collocations.Trie(keys)
    for k in pick.sample(range(len(keys)), 500):
        assert trie.accept[trie.walk(keys[k])] == k
    known = set(keys)
    for _ in range(500):
        key = bytes(pick.choices(b"abcdefgh \xc3\xa9z", k=pick.randint(1, 12)))
        at = trie.walk(key)
        assert (at >= 0 and trie.accept[at] >= 0) == (key in known)


# ---- Jaccard join


def plain_sets(rows, words=3):
    out = []
    for d, text, _ in rows:
        split = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(words, len(split))
        out.append((d, {tuple(split[i : i + n]) for i in range(len(split) - n + 1)} if split else set()))
    return out


def plain_components(rows, percent=90, words=3):
    sets = plain_sets(rows, words)
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, s) in enumerate(sets):
        for j in range(i):
            t = sets[j][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                root[top(i)] = top(j)
    ids = defaultdict(list)
    for i, (d, s) in enumerate(sets):
        ids[top(i)].append(d)
    key = lambda r: tuple((x is None, x) for x in r)
    least = lambda i: min((d for d in ids[top(i)] if d is not None), default=None)
    return sorted(((d, len(s), least(i) if s else d) for i, (d, s) in enumerate(sets)), key=key)


def joined(df):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=key)


def near_copies(seed, n, size=60, least=0, most=4):
    """Copies of a few texts with some words changed: sets on both sides of the threshold."""
    pick = random.Random(seed)
    bases = [[f"w{pick.randint(0, 5000)}" for _ in range(size)] for _ in range(4)]
    rows = []
    for k in range(n):
        words = list(pick.choice(bases))
        for _ in range(pick.randint(least, most)):
            words[pick.randrange(size)] = f"W{pick.randint(0, 9000)}"
        rows.append((3 * k + 5, pick.choice([" ", "\n"]).join(words[: pick.choice([size, size, size - 1, 2])]), "x"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_join_against_a_plain_version(spark, seed):
    rows = near_copies(seed, 250) + ODD
    assert joined(group_join.similar_documents(table(spark, rows))) == plain_components(rows)


def test_join_in_blocks(spark, monkeypatch):
    """Lists and components far over their bounds give the same links."""
    monkeypatch.setattr(group_join, "LIST", 4)
    monkeypatch.setattr(group_join, "SHINGLES", 300)
    monkeypatch.setattr(group_join, "LEAST_SHARE", 3)
    rows = near_copies(3, 200, size=120, most=6) + [(k, "the very same text again and again", "x") for k in range(1000, 1040)]
    assert joined(group_join.similar_documents(table(spark, rows))) == plain_components(rows)


def test_join_of_groups_with_several_members(spark, monkeypatch):
    """With a sketch of one slot the order is that of the hashes, so different sets share whole prefixes."""
    monkeypatch.setattr(group_join, "SLOTS", 1 << 15)
    rows = near_copies(4, 150, size=400, most=3)
    assert joined(group_join.similar_documents(table(spark, rows))) == plain_components(rows)


def test_join_at_other_settings(spark):
    rows = near_copies(5, 150, most=12)
    got = group_join.similar_documents(table(spark, rows), group_join.JaccardConfig(words=2, percent=60))
    assert joined(got) == plain_components(rows, 60, 2)


def test_join_ties_at_the_threshold(spark):
    """Nine of ten shingles are enough, and of nineteen of twenty-one one more is needed."""
    words = [f"x{k}" for k in range(11)]
    rows = [(1, " ".join(words), "x"), (2, " ".join(words + ["y"]), "x"), (3, " ".join(words + ["y", "z"]), "x")]
    assert [len(s) for _, s in plain_sets(rows)] == [9, 10, 11]
    assert [r[2] for r in joined(group_join.similar_documents(table(spark, rows)))] == [1, 1, 1]


def test_join_of_nothing_and_long_texts(spark):
    assert group_join.similar_documents(table(spark, [])).count() == 0
    assert joined(group_join.similar_documents(table(spark, ODD[:3]))) == plain_components(ODD[:3])
    pick = random.Random(8)
    words = [f"v{pick.randint(0, 10**6)}" for _ in range(150_000)]
    rows = [(9, " ".join(words), "x"), (4, " ".join(words[500:]), "x"), (2, " ".join(words[: len(words) // 2]), "x")]
    assert joined(group_join.similar_documents(table(spark, rows))) == plain_components(rows)
