"""Every registered query against its SQL, or against a plain version of its rule."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
import xxhash

import corpus_pipeline
from stopwise.llm import queries

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in queries.table(spark, SMALL, "documents").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert not compare.differences(queries.QUERIES[name](spark, SMALL), compare.connect(SMALL), queries.ORACLES[name])


def fingerprint(text):
    words = WORD.findall(lower(text))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits):
    root = {d: d for d in prints}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {d: top(d) for d in ids}


def test_simhash(spark, texts):
    prints = {d: fingerprint(t) for d, t in texts.items()}
    named = components(prints, 3)
    got = rows(queries.QUERIES["op3_simhash"](spark, SMALL))
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == sorted((d, f"{prints[d]:016x}", named[d]) for d in texts)


def test_neighbours_recall_and_scores(spark):
    vectors = {r.vec_id: np.array(r[1], float) for r in queries.table(spark, SMALL, "embeddings").collect()}
    ids, matrix = np.array(list(vectors)), np.array(list(vectors.values()))
    found = defaultdict(list)
    for r in sorted(rows(queries.QUERIES["op4_projected_neighbours"](spark, SMALL)), key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append(r)
    hits = total = 0
    assert set(found) == {i for i in vectors if i % 100 == 0}
    for q, near in found.items():
        d = np.sqrt(((matrix - vectors[q]) ** 2).sum(1))
        best = [int(v) for x, v in sorted(zip(d, ids, strict=True)) if v != q][:10]
        assert [r["rank"] for r in near] == list(range(1, len(best) + 1)) and q not in {r["vec_id"] for r in near}
        assert [(r["score"], r["vec_id"]) for r in near] == sorted((r["score"], r["vec_id"]) for r in near)
        for r in near:
            assert math.isclose(r["score"], float(np.linalg.norm(vectors[r["vec_id"]] - vectors[q])), rel_tol=1e-9, abs_tol=1e-12)
        hits, total = hits + len(set(best) & {r["vec_id"] for r in near}), total + len(best)
    assert hits >= 0.9 * total


def base_columns(text):
    words, seen, repeated = WORD.findall(text), defaultdict(list), set()
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    for at in seen.values():
        if len(at) > 1:
            repeated.update(j for i in at for j in range(i, i + 8))
    lines = Counter(x for x in text.split("\n") if WORD.search(x))
    n, r = len(words), len(repeated)
    failed = n < 20 or 100 * r > 30 * n
    return n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), sum(c - 1 for c in lines.values()), r, failed


def test_quality_base_rules(spark, texts):
    for r in rows(queries.QUERIES["op5_quality_rules"](spark, SMALL)):
        want = base_columns(texts[r["doc_id"]])
        assert tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == want
        assert not (r["base_failed"] and r["kept"])


def test_chat_reads_back(spark):
    turns = defaultdict(list)
    for r in queries.table(spark, SMALL, "conversations").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: r for r in rows(queries.QUERIES["op6_chat_formatting"](spark, SMALL))}
    assert set(got) == set(turns)
    for conv, said in turns.items():
        said.sort()
        loss = "".join(t for _, role, t in said if role == "assistant")
        plain = "".join(f"{role}\n{t}\n" for _, role, t in said)
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(said), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def check_packing(got, texts):
    codec = tokenizers.Tokenizer.from_file(public_tokenizers.path(queries.WORDS))
    bins, want = defaultdict(list), []
    for d, t in texts.items():
        ids = [*codec.encode(t, add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((d, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(tuple(r[k] for k in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got) == sorted(want)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= math.ceil(sum(w[3] for w in want) / 4096 * 1.02) + 1


def test_packing(spark, texts):
    check_packing(rows(queries.QUERIES["op7_best_fit_packing"](spark, SMALL)), texts)


def test_sentencepiece(spark, texts):
    codec = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    for r in rows(queries.QUERIES["op8_sentencepiece"](spark, SMALL)):
        assert r["round_trip"] and r["n_ids"] == len(r["ids"])
        text = texts[r["doc_id"]]
        score = sum(codec.get_score(i) for i in r["ids"])
        assert score >= sum(codec.get_score(i) for i in codec.encode(text)) - 1e-3  # Viterbi is at least as good as the merges


def test_toxicity_held_out(spark):
    """On the next larger table: the smallest one has 19 held-out labels (17 right), too few for a share."""
    labels = {r.doc_id: bool(r.toxic) for r in queries.table(spark, LARGER, "labels").collect()}
    got = rows(queries.QUERIES["op9_toxicity"](spark, LARGER))
    assert sorted(r["doc_id"] for r in got) == sorted(r.doc_id for r in queries.table(spark, LARGER, "documents").collect())
    right = total = 0
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] in labels:
            right, total = right + (r["predicted"] == labels[r["doc_id"]]), total + 1
    print(right, total)
    assert right >= 0.95 * total


def test_warc_digest_is_sha1(spark):
    pages = {r.page_id: (r.html or "").encode() for r in queries.table(spark, SMALL, "pages").collect()}
    for r in rows(queries.QUERIES["op10_warc"](spark, SMALL)):
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(pages[r["page_id"]]).digest()).decode()


def test_licences(spark):
    got = rows(queries.QUERIES["op1_license_scans"](spark, SMALL))
    own = {r["path"]: r["license"] for r in got if r["source"] not in ("inherited", "none")}
    assert len(got) == len({r["doc_id"] for r in got}) and all((r["license"] is None) == (r["source"] == "none") for r in got)
    assert all(v is not None for v in own.values())


def test_pipeline_by_brute_force(spark, texts):
    """The first two stages by their queries' rules, the others by plain versions."""
    docs = queries.table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SMALL)
    kept = {r.doc_id: r.text or "" for r in docs.collect()}
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    seen = Counter(k for t in kept.values() for k in {key(x) for x in t.split("\n")})
    kept = {d: "\n".join(x for x in t.split("\n") if not key(x) or seen[key(x)] < 10) for d, t in kept.items()}
    named = components({d: fingerprint(t) for d, t in kept.items()}, 3)
    check_packing(rows(corpus_pipeline.run(spark, SMALL)), {d: t for d, t in kept.items() if named[d] == d})
