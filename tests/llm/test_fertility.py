"""The bands of the quality rules against a plain version over the measures."""

from collections import defaultdict

import numpy as np

from stopwise.llm import fertility, queries

SMALL = "/root/testdata/sf0.001"
MEASURES = {"chars_per_token": "chars", "byte_share": "share", "token_entropy": "entropy"}


def plain_failed(rows, cfg):
    """By place: names of the measures outside the band of the row's language (or script) and octave of tokens."""
    groups = defaultdict(list)
    key = lambda r: ((r.lang or "").strip(" ") or "script " + r.script, int(np.log2(max(r.n_tokens, 1))))
    for r in rows:
        if r.n_tokens and not r.base_failed:
            groups[key(r)].append(r)
    out = []
    for r in rows:
        own, bad = groups.get(key(r), []), []
        for name, kind in MEASURES.items():
            if not own or not r.n_tokens:
                continue
            low, mid, high = np.percentile([round(x[name] * 1000) for x in own], [25, 50, 75]) / 1000
            half = cfg.width * max(high - low, getattr(cfg, f"floor_{kind}")) + getattr(cfg, f"slack_{kind}") / np.sqrt(r.n_tokens)
            half *= 1 + cfg.few / len(own)
            away = r[name] - mid
            if -away > half or away > half * getattr(cfg, f"up_{kind}"):
                bad.append(name)
        out.append(bad)
    return out


def test_bands_by_a_plain_version(spark):
    cfg = queries.fertility_config()
    odd = spark.createDataFrame(
        [(-1, "q7 x9 " * 300, "en"), (-2, " ".join(f"w{i}" for i in range(25)), "en"), (-3, " ".join(f"一{chr(0x4E00 + i)}" for i in range(400)), "en"),
         (-4, " ".join(chr(0x1F300 + i) for i in range(60)), "en"), (-5, " ".join(f"only{i} one{i}" for i in range(30)), "xx")], "doc_id long, text string, lang string")
    docs = queries.table(spark, SMALL, "documents").select("doc_id", "text", "lang").unionByName(odd)
    rows = fertility.rate(docs, cfg).collect()
    expected = plain_failed(rows, cfg)
    assert [list(r.failed) for r in rows] == expected
    assert all(r.kept == (not r.base_failed and not bad) for r, bad in zip(rows, expected, strict=True))
    by_id = {r.doc_id: r for r in rows}
    assert "byte_share" in by_id[-4].failed or "chars_per_token" in by_id[-4].failed
    assert by_id[-5].kept  # alone in its group: the band is its own


def test_a_column_of_any_name_passes(spark):
    docs = spark.createDataFrame([(1, "some words", 7, 8, 9)], "doc_id long, text string, __m int, m int, grp int")
    row = fertility.rate(docs, queries.fertility_config()).first()
    assert (row["__m"], row.m, row.grp, row.base_failed) == (7, 8, 9, True)
