"""Nulls, empty texts, repeated rows, clashing columns and empty tables."""

import public_tokenizers
import pytest

from stopwise.llm import fertility, line_runs, packing, queries, simhash, viterbi

DDL = "doc_id long, text string, kept string, fp long, row string, pieces string"
ROWS = [
    (1, None, "x", 1, "r", "p"), (2, "", "x", 1, "r", "p"), (3, "One line\n same ", None, None, None, None),
    (3, "One line\n same ", None, None, None, None), (None, "a b c", "x", 1, "r", "p"), (5, " \t\n", "x", 1, "r", "p"),
]


OPERATORS = {
    "lines": lambda d: line_runs.dedup_lines(d, min_docs=2),
    "simhash": simhash.near_duplicates,
    "quality": lambda d: fertility.rate(d, queries.fertility_config()),
    "packing": lambda d: packing.pack(d, public_tokenizers.path(queries.WORDS)),
    "sentencepiece": lambda d: viterbi.encode_documents(d.drop("pieces"), public_tokenizers.path(queries.PIECES)),
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("table", [ROWS, []], ids=["odd", "empty"])
def test_one_row_each(spark, name, table):
    got = OPERATORS[name](spark.createDataFrame(table, DDL)).collect()
    assert len(got) == len(table)


def test_lines_of_two_documents_go(spark):
    got = {(r.doc_id, r.kept, r.n_lines, r.n_dropped) for r in OPERATORS["lines"](spark.createDataFrame(ROWS, DDL)).collect()}
    assert (3, "", 2, 2) in got and (1, "", 1, 0) in got and (None, "a b c", 1, 0) in got


def test_texts_without_words_are_linked(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in OPERATORS["simhash"](spark.createDataFrame(ROWS, DDL)).collect()}
    assert got[1] == got[2] == got[5] == ("0" * 16, 1)
