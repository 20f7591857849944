"""A text of nothing but digits: the decoder holds a window of scores, and chooses what the whole lattice would."""

import tracemalloc

import pytest
from lexipress.llm import pii


@pytest.mark.parametrize("text", ["1 " * 400, "12-34 " * 200, "a1@b.c " * 150, "1.2.3.4 " * 100, "+1 (2) " * 150, "call (415) 555-0134 or 4111 1111 1111 1111 " * 20])
def test_streamed_decoding_equals_the_lattice(text):
    field = pii.trained()
    tokens, segments = pii.lattice(text, 0, len(text), [])
    assert field.decode_from(len(tokens), lambda i: pii.starting(text, tokens, i, [])) == field.decode(len(tokens), segments)


def test_memory_of_digits_is_in_proportion():
    field = pii.trained()
    pii.find_spans("1 " * 50, field)
    tracemalloc.start()
    pii.find_spans("1 " * 4000, field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4000 * 250  # a megabyte of digits stays far below the memory of an executor


def test_long_texts_through_spark(spark):
    rows = [(1, "9" * 300_000), (2, "x" * 300_000 + " +1 415 555 0134"), (3, None), (4, "1 " * 1500)]
    found = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[2]["n_phone"] == 1 and found[1]["n_card"] == found[3]["n_card"] == 0 and len(found) == 4
