"""Every word of a window counts in proximity matches, however common."""

from __future__ import annotations

from rivernet.llm import decontaminate


def test_one_rare_word_and_common_ones(spark):
    common = "the of and in to is " * 12
    rows = [(1, "the rare of and in to"), (2, "rare is is is " + common), (3, "the x rare of and y in to"), (4, "rare"), (5, common),
            (6, "of and in to the rare"), (7, "rare the the of and to to"), (8, common + "the rare x of and in to the")]
    source = decontaminate.training_texts(spark.createDataFrame(rows, "doc_id int, text string"))
    windows = decontaminate.benchmark_windows(spark.createDataFrame(
        [(9, "the rare of and in to")], "item_id int, text string"), 10)
    near = decontaminate.proximity_matches(source, windows, within=2).join(source, "row").select("doc_id").distinct()
    assert {r[0] for r in near.collect()} == {1, 3, 8}


def test_a_word_that_is_twice_in_the_phrase_is_twice_in_the_text(spark):
    rows = [(1, "no no yes"), (2, "no x yes"), (3, "no x no yes")]
    source = decontaminate.training_texts(spark.createDataFrame(rows, "doc_id int, text string"))
    windows = decontaminate.benchmark_windows(spark.createDataFrame([(9, "no no yes")], "item_id int, text string"), 10)
    near = decontaminate.proximity_matches(source, windows, within=2).join(source, "row").select("doc_id").distinct()
    assert {r[0] for r in near.collect()} == {1, 3}
