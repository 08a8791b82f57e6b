"""The warm-up of the language model reads what a parallel filter wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivernet.llm import lm_score


def test_warm_up_reads_a_written_sample(spark, tmp_path, monkeypatch):
    rows = [(None if i % 3 == 0 else i, f"word{i} and more {i % 7}") for i in range(900)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6).write.parquet(f"{tmp_path}/documents")
    train = spark.read.parquet(f"{tmp_path}/documents")
    seen, train_one = [], lm_score._train

    def watched(data, *rest):
        seen.append(data)
        return train_one(data, *rest)
    monkeypatch.setattr(lm_score, "_train", watched)
    lex = lm_score.lexicon(lm_score.token_table(train), 20, 8, 100)
    lm_score.train_model(train, lex, warm_tokens=lex.n // 10)
    warm, whole = seen
    assert not set(warm.inputFiles()) & set(whole.inputFiles())
    assert warm.rdd.getNumPartitions() == 1
    # rows without an id are sampled like the others
    assert 0 < warm.count() < 200 and warm.where(F.col("text").rlike("word(0|3|6|9)")).count() < 100


def test_each_task_starts_from_the_shared_model(spark):
    """Tasks of one worker that read the same texts end with the same parameters."""
    parts = spark.range(0, 120, 1, 3).selectExpr("id AS doc_id", "concat('w', id % 40 % 5, ' then w', id % 40 % 3, ' on') AS text")
    lex = lm_score.lexicon(lm_score.token_table(parts), 20, 8, 100)
    got = lm_score._train(parts, lex, lm_score.LogBilinear(lex.frequency), 16, 0.1).collect()
    assert len(got) == 3 and len({(r["tokens"], bytes(r["next"]), bytes(r["given"])) for r in got}) == 1
