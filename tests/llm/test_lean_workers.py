"""A Python worker does not hold the encoder while it works for other stages."""

import public_tokenizers
import pyarrow as pa

from rivernet.llm.bpe_automaton import bpe_round_trip, load
from rivernet.llm.common import lean, ship


def test_encoder_is_let_go_by_other_stages(spark):
    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([load.cache_info().currsize] * batch.num_rows, pa.int64())], ["n"])

    ship(spark)
    docs = spark.range(0, 8, 1, 4).selectExpr("id AS doc_id", "concat('text number ', id) AS text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert bpe_round_trip(docs, path).where("n_tokens > 0").count() == 8
    same = {r["n"] for r in docs.mapInArrow(lean(held, load), "n bigint").collect()}
    assert 1 in same  # tasks of its own kind find it
    assert bpe_round_trip(docs, path).where("n_tokens > 0").count() == 8
    assert {r["n"] for r in docs.mapInArrow(lean(held), "n bigint").collect()} == {0}
