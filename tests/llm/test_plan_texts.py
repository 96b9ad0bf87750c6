"""The rank map is not written out in the plan texts the driver keeps."""

import public_tokenizers
import pytest

from eventloom.llm import byte_bpe
from eventloom.session import short_plan_texts

LENGTH = "spark.sql.maxPlanStringLength"


def test_encoding_writes_short_plan_texts(spark):
    jvm = spark._jsparkSession.sharedState().statusStore()
    before = jvm.executionsCount()
    rows = spark.createDataFrame([(1, "the cat sat")], "doc_id long, text string")
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    byte_bpe.encode(rows, ranks, public_tokenizers.PATTERN, {"doc_id": rows.doc_id})
    made = jvm.executionsList()
    texts = [made.apply(i).physicalPlanDescription() for i in range(before, made.size())]
    assert texts and max(map(len, texts)) < 50_000


def test_setting_is_restored(spark):
    before = spark.conf.get(LENGTH)
    with pytest.raises(ValueError), short_plan_texts(spark, 100):
        assert spark.conf.get(LENGTH) == "100"
        raise ValueError
    assert spark.conf.get(LENGTH) == before
