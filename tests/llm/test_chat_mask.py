"""The digests of the loss are read through the mask."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidehouse.llm import chat


def test_shifted_mask_shows_in_the_digest(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "a</s>\\b😀"), (1, 2, "assistant", "c")],
                                  "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(turns.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("content")))
    right = chat.digests(made).first()
    want = F.sha2(F.lit("a</s>\\b😀c").cast("binary"), 256)
    assert (right.loss_chars, right.loss_sha256) == (9, spark.range(1).select(want).first()[0])
    shifted = F.transform("loss_spans", lambda s: s.withField("start", s["start"] + 1))
    assert chat.digests(made.withColumn("loss_spans", shifted)).first().loss_sha256 != right.loss_sha256
