"""The line stage of the pipeline."""

import corpus_pipeline
from llm.conftest import prose


def stage(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, "").collect()}


def test_short_lines_and_lines_without_spaces(spark):
    own = [prose(600 + i, 9, 99) for i in range(24)]
    common = "All  rights reserved.\n版权所有本站内容未经许可不得转载\nPage 12 of 40"
    texts = [f"{common}\n{t}\nNote number {i}\n{{\n17 4\n" for i, t in enumerate(own)] + ["All rights\nreserved.", "Rare words here\n" * 30]
    out = stage(spark, texts)
    assert out[0] == texts[0] and out[24] == texts[24] and out[25] == texts[25]
    assert all(out[i] == f"{own[i]}\nNote number {i}\n{{\n17 4\n" for i in range(1, 24))


def test_rows_of_numbers_stay(spark):
    rows = ["\n".join(f"{1990 + i} {i * j} {j}.5 {i + j} 1,{i:03} {j * 7}" for j in range(1, 5)) for i in range(30)]
    texts = [f"{r}\nOrder {i} shipped to the {i % 4}-a depot on day {i}" for i, r in enumerate(rows)]
    out = stage(spark, texts)
    assert out[0] == texts[0] and all(out[i] == rows[i] for i in range(1, 30))
