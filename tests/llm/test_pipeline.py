"""Each stage of the pipeline against what its operator says of the stage's own input."""

import corpus_pipeline
from keelmark.llm import decontamination, mixing, ranking, simhash


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark, folder, tmp_path):
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{n}")
        seen[n], docs = docs, spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            assert docs.columns == seen[n].columns
    after = [spark.read.parquet(f"{tmp_path}/{n}") for n in range(5)]
    labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    assert ids(after[0]) == ids(ranking.scores(seen[0], labels).where("predicted = 1"))
    assert ids(after[1]) == sorted({r["component_id"] for r in simhash.near_duplicates(seen[1]).collect()})
    leaked = set(ids(decontamination.contaminated(seen[2], items)))
    assert ids(after[2]) == [i for i in ids(seen[2]) if i not in leaked]
    assert ids(after[3]) == sorted(r["doc_id"] for r in mixing.mixed(seen[3]).collect() for _ in range(r["copies"]))
    assert ids(after[4]) == ids(after[3])


def test_rows_without_an_id_are_not_one_group(spark, folder):
    far, near = "lorem ipsum dolor sit amet consectetur", "one two three four five six seven eight"
    rows = [(None, far), (None, far), (None, near), (7, near), (3, near), (5, None), (4, "")]
    got = corpus_pipeline.single(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), folder).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(3, near), (4, ""), (None, far)], key=str)
