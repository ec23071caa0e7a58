import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tickloom.llm import bpe, common, credentials, decontam, langid, near_dedup
from tickloom.session import materialize


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """Documents before the first stage and after every stage."""
    made = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for _, stage in cp.STAGES:
        made.append(materialize(stage(spark, made[-1], sf_dir)))
    return made


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns_of_documents(steps):
    assert len(cp.STAGES) == 5
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_languages(steps):
    wordless = {r["doc_id"] for r in steps[0].collect() if not any(c.isalpha() for c in r["text"] or "")}
    assert ids(steps[0]) - ids(steps[1]) == wordless


def test_switched_texts_and_texts_without_labels_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    parts = [" ".join(docs.filter(F.col("lang") == lang).first()["text"].split()[:30]) for lang in ("de", "en", "es", "fr")]
    mixed = docs.limit(1).select(*[F.lit(10**9).cast("long").alias(c) if c == "doc_id" else F.lit(" ".join(parts)).alias(c)
                                   if c == "text" else F.col(c) for c in docs.columns])
    assert 10**9 in ids(cp.language(spark, docs.union(mixed), sf_dir))
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert cp.language(spark, unknown, sf_dir).count() == docs.filter(F.col("text").rlike(r"\p{L}")).count()


def test_one_document_of_each_group_stays(steps):
    found = near_dedup.near_duplicates(steps[1])
    assert ids(steps[2]) == ids(found.filter("kept")) and steps[2].count() == found.select("component_id").distinct().count()


def test_no_benchmark_passage_stays(spark, sf_dir, steps):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = {r["_id"] for r in decontam.contamination(steps[2], items).filter("contaminated").collect()}
    assert hit and ids(steps[3]) == ids(steps[2]) - hit


def test_no_credential_stays(steps):
    assert ids(steps[4]) == ids(steps[3])
    assert credentials.findings(steps[4]).filter("spans <> ''").count() == 0
    before, after = ({r["doc_id"]: r["text"] for r in s.collect()} for s in steps[3:5])
    assert all(after[i] == before[i] or "[credential]" in after[i] for i in before)
    assert steps[4].filter(F.col("n_chars") != F.length("text")).count() == 0


def test_ids_decode_to_the_texts(steps):
    texts = {r["doc_id"]: r["text"] for r in steps[4].collect()}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as source:
        coder = bpe.encoding(source.read(), public_tokenizers.PATTERN)
    rows = steps[5].collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        assert coder.decode(np.frombuffer(r["ids"], "<u4").tolist()) == texts[r["doc_id"]]


def test_odd_and_no_documents(spark, sf_dir):
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = base.limit(60).union(spark.createDataFrame(
        [(1, None, None, None, None), (None, "the and of", "en", "s", 3), (10**9, "", "en", "s", 0), (10**9, "", "en", "s", 0)],
        base.schema)).withColumn("score", F.lit("x")).withColumn("ids", F.lit(1))
    for docs in (odd, odd.limit(0)):
        for i, (_, stage) in enumerate(cp.STAGES):
            made = materialize(stage(spark, docs, sf_dir))
            assert made.columns == docs.columns or i == 4
            docs = made
        assert langid.UNDETERMINED not in docs.columns


def test_run_equals_the_stages(spark, sf_dir, steps):
    assert sorted(map(repr, cp.run(spark, sf_dir).select("doc_id", "n_tokens").collect())) == sorted(
        map(repr, steps[-1].select("doc_id", "n_tokens").collect()))


def test_documents_that_stay_as_they_are_are_not_shuffled(spark, sf_dir):
    """Where joins are not broadcast, rows that a stage leaves alone come out with those they came with."""
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter("length(text) > 80").first()["text"]

    def text(i, words):
        return " ".join(f"w{i}x{k}" for k in range(words))

    rows = [(i, text(i, 20), "en", "s", 1) for i in range(400)]
    rows += [(1000 + i, text(i, 20), "en", "s", 1) for i in range(4)]               # copies of the first ones
    rows += [(2000 + i, f"{text(2000 + i, 20)} {item}", "en", "s", 1) for i in range(4)]
    rows += [(3000 + i, f"{text(3000 + i, 20)} password = hunter{i}hunter{i}", "en", "s", 1) for i in range(4)]
    rows += [(None, text(5000, 20), "en", "s", 1), (None, text(5000, 20), "en", "s", 1), (4000, None, "en", "s", 1)]
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    docs = spark.createDataFrame(rows, base.schema).repartition(6).withColumn("came", F.spark_partition_id())
    docs = materialize(docs)
    every = {(r["doc_id"], r["text"]) for r in docs.collect()}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for stage, gone in ((cp.near_duplicates, range(1000, 1004)), (cp.decontaminate, range(2000, 2004)),
                            (cp.redact, range(0))):
            made = stage(spark, docs, sf_dir).withColumn("went", F.spark_partition_id()).collect()
            assert len(made) == len(rows) - len(gone)
            assert {r["doc_id"] for r in made} == {d for d, _ in every} - set(gone)
            alone = [r for r in made if (r["doc_id"], r["text"]) in every and (r["doc_id"] or 0) < 400]
            assert len(alone) == 402
            assert len({(r["came"], r["went"]) for r in alone}) == 6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_parted_by_key(spark):
    rows = spark.createDataFrame([(i if i else None, i % 3, f"t{i}") for i in range(3000)], "id long, _slot int, `a.b` string")
    wanted = rows.filter("id is null or id % 50 = 0").select("id", "_slot")
    maybe, rest = common.parted(rows, [F.col("id"), F.col("_slot")], wanted, [F.col("id"), F.col("_slot")])
    assert maybe.columns == rest.columns == rows.columns
    assert sorted(map(repr, maybe.union(rest).collect())) == sorted(map(repr, rows.collect()))
    assert maybe.join(wanted, maybe["id"].eqNullSafe(wanted["id"])).count() == wanted.count() == 60
    assert maybe.count() < 70
    maybe, rest = common.parted(rows, [F.col("id")], wanted.limit(0), [F.col("id")])
    assert maybe.count() == 0 and rest.count() == 3000
