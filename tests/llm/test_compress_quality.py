import zlib

from pyspark.sql import functions as F

from newsgraph.llm import compress_quality as cq

SF = "/root/testdata/sf0.01"


def test_fold_is_crc32_of_the_id(spark):
    ids = [0, 1, 17, 123456789012]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    assert [r[0] for r in df.select(cq.fold(F.col("doc_id"))).collect()] == [zlib.crc32(str(i).encode()) % 5 for i in ids]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = cq.op8(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.45 * len(bad)


def test_held_out_labels_never_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(cq.fold(F.col("doc_id")) == 0, 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    assert cq.train(docs, labels) == cq.train(docs, turned)


def test_bounds_of_the_sample(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = cq.sample(docs, labels, texts=10, text_bytes=3000)
    assert len(rows) == 20 and max(len(t.encode()) for _, t in rows) <= 3000


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (5, 1)], "doc_id long, quality int")
    got = cq.op8(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert cq.op8(no_docs, labels).collect() == []
    assert all(r["score"] == 0.5 for r in cq.op8(odd_docs, labels.limit(0)).collect())
    assert cq.keep_good(odd_docs, odd_docs, labels).columns == odd_docs.columns
