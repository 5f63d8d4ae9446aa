"""I1-I9, E2, D10, F6, I14 (FIXTURES F2, F5, F6, F12, F13)."""
from pyspark.sql import functions as F

from newsgraph.functions import text as tx
from newsgraph.operators import coref, sentences, trainset


def test_normalize(spark):
    df = spark.createDataFrame([("a―b？“q” ‘x’",), ("l1\\nl2\nl3",), ("漢字k",)], "s string")
    got = [r[0] for r in df.select(tx.normalize_text("s")).collect()]
    assert got == ["a-b-\"q\" 'x'", "l1 l2 l3", "k"]


def test_strip_marker(spark):
    df = spark.createDataFrame([("##ab##",), ("ab",)], "s string")
    assert [r[0] for r in df.select(tx.strip_subword_marker("s")).collect()] == ["ab##", "ab"]


def test_sentence_split(spark):
    df = spark.createDataFrame([(1, "One. Two!  Three? four"), (2, None)], "article_id long, text string")
    out = sentences.split_sentences(df).collect()
    assert len(out) == 1 and out[0].split_text == ["One.", "Two!", "Three?", "four"]


def test_regroup_keeps_empty_lists(spark):
    df = spark.createDataFrame([(1, [["a", "b"], [], ["c"]])], "id long, l array<array<string>>")
    flat = df.select(F.posexplode("l").alias("p", "lst")).withColumn("article_id", F.col("p").cast("long"))
    up = sentences.map_list(flat, "lst", F.upper, "up", exploded=True).orderBy("p")
    assert [r.up for r in up.collect()] == [["A", "B"], [], ["C"]]
    inline = sentences.map_list(flat, "lst", F.upper, "up").orderBy("p")
    assert [r.up for r in inline.collect()] == [["A", "B"], [], ["C"]]


def test_keep_mask(spark):
    toks = [("a", 0), ("b", 1), ("c", 2)]
    df = spark.createDataFrame([(1, toks)], "id long, t array<struct<token:string,label:int>>")
    keep = lambda drop: F.array_join(F.transform(F.filter("t", lambda x: x["label"] != drop),
                                                 lambda x: x["token"]), " ")
    r = df.select(keep(1).alias("eng"), keep(0).alias("other")).first()
    assert (r.eng, r.other) == ("a c", "b c")


def test_glossary_literal_and_join_agree(spark):
    df = spark.createDataFrame([(1, ["le chat et la", "x", "a  b"]), (2, [])], "article_id long, split_text array<string>")
    pairs = [("le", "the"), ("la", "the"), ("et", "and")]
    g = spark.createDataFrame(pairs, "src string, dst string")
    a = {r.article_id: r.translated_text for r in sentences.glossary_map(df, dict(pairs)).collect()}
    b = {r.article_id: r.translated_text for r in sentences.glossary_map(df, g).collect()}
    assert a == b == {1: ["the chat and the", "x", "a  b"], 2: []}


def test_paragraph_prefix(spark):
    df = spark.createDataFrame([(1, "abc\nde\nf"), (2, "abcdef\ng"), (3, "\n \n")], "article_id long, text string")
    out = {r.article_id: r.text_prefix for r in trainset.paragraph_prefix(df, n=5).collect()}
    assert out == {1: "abcde", 2: "abcdef"}


def test_label_rows(spark):
    idx = spark.createDataFrame([("2012a.csv", 0), ("2012a.csv", 2), ("2012a.csv", 2)], "file string, idx int")
    rows = spark.createDataFrame([("2012a.csv", 0), ("2012a.csv", 1), ("2012a.csv", 2), ("2013b.csv", 0)],
                                 "file string, idx int")
    out = trainset.label_rows(rows, idx, ["file", "idx"]).orderBy("file", "idx")
    assert [r.labels for r in out.collect()] == [1, 0, 1, 0]


def test_label_index_json(spark, tmp_dir):
    from newsgraph.sources.readers import read_label_index
    p = f"{tmp_dir}/idx.json"
    open(p, "w").write('{\n  "2012a.csv": [0, 2],\n  "2013b.csv": []\n}\n')
    got = sorted((r.file, r.idx) for r in read_label_index(spark, p).collect())
    assert got == [("2012a.csv", 0), ("2012a.csv", 2)]


def test_unlabeled_guard(spark):
    df = spark.createDataFrame([(1, "T", "x" * 30), (2, "Title", "short"), (3, None, "y" * 30),
                                (4, "Title", "z" * 800)], "article_id long, title string, text string")
    out = {r.article_id: len(r.text) for r in trainset.build_unlabeled(df).collect()}
    assert out == {4: 750}


def test_coref_rewrite(spark):
    df = spark.createDataFrame([(1, "Kim said he won"), (2, "the firm said it won"), (3, "no spans")],
                               "article_id long, text string")
    spans = spark.createDataFrame([(1, 0, 0, 3, "Kim"), (1, 0, 9, 11, "he"),
                                   (2, 0, 0, 8, "the firm"), (2, 0, 14, 16, "it")],
                                  "article_id long, cluster_id int, start int, end int, string string")
    out = {r.article_id: r.resolved_text for r in coref.resolve_coref(df, spans).collect()}
    assert out == {1: "Kim said Kim won", 2: "the firm said it won", 3: "no spans"}


def test_cluster_representative_possessive(spark):
    spans = spark.createDataFrame([(1, 0, 0, 11, "Acme Corp's"), (1, 0, 20, 22, "it")],
                                  "article_id long, cluster_id int, start int, end int, string string")
    assert coref.cluster_representative(spans).first().rep == "Acme Corp"


def test_nested_and_overlapping_spans_keep_the_text(spark):
    df = spark.createDataFrame([(1, "abcdef"), (2, "0123456789"), (3, "xy"), (4, None), (5, "plain")],
                               "article_id long, text string")
    rows = [(1, 0, 3, "X"), (1, 2, 4, "Y"),
            (2, 1, 2, "in"), (2, 1, 5, "OUT"), (2, 3, 4, "in"), (2, 4, 7, "late"), (2, 6, 9, "NEXT"), (2, 6, 9, "NEXT"),
            (3, 0, 1, "b"), (3, 0, 1, "a"), (3, None, 2, "n"), (3, 1, 1, "empty"), (3, 1, 2, None), (4, 0, 1, "z")]
    sp = spark.createDataFrame(rows, "article_id long, start int, end int, rep string")
    got = {r.article_id: (r.resolved_text, r.nested_spans) for r in coref.rewrite_spans(df, sp).collect()}
    assert got == {1: ("Xdef", True), 2: ("0OUT5NEXT9", True), 3: ("ay", True), 4: (None, False), 5: ("plain", False)}


def test_template_does_not_reexpand(spark):
    df = spark.createDataFrame([("{sbj} works for {obj}", "A{obj}", "B")], "t string, s string, o string")
    assert df.select(tx.fill_template("t", "s", "o")).first()[0] == "A{obj} works for B"


def test_extractive_summary_keeps_order_and_bounds(spark):
    txt = ("Common words here. Rare zebra quartz appears. Common words again here. "
           "Another rare xylophone sentence. Common words.")
    df = spark.createDataFrame([(1, txt), (2, "Common words here.")], "article_id long, text string")
    s = sentences.extractive_summary(sentences.split_sentences(df), k=2, min_words=1, max_words=250)
    out = {r.article_id: r.summarized_text for r in s.collect()}
    assert out[1] == "Rare zebra quartz appears. Another rare xylophone sentence."
    assert out[2] == "Common words here."
