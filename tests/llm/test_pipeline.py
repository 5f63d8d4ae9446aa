import corpus_pipeline
import public_tokenizers
from test_jaccard import brute
from tokenizers import Tokenizer

from newsgraph.llm import compress_quality, line_rules
from newsgraph.llm.shared import read

SF = "/root/testdata/sf0.01"


def test_stages_and_run_equal_brute_force(spark, tmp_path):
    source = docs = read(spark, SF, "documents")
    labels = read(spark, SF, "labels")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == source.columns and docs.dtypes == source.dtypes
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rules = {r["doc_id"]: r["kept"] for r in line_rules.op6(source).collect()}
    assert set(kept["quality_rules"]) == {k for k, v in rules.items() if v}
    judged = {r["doc_id"]: r for r in line_rules.judge(source).collect()}
    for k, text in kept["quality_rules"].items():
        r = judged[k]
        assert text == (r["clean_text"] if r["lost_chars"] or r["n_dup_lines"] else r["text"])
    assert any(text != judged[k]["text"] for k, text in kept["quality_rules"].items())
    model = compress_quality.train(source, labels)
    assert set(kept["quality_classifier"]) == {
        k for k, t in kept["quality_rules"].items() if model.score(*model.sizes(t)) >= 0.3}
    good = [k for k in kept["quality_rules"] if quality.get(k) == 1]
    assert sum(k in kept["quality_classifier"] for k in good) >= 0.97 * len(good)
    assert set(kept["ngram_jaccard_join"]) == {c for _, c, _, _ in brute(list(kept["quality_classifier"].items()))}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    n = {k: len(plain.encode(t, add_special_tokens=False).ids) + 1 for k, t in kept["ngram_jaccard_join"].items()}
    lengths = {}
    for r in packed:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == n
    whole = corpus_pipeline.run(spark, SF).collect()
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole} == {
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed}


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for table in (odd_docs, no_docs):
            out = stage(spark, table, SF)
            assert out.count() >= 0
            if k < 3:
                assert out.columns == table.columns
