import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tabulae.llm.common import written
from tests_llm_phrase import phrase


def test_stages_in_order_and_their_columns(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "minhash_dedup", "decontamination", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder))
        counts.append(docs.count())
        assert name == "bpe" or docs.columns == columns
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0
    ids = {r.doc_id: r for r in docs.collect()}
    run = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert ids == run
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        if r.doc_id in ids:
            assert ids[r.doc_id].ids == library.encode(r.text, add_special_tokens=False).ids


def test_planted_rows_go_and_the_others_stay(spark, tmp_path):
    """Brute-force expectations on a small corpus written as the pipeline's input."""
    lang = {0: "en", 1: "de"}
    rows = [(i, phrase(i, 80), lang[i % 2], "s", 1) for i in range(60)]
    item = phrase(700, 30)
    rows += [(100, phrase(0, 80), "en", "s", 1), (101, phrase(1, 80) + " tail", "en", "s", 1),   # copies of 0 and 1
             (102, phrase(2, 40) + " " + item, "en", "s", 1),                                    # contaminated
             (103, phrase(3, 900) + " " + " ".join(item.split()[:13]), "en", "s", 1),            # hit, but by little
             (104, "1234 !!", "en", "s", 1), (105, None, "en", "s", 1),                          # no letters
             (106, phrase(4, 60) + " you stupid idiot worthless scum", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert kept == {*range(60), 103}


def test_empty_tables(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns_pass_through(spark, odd):
    folder, docs = "/root/testdata/sf0.001", odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == odd.columns
        docs = written(docs)
