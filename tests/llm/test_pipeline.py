"""The pipeline stage by stage against brute force, and the registration of the queries."""

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm.conftest import DOCS
from tests.llm.test_classifiers import hits
from tests.llm.test_corpus import counts_by_hand
from tests.llm.test_duplicates import brute_components, words


def test_stages_one_after_another(spark, frame, corpus, tmp_path):
    rows, bench, passage = corpus
    folder = str(tmp_path)
    frame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    frame([(1, bench)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        kept.append([tuple(r) for r in docs.collect()])
        assert number == 4 or docs.columns == columns

    def good(text):
        n, _, _, _, repeated = counts_by_hand(text)
        return n >= 50 and 100 * repeated <= 50 * n

    # The corpus is too small for adaptive limits, so only the base rule holds.
    assert sorted(kept[0], key=str) == sorted((r for r in rows if good(r[1])), key=str)
    root = brute_components(kept[0], 5, 80)
    assert sorted(r[0] for r in kept[1] if r[0] is not None) == sorted({i for i, c in root.items() if i == c})
    assert [r[0] for r in kept[1]].count(None) == [r[0] for r in kept[0]].count(None)

    assert sorted(str(r[0]) for r in kept[2]) == sorted(str(r[0]) for r in kept[1])
    middle = " ".join(passage.split(" ")[20:40])
    assert sum(middle in r[1] for r in kept[1]) > 1 and sum(middle in r[1] for r in kept[2]) == 1
    before = dict((r[0], r[1]) for r in kept[1])
    for r in kept[2]:
        assert r[4] == len(r[1])
        lost = len(words(before[r[0]])) - len(words(r[1]))
        assert lost == 0 or r[0] is not None

    clean = [r for r in kept[2] if not hits(r[1], [(1, bench)])[-1]]
    assert len(clean) < len(kept[2]) and sorted(kept[3], key=str) == sorted(clean, key=str)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    total = sum(len(tokenizer.encode(r[1], add_special_tokens=False).ids) + 1 for r in kept[3])
    length, sequence = docs.columns.index("length"), docs.columns.index("sequence_id")
    assert sum(r[length] for r in kept[4]) == total
    fills = {}
    for r in kept[4]:
        fills[r[sequence]] = fills.get(r[sequence], 0) + r[length]
    assert max(fills.values()) <= 2048 and len(fills) <= total / 2048 + 2

    assert corpus_pipeline.run(spark, folder).count() == len(kept[4])


def test_stages_keep_texts_of_one_id_apart_and_clashing_columns(spark, frame, corpus, tmp_path):
    bench = corpus[1]
    folder = str(tmp_path)
    frame([(1, bench)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    clean = [f"{corpus[0][k][1]}" for k in (40, 41)]
    rows = [(None, clean[0]), (None, f"{bench} x"), (7, f"{bench} y"), (7, clean[1]), (8, None)]
    docs = frame(rows, "doc_id bigint, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "1 AS n_chars", "2 AS _id", "3 AS hit_id", "4 AS own_key")
    kept = corpus_pipeline.decontamination(spark, docs, folder)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, docs.where(
        "text IS NULL OR NOT text LIKE '" + bench + "%'").select("doc_id", "text").collect()))
    cut = corpus_pipeline.substring_dedup(spark, docs, folder)
    assert cut.columns == docs.columns and cut.count() == 5 and cut.where("text IS NULL").count() == 1


def test_operators_of_this_round_have_queries():
    names = driver.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(11, 14)] == [1] * 3
    assert "op13_importance" in driver.oracle_sql()


def test_every_operator_has_a_query():
    names = driver.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert {"op4_archive", "op6_decontamination"} <= set(driver.oracle_sql())
