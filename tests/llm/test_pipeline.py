"""The pipeline stage by stage, and every query with SQL against DuckDB."""

import random

import compare
import corpus_pipeline
import pyarrow as pa
import pytest
from llm_helpers import SMALL, prose
from pyspark.sql import functions as F

import __spark_entry__ as entry
from seriesmill import session
from seriesmill.llm import catalogue, near_duplicates, scratch

ORACLES = catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    assert compare.compare(catalogue.queries()[name](spark, SMALL), compare.connect(SMALL), ORACLES[name]) == []


def test_all_are_registered():
    names = set(entry.queries())
    assert set(catalogue.queries()) | {"pipeline"} <= names
    assert sorted({int(n[2:].split("_")[0]) for n in catalogue.queries()}) == list(range(1, 14))


def planted(spark, documents, tmp_path):
    """Clean documents, and one of each kind that a stage must catch."""
    rng = random.Random(17)
    items = [(k, prose(rng, 30)) for k in range(3)]
    clean = [(k, prose(rng, 80), f"s{k % 3}") for k in range(60)]
    rows = clean + [
        (100, clean[5][1], "s1"), (101, clean[6][1] + " end", "s2"),
        (102, f"{prose(rng, 60)} {items[1][1]}", "s0"), (103, "ab cd ef gh ij " * 9, "s0"),
        (104, "short text", "s1"), (105, None, "s1"), (None, prose(rng, 40), None),
    ]
    table = documents(rows)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table.write.parquet(str(tmp_path / "documents.parquet"))
    return spark.read.parquet(str(tmp_path / "documents.parquet")), [c[0] for c in clean]


def test_stages(spark, documents, tmp_path):
    docs, clean = planted(spark, documents, tmp_path)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        kept[name] = sorted({r.doc_id for r in docs.collect()}, key=lambda i: (i is None, i))
    first, second, third, fourth = kept.values()
    assert first == [*clean, 100, 101, 102, None]
    assert second == [*clean, 102, None]
    assert third == [*clean, None]
    assert set(fourth) <= set(third)
    rows = docs.collect()
    assert max(sum(r.doc_id == i for r in rows) for i in fourth) <= 2
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "benchmark_decontamination", "source_mixing", "token_output",
    ]


def test_run_equals_its_stages(spark, documents, tmp_path):
    docs, _ = planted(spark, documents, tmp_path)
    by_hand = docs
    for _, stage in corpus_pipeline.STAGES:
        by_hand = stage(spark, by_hand, str(tmp_path))
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.agg(F.sum("n_tokens"), F.count("slot")).first() == by_hand.agg(F.sum("n_tokens"), F.count("slot")).first()


#: Names of helper columns anywhere in the operators of the stages.
INTERNAL = (
    "row _lines _host_key _clean _bad host lines removed kept line document holders _copies _doc_id _copy cut epochs of_source key size "
    "source_size target taken before last _cell0 _total _start _gone _several digest digest2 bands sketch component component_id rep hub "
    "n_shingles shingles _leak _doc _item item_id shared tokens hashes width hash part start base at sequence shard slot piece begin n_tokens col"
)


def test_stages_carry_columns_of_any_name(spark, documents, tmp_path):
    """Extra columns with the names of helper columns come through every stage unchanged."""
    rng = random.Random(41)
    line = prose(rng, 12)
    rows = [(k, f"{prose(rng, 40)}\n{line}", f"s{k % 2}") for k in range(60)] + [(70, prose(rng, 60), None)]
    docs = documents(rows, INTERNAL)
    spark.createDataFrame([(1, prose(rng, 30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        found = out.collect()
        assert found and all(getattr(r, "_lines") == str(r.doc_id) and r["row"] == str(r.doc_id) and r["size"] == str(r.doc_id) for r in found), name
        docs = spark.createDataFrame(found, docs.schema)
    assert not any(line in r.text for r in found)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0


def test_long_texts_reach_python_in_small_batches(spark, documents):
    """Thirty MB of texts in one partition are many batches, and all rows of them."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    texts = documents([(k, "text") for k in range(300)]).coalesce(1).select(F.repeat("text", 25_000).alias("text"))
    found = scratch.map_batches(texts, sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in found) == 300
    assert max(r.bytes for r in found) < 2 * session.BATCH_BYTES


def test_near_dedup_of_the_small_table(spark):
    """One document of each exact five-word group stays."""
    from test_near_duplicates import brute_force

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = [r[0] for r in brute_force([(r.doc_id, r.text) for r in docs.collect()], 5) if r[3]]
    assert sorted(r.doc_id for r in near_duplicates.without_copies(docs).collect()) == expected


def test_empty_tables(spark, documents, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
