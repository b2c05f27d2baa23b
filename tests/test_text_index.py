import re

import pytest
from pyspark.sql import functions as F

from mendwork.functions import text
from mendwork.functions.durable import new_stage
from mendwork.functions.text import build_tokens, text_matches
from mendwork.operators import search, text_index

QUERIES = ["cat", "sad cat", '"sad cat"', "cat -sad", '"sad cat" or rat', "cat fat or rat", "-cat", "rat or -cat", "", '"" - !', "CAT", "sad-cat", "cat -zebra", "zebra", "zebra or rat",
           '"the the"', 'the -"the the"', '"cat sat on the" mat', '"on the" "the mat"', '"mat the"', "cat cat", '-"sad cat" cat or "a sad"']
TEXTS = ["A sad cat.", "cat, then sad", "Rat!", "fat CAT", "", None, "the the cat sat on the mat", "the cat sat on a mat", "on mat the", "A SAD cat sad cat"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")


@pytest.fixture(scope="module")
def index(spark, docs):
    return text_index.build(docs, new_stage(spark), buckets=4, part_rows=2)


@pytest.mark.parametrize("query", QUERIES)
def test_same_documents_as_by_reading_every_text(docs, index, query):
    want = build_tokens(docs).where(text_matches(F.col("tokens"), query)).select("doc_id").collect()
    assert sorted(index.matches(query).collect()) == sorted(want)


def test_postings_and_lexicon(index):
    rows = {(r["token"], r["doc_id"]): r["positions"] for r in index.postings().collect()}
    assert rows[("the", 6)] == [1, 2, 6] and rows[("sad", 9)] == [2, 4] and ("a", 0) in rows
    words = {r["token"]: (r["n_docs"], r["n_words"]) for r in index.lexicon().collect()}
    assert words["cat"] == (6, 7) and words["the"] == (3, 5)
    assert index.lexicon("cat", "zebra").collect()[0]["n_docs"] == 6


def test_added_documents_are_found_beside_old_ones(spark, docs):
    built = text_index.build(docs.where("doc_id < 3"), new_stage(spark), buckets=2)
    built.add(docs.where("doc_id >= 3"))
    assert sorted(r[0] for r in built.matches("cat").collect()) == [0, 1, 3, 6, 7, 9]
    assert built.lexicon("cat").collect()[0]["n_docs"] == 6
    assert text_index.build(docs.limit(0), new_stage(spark)).matches("cat").count() == 0


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_queries_read_their_own_buckets_and_split_no_text(spark, docs, index):
    dialogs = spark.createDataFrame([(i, "p", "s") for i in range(10)], "id bigint, party string, service string").selectExpr(
        "*", "'o' AS org", "1 AS status_id", "timestamp'2020-01-01' + make_dt_interval(cast(id as int)) AS content_updated_at", "cast(null AS timestamp) AS visible_from",
        "cast(null AS timestamp) AS expires_at", "false AS deleted", "1 AS mask", "false AS is_api_only",
    )
    perms = search.permission_tables(spark.createDataFrame([('[{"Parties":["p"],"Services":["s"]}]',)], "payload string"))
    page = search.search_dialog_first_text(dialogs, perms, index, 'the "sad cat" or mat', "2024-01-01", k=2)
    assert [r["id"] for r in page.collect()] == [8, 7]
    for df in (page, index.matches('"on the" mat -rat')):
        plan = plan_of(df)
        assert "regexp" not in plan and "split(" not in plan and "lower(" not in plan
        scans = re.findall(r"PartitionFilters: \[(.*)\]", plan)
        assert any("bucket" in s for s in scans)
        assert re.search(r"PushedFilters: .*token", plan)


def test_a_hot_token_is_several_files(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("hot word"), F.col("id").cast("string")).alias("text"))
    built = text_index.build(docs, new_stage(spark), buckets=1, part_rows=50)
    rows = spark.read.parquet(f"{built.path}/postings").where("token = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert len(rows) > 1 and sum(r["count"] for r in rows) == 400 and max(r["count"] for r in rows) < 200
    assert built.matches("hot").count() == 400


def test_files_of_one_bucket_hold_a_bounded_number_of_postings(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 20), i -> concat('w', (id * 7 + i * 13) % 97))) AS text")
    built = text_index.build(docs, new_stage(spark), buckets=1, part_rows=200)
    rows = spark.read.parquet(f"{built.path}/postings").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in rows) == built.postings().count() > 5000 and max(r["count"] for r in rows) < 600
    assert sorted(r[0] for r in built.matches("w5 w18").collect()) == sorted(
        r[0] for r in build_tokens(docs).where(text_matches(F.col("tokens"), "w5 w18")).select("doc_id").collect()
    )


def test_words_are_grouped_where_their_texts_are(spark, docs, monkeypatch):
    monkeypatch.setattr(text, "DOCS_PER_TASK", 3)
    plan = plan_of(text_index.postings_of(docs))
    dealt = re.findall(r"Arguments: hashpartitioning\((.*?)\)", plan)
    assert len(dealt) == 1 and "doc_id" in dealt[0] and "token" not in dealt[0]
    assert text_index.postings_of(docs).count() == sum(len(set((t or "").lower().replace(",", "").replace(".", "").replace("!", "").split())) for t in TEXTS)
