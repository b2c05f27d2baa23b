import json
import re

import pytest
from pyspark.sql import functions as F

from mendwork.operators import analytics, workload
from mendwork.operators.equivalence import multiset_diff, variant_pairs
from mendwork.operators.plan_tree import plan_nodes
from mendwork.sources import logs, pools, run_folder, staging


def test_label_csv_spellings_and_rejects(spark, tmp_path):
    good = tmp_path / "a.csv"
    good.write_text(
        "dialogid,TimeStamp,ActorId,SystemLabel\n"
        'd1,2026-01-17 02:53:52.533 +0100,"urn:demo:person:identifier-no:1",Bin\n'
        'd2,2026-01-17T01:53:52.5330000Z,"a ""quoted"" actor",Archive\n'
    )
    rows = {r["dialog_id"]: r for r in staging.read_label_staging(spark, str(good)).collect()}
    assert rows["d1"]["source_ts"] == rows["d2"]["source_ts"]
    assert rows["d2"]["actor_id"] == 'a "quoted" actor'
    for bad in ("d1,2026-01-17 02:53:52.533 +0100,,Bin\n", "d1,not a time,x,Bin\n"):
        path = tmp_path / "bad.csv"
        path.write_text("h,h,h,h\n" + bad)
        with pytest.raises(Exception):
            staging.read_label_staging(spark, str(path)).collect()


def test_actor_csvs_are_one_normalised_set(spark, tmp_path):
    for i, urn in enumerate(("urn:demo:organizationnumber:912345678", "urn:demo:person:identifier-no:1")):
        (tmp_path / f"{i}.csv").write_text(f"a,b,c,d,e,f\nd{i},a{i},2026-01-01T00:00:00.0000000Z,{urn},ØRE ÅSE,CorrespondenceOpened\n")
    rows = staging.read_actor_staging(spark, [str(tmp_path / "0.csv"), str(tmp_path / "1.csv")]).orderBy("dialog_id").collect()
    assert [r["actor_id"] for r in rows] == ["urn:demo:organization:identifier-no:912345678", "urn:demo:person:identifier-no:1"]
    assert rows[0]["actor_name"] == "ØRE ÅSE"


def test_a_seventh_digit_rounds(spark, tmp_path):
    path = tmp_path / "t.csv"
    times = ["2026-01-01T00:00:52.1234567Z", "2026-01-01T00:00:52.1234564Z", "2026-01-01T00:00:59.9999999Z", "2026-01-01T00:00:52.5Z"]
    path.write_text("a,b,c,d\n" + "".join(f"d{i},{t},x,y\n" for i, t in enumerate(times)))
    rows = staging.read_label_staging(spark, str(path)).orderBy("dialog_id").select(F.date_format("source_ts", "mm:ss.SSSSSS").alias("t")).collect()
    assert [r["t"] for r in rows] == ["00:52.123457", "00:52.123456", "01:00.000000", "00:52.500000"]


def test_pool_rejects_malformed_entries(spark, tmp_path):
    entries = [
        {"Party": "p1", "Services": ["b", "a", "b"], "EstimatedDialogCount": 3}, {"Party": "p2", "Services": []},
        {"Party": "", "Services": ["a"]}, {"Party": 5, "Services": ["a"]}, {"Party": "p3", "Services": ["a", 1]},
        {"Party": "p4", "Services": "a"}, {"Services": ["a"]}, {"Party": "p5", "Services": [""]},
    ]
    path = tmp_path / "pool.json"
    path.write_text(json.dumps(entries))
    pool, rejected = pools.read_party_service_pool(spark, str(path))
    assert [tuple(r) for r in pool.collect()] == [("p1", 3, ["a", "b"])]
    assert rejected.count() == 6


def test_a_json_array_is_read_in_splits(spark, tmp_path):
    texts = ["x}{][", 'say "}, {"', "back\\slash}", "", "\\", '"', "é日}", "a" * 300]
    entries = [
        {"Party": f"p{i}", "Services": ["b", texts[i % 8] + "s", "b"], "EstimatedDialogCount": i, "More": [{"x": {"y": [i, "}"]}}, "]"], "k}": None} for i in range(400)
    ]
    entries[17] = 5
    entries[40:42] = [None, "text }"]
    entries[-1] = [1, 2]
    for name, indent in (("one", None), ("two", 1)):
        (tmp_path / f"{name}.json").write_text(json.dumps(entries, indent=indent, ensure_ascii=name == "one"))
    (tmp_path / "none.json").write_text(" [\n ] ")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for name in ("one", "two", "none"):
            read = pools.json_array_elements(spark, str(tmp_path / f"{name}.json"))
            got = [json.loads(r[0]) for r in read.select(F.to_json("v")).collect() if r[0] is not None]
            want = entries if name != "none" else []
            nulls = read.where("v is null or is_variant_null(v)").count()
            dumped = [json.dumps(e, sort_keys=True) for e in want if e is not None]
            assert sorted(json.dumps(g, sort_keys=True) for g in got if g is not None) == sorted(dumped) and nulls == (1 if want else 0)
        chunks = spark.read.option("lineSep", "}").text(str(tmp_path / "one.json")).rdd.getNumPartitions()
        assert chunks > 10
        pool, rejected = pools.read_party_service_pool(spark, str(tmp_path))
        assert pool.count() == 2 * 396 and rejected.count() == 2 * 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_text_that_is_no_json_is_rejected_as_it_stands(spark, tmp_path):
    (tmp_path / "p.json").write_text('[{"Party": "p1", "Services": ["a"]}, {"Party": oops}, {"Party": "p2", "Services": ["b"]}]')
    pool, rejected = pools.read_party_service_pool(spark, str(tmp_path / "p.json"))
    assert sorted(r["party"] for r in pool.collect()) == ["p1", "p2"]
    assert [r["entry"].strip() for r in rejected.collect()] == ['{"Party": oops}']


PLAN = [
    {
        "Plan": {
            "Node Type": "Limit", "Actual Rows": 7, "Shared Hit Blocks": 360, "Shared Read Blocks": 40, "I/O Read Time": 2.75,
            "Plans": [
                {"Node Type": "Index Scan", "Relation Name": "Dialog", "Index Name": "IX_A", "Rows Removed by Filter": 11,
                 "Filter": 'x = "Node Type": "Decoy"'},
                {"Node Type": "Hash Join", "Rows Removed by Join Filter": 6, "Plans": [{"Node Type": "Index Scan", "Index Name": "IX_A"}]},
            ],
        },
        "Planning Time": 0.75, "Execution Time": 18.25,
    }
]


@pytest.mark.parametrize("indent", [None, 2])
def test_plan_logs_to_metrics(spark, tmp_path, indent):
    folder = tmp_path / "raw" / "case_0001_p_1_s_1" / "pass_01" / "run_02" / "variantA"
    folder.mkdir(parents=True)
    (folder / "explain.json").write_text(json.dumps(PLAN, indent=indent))
    row = analytics.plan_metrics(logs.read_plan_logs(spark, str(tmp_path))).first()
    assert (row["case_id"], row["pass"], row["run_index"], row["variant"]) == ("case_0001_p_1_s_1", 1, 2, "variantA")
    assert (row["execution_time_ms"], row["planning_time_ms"], row["rows_removed"]) == (18.25, 0.75, 17)
    assert (row["node_types"], row["index_names"]) == ("Hash Join:1|Index Scan:2|Limit:1", "IX_A:2")
    assert (row["temp_read_blocks"], row["io_read_time_ms"]) == (0.0, 2.75)
    assert row["shared_hit_ratio"] == pytest.approx(360 / 400)


def test_run_folder_round_trip_and_its_commit(spark, tmp_path):
    root = str(tmp_path / "run")
    rows = [(f"case_{i % 5}", 1 + i % 2, i, "vA", json.dumps(PLAN) if i % 4 else "{broken") for i in range(40)] + [("case_x", 1, 1, "vB", None)]
    plans = spark.createDataFrame(rows, "case_id string, pass int, run_index int, variant string, plan string").repartition(4)
    run_folder.write_plan_logs(plans, root)
    assert (tmp_path / "run/raw/case_3/pass_002/run_3/vA/explain.json").read_text() == json.dumps(PLAN)
    back = run_folder.read_plan_logs(spark, root)
    assert sorted(tuple(r) for r in back.drop("path").collect()) == sorted(r for r in rows if r[4] is not None)
    assert sorted(map(tuple, logs.read_plan_logs(spark, root).drop("path").collect())) == sorted(map(tuple, back.drop("path").collect()))
    assert analytics.plan_metrics(back).where("parse_error is null").count() == 30
    run_folder.write_plan_logs(plans.where("run_index = 5").withColumn("case_id", F.lit("later")), root)
    assert run_folder.read_plan_logs(spark, root).count() == 41 and run_folder.read_plan_logs(spark, str(tmp_path / "none")).count() == 0
    bad = plans.withColumn("case_id", F.when(F.col("run_index") == 7, "../up").otherwise("never"))
    with pytest.raises(Exception, match="cannot name a folder"):
        run_folder.write_plan_logs(bad, root)
    assert not (tmp_path / "run/raw/never").exists() and list((tmp_path / "run/_staging").iterdir()) == []


def test_packed_logs_take_no_file_each(spark, tmp_path):
    root = str(tmp_path / "run")
    rows = [(f"case_{i % 50}", 1, i, "v" * 90 if i % 3 else "vÅ", json.dumps(PLAN) if i % 4 else "") for i in range(12_000)] + [("case_x", 1, 1, "vB", None)]
    plans = spark.createDataFrame(rows, "case_id string, pass int, run_index int, variant string, plan string")
    run_folder.write_plan_logs(plans.coalesce(1), root, packed=True)
    found = [p for p in (tmp_path / "run").rglob("*") if p.is_file() and not p.name.startswith(".")]
    assert len(found) == 2 and sum(p.stat().st_size for p in found) < 2_000_000 and list((tmp_path / "run/_staging").iterdir()) == []
    run_folder.write_plan_logs(plans.limit(3).withColumn("case_id", F.lit("file")), root)
    back = run_folder.read_plan_logs(spark, root)
    want = [r for r in rows if r[4] is not None] + [("file", *r[1:]) for r in rows[:3]]
    assert sorted(tuple(r) for r in back.drop("path").collect()) == sorted(want)
    assert back.select("path").distinct().count() == len(want)
    with pytest.raises(Exception, match="cannot name a folder"):
        run_folder.write_plan_logs(plans.withColumn("case_id", F.lit("..")), root, packed=True)
    assert run_folder.read_plan_logs(spark, root).count() == len(want)


def test_tree_is_walked_and_not_searched(spark):
    deep = node = {"Node Type": "Append"}
    for _ in range(12):
        node["Plans"] = [{"Node Type": "Append"}]
        node = node["Plans"][0]
    plan = {"Node Type": "Limit", "Workers": [{"Node Type": "Not a node", "Sort Method": "x"}], "Rows Removed by Filter": 2.9, "Node Type of": "no",
            "Filter": "\"Node Type\":\"Decoy\"", "Plans": [{"Node Type": "Sort", "Sort Method": "quicksort"}, {"Plans": []}, deep, {"Node Type": "", "Plans": None}]}
    logged = spark.createDataFrame([(1, json.dumps([{"Plan": plan}])), (2, json.dumps([{"Plan": {}}])), (3, "[]")], "id int, plan string")
    rows = {r["id"]: r for r in analytics.plan_metrics(logged).collect()}
    assert rows[1]["node_types"] == "Append:13|Limit:1|Sort:1" and rows[1]["sort_methods"] == "quicksort:1" and rows[1]["rows_removed"] == 2
    assert rows[2]["node_types"] == "" and rows[2]["rows_removed"] == 0 and rows[3]["parse_error"] == "not a JSON plan"
    nodes = plan_nodes(analytics.read_plans(logged), ["id"], [("kind", "Node Type", "string")]).where("id = 1")
    assert nodes.agg(F.max("depth")).first()[0] == 13 and nodes.where("path = '0.2.0.0'").first()["parent"] == "0.2.0"


def test_plan_text_split_over_many_chunks(spark, tmp_path):
    text = "ignored\n"
    for case in range(40):
        text += f"EXPLAIN sql/v.sql cases/c{case}.json\nLimit (actual time=1..2)\n  Buffers: shared hit={case} read=2\n" + "  filler\n" * 30
        text += f"Planning:\n  Buffers: shared hit=9\nExecution Time: {case}.5 ms\n"
    path = tmp_path / "log.txt"
    path.write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        blocks = logs.split_plan_text(spark, str(path))
        assert blocks.select("chunk").distinct().count() > 5
        ordered = blocks.withColumn("line_no", F.struct("chunk", "at"))
        rows = {r["case"]: r for r in analytics.plan_text_metrics(ordered).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 40
    for case in range(40):
        r = rows[f"c{case}"]
        assert (r["exec_ms"], r["shared_hit"], r["shared_read"], r["shared_dirtied"]) == (case + 0.5, case, 2, 0)


def test_dictionary_can_be_read_back(spark):
    lines = spark.createDataFrame(
        [(1, 'Index Scan using "IX_A" on "Dialog" d'), (2, "Seq Scan on Other.Table"), (3, "Filter: (a = 1)")], "line_no int, line string"
    )
    encoded, dictionary = analytics.dictionary_encode(lines)
    codes = {r["text"]: r["code"] for r in dictionary.where("kind = 'name'").collect()}
    assert codes == {"IX_A": "AA", "Dialog": "AB", "Other.Table": "AC"}
    first = encoded.orderBy("line_no").first()["line"]
    assert "AA" in first and "AB" in first and "IX_A" not in first


def _encoded(line, names):
    """Names in order of first use: at each step the quoted ones, then those between word borders, in what is still text."""
    pieces = [(line, False)]
    for code, name in names:
        for pattern in (f'"{re.escape(name)}"', rf"\b{re.escape(name)}\b"):
            new = []
            for text, done in pieces:
                if done:
                    new.append((text, True))
                    continue
                at = 0
                for hit in re.finditer(pattern, text):
                    new += [(text[at : hit.start()], False), (code, True)]
                    at = hit.end()
                new.append((text[at:], False))
            pieces = new
    return "".join(t for t, _ in pieces)


def test_names_are_replaced_as_one_after_the_other(spark):
    texts = [
        'Index Scan using IX_A on "Dialog" d', 'Seq Scan on Dialog.Part x, Dialog, "Dialog.Part"', 'on "The Long Name" on Long', 'Filter: "The Long Name" "Long" Name. The Long Names',
        'on IX_A.x IX_AB IX_A', "", None, 'on "Über_1" on Über_1x on Über_1', '"A.B.C" "A.B" A.B.C A.B', 'on "AA" on AA, AB',
    ]
    lines = spark.createDataFrame(list(enumerate(texts)), "line_no int, line string").repartition(3)
    encoded, dictionary = analytics.dictionary_encode(lines)
    terms = [r for r in dictionary.collect() if r["kind"] == "term"]
    names = sorted((r["code"], r["text"]) for r in dictionary.collect() if r["kind"] == "name")
    assert len(terms) == 41 and len(names) > 8
    for r in encoded.collect():
        want = texts[r["line_no"]]
        if want is not None:
            want = _encoded(want, names)
            for term, code in sorted(zip(analytics.COMMON_TERMS, analytics.TERM_CODES), key=lambda t: -len(t[0])):
                want = re.sub(re.escape(term) if term.endswith(":") or " " in term else rf"\b{re.escape(term)}\b", lambda _, c=code: c, want)
        assert r["line"] == want


def test_codes_go_on_after_two_letters(spark):
    lines = spark.createDataFrame([(i, f'on "Name{i}"') for i in range(700)], "line_no int, line string")
    encoded, dictionary = analytics.dictionary_encode(lines)
    codes = {r["text"]: r["code"] for r in dictionary.collect()}
    assert [codes[f"Name{i}"] for i in (0, 25, 26, 675, 676, 699)] == ["AA", "AZ", "BA", "ZZ", "AAA", "AAX"]
    assert {r["line"].split()[-1] for r in encoded.where("line_no in (3, 690)").collect()} == {codes["Name3"], codes["Name690"]}


def test_multiset_diff_equals_except_all(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (4, "z")], "k int, v string")
    got = {(r["k"], r["v"], r["side"], r["copies"]) for r in multiset_diff(a, b).collect()}
    assert got == {(1, None, "left", 1), (3, "y", "left", 1), (2, "x", "right", 1), (4, "z", "right", 1)}
    assert a.exceptAll(b).count() + b.exceptAll(a).count() == sum(c for *_, c in got)
    assert variant_pairs(["b", "a", "c"], "b") == [("b", "a"), ("b", "c")]


def test_allocation():
    caps = {"0": 1, "1-10": 50, "11-100": 3}
    assert workload.allocate(caps, 10, "balanced") == {"0": 1, "1-10": 6, "11-100": 3}
    assert workload.allocate(caps, 27, "proportional") == {"0": 0, "1-10": 25, "11-100": 2}
    for n in range(1, 55):
        for kind in ("balanced", "proportional"):
            got = workload.allocate(caps, n, kind)
            assert sum(got.values()) == n and all(got[s] <= caps[s] for s in got)


def test_resume_refuses_another_pool_or_cap(spark):
    pool = spark.createDataFrame([("a",), ("b",)], "party string")
    facts = spark.createDataFrame([("a",), ("a",)], "party string")
    done = spark.createDataFrame([("b", 7)], "party string, dialog_count bigint")
    saved = {"fingerprint": workload.pool_fingerprint(pool), "count_cap": 5}
    got = {tuple(r) for r in workload.resume_counts(pool, facts, done, saved, cap=5).collect()}
    assert got == {("a", 2), ("b", 7)}
    with pytest.raises(ValueError):
        workload.resume_counts(pool, facts, done, saved, cap=6)
    with pytest.raises(ValueError):
        workload.resume_counts(facts, facts, done, saved, cap=5)
