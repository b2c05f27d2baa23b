"""The record model derived from the given tables.

Every view is one SQL text that reads the same in Spark and in DuckDB, so a query and its check start from
equal rows. Views grow with their tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mendwork.functions.durable import CODEC, exists, new_stage, stage_dir
from mendwork.operators import text_index
from mendwork.operators.text_index import TextIndex

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {
    # customers with their identifier
    "cust": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
               lpad(CAST(c_custkey AS VARCHAR(20)), 9, '0') AS number,
               CASE WHEN c_custkey % 3 = 0 THEN 'organization' ELSE 'person' END AS kind,
               concat('urn:demo:', CASE WHEN c_custkey % 3 = 0 THEN 'organization' ELSE 'person' END,
                      ':identifier-no:', lpad(CAST(c_custkey AS VARCHAR(20)), 9, '0')) AS urn
        FROM customer""",
    "dialog": """
        SELECT o_orderkey AS id, urn AS party,
               concat('urn:demo:resource:', replace(o_orderpriority, ' ', '-')) AS service,
               CASE WHEN o_orderkey % 6 = 0 THEN 'correspondenceservice' ELSE 'generic' END AS service_type,
               concat('org', CAST(c_nationkey AS VARCHAR(9))) AS org,
               CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 7 ELSE 9 END AS status_id,
               o_orderdate AS content_updated_at,
               CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL '30' DAY END AS visible_from,
               CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL '2000' DAY END AS expires_at,
               o_orderkey % 50 = 0 AS deleted,
               CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 9 ELSE 24 END AS mask,
               o_orderkey % 9 = 0 AS is_api_only,
               o_orderkey % 2 = 0 AS has_unopened,
               o_orderkey % 3 <> 0 AS is_seen
        FROM orders JOIN cust ON c_custkey = o_custkey""",
    "transmission": """
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS dialog_id,
               CASE WHEN l_linenumber = 7 THEN 7 WHEN l_linenumber = 5 THEN 8 ELSE 1 END AS type_id
        FROM lineitem""",
    "activity": """
        SELECT id, dialog_id, transmission_id, type_id, created_at
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_at, type_id) AS rn
              FROM (SELECT DISTINCT l_orderkey AS dialog_id, l_orderkey * 10 + l_linenumber AS transmission_id,
                           (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS id,
                           CASE l_returnflag WHEN 'R' THEN 4 WHEN 'A' THEN 16 ELSE 17 END AS type_id,
                           l_shipdate AS created_at
                    FROM lineitem) x) y
        WHERE rn = 1""",
    "seen_log": "SELECT l_orderkey AS dialog_id, l_shipdate AS created_at FROM lineitem",
    "context": """
        SELECT o_orderkey + 1000000 AS id, o_orderkey AS dialog_id, o_orderkey % 5 AS revision
        FROM orders WHERE o_orderstatus <> 'P'""",
    "context_label": """
        SELECT id + 1000000 AS context_id, 1 AS label_id, content_updated_at AS created_at FROM dialog WHERE (mask & 1) <> 0
        UNION ALL SELECT id + 1000000, 2, content_updated_at FROM dialog WHERE (mask & 2) <> 0
        UNION ALL SELECT id + 1000000, 4, content_updated_at FROM dialog WHERE (mask & 8) <> 0
        UNION ALL SELECT id + 1000000, 5, content_updated_at FROM dialog WHERE (mask & 16) <> 0""",
    # permissions: two groups over parties of three segments; one party set is in both groups
    "permission": """
        SELECT DISTINCT 0 AS group_no, party, service FROM dialog JOIN cust ON urn = party
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND service < 'urn:demo:resource:3'
        UNION ALL
        SELECT DISTINCT 1, party, service FROM dialog JOIN cust ON urn = party
        WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') AND service >= 'urn:demo:resource:2'""",
    "actor_name": """
        SELECT c_custkey * 10 + 1 AS id, urn AS actor_id,
               CASE WHEN c_nationkey BETWEEN 5 AND 9 THEN concat(c_name, ' ', c_mktsegment)
                    ELSE concat(c_mktsegment, ' ', c_name) END AS name,
               first_order AS created_at
        FROM cust JOIN customer_start ON o_custkey = c_custkey WHERE c_acctbal >= 0
        UNION ALL
        SELECT c_custkey * 10 + 2, urn, concat('OLD ', c_name), first_order - INTERVAL '10' DAY
        FROM cust JOIN customer_start ON o_custkey = c_custkey WHERE c_nationkey < 5
        UNION ALL
        SELECT c_custkey * 10 + 3, concat('urn:demo:organizationnumber:', number), concat(c_mktsegment, ' ', c_name),
               first_order + INTERVAL '5' DAY
        FROM cust JOIN customer_start ON o_custkey = c_custkey WHERE kind = 'organization' AND c_nationkey >= 20
        UNION ALL
        SELECT c_custkey * 10 + 4, urn, CAST(NULL AS VARCHAR(20)), first_order + INTERVAL '90' DAY
        FROM cust JOIN customer_start ON o_custkey = c_custkey WHERE c_nationkey = 3""",
    "customer_start": "SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey",
    "actor": """
        SELECT id * 10 + 1 AS id, id AS activity_id, 'DialogActivityPerformedByActor' AS discriminator,
               1 AS actor_type_id,
               CASE id % 4 WHEN 0 THEN o_custkey * 10 + 1 WHEN 1 THEN o_custkey * 10 + 2 WHEN 2 THEN o_custkey * 10 + 3 END
                 AS actor_name_entity_id
        FROM activity JOIN orders ON o_orderkey = dialog_id WHERE created_at < CAST('2001-06-01' AS TIMESTAMP)
        UNION ALL
        SELECT id * 10 + 2, id, 'DialogSeenLogActor', 1, o_custkey * 10 + 1
        FROM activity JOIN orders ON o_orderkey = dialog_id""",
    # staged rows with planned faults
    "staging_actor_base": """
        SELECT CASE WHEN id % 23 = 0 THEN dialog_id + 1 ELSE dialog_id END AS dialog_id,
               CASE WHEN id % 29 = 0 THEN -id ELSE id END AS dialog_activity_id,
               CASE WHEN id % 31 = 0 THEN created_at + INTERVAL '1' DAY ELSE created_at END AS source_ts,
               CASE WHEN c_nationkey = 13 THEN concat('urn:demo:robot:', number)
                    WHEN kind = 'organization' AND c_nationkey >= 22 THEN concat('urn:demo:organizationnumber:', number)
                    ELSE urn END AS actor_id,
               concat(c_mktsegment, ' ', c_name) AS actor_name,
               CASE WHEN id % 37 = 0 THEN 'CorrespondenceConfirmed'
                    WHEN type_id = 16 THEN 'CorrespondenceOpened'
                    WHEN type_id = 17 THEN 'CorrespondenceConfirmed'
                    ELSE 'TransmissionOpened' END AS activity_type,
               id
        FROM activity JOIN orders ON o_orderkey = dialog_id JOIN cust ON c_custkey = o_custkey""",
    "staging_actor_raw": """
        SELECT dialog_id, dialog_activity_id, source_ts, actor_id, actor_name, activity_type FROM staging_actor_base
        UNION ALL
        SELECT dialog_id, dialog_activity_id, source_ts, actor_id, actor_name, activity_type FROM staging_actor_base
        WHERE activity_type = 'CorrespondenceOpened'
        UNION ALL
        SELECT dialog_id, dialog_activity_id, source_ts, actor_id, 'SOMEONE ELSE', activity_type FROM staging_actor_base
        WHERE id % 11 = 0""",
    "staging_actor": """
        SELECT dialog_id, dialog_activity_id, source_ts,
               CASE WHEN actor_id LIKE 'urn:demo:organizationnumber:%'
                    THEN concat('urn:demo:organization:identifier-no:', split_part(actor_id, ':', 4))
                    ELSE actor_id END AS actor_id,
               actor_name, activity_type
        FROM staging_actor_raw""",
    "staging_label": """
        SELECT CASE WHEN l_suppkey % 17 = 0 THEN -l_orderkey ELSE l_orderkey END AS dialog_id,
               l_shipdate AS source_ts,
               CASE WHEN c_nationkey = 13 THEN concat('urn:demo:robot:', number)
                    WHEN kind = 'organization' AND c_nationkey = 14 THEN concat(urn, 'X') ELSE urn END AS actor_id,
               CASE l_linenumber WHEN 1 THEN 'Bin' WHEN 2 THEN 'Archive' WHEN 3 THEN 'MarkedAsUnopened'
                    WHEN 4 THEN 'Default' WHEN 5 THEN 'Sent' ELSE 'Archive' END AS system_label
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN cust ON c_custkey = o_custkey""",
    "units": """
        SELECT number AS org_no, concat('Main ', c_name) AS name FROM cust WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "subunits": """
        SELECT number AS org_no, concat('Sub ', c_name) AS name FROM cust WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')""",
    "candidate": """
        SELECT o_orderkey AS entity_id, o_orderdate AS enqueued_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '1' DAY END AS processed_at,
               CASE WHEN o_orderstatus = 'F' THEN concat('worker-', CAST(o_custkey % 4 AS VARCHAR(9))) END AS worker_id,
               CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_orderkey % 10 < 3 THEN 'skipped_state_changed'
                    WHEN o_orderkey % 10 = 9 THEN NULL ELSE 'updated' END AS outcome
        FROM orders""",
    "batch_log": """
        SELECT min(event_id) AS batch_id, event_type AS worker_id, min(ts) AS started_at,
               CASE WHEN count(*) = 1 THEN NULL ELSE max(ts) END AS finished_at,
               count(*) AS claimed,
               count(CASE WHEN value > 20 THEN 1 END) AS updated,
               count(CASE WHEN value <= 20 THEN 1 END) AS skipped
        FROM events GROUP BY date_trunc('hour', ts), event_type""",
    "party_dist": "SELECT party, count(*) AS estimated_count FROM dialog GROUP BY party",
    "pr_party": """
        SELECT c_custkey AS id, CASE kind WHEN 'person' THEN 'p' ELSE 'o' END AS short_prefix, number AS unprefixed
        FROM cust WHERE c_acctbal > 1000""",
    "pr_party_resource": """
        SELECT DISTINCT o_custkey AS party_id, l_suppkey AS resource_id
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
    "pr_resource": "SELECT s_suppkey AS id, lower(s_name) AS unprefixed FROM supplier",
    "party_service": """
        SELECT DISTINCT p.unprefixed, p.short_prefix,
               concat('urn:demo:', CASE p.short_prefix WHEN 'p' THEN 'person' ELSE 'organization' END,
                      ':identifier-no:', p.unprefixed) AS party,
               concat('urn:demo:resource:', r.unprefixed) AS service
        FROM pr_party p JOIN pr_party_resource pr ON pr.party_id = p.id JOIN pr_resource r ON r.id = pr.resource_id""",
    "run": """
        SELECT concat('case_', CAST(user_id AS VARCHAR(20))) AS case_name, event_type AS variant,
               event_id % 2 + 1 AS round, user_id % 30 AS party_count, user_id % 50 AS service_count,
               CASE WHEN event_id % 20 <> 0 THEN value END AS exec_ms,
               CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 100 END AS shared_read,
               CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 6 = 0 THEN 0 ELSE event_id % 1000 END AS shared_hit,
               event_id % 7 AS shared_dirtied
        FROM events""",
    "metric": """
        SELECT concat('case_', CAST(user_id AS VARCHAR(20))) AS case_id, event_type AS variant,
               event_id % 2 AS run_index, event_id % 3 + 1 AS pass, user_id % 30 AS party_count, user_id % 50 AS service_count,
               CASE user_id % 4 WHEN 0 THEN 'very_hot' WHEN 1 THEN 'hot' WHEN 2 THEN 'medium' ELSE 'long_tail' END
                 AS estimated_dialog_count_band,
               value AS execution_time_ms, value / 8 AS planning_time_ms,
               CAST(event_id % 1000 AS DOUBLE) AS shared_hit_blocks, CAST(event_id % 5 AS DOUBLE) AS shared_read_blocks,
               CAST(event_id % 11 AS DOUBLE) AS temp_read_blocks, CAST(event_id % 13 AS DOUBLE) AS temp_written_blocks,
               CAST(event_id % 50 AS DOUBLE) / 4 AS shared_io_read_time_ms,
               CASE WHEN event_id % 1000 + event_id % 5 > 0
                    THEN (event_id % 1000) / CAST(event_id % 1000 + event_id % 5 AS DOUBLE) END AS shared_hit_ratio,
               concat('IX_', CAST(event_id % 9 AS VARCHAR(9)), ':', CAST(event_id % 4 + 1 AS VARCHAR(9)),
                      '|IX_shared:1') AS index_names,
               concat('Limit:1|Node', CAST(user_id % 12 AS VARCHAR(9)), ':', CAST(event_id % 3 + 1 AS VARCHAR(9))) AS node_types
        FROM events""",
    "plan_line": """
        SELECT concat('log_', event_type) AS file, CAST(floor(event_id / 1000) AS BIGINT) AS chunk, event_id AS pos,
               event_id AS line_no,
               CASE event_id % 10
                 WHEN 0 THEN concat('EXPLAIN sql/variant_', event_type, '.sql cases/case_', CAST(user_id AS VARCHAR(20)), '.json')
                 WHEN 1 THEN concat('Limit  (cost=0.5..9 rows=101 width=16) (actual time=0.1..', CAST(user_id AS VARCHAR(20)),
                                    '.5 rows=101 loops=1)')
                 WHEN 2 THEN concat('  Buffers: shared hit=', CAST(event_id AS VARCHAR(20)), ' read=', CAST(user_id AS VARCHAR(20)))
                 WHEN 3 THEN concat('        ->  Index Scan using "IX_Tab', CAST(user_id % 7 AS VARCHAR(9)), '" on "Table',
                                    CAST(user_id % 5 AS VARCHAR(9)), '" d  (cost=1..2 rows=3 width=4) (actual time=1.0..2.0   rows=3 loops=1)')
                 WHEN 4 THEN concat('    Buffers: shared hit=5 dirtied=', CAST(user_id AS VARCHAR(20)))
                 WHEN 5 THEN CASE WHEN user_id % 3 = 0 THEN 'Planning:' ELSE '  Buffers: temp read=7' END
                 WHEN 6 THEN concat('  Buffers: shared hit=', CAST(user_id AS VARCHAR(20)))
                 WHEN 7 THEN concat('Execution Time: ', CAST(user_id AS VARCHAR(20)), '.25 ms')
                 WHEN 8 THEN '  Sort Method: quicksort  Memory: 25kB'
                 ELSE concat('   Rows Removed by Filter:    ', CAST(user_id AS VARCHAR(20))) END AS line
        FROM events""",
    "plan_json": """
        SELECT event_id AS run_id,
               concat('[{"Plan":{"Node Type":"Limit","Actual Rows":', CAST(user_id AS VARCHAR(20)),
                      ',"Actual Loops":1,"Shared Hit Blocks":', CAST(event_id % 1000 AS VARCHAR(20)),
                      ',"Shared Read Blocks":', CAST(event_id % 5 AS VARCHAR(20)),
                      ',"Plans":[{"Node Type":"Nested Loop","Rows Removed by Join Filter":', CAST(event_id % 6 AS VARCHAR(20)),
                      ',"Plans":[{"Node Type":"Index Scan","Index Name":"IX_', CAST(user_id % 9 AS VARCHAR(9)),
                      '","Relation Name":"Dialog","Filter":"(x = ', chr(92), '"Node Type', chr(92), '":', chr(92), '"Decoy', chr(92), '")","Rows Removed by Filter":',
                      CAST(event_id % 4 AS VARCHAR(20)), '},{"Node Type":"Index Scan","Index Name":"IX_',
                      CAST(event_id % 3 AS VARCHAR(9)), '"}]}]},"Planning Time":1.25,"Execution Time":',
                      CAST(user_id AS VARCHAR(20)), '.5}]') AS plan
        FROM events""",
}

# Views that a whole repair reads several times: derived once, written, and read back as the tables they stand for.
STORED = (
    "staging_label", "staging_actor_base", "staging_actor", "actor_name", "activity", "actor", "context_label",
    "party_service",
)

# Tables that are dealt out by a stored view's own key before it reads them, so that its steps share one shuffle: the table, its
# columns that the view reads, and the key as the view writes it.
DEALT = {
    "activity": (
        "lineitem",
        ("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate"),
        "(l_orderkey * 10 + l_linenumber) * 100000 + l_partkey",
    ),
}

# Tables that a stored view's joins shuffle with fewer bytes: the table, and its columns that the view reads, each as far as the
# view tells its values apart. The staged labels only ask whether 17 divides the supplier.
NARROWED = {
    "staging_label": (
        "lineitem",
        ("l_orderkey", "l_shipdate", "l_linenumber", "CASE WHEN l_suppkey % 17 = 0 THEN 0 ELSE 1 END AS l_suppkey"),
    ),
}

# Bytes of a shuffle that one task of a stored view reads at most, where Spark joins parts (its own limit is 64 MB): rows of
# numbers take some twenty times that in the maps and sorts of a task.
TASK_BYTES = 16 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Within it, what is run reads at most ``TASK_BYTES`` a task of joined parts; a lower limit of the session stays."""
    given = spark.conf.get(_ADVISORY)
    number, unit = re.fullmatch(r"(\d+)([bkmg]?)b?", given.strip().lower()).groups()
    if int(number) << {"k": 10, "m": 20, "g": 30}.get(unit, 0) <= TASK_BYTES:
        yield
        return
    spark.conf.set(_ADVISORY, str(TASK_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_ADVISORY, given)


_NAME = re.compile(r"\b[a-z_]+\b")


def _needs(text: str, seen: list[str], given: tuple[str, ...]) -> None:
    for name in _NAME.findall(text):
        if name in VIEWS and name not in seen and name not in given:
            _needs(VIEWS[name], seen, given)
            if name not in seen:
                seen.append(name)


def with_views(body: str, given: tuple[str, ...] = ()) -> str:
    """``body`` preceded by the views it mentions, in dependency order, but for those ``given`` as tables.

    ``body`` may start with its own ``WITH``.
    """
    needed: list[str] = []
    _needs(body, needed, given)
    own = body.strip()
    if not needed:
        return own
    head = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    if own.upper().startswith("WITH "):
        return f"WITH {head},\n{own[5:]}"
    return f"WITH {head}\n{own}"


# Stored views of the applications of this process: path and schema by (stage folder, tables, view).
_WRITTEN: dict[tuple[str, str, str], tuple[str, StructType]] = {}

# Built text indexes, likewise; the given tables are small, so few buckets.
_INDEXES: dict[tuple[str, str, str], TextIndex] = {}
INDEX_BUCKETS = 8


class Views:
    """The views over one folder of parquet tables, as DataFrames: ``v.dialog``, ``v.orders``.

    Stored views stand for tables: they are written once for an application and folder, and read by all queries.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._sf_dir = sf_dir

    def prepare(self) -> None:
        """Write all stored views that are not there yet."""
        for name in STORED:
            self._store(name)
        self.text_index()

    def text_index(self) -> TextIndex:
        """The positional index of ``documents``, built once for an application and folder."""
        key = (stage_dir(self.spark), self._sf_dir, "text_index")
        if key not in _INDEXES or not exists(self.spark, _INDEXES[key].path):
            _INDEXES[key] = text_index.build(self.documents, new_stage(self.spark), buckets=INDEX_BUCKETS)
        return _INDEXES[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._sf_dir}/{name}.parquet")

    def sql(self, body: str, view: str | None = None) -> DataFrame:
        """The rows of ``body``; as the stored view ``view`` reads its tables, if one is named."""
        text = with_views(body, given=STORED)
        dealt, columns, key = DEALT.get(view, (None, (), ""))
        narrowed, narrow = NARROWED.get(view, (None, ()))
        for name in STORED:
            if re.search(rf"\b{name}\b", text):
                self._store(name).createOrReplaceTempView(name)
        for name in BASE_TABLES:
            if re.search(rf"\b{name}\b", text):
                rows = self.table(name)
                rows = rows.select(*columns).repartition(F.expr(key)) if name == dealt else rows
                rows = rows.selectExpr(*narrow) if name == narrowed else rows
                rows.createOrReplaceTempView(name)
        return self.spark.sql(text)

    def _store(self, name: str) -> DataFrame:
        key = (stage_dir(self.spark), self._sf_dir, name)
        if key not in _WRITTEN or not exists(self.spark, _WRITTEN[key][0]):
            df, path = self.sql(VIEWS[name], name), new_stage(self.spark)
            with small_tasks(self.spark):
                df.write.option("compression", CODEC).parquet(path)
            _WRITTEN[key] = (path, df.schema)
        path, schema = _WRITTEN[key]
        return self.spark.read.schema(schema).parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name in STORED:
            return self._store(name)
        if name in VIEWS:
            return self.sql(f"SELECT * FROM {name}")
        if name in BASE_TABLES:
            return self.table(name)
        raise AttributeError(name)
