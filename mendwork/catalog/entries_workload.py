"""Sampling and workload queries and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.catalog.views import Views
from mendwork.functions.columns import party_key, stratum
from mendwork.functions.durable import durable, new_stage
from mendwork.functions.text import build_tokens
from mendwork.operators import workload as w
from mendwork.sources.pools import read_party_service_pool

SEED = 7


def _joined(column: str) -> Column:
    return F.array_join(F.col(column), ",").alias(column)


def w1_sample_distinct(v: Views) -> DataFrame:
    return w.sample_distinct(v.dialog, "party", 60, SEED)


def w1_sample_distinct_widening(v: Views) -> DataFrame:
    # The first share is far too small at every size, so the sample is doubled several times.
    return w.sample_distinct_widening(v.dialog, "party", 60, SEED, fraction=1 / 4096)


def w2_heavy_hitters(v: Views) -> DataFrame:
    return w.heavy_hitters(v.dialog, "party", 50)


def w2_heavy_hitters_sketch(v: Views) -> DataFrame:
    return w.heavy_hitters(v.dialog, "service", 5, exact=False)


def w2_heavy_hitters_two_pass(v: Views) -> DataFrame:
    """The commonest words of all documents; far more words than counters."""
    words = build_tokens(v.documents).select(F.explode("tokens").alias("word"))
    return w.heavy_hitters_two_pass(words, "word", 20, counters=2000)


def w3_written_pool(v: Views) -> DataFrame:
    """The whole pool written one object per line and read back."""
    path = new_stage(v.spark)
    w.write_pool(v.party_dist.join(v.party_service.groupBy("party").agg(F.collect_set("service").alias("services")), "party"), path)
    pool, _ = read_party_service_pool(v.spark, path, lines=True)
    return pool.select("party", "estimated_count", _joined("services"))


def w3_hot_party_services(v: Views) -> DataFrame:
    found = w.hot_party_services(v.party_dist, v.pr_party, v.pr_party_resource, v.pr_resource, 30)
    return found.select("party", "estimated_count", _joined("services"))


def w3_pool_json(v: Views) -> DataFrame:
    found = w.hot_party_services(v.party_dist, v.pr_party, v.pr_party_resource, v.pr_resource, 30)
    return w.pool_json(found)


def w4_party_key(v: Views) -> DataFrame:
    urns = v.sql(
        "SELECT DISTINCT actor_id AS urn FROM staging_actor_raw UNION ALL SELECT DISTINCT service FROM dialog"
    )
    return urns.withColumn("k", party_key(F.col("urn"))).select("urn", "k.unprefixed", "k.short_prefix")


def w5_sampled_distribution(v: Views) -> DataFrame:
    return w.sampled_distribution(v.dialog, "party", 20.0, SEED)


def w5_distribution_of(v: Views) -> DataFrame:
    # The scaling alone, of all dialogs taken as a sample of three tenths.
    return w.distribution_of(v.dialog, "party", 30.0)


def w6_band_sample(v: Views) -> DataFrame:
    return w.band_sample(v.party_dist, 40, SEED)


def w7_merge_candidate_sources(v: Views) -> DataFrame:
    hitters, sampled = w.split_limit(60)
    scaled = v.party_dist.withColumn("estimated_count", F.col("estimated_count") + 1)
    return w.merge_candidate_sources(
        w.heavy_hitters(v.dialog, "party", hitters), w.band_sample(scaled, sampled, SEED).select("party", "estimated_count")
    )


def w8_rank_bands(v: Views) -> DataFrame:
    return w.rank_bands(v.party_dist)


def w9_party_services(v: Views) -> DataFrame:
    keys = v.party_dist.select(party_key(F.col("party")).alias("k")).select("k.*")
    found = w.party_services(keys, v.pr_party, v.pr_party_resource, v.pr_resource)
    return found.select("unprefixed", "short_prefix", _joined("services"))


def _eligible(v: Views, min_bucket: int = 3) -> DataFrame:
    banded = w.rank_bands(v.party_dist)
    keys = banded.select(party_key(F.col("party")).alias("k")).select("k.*")
    return w.eligibility(
        banded, w.party_services(keys, v.pr_party, v.pr_party_resource, v.pr_resource), min_bucket
    )


def w10_eligibility(v: Views) -> DataFrame:
    return _eligible(v, 38).select("party", "estimated_count", "band", _joined("services"), "selected", "skip_reason")


def _selected(v: Views, strategy: str, n: int) -> DataFrame:
    return w.select_candidates(_eligible(v), strategy, n)


def w11_select_candidates(v: Views) -> DataFrame:
    return _selected(v, "stratified", 60).select("seed_no", "party", "band")


def w11_select_candidates_top(v: Views) -> DataFrame:
    return _selected(v, "top", 60).select("seed_no", "party", "band")


def w12_case_parties(v: Views) -> DataFrame:
    candidates = durable(_selected(v, "stratified", 60))
    seeds = candidates.select("seed_no", "party", "band", F.lit(8).alias("party_bucket"))
    return w.case_parties(candidates, seeds).select("seed_no", "member")


def _w13(v: Views) -> tuple[DataFrame, DataFrame]:
    pool = v.party_service.select(F.col("unprefixed").cast("long").alias("case_no"), "service")
    cases = pool.select("case_no").distinct().withColumn("service_bucket", F.lit(5))
    return pool, cases


def w13_case_services(v: Views) -> DataFrame:
    return w.case_services(*_w13(v), seed=SEED).select("case_no", _joined("services"))


def w13_payload_json(v: Views) -> DataFrame:
    chosen = w.case_services(*_w13(v), seed=SEED)
    party = F.array(F.concat(F.lit("p"), F.col("case_no").cast("string")))
    return chosen.select("case_no", w.payload_json(party, F.col("services")).alias("payload"))


_BUCKETS = [(1, 1), (1, 20), (5, 5), (20, 20)]


def w14_build_cases(v: Views) -> DataFrame:
    candidates = durable(_selected(v, "stratified", 37))
    return w.build_cases(candidates, _BUCKETS, 45, SEED).select(
        "case_id", "hot_party", "band", "party_count", "service_count", _joined("parties"), _joined("services")
    )


def w15_single_party_cases(v: Views) -> DataFrame:
    cases = w.single_party_cases(durable(_selected(v, "stratified", 50)), [1, 5, 20])
    return cases.select("case_id", "party", "band", "service_count", _joined("services"))


def _groups(v: Views) -> tuple[DataFrame, DataFrame]:
    services = v.party_service.select("service")
    return w.permission_groups(v.dialog.select("party"), services, p=90, s=5, g=7, seed=SEED)


def w16_permission_groups(v: Views) -> DataFrame:
    return _groups(v)[0]


def w16_permission_group_services(v: Views) -> DataFrame:
    return _groups(v)[1]


def w17_correlated_groups(v: Views) -> DataFrame:
    pool = v.party_service.groupBy("party").agg(F.collect_set("service").alias("services"))
    return w.correlated_groups(pool, 50, 4, SEED).select("party", _joined("services"))


def _counts(v: Views) -> DataFrame:
    """Dialogs per customer, also those without any."""
    return w.capped_counts(v.cust.select(F.col("urn").alias("party")), v.dialog, "party")


def w18_capped_counts(v: Views) -> DataFrame:
    return _counts(v)


def _strata(v: Views) -> DataFrame:
    # Line counts per part, spread over the strata by the part size.
    return v.sql(
        """SELECT CAST(p_partkey AS VARCHAR(20)) AS party, CASE WHEN p_size < 5 THEN 0 ELSE count(*) * p_size * p_size END AS dialog_count
           FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_size"""
    )


def w19_stratum(v: Views) -> DataFrame:
    return _strata(v).select("party", "dialog_count", stratum(F.col("dialog_count")).alias("stratum"))


def w20_stratified_balanced(v: Views) -> DataFrame:
    return w.stratified_sample(_strata(v), 40, "balanced", SEED).select("party", "stratum")


def w20_stratified_proportional(v: Views) -> DataFrame:
    return w.stratified_sample(_strata(v), 43, "proportional", SEED).select("party", "stratum")


def w20_uniform(v: Views) -> DataFrame:
    return w.stratified_sample(_strata(v), 43, "uniform", SEED).select("party", "stratum")


def w21_strata_summary(v: Views) -> DataFrame:
    everything = _strata(v).withColumn("stratum", stratum(F.col("dialog_count")))
    return w.strata_summary(everything, w.stratified_sample(_strata(v), 43, "uniform", SEED))


def w22_resume_counts(v: Views) -> DataFrame:
    pool = v.cust.select(F.col("urn").alias("party"))
    done = _counts(v).where(F.md5("party") < "8").withColumn("dialog_count", F.lit(99).cast("long"))
    saved = {"fingerprint": w.pool_fingerprint(pool), "count_cap": None}
    return w.resume_counts(pool, v.dialog, done, saved)


_RANKED = "SELECT party, estimated_count, row_number() OVER (ORDER BY estimated_count DESC, party) AS rn, count(*) OVER () AS n FROM party_dist"


def _band_sample_sql(limit: int, plus: int = 0) -> str:
    per_band = -(-limit // 4)
    return f"""SELECT party, estimated_count + {plus} AS estimated_count, band FROM (
        SELECT *, row_number() OVER (PARTITION BY band ORDER BY md5(concat(party, '{SEED}'))) AS br FROM (
          SELECT party, estimated_count, CASE WHEN f <= 0.01 THEN 'very_hot' WHEN f <= 0.05 THEN 'hot' WHEN f <= 0.25 THEN 'medium'
                 ELSE 'long_tail' END AS band
          FROM (SELECT party, estimated_count, cume_dist() OVER (ORDER BY estimated_count DESC, party) AS f FROM party_dist) a) b) c
        WHERE br <= {per_band} ORDER BY estimated_count DESC, party LIMIT {limit}"""


_BANDED = f"""SELECT party, estimated_count, CASE WHEN (rn - 1) / n < 0.01 THEN 'very_hot' WHEN (rn - 1) / n < 0.05 THEN 'hot'
    WHEN (rn - 1) / n < 0.25 THEN 'medium' ELSE 'long_tail' END AS band FROM ({_RANKED}) r"""
_LISTED = """SELECT party, string_agg(service, ',' ORDER BY service) AS services, count(*) AS k FROM party_service GROUP BY party"""


def _selected_sql(strategy: str, n: int) -> str:
    order = (
        "turn, CASE band WHEN 'very_hot' THEN 0 WHEN 'hot' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END"
        if strategy == "stratified"
        else "estimated_count DESC, party"
    )
    return f"""SELECT row_number() OVER (ORDER BY {order}) - 1 AS seed_no, party, band, estimated_count, services FROM (
        SELECT b.*, services, row_number() OVER (PARTITION BY band ORDER BY estimated_count DESC, b.party) AS turn
        FROM ({_BANDED}) b JOIN ({_LISTED}) s ON s.party = b.party WHERE k >= 3) x ORDER BY 1 LIMIT {n}"""


_BAND_NO = "CASE {0} WHEN 'very_hot' THEN 0 WHEN 'hot' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END"


def _filled(seeds: str, candidates: str, key: str) -> str:
    """Every seed's members by brute force over all candidates."""
    return f"""SELECT * FROM (SELECT s.*, c.party AS member, row_number() OVER (PARTITION BY {key} ORDER BY
          CASE WHEN c.party = s.party THEN 0 ELSE 1 END, abs({_BAND_NO.format('c.band')} - {_BAND_NO.format('s.band')}),
          c.estimated_count DESC, c.party) AS place
        FROM ({seeds}) s, ({candidates}) c) f WHERE place <= party_bucket"""


_C14 = _selected_sql("stratified", 37)
_TRIES = f"""SELECT a AS attempt, c.party, c.band, b.p AS party_bucket, b.s AS service_bucket
    FROM range(148) r(a) JOIN ({_C14}) c ON c.seed_no = a % 37
    JOIN (VALUES (0, 1, 1), (1, 1, 20), (2, 5, 5), (3, 20, 20)) b(i, p, s) ON b.i = a % 4"""
_STRATA = """SELECT CAST(p_partkey AS VARCHAR) AS party, CASE WHEN p_size < 5 THEN 0 ELSE count(*) * p_size * p_size END AS dialog_count
    FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_size"""
_LABELLED = f"""SELECT *, CASE WHEN dialog_count = 0 THEN '0' WHEN dialog_count <= 10 THEN '1-10' WHEN dialog_count <= 100 THEN '11-100'
    WHEN dialog_count <= 1000 THEN '101-1000' WHEN dialog_count <= 10000 THEN '1001-10000' ELSE '10001+' END AS stratum FROM ({_STRATA}) s"""
_DRAWN = f"""SELECT party, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5(concat(party, '{SEED}')), party) AS rn,
    count(*) OVER (PARTITION BY stratum) AS cap FROM ({_LABELLED}) l"""
_PER_CUSTOMER = "SELECT urn AS party, count(d.id) AS dialog_count FROM cust LEFT JOIN dialog d ON d.party = urn GROUP BY urn"


def _drawn(share: str) -> str:
    """A dialog's place in a row sample."""
    return f"CAST(concat('0x', substr(md5(concat(CAST(id AS VARCHAR), '{SEED}')), 1, 8)) AS BIGINT) < CAST(floor({share} * 4294967296) AS BIGINT)"

ENTRIES = {
    "w1_sample_distinct": (
        w1_sample_distinct,
        f"SELECT party FROM (SELECT DISTINCT party FROM dialog) d ORDER BY md5(concat(party, '{SEED}')), party LIMIT 60",
    ),
    "w1_sample_distinct_widening": (
        w1_sample_distinct_widening,
        f"""WITH rounds AS (SELECT r, (SELECT count(DISTINCT party) FROM dialog WHERE r >= 12 OR {_drawn('power(2, r - 12)')}) AS n FROM range(13) t(r)),
                 enough AS (SELECT min(r) AS r FROM rounds WHERE n >= 60 OR r = 12)
            SELECT party FROM (SELECT DISTINCT party FROM dialog, enough WHERE r >= 12 OR {_drawn('power(2, r - 12)')}) d
            ORDER BY md5(concat(party, '{SEED}')), party LIMIT 60""",
    ),
    "w2_heavy_hitters": (
        w2_heavy_hitters,
        "SELECT party, estimated_count FROM party_dist ORDER BY estimated_count DESC, party LIMIT 50",
    ),
    # Five services fit the sketch, so its counts are exact.
    "w2_heavy_hitters_sketch": (
        w2_heavy_hitters_sketch,
        "SELECT service, count(*) AS estimated_count FROM dialog GROUP BY service",
    ),
    "w2_heavy_hitters_two_pass": (
        w2_heavy_hitters_two_pass,
        r"""SELECT word, count(*) AS estimated_count FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM documents) d
            GROUP BY word ORDER BY estimated_count DESC, word LIMIT 20""",
    ),
    "w3_written_pool": (
        w3_written_pool,
        """SELECT party, h.estimated_count, string_agg(DISTINCT service, ',' ORDER BY service) AS services
           FROM party_dist h JOIN party_service s USING (party) GROUP BY party, h.estimated_count""",
    ),
    "w3_hot_party_services": (
        w3_hot_party_services,
        f"""SELECT h.party, estimated_count, services FROM party_dist h
            JOIN ({_LISTED}) s ON s.party = h.party ORDER BY estimated_count DESC, h.party LIMIT 30""",
    ),
    "w3_pool_json": (
        w3_pool_json,
        f"""SELECT concat('[', string_agg(concat('{{"Party":"', party, '","EstimatedDialogCount":', CAST(estimated_count AS VARCHAR),
                   ',"Services":["', replace(services, ',', '","'), '"]}}'), ',' ORDER BY estimated_count DESC, party), ']') AS pool
            FROM (SELECT h.party, estimated_count, services FROM party_dist h
            JOIN ({_LISTED}) s ON s.party = h.party ORDER BY estimated_count DESC, h.party LIMIT 30) x""",
    ),
    "w4_party_key": (
        w4_party_key,
        """SELECT urn, CASE WHEN k IS NOT NULL THEN split_part(urn, ':', -1) END AS unprefixed, k AS short_prefix FROM (
             SELECT urn, CASE WHEN contains(urn, ':person:identifier-no:') THEN 'p'
                              WHEN contains(urn, ':organization:identifier-no:') THEN 'o' END AS k
             FROM (SELECT DISTINCT actor_id AS urn FROM staging_actor_raw UNION ALL SELECT DISTINCT service FROM dialog) u) x""",
    ),
    "w5_sampled_distribution": (
        w5_sampled_distribution,
        f"""SELECT party, count(*) AS sample_count, greatest(1, CAST(round(count(*) / 0.2) AS BIGINT)) AS estimated_count
           FROM dialog WHERE {_drawn('0.2')} GROUP BY party""",
    ),
    "w5_distribution_of": (
        w5_distribution_of,
        """SELECT party, count(*) AS sample_count, greatest(1, CAST(round(count(*) / 0.3) AS BIGINT)) AS estimated_count
           FROM dialog GROUP BY party""",
    ),
    "w6_band_sample": (w6_band_sample, _band_sample_sql(40)),
    "w7_merge_candidate_sources": (
        w7_merge_candidate_sources,
        f"""WITH hit AS (SELECT party, estimated_count FROM party_dist ORDER BY estimated_count DESC, party LIMIT 30),
                 smp AS ({_band_sample_sql(30, 1)})
            SELECT * FROM hit UNION ALL SELECT party, estimated_count FROM smp WHERE party NOT IN (SELECT party FROM hit)""",
    ),
    "w8_rank_bands": (w8_rank_bands, _BANDED),
    "w9_party_services": (
        w9_party_services,
        """SELECT unprefixed, short_prefix, string_agg(service, ',' ORDER BY service) AS services FROM party_service
           WHERE party IN (SELECT party FROM party_dist) GROUP BY unprefixed, short_prefix""",
    ),
    "w10_eligibility": (
        w10_eligibility,
        f"""SELECT b.party, estimated_count, band, coalesce(services, '') AS services, coalesce(k, 0) >= 38 AS selected,
                   CASE WHEN coalesce(k, 0) < 38 THEN concat('only_', CAST(coalesce(k, 0) AS VARCHAR), '_service_resources_below_min_bucket_38')
                        ELSE '' END AS skip_reason
            FROM ({_BANDED}) b LEFT JOIN ({_LISTED}) s ON s.party = b.party""",
    ),
    "w11_select_candidates": (
        w11_select_candidates,
        f"SELECT seed_no, party, band FROM ({_selected_sql('stratified', 60)}) s",
    ),
    "w11_select_candidates_top": (
        w11_select_candidates_top,
        f"SELECT seed_no, party, band FROM ({_selected_sql('top', 60)}) s",
    ),
    "w12_case_parties": (
        w12_case_parties,
        f"""WITH c12 AS ({_selected_sql('stratified', 60)})
            SELECT seed_no, member FROM ({_filled('SELECT seed_no, party, band, 8 AS party_bucket FROM c12', 'SELECT * FROM c12', 's.seed_no')}) f""",
    ),
    "w13_case_services": (
        w13_case_services,
        f"""SELECT CAST(unprefixed AS BIGINT) AS case_no, string_agg(service, ',' ORDER BY service) AS services FROM (
              SELECT unprefixed, service, row_number() OVER (PARTITION BY unprefixed ORDER BY
                md5(concat(service, CAST({SEED} + CAST(unprefixed AS BIGINT) * 1009 + 5 AS VARCHAR))), service) AS rn FROM party_service) x
            WHERE rn <= 5 GROUP BY unprefixed HAVING count(*) = 5""",
    ),
    "w13_payload_json": (
        w13_payload_json,
        f"""SELECT CAST(unprefixed AS BIGINT) AS case_no, concat('[{{"Parties":["p', CAST(CAST(unprefixed AS BIGINT) AS VARCHAR),
                   '"],"Services":["', string_agg(service, '","' ORDER BY service), '"]}}]') AS payload FROM (
              SELECT unprefixed, service, row_number() OVER (PARTITION BY unprefixed ORDER BY
                md5(concat(service, CAST({SEED} + CAST(unprefixed AS BIGINT) * 1009 + 5 AS VARCHAR))), service) AS rn FROM party_service) x
            WHERE rn <= 5 GROUP BY unprefixed HAVING count(*) = 5""",
    ),
    "w14_build_cases": (
        w14_build_cases,
        f"""WITH tries AS ({_TRIES}), members AS ({_filled('SELECT * FROM tries', _C14, 's.attempt')}),
              good AS (SELECT attempt, row_number() OVER (ORDER BY attempt) AS case_no FROM (
                SELECT m.attempt FROM members m JOIN party_service ps ON ps.party = m.member
                GROUP BY m.attempt, m.service_bucket, m.party_bucket
                HAVING count(DISTINCT ps.service) >= m.service_bucket AND count(DISTINCT m.member) = m.party_bucket) g
                ORDER BY attempt LIMIT 45),
              owned AS (SELECT DISTINCT case_no, service_bucket, service FROM good g JOIN members m ON m.attempt = g.attempt
                JOIN party_service ps ON ps.party = m.member),
              picked AS (SELECT case_no, string_agg(service, ',' ORDER BY service) AS services FROM (
                SELECT *, row_number() OVER (PARTITION BY case_no ORDER BY
                  md5(concat(service, CAST({SEED} + case_no * 1009 + service_bucket AS VARCHAR))), service) AS rn FROM owned) o
                WHERE rn <= service_bucket GROUP BY case_no)
            SELECT printf('case_%04d_p_%d_s_%d', g.case_no, party_bucket, service_bucket) AS case_id, party AS hot_party, band,
                   party_bucket AS party_count, service_bucket AS service_count,
                   string_agg(member, ',' ORDER BY member) AS parties, any_value(services) AS services
            FROM good g JOIN members m ON m.attempt = g.attempt JOIN picked k ON k.case_no = g.case_no
            GROUP BY g.case_no, party_bucket, service_bucket, party, band""",
    ),
    "w15_single_party_cases": (
        w15_single_party_cases,
        f"""SELECT printf('case_%04d_sr_%d', row_number() OVER (ORDER BY seed_no, b), b) AS case_id, party, band, b AS service_count,
                   array_to_string(string_split(services, ',')[1:b], ',') AS services
            FROM ({_selected_sql('stratified', 50)}) c, (VALUES (1), (5), (20)) v(b) WHERE len(string_split(services, ',')) >= b""",
    ),
    "w16_permission_groups": (
        w16_permission_groups,
        f"""SELECT (row_number() OVER (ORDER BY md5(concat(party, '{SEED}')), party) - 1) % 7 AS group_no, party FROM (
              SELECT party FROM (SELECT DISTINCT party FROM dialog) d ORDER BY md5(concat(party, '{SEED}')), party LIMIT 90) x""",
    ),
    "w16_permission_group_services": (
        w16_permission_group_services,
        f"""SELECT group_no, service FROM (
              SELECT g AS group_no, service, CAST(concat('0x', substr(md5(concat(CAST(g AS VARCHAR), ':{SEED}')), 1, 8)) AS BIGINT) % 3 + 3 AS size,
                     row_number() OVER (PARTITION BY g ORDER BY md5(concat(service, ':', CAST(g AS VARCHAR), ':{SEED}')), service) AS rn
              FROM (SELECT service FROM (SELECT DISTINCT service FROM party_service) d
                    ORDER BY md5(concat(service, '{SEED}')), service LIMIT 5) s, range(7) r(g)) x WHERE rn <= size""",
    ),
    "w17_correlated_groups": (
        w17_correlated_groups,
        f"""SELECT party, string_agg(service, ',' ORDER BY service) AS services FROM (
              SELECT p.party, service, row_number() OVER (PARTITION BY p.party ORDER BY md5(concat(service, p.party, '{SEED}'))) AS rn
              FROM (SELECT party FROM (SELECT DISTINCT party FROM party_service) d ORDER BY md5(concat(party, '{SEED}')), party LIMIT 50) p
              JOIN party_service ps ON ps.party = p.party) x WHERE rn <= 4 GROUP BY party""",
    ),
    "w18_capped_counts": (w18_capped_counts, _PER_CUSTOMER),
    "w19_stratum": (w19_stratum, _LABELLED),
    "w20_stratified_balanced": (
        w20_stratified_balanced,
        # Equal shares in stratum order; the check holds while no stratum is smaller than its share.
        f"""WITH caps AS (SELECT stratum, count(*) AS cap, row_number() OVER (ORDER BY list_position(
                ['0', '1-10', '11-100', '101-1000', '1001-10000', '10001+'], stratum)) - 1 AS i, count(*) OVER () AS m
              FROM ({_LABELLED}) l GROUP BY stratum),
            first AS (SELECT *, least(cap, CAST(floor(40 / m) AS BIGINT) + CASE WHEN i < 40 % m THEN 1 ELSE 0 END) AS t FROM caps),
            rest AS (SELECT *, 40 - sum(t) OVER () AS missing FROM first),
            filled AS (SELECT stratum, step FROM rest, range(1, 41) r(step) WHERE step <= cap - t
                       ORDER BY step, i LIMIT (SELECT any_value(missing) FROM rest)),
            target AS (SELECT r.stratum, r.t + count(f.step) AS t FROM rest r LEFT JOIN filled f ON f.stratum = r.stratum GROUP BY r.stratum, r.t)
            SELECT party, d.stratum FROM ({_DRAWN}) d JOIN target t ON t.stratum = d.stratum WHERE rn <= t.t""",
    ),
    "w20_stratified_proportional": (
        w20_stratified_proportional,
        f"""WITH caps AS (SELECT stratum, cap, 43 * cap / CAST(sum(cap) OVER () AS DOUBLE) AS ideal
                          FROM (SELECT stratum, count(*) AS cap FROM ({_LABELLED}) l GROUP BY stratum) c),
            ranked AS (SELECT *, row_number() OVER (ORDER BY ideal - floor(ideal) DESC, stratum DESC) AS place,
                              43 - sum(floor(ideal)) OVER () AS missing FROM caps)
            SELECT party, d.stratum FROM ({_DRAWN}) d JOIN ranked r ON r.stratum = d.stratum
            WHERE rn <= floor(ideal) + CASE WHEN place <= missing THEN 1 ELSE 0 END""",
    ),
    "w20_uniform": (
        w20_uniform,
        f"SELECT party, stratum FROM ({_LABELLED}) l ORDER BY md5(concat(party, '{SEED}')), party LIMIT 43",
    ),
    "w21_strata_summary": (
        w21_strata_summary,
        f"""SELECT a.stratum, available, coalesce(selected, 0) AS selected
            FROM (SELECT stratum, count(*) AS available FROM ({_LABELLED}) l GROUP BY stratum) a
            LEFT JOIN (SELECT stratum, count(*) AS selected FROM (SELECT party, stratum FROM ({_LABELLED}) l
                       ORDER BY md5(concat(party, '{SEED}')), party LIMIT 43) x GROUP BY stratum) s ON s.stratum = a.stratum""",
    ),
    "w22_resume_counts": (
        w22_resume_counts,
        f"SELECT party, CASE WHEN md5(party) < '8' THEN CAST(99 AS BIGINT) ELSE dialog_count END AS dialog_count FROM ({_PER_CUSTOMER}) c",
    ),
}
