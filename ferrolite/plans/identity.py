"""Queries on distances, selection, identity and reuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolite.functions import structure as S
from ferrolite.operators import distance, registry, selection, validation
from ferrolite.plans.tables import table

#: Rows to select, as the original workflow has it by default.
SELECTED = 1000
#: Targets, tolerance and pool of the registered split.
TRAIN, TEST, TOLERANCE, POOL = 200, 40, 10, 0.5


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), distance.as_double(F.col("embedding")).alias("v"), "label")


def nn_distance_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir).select("id", "v")
    return distance.summary(distance.nearest(rows, rows, itself=True))


def cross_distance_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir)
    return distance.summary(distance.nearest(rows.where("label >= 5").select("id", "v"), rows.where("label < 5").select("id", "v"))).select("n", "nn_min", "nn_mean")


def selected_min_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir).select("id", "v")
    found = distance.nearest(rows, rows, itself=True)
    return found.agg(F.round(F.min("distance"), 9).alias("min_distance"), F.round(F.min("positive_distance"), 9).alias("min_positive_distance"))


def descriptor_topk_farthest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir)
    found = distance.nearest(rows.where("label >= 5").select("id", "v"), rows.where("label < 5").select("id", "v")).withColumn("distance", F.round("distance", 9))
    return distance.farthest(found, 20, 0.1).select("id", "distance")


def descriptor_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir).select("id", F.col("v")[0].alias("x"), F.col("v")[1].alias("y"))
    return distance.zscored(rows, ["x", "y"]).select("id", F.round("x_z", 6).alias("x_z"), F.round("y_z", 6).alias("y_z"))


def fps_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    picks = selection.farthest_points(_vectors(spark, sf_dir).select("id", "v"), SELECTED)
    return picks.select("pick", "id", F.when(F.col("pick") > 1, F.round("distance", 8)).alias("distance"))


def fps_target_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stops = [1.2, 1.3, 1.35, 1.4, 1.45]
    return selection.count_at(selection.farthest_points(_vectors(spark, sf_dir).select("id", "v"), None, min(stops)), stops)


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of each label is an anchor of the training rows."""
    rows = _vectors(spark, sf_dir)
    return selection.train_test(rows.select("id", "v"), rows.groupBy("label").agg(F.max("id").alias("id")), TRAIN, TEST, TOLERANCE, POOL)


def composition_aware_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand rows, or half of a smaller table, that fill the bins of their label and of the leading components, from
    the last row of each label on; the better of two attempts."""
    rows = _vectors(spark, sf_dir)
    target = min(SELECTED, rows.count() // 2)
    two = F.struct(F.concat(F.lit("a|"), F.col("label") % 3).alias("subset"), F.floor((F.col("v")[0] + 1) * 10).cast("string").alias("bin"), F.lit(False).alias("ternary"))
    three = F.struct(F.concat(F.lit("t|"), F.col("label") % 2).alias("subset"), F.concat_ws(",", F.floor((F.col("v")[1] + 1) * 5), F.floor((F.col("v")[2] + 1) * 5)).alias("bin"), F.lit(True).alias("ternary"))
    return selection.composition_aware_training(rows.select("id", "v", F.array(two, three).alias("bins")), target, 0.2, 2, rows.groupBy("label").agg(F.max("id").alias("id")))


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven of ten orders for training, by a hash."""
    return selection.random_split(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), 0.7)


def settings_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as settings of runs: numbers near the ends of their ranges, words, blanks, and lists of return flags."""
    keys = [r[0] for r in validation.RULES] + ["flags", "free"]
    x = (F.col("l_linenumber") + F.col("l_orderkey")) % 7
    number = F.round(F.col("l_discount") * 20 - 0.4, 2).cast("string")
    flags = F.concat_ws(",", F.lower("l_returnflag"), F.when(F.col("l_suppkey") % 3 == 0, F.col("l_linestatus")))
    value = F.when(F.col("l_quantity") < 4, " ").when(F.col("l_quantity") < 7, F.lit("word")).when(x == 5, flags).when(x.isin(2, 4), F.floor(F.col("l_quantity") / 10).cast("string")).otherwise(number)
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("line"), F.element_at(F.lit(keys), (x + 1).cast("int")).alias("key"), value.alias("value"))
    return validation.violations(rows, validation.rules(spark, None, {"flags": (["A", "N", "R"], True)}))


def split_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir)
    return selection.split_labels(rows, [("train", rows.where("label < 4")), ("test", rows.where("label in (3, 4, 5)")), ("potential_train", rows.where("label = 5 and id % 2 = 0"))])


def structure_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part in each order is an atom at (quantity, discount, tax) in a cell set by the order's number."""
    items = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")

    def cell(index: str) -> Column:
        size, zero = (F.col(index) % 7 + 3).cast("double"), F.lit(0.0)
        return F.array(F.array(size, zero, zero), F.array(zero, size, zero), F.array(zero, zero, size))

    place = S.scaled(F.array(F.array("l_quantity", "l_discount", "l_tax")), cell("l_orderkey"))[0]
    atom = F.struct("l_quantity", "l_discount", "l_tax", "p_type", place.alias("place"))
    found = items.groupBy(F.col("l_orderkey").alias("structure_index")).agg(F.array_sort(F.collect_list(atom)).alias("atoms"))
    return found.select("structure_index", S.structure_hash(F.transform("atoms", lambda a: a["p_type"]), F.transform("atoms", lambda a: a["place"]), cell("structure_index"), F.lit([True, True, True])).alias("structure_hash"))


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("structure_hash"))


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.first_of_each(_hashed(spark, sf_dir), "structure_hash", ["doc_id"])


def dedup_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _hashed(spark, sf_dir)
    return registry.unseen(rows.where("doc_id % 2 = 1"), rows.where("doc_id % 2 = 0"), "structure_hash", ["doc_id"]).select("doc_id", "structure_hash")


def _identity(*parts: str) -> list:
    return [F.md5(F.col(c).cast("string").cast("binary")).alias(n) for c, n in zip(parts, registry.IDENTITY, strict=True)]


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    entries = events.withColumn("a", F.col("user_id") % 5).withColumn("b", F.col("user_id") % 7).withColumn("c", F.col("user_id") % 150)
    entries = entries.select(*_identity("a", "b", "c"), F.concat(F.lit("/jobs/"), F.col("event_id")).alias("job_path"), (F.col("event_type") == "purchase").alias("complete"), "event_id")
    return registry.latest(entries, registry.IDENTITY, "event_id")


def registry_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _registry(spark, sf_dir)


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("c", F.col("o_custkey") % 300)
    return orders.withColumn("a", F.col("c") % 5).withColumn("b", F.col("c") % 7).select(F.col("o_orderkey").alias("job"), *_identity("a", "b", "c"))


def registry_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.reuse(_jobs(spark, sf_dir), _registry(spark, sf_dir)).select("job", "status", "reused_from")


def registry_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.misses(_jobs(spark, sf_dir), _registry(spark, sf_dir)).select("job")


def priority_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    own = orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key"), F.concat(F.lit("own/"), F.col("o_orderkey")).alias("path"))
    other = orders.where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("key"), F.concat(F.lit("other/"), F.col("o_orderkey")).alias("path"))
    pending = orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("key"), F.concat(F.lit("pending/"), F.col("o_orderkey")).alias("path"))
    kept = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.concat(F.lit("registry/"), F.col("event_id")).alias("path"))
    return registry.prioritised(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), [own, other, pending, kept])


def seed_anchor_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    generated = table(spark, sf_dir, "orders").select(F.format_string("seed_%06d", "o_custkey").alias("seed_id"), F.col("o_orderkey").alias("structure_index"))
    seeds = table(spark, sf_dir, "customer").select(F.format_string("seed_%06d", "c_custkey").alias("seed_id"))
    return registry.seed_anchors(generated, seeds)


def positional_identity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    structures = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("structure_index"), F.col("o_orderstatus").alias("identity"))
    jobs = table(spark, sf_dir, "events").select(F.col("event_id").alias("structure_index"), F.upper(F.substring("event_type", 1, 1)).alias("identity"), F.format_string("struct_%04d", "event_id").alias("path"))
    return registry.positional(structures, jobs)


def missing_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ferrolite.operators.generators import missing_elements

    used = table(spark, sf_dir, "part").select(F.col("p_brand").alias("element"))
    return missing_elements(used, table(spark, sf_dir, "supplier").select(F.concat(F.lit("Brand#"), F.col("s_nationkey")).alias("element")))


_V = "v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings)"
_NN = f"{_V}, nn AS (SELECT a.id, min(list_distance(a.v, b.v)) AS d, min(CASE WHEN list_distance(a.v, b.v) > 1e-12 THEN list_distance(a.v, b.v) END) AS p FROM v a JOIN v b ON a.id <> b.id GROUP BY a.id)"
_CROSS = f"{_V}, nn AS (SELECT a.id, min(list_distance(a.v, b.v)) AS d FROM v a JOIN v b ON a.label >= 5 AND b.label < 5 GROUP BY a.id)"


def _fps_sql(name: str, rows: str, picks: int | None, least: float = 0.0, first: str = "id") -> str:
    """Recursive tables for farthest-point selection: each step holds all rows with their distance to the picks so far.

    ``rows`` has id and v; the first pick is the first in the order ``first``. ``name`` has pick, id, distance (infinite
    for the first pick).
    """
    return f"""{name}_steps AS (
        SELECT 0 AS pick, id, 'inf'::DOUBLE AS d, row_number() OVER (ORDER BY {first}) AS nth, NULL::BIGINT AS chosen, NULL::DOUBLE AS distance FROM {rows}
        UNION ALL
        SELECT pick + 1, n.id, CASE WHEN n.id = best THEN -1 ELSE least(d, list_distance(x.v, y.v)) END, CASE WHEN n.id = best THEN NULL ELSE n.id END, best, far
        FROM (SELECT *, first_value(id) OVER w AS best, first_value(d) OVER w AS far FROM {name}_steps
              WINDOW w AS (ORDER BY d DESC, CASE WHEN pick = 0 THEN nth ELSE id END ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) n
        JOIN {rows} x ON x.id = n.id JOIN {rows} y ON y.id = best WHERE far >= {least} AND pick < {picks if picks is not None else 1 << 40}
    ), {name} AS (SELECT DISTINCT pick, chosen AS id, distance FROM {name}_steps WHERE pick > 0)"""


def _target_sql(name: str, picks: str, target: str, tolerance: int) -> str:
    """Recursive tables for the stop distance by doubling and bisection; ``name`` has one row, ``stop``."""
    count = f"(SELECT count(*) FROM {picks} WHERE distance >= {{}})"
    return f"""{name}_up AS (
        SELECT 0.01::DOUBLE AS high UNION ALL SELECT high * 2 FROM {name}_up WHERE {count.format('high')} > {target}
    ), {name}_probe AS (
        SELECT 0 AS nth, 0::DOUBLE AS low, max(high) AS high, max(high) AS best, FALSE AS done FROM {name}_up
        UNION ALL
        SELECT nth + 1, CASE WHEN n > {target} THEN mid ELSE low END, CASE WHEN n > {target} THEN high ELSE mid END,
            CASE WHEN abs(n - {target}) <= {tolerance} OR n <= {target} THEN mid ELSE best END, abs(n - {target}) <= {tolerance}
        FROM (SELECT *, (low + high) / 2 AS mid, {count.format('(low + high) / 2')} AS n FROM {name}_probe) WHERE NOT done AND nth < 30
    ), {name} AS (SELECT arg_max(best, nth) AS stop FROM {name}_probe)"""


_REGISTRY = """reg AS (
        SELECT md5((user_id % 5)::VARCHAR) AS incar_hash, md5((user_id % 7)::VARCHAR) AS potcar_hash, md5((user_id % 150)::VARCHAR) AS structure_hash,
               '/jobs/' || max(event_id) AS job_path, arg_max(event_type, event_id) = 'purchase' AS complete, max(event_id) AS event_id
        FROM events GROUP BY 1, 2, 3
    ),
    jobs AS (SELECT o_orderkey AS job, md5((o_custkey % 300 % 5)::VARCHAR) AS a, md5((o_custkey % 300 % 7)::VARCHAR) AS b, md5((o_custkey % 300)::VARCHAR) AS c FROM orders)"""
_HASHES = "h AS (SELECT doc_id, source, sha256(coalesce(text, '')) AS structure_hash FROM documents)"

QUERIES = {
    f.__name__: f
    for f in (
        nn_distance_stats, cross_distance_stats, selected_min_distance, descriptor_topk_farthest, descriptor_zscore, fps_select, fps_target_count, train_test_split, composition_aware_selection,
        random_split, settings_violations, split_labels, structure_hash, dedup_first, dedup_unseen, registry_upsert_latest, registry_reuse, registry_miss, priority_resolve, seed_anchor_join,
        positional_identity_join, missing_dimension,
    )
}

ORACLES = {
    "random_split": """WITH h AS (SELECT o_orderkey AS id, row_number() OVER (ORDER BY ('0x' || substr(md5(o_orderkey || '|42'), 1, 8))::BIGINT, o_orderkey) AS nth, count(*) OVER () AS n FROM orders)
        SELECT id, CASE WHEN nth <= greatest(1, round_even(0.7 * n, 0)) THEN 'train' ELSE 'test' END AS split FROM h""",
    "settings_violations": """WITH k AS (SELECT [%s, 'flags', 'free'] AS keys), l AS (SELECT *, (l_linenumber + l_orderkey) %% 7 AS x FROM lineitem),
        s AS (SELECT l_orderkey AS run, keys[x + 1] AS key, x, CASE WHEN l_quantity < 4 THEN ' ' WHEN l_quantity < 7 THEN 'word'
            WHEN x = 5 THEN lower(l_returnflag) || CASE WHEN l_suppkey %% 3 = 0 THEN ',' || l_linestatus ELSE '' END
            WHEN x IN (2, 4) THEN floor(l_quantity / 10)::BIGINT::VARCHAR ELSE round(l_discount * 20 - 0.4, 2)::VARCHAR END AS value FROM l, k),
        n AS (SELECT *, try_cast(value AS DOUBLE) AS v FROM s),
        r AS (SELECT run, key, value, CASE WHEN key = 'free' THEN NULL WHEN trim(value) = '' THEN CASE WHEN x IN (4, 5) THEN 'missing' END
            WHEN x = 5 THEN CASE WHEN len(list_filter(string_split(upper(value), ','), lambda i: i NOT IN ('A', 'N', 'R'))) > 0 THEN 'unknown item' END
            WHEN v IS NULL THEN 'not a number' WHEN x IN (2, 4) AND v <> floor(v) THEN 'not a whole number'
            WHEN (x IN (0, 3) AND v <= 0) OR (x = 1 AND v < 0) OR (x IN (2, 4) AND v < 1) THEN 'below the range' WHEN x IN (0, 3) AND v > 1 THEN 'above the range' END AS reason FROM n)
        SELECT run, key, value, reason FROM r WHERE reason IS NOT NULL
        UNION ALL SELECT run, key, NULL, 'missing' FROM (SELECT DISTINCT run FROM s), (VALUES ('target_n_atoms'), ('flags')) t(key) WHERE (run, key) NOT IN (SELECT (run, key) FROM s)""" % ", ".join(f"'{r[0]}'" for r in validation.RULES),
    "nn_distance_stats": f"""WITH {_NN} SELECT count(d) AS n, round(min(d), 9) AS nn_min, round(avg(d), 9) AS nn_mean, round(quantile_cont(d, 0.5), 9) AS nn_p50,
        round(quantile_cont(d, 0.95), 9) AS nn_p95, round(quantile_cont(d, 0.99), 9) AS nn_p99, round(max(d), 9) AS nn_max FROM nn""",
    "cross_distance_stats": f"WITH {_CROSS} SELECT count(d) AS n, round(min(d), 9) AS nn_min, round(avg(d), 9) AS nn_mean FROM nn",
    "selected_min_distance": f"WITH {_NN} SELECT round(min(d), 9) AS min_distance, round(min(p), 9) AS min_positive_distance FROM nn",
    "descriptor_topk_farthest": f"""WITH {_CROSS} SELECT id, round(d, 9) AS distance FROM nn
        QUALIFY row_number() OVER (ORDER BY round(d, 9) DESC, id) <= greatest(20, floor(count(*) OVER () * 0.1))""",
    "descriptor_zscore": f"""WITH {_V}, m AS (SELECT avg(v[1]) AS mx, stddev_pop(v[1]) AS sx, avg(v[2]) AS my, stddev_pop(v[2]) AS sy FROM v)
        SELECT id, round((v[1] - mx) / CASE WHEN sx = 0 THEN 1 ELSE sx END, 6) AS x_z, round((v[2] - my) / CASE WHEN sy = 0 THEN 1 ELSE sy END, 6) AS y_z FROM v CROSS JOIN m""",
    "fps_select": f"""WITH RECURSIVE {_V}, {_fps_sql('s', 'v', SELECTED)} SELECT pick::INTEGER AS pick, id, CASE WHEN pick > 1 THEN round(distance, 8) END AS distance FROM s""",
    "fps_target_count": f"""WITH RECURSIVE {_V}, {_fps_sql('s', 'v', None, 1.2)} SELECT t.d AS min_distance, count(pick) AS n FROM (VALUES (1.2::DOUBLE), (1.3), (1.35), (1.4), (1.45)) t(d)
        LEFT JOIN s x ON x.distance >= t.d GROUP BY t.d""",
    "train_test_split": f"""WITH RECURSIVE {_V}, anchor AS (SELECT max(id) AS id FROM v GROUP BY label), free AS (SELECT * FROM v WHERE id NOT IN (FROM anchor)),
        {_fps_sql('s', 'free', TRAIN + TOLERANCE + 1)}, {_target_sql('a', 's', f'({TRAIN} - (SELECT count(*) FROM anchor))', TOLERANCE)},
        train AS (FROM anchor UNION SELECT id FROM s WHERE distance >= (SELECT stop FROM a)),
        l AS (SELECT x.id, any_value(x.v) AS v, min(list_distance(x.v, y.v)) AS d FROM v x JOIN v y ON x.id NOT IN (FROM train) AND y.id IN (FROM train) GROUP BY x.id),
        pool AS (SELECT id, v, d AS apart FROM l QUALIFY row_number() OVER (ORDER BY d DESC, id) <= greatest({TEST}, floor(count(*) OVER () * {POOL}))),
        {_fps_sql('t', 'pool', TEST + TOLERANCE + 1, 0.0, 'apart DESC, id')}, {_target_sql('b', 't', str(TEST), TOLERANCE)}
        SELECT id, CASE WHEN id IN (FROM train) THEN 'train' WHEN id IN (SELECT id FROM t WHERE distance >= (SELECT stop FROM b)) THEN 'test' ELSE 'unselected' END AS split FROM v""",
    "split_labels": """SELECT vec_id AS id, CASE WHEN label = 5 AND vec_id % 2 = 0 THEN 'potential_train' WHEN label IN (3, 4, 5) THEN 'test' WHEN label < 4 THEN 'train' ELSE 'unselected' END AS split FROM embeddings""",
    "structure_hash": """WITH a AS (
            SELECT l_orderkey AS k, p_type AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_discount, l_tax, p_type) AS i,
                   printf('%.14f', l_quantity * f) || ' ' || printf('%.14f', l_discount * f) || ' ' || printf('%.14f', l_tax * f) AS p
            FROM (SELECT *, (l_orderkey % 7 + 3)::DOUBLE AS e, (e * e) / (e * e * e) AS f FROM lineitem) JOIN part ON l_partkey = p_partkey
        ), t AS (SELECT k, string_agg(s || ' ' || p, chr(10) ORDER BY s, i) AS atoms, printf('%.14f', (k % 7 + 3)::DOUBLE) AS c, printf('%.14f', 0::DOUBLE) AS z FROM a GROUP BY k)
        SELECT k AS structure_index, sha256(concat_ws(chr(10), 'structure-v1', 'pbc 1 1 1', 'cell', concat_ws(' ', c, z, z), concat_ws(' ', z, c, z), concat_ws(' ', z, z, c), 'atoms', atoms, '')) AS structure_hash FROM t""",
    "dedup_first": f"WITH {_HASHES} SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY structure_hash ORDER BY doc_id) = 1",
    "dedup_unseen": f"""WITH {_HASHES} SELECT min(doc_id) AS doc_id, structure_hash FROM h WHERE doc_id % 2 = 1 AND structure_hash NOT IN (SELECT structure_hash FROM h WHERE doc_id % 2 = 0) GROUP BY 2""",
    "registry_upsert_latest": f"WITH {_REGISTRY} SELECT * FROM reg",
    "registry_reuse": f"""WITH {_REGISTRY} SELECT job, CASE WHEN job_path IS NOT NULL THEN 'reused' ELSE 'pending' END AS status, job_path AS reused_from
        FROM jobs LEFT JOIN reg ON complete AND a = incar_hash AND b = potcar_hash AND c = structure_hash""",
    "registry_miss": f"WITH {_REGISTRY} SELECT job FROM jobs ANTI JOIN reg ON complete AND a = incar_hash AND b = potcar_hash AND c = structure_hash",
    "priority_resolve": """WITH c AS (
            SELECT o_custkey AS key, 'own/' || o_orderkey AS path, 1 AS priority FROM orders WHERE o_orderstatus = 'F'
            UNION ALL SELECT o_custkey, 'other/' || o_orderkey, 2 FROM orders WHERE o_orderstatus = 'O'
            UNION ALL SELECT o_custkey, 'pending/' || o_orderkey, 3 FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT user_id, 'registry/' || event_id, 4 FROM events
        ), b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY key ORDER BY priority, path) = 1)
        SELECT c_custkey AS key, path, priority FROM customer LEFT JOIN b ON key = c_custkey""",
    "seed_anchor_join": """SELECT printf('seed_%06d', c_custkey) AS seed_id, max(o_orderkey) AS structure_index FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1""",
    "positional_identity_join": """SELECT o_orderkey AS structure_index, CASE WHEN o_orderstatus = upper(substr(event_type, 1, 1)) THEN printf('struct_%04d', event_id) END AS path,
        coalesce(o_orderstatus <> upper(substr(event_type, 1, 1)), FALSE) AS mismatch FROM orders LEFT JOIN events ON event_id = o_orderkey""",
    "missing_dimension": "SELECT DISTINCT p_brand AS element FROM part WHERE p_brand NOT IN (SELECT 'Brand#' || s_nationkey FROM supplier)",
}
