"""Queries on benchmark history and on log and settings texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolite.functions import text as X
from ferrolite.operators import benchmark, generators
from ferrolite.plans.tables import FACTS_SQL, facts, table


def fastest_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark.fastest(facts(spark, sf_dir), ["n_atoms", "gpus"])


def cheapest_viable_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark.cheapest_viable(facts(spark, sf_dir)).withColumn("ratio", F.round("ratio", 9))


def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark.outcomes(facts(spark, sf_dir))


def config_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facts(spark, sf_dir).withColumn("oom", F.when((F.col("oom") == 1) & (F.col("n_atoms") > 96), 1).otherwise(0))
    return benchmark.grid(rows, [1, 2, 4], "avg_loop_time")


def predict_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("query_id"), (F.col("c_custkey") % 700).alias("n_electrons"), (F.col("c_custkey") % 11).alias("n_kpoints_irr"))
    return benchmark.predicted(asked, facts(spark, sf_dir))


def snap_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return rows.select("p_partkey", benchmark.snap(F.col("p_size"), benchmark.powers_of_two(64)).alias("ncore"), benchmark.snap(F.col("p_size"), [1, 2, 4, 8, 16]).alias("nodes"))


def param_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a kind of node, by the settings that a benchmark measures on it."""
    nodes = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 24 * 4 + 4).alias("cores"), (F.col("s_nationkey") % 9).alias("gpus"))
    return generators.parameter_grids(nodes)


def retry_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a job that ran out of memory with settings of its own."""
    two = lambda n: F.call_function("shiftleft", F.lit(1), (F.col("p_size") % n).cast("int"))
    jobs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("job"), two(3).alias("gpu"), two(8).alias("ncore"), two(4).alias("kpar"))
    return generators.retry_ladders(jobs, [1, 2, 4], 64, 8)


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    head = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("running "), F.col("user_id"), F.lit(" mpi-ranks, with 1 threads/rank\n"))).otherwise(F.concat(F.lit("running on  "), F.col("user_id"), F.lit(" total cores\n")))
    loop = F.concat(F.lit("      LOOP:  cpu time    1.0: real time    "), F.col("value"), F.lit("\n"))
    log = F.concat(
        head, F.lit(" Found     "), k, F.lit(" irreducible k-points:\n   NELECT =     "), F.col("value"), F.lit("    total number of electrons\n"),
        F.when(F.col("event_type") != "error", F.concat(loop, F.lit("      LOOP:  cpu time    2.0: real time    2.5\n"))).otherwise(""),
        F.when(F.col("event_type") == "purchase", " General timing and accounting informations for this job:\n").otherwise(""),
        F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, "CUDA error: device lost\n").otherwise("slurmstepd: Killed\n")).otherwise(""),
    )
    return e.select("event_id", log.alias("log"))


def log_regex_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = F.col("log")
    return _logs(spark, sf_dir).select("event_id", X.ranks(log).alias("ranks"), X.kpoints(log).alias("n_kpoints_irr"), X.electrons(log).alias("n_electrons"), F.round(X.mean_loop_time(log), 9).alias("avg_loop_time"), F.size(X.loop_times(log)).alias("loops"))


def completion_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logs(spark, sf_dir).select("event_id", X.is_complete(F.col("log")).alias("complete"))


def log_error_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logs(spark, sf_dir).select("event_id", X.error_class(F.col("log")).alias("error"))


def _settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    def line(key: str, value: Column) -> Column:
        return F.concat(F.lit(key), value.cast("string"), F.lit("\n"))

    o = table(spark, sf_dir, "orders")
    text = F.concat(
        line("ENCUT = ", F.col("o_custkey") % 5 * 100 + 300), line("  ncore= ", F.col("o_orderkey") % 64), line("ISMEAR = 0   # smearing ", F.col("o_orderkey") % 2),
        line("KPAR = ", F.col("o_orderkey") % 4), line("NSW = ", F.col("o_orderkey") % 3), line("encut = ", F.col("o_custkey") % 3 + 400), line("ISYM = ", F.col("o_orderkey") % 2),
    )
    return o.select(F.col("o_orderkey").alias("job"), text.alias("settings"))


def settings_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settings(spark, sf_dir).select("job", X.settings_hash(F.col("settings")).alias("incar_hash"))


def settings_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = X.settings_map(F.col("settings"))
    return _settings(spark, sf_dir).select("job", F.size(m).alias("n"), m["ENCUT"].alias("encut"), m["ISMEAR"].alias("ismear"), m["NCORE"].alias("ncore"))


def settings_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = X.overridden(X.with_defaults(F.col("settings"), [("KSPACING", "0.2"), ("NSW", "9")]), [("NSW", "0"), ("NELM", "10")])
    return _settings(spark, sf_dir).select("job", F.md5(text.cast("binary")).alias("text_md5"))


def lint_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settings(spark, sf_dir).select("job", F.array_join(X.lint(X.settings_map(F.col("settings"))), "; ").alias("warnings"))


def json_status_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.coalesce(F.from_json("props", "k int", {"mode": "PERMISSIVE"})["k"], F.lit(-1))
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("dataset"), "event_type", k.alias("k"))
    done = F.col("event_type").isin("purchase", "view")
    return rows.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(done).alias("completed"), F.count_if(F.col("event_type") == "error").alias("failed"), F.count_if(~done & (F.col("event_type") != "error")).alias("pending"), F.sum("k").alias("k_sum")
    )


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.regexp_replace("url", r"^https?://([^./]+)[^/]*/([^/]*)/(\d+).*$", "/scratch/projects/$1/run/$2/struct_$3")
    return table(spark, sf_dir, "pages").select("page_id", X.job_path(url).alias("x")).select("page_id", "x.*")


def scalar_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.element_at(F.array(F.lit("true"), F.col("user_id").cast("string"), F.format_string("%.2f", "value"), F.col("event_type")), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", X.coerced(raw).alias("x")).select("event_id", "x.*")


def walltime_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = (F.col("o_orderkey") * 37 % 200_000).cast("int")
    text = F.when(F.col("o_orderkey") % 10 == 0, "soon").otherwise(X.walltime(s))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("job"), text.alias("walltime"), X.seconds(text).cast("int").alias("seconds"))


_LOGS = """l AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'running ' || user_id || ' mpi-ranks, with 1 threads/rank' ELSE 'running on  ' || user_id || ' total cores' END || chr(10)
        || ' Found     ' || json_extract_string(props, '$.k') || ' irreducible k-points:' || chr(10) || '   NELECT =     ' || value || '    total number of electrons' || chr(10)
        || CASE WHEN event_type <> 'error' THEN '      LOOP:  cpu time    1.0: real time    ' || value || chr(10) || '      LOOP:  cpu time    2.0: real time    2.5' || chr(10) ELSE '' END
        || CASE WHEN event_type = 'purchase' THEN ' General timing and accounting informations for this job:' || chr(10) ELSE '' END
        || CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'CUDA error: device lost' ELSE 'slurmstepd: Killed' END || chr(10) ELSE '' END AS log FROM events)"""
_SETTINGS = """s AS (SELECT o_orderkey AS job, 'ENCUT = ' || (o_custkey % 5 * 100 + 300) || chr(10) || '  ncore= ' || (o_orderkey % 64) || chr(10) || 'ISMEAR = 0   # smearing ' || (o_orderkey % 2) || chr(10)
        || 'KPAR = ' || (o_orderkey % 4) || chr(10) || 'NSW = ' || (o_orderkey % 3) || chr(10) || 'encut = ' || (o_custkey % 3 + 400) || chr(10) || 'ISYM = ' || (o_orderkey % 2) || chr(10) AS settings FROM orders)"""

QUERIES = {
    f.__name__: f
    for f in (
        fastest_config, cheapest_viable_config, outcome_counts, config_pivot, predict_params, snap_values, param_grid, retry_ladder, log_regex_extract, completion_marker,
        log_error_class, settings_strip, settings_parse, settings_defaults, lint_warnings, json_status_tally, page_paths, scalar_coercion, walltime_seconds,
    )
}

ORACLES = {
    "fastest_config": f"WITH {FACTS_SQL} SELECT n_atoms, gpus, avg_loop_time, ncore, kpar FROM facts WHERE oom <> 1 QUALIFY row_number() OVER (PARTITION BY n_atoms, gpus ORDER BY avg_loop_time, ncore, kpar) = 1",
    "cheapest_viable_config": f"""WITH {FACTS_SQL}, b AS (SELECT * FROM facts WHERE oom <> 1 QUALIFY row_number() OVER (PARTITION BY n_atoms ORDER BY gpus, avg_loop_time, ncore, kpar) = 1),
        f AS (SELECT n_atoms, min(avg_loop_time) AS fastest FROM facts WHERE oom <> 1 GROUP BY 1)
        SELECT d.n_atoms, gpus, avg_loop_time, ncore, kpar, fastest, round(avg_loop_time / fastest, 9) AS ratio FROM (SELECT DISTINCT n_atoms FROM facts) d LEFT JOIN b USING (n_atoms) LEFT JOIN f USING (n_atoms)""",
    "outcome_counts": f"""WITH {FACTS_SQL} SELECT a.n_atoms, g.gpus, count(*) FILTER (oom = 0) AS n_ok, count(*) FILTER (oom = 1) AS n_oom
        FROM (SELECT DISTINCT n_atoms FROM facts) a CROSS JOIN (SELECT DISTINCT gpus FROM facts) g LEFT JOIN facts f ON f.n_atoms = a.n_atoms AND f.gpus = g.gpus GROUP BY 1, 2""",
    "config_pivot": f"""WITH {FACTS_SQL}, c AS (SELECT ncore, kpar, CASE WHEN max(CASE WHEN oom = 1 AND n_atoms > 96 THEN 1 ELSE 0 END) = 1 THEN NULL ELSE arg_max(avg_loop_time, avg_loop_time) END AS t
        FROM facts GROUP BY 1, 2)
        SELECT ncore, max(CASE WHEN kpar = 1 THEN t END) AS kpar_1, max(CASE WHEN kpar = 2 THEN t END) AS kpar_2, max(CASE WHEN kpar = 4 THEN t END) AS kpar_4 FROM c GROUP BY 1""",
    "predict_params": f"""WITH {FACTS_SQL}, g AS (SELECT * FROM facts WHERE oom <> 1), m AS (SELECT avg(n_electrons) AS me, stddev_pop(n_electrons) AS se, avg(n_kpoints_irr) AS mk, stddev_pop(n_kpoints_irr) AS sk FROM g),
        p AS (SELECT n_electrons, n_kpoints_irr, min(struct_pack(gpus := gpus, t := avg_loop_time, ncore := ncore, kpar := kpar)) AS b FROM g GROUP BY 1, 2),
        d AS (SELECT c_custkey AS query_id, b, sqrt(((p.n_electrons - c_custkey % 700) / se) ** 2 + ((p.n_kpoints_irr - c_custkey % 11) / sk) ** 2) AS d FROM customer CROSS JOIN p CROSS JOIN m),
        n AS (SELECT query_id, b FROM d QUALIFY d <= min(d) OVER (PARTITION BY query_id) + 1e-6), x AS (SELECT query_id, min(b) AS b FROM n GROUP BY 1)
        SELECT query_id, b.gpus AS gpus, b.ncore AS ncore, b.kpar AS kpar, b.t AS avg_loop_time FROM x""",
    "snap_values": """SELECT p_partkey, (SELECT v FROM (VALUES (1), (2), (4), (8), (16), (32), (64)) t(v) ORDER BY abs(v - p_size), v LIMIT 1) AS ncore,
        (SELECT v FROM (VALUES (1), (2), (4), (8), (16)) t(v) ORDER BY abs(v - p_size), v LIMIT 1) AS nodes FROM part""",
    "param_grid": """WITH n AS (SELECT s_suppkey, (s_suppkey % 24 * 4 + 4)::INTEGER AS cores, (s_nationkey % 9)::INTEGER AS gpus FROM supplier),
        g AS (SELECT s_suppkey, x::INTEGER AS gpus FROM n, (VALUES (1), (2), (4), (8)) v(x) WHERE x <= gpus UNION ALL SELECT s_suppkey, gpus FROM n WHERE gpus < 1),
        c AS (SELECT s_suppkey, (2 ** k)::INTEGER AS ncore FROM n, range(1, 12) r(k) WHERE cores % (2 ** k)::INTEGER = 0),
        p AS (SELECT s_suppkey, (2 ** k)::INTEGER AS kpar FROM n, range(0, 8) r(k) WHERE 2 ** k <= gpus UNION ALL SELECT s_suppkey, 1 FROM n WHERE gpus < 1)
        SELECT s_suppkey, (row_number() OVER (PARTITION BY s_suppkey ORDER BY gpus, ncore, kpar) - 1)::INTEGER AS job, gpus, ncore, kpar FROM g JOIN c USING (s_suppkey) JOIN p USING (s_suppkey)""",
    "retry_ladder": """WITH j AS (SELECT p_partkey AS job, (2 ** (p_size % 3))::INTEGER AS gpu, (2 ** (p_size % 8))::INTEGER AS first, (2 ** (p_size % 4))::INTEGER AS k0 FROM part),
        s AS (SELECT job, nodes, gpus, kp, CASE kp WHEN 0 THEN k0 WHEN 1 THEN greatest(1, k0 // 2) ELSE 1 END AS kpar, np, least(first, 64) >> np AS ncore, gpu, first, k0
            FROM j, (VALUES (1, 1), (1, 2), (1, 4), (2, 4), (4, 4), (8, 4)) t(nodes, gpus), range(0, 3) a(kp), range(0, 8) b(np) WHERE (nodes > 1 OR gpus >= gpu) AND least(first, 64) >> np > 0),
        d AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY job, nodes, gpus, ncore, kpar ORDER BY kp, np) = 1)
        SELECT job, row_number() OVER (PARTITION BY job ORDER BY nodes, gpus, kp, np)::INTEGER AS level, nodes, gpus, ncore, kpar::INTEGER AS kpar FROM d WHERE NOT (nodes = 1 AND gpus = gpu AND ncore = first AND kpar = k0)""",
    "log_regex_extract": f"""WITH {_LOGS}, x AS (SELECT event_id, log, regexp_extract_all(log, 'LOOP:\\s+cpu time\\s+[0-9.]+:\\s+real time\\s+([0-9.]+)', 1)::DOUBLE[] AS t FROM l)
        SELECT event_id, coalesce(nullif(regexp_extract(log, 'running\\s+([0-9]+)\\s+mpi-ranks', 1), ''), regexp_extract(log, 'running on\\s+([0-9]+)\\s+total cores', 1))::INTEGER AS ranks,
        regexp_extract(log, 'Found\\s+([0-9]+)\\s+irreducible', 1)::INTEGER AS n_kpoints_irr, floor(regexp_extract(log, 'NELECT\\s*=\\s*([0-9.]+)', 1)::DOUBLE)::INTEGER AS n_electrons,
        round(CASE WHEN len(t) > 0 THEN list_sum(t) / len(t) ELSE 0 END, 9) AS avg_loop_time, len(t)::INTEGER AS loops FROM x""",
    "completion_marker": f"WITH {_LOGS} SELECT event_id, right(log, 50000) LIKE '%General timing%' OR right(log, 50000) LIKE '%Voluntary context switches%' AS complete FROM l",
    "log_error_class": f"""WITH {_LOGS} SELECT event_id, CASE WHEN log ILIKE '%cuda%' AND log ILIKE '%error%' THEN 'cuda error' WHEN log ILIKE '%out of memory%' OR log ILIKE '%oom%' THEN 'out of memory'
        WHEN log ILIKE '%segmentation fault%' THEN 'segmentation fault' WHEN log ILIKE '%killed%' THEN 'killed' ELSE trim(list_filter(string_split(log, chr(10)), lambda x: trim(x) <> '')[-1]) END AS error FROM l""",
    "settings_strip": """SELECT o_orderkey AS job, sha256('ENCUT = ' || (o_custkey % 5 * 100 + 300) || chr(10) || 'ISMEAR = 0   # smearing ' || (o_orderkey % 2) || chr(10) || 'NSW = ' || (o_orderkey % 3) || chr(10)
        || 'encut = ' || (o_custkey % 3 + 400) || chr(10) || 'ISYM = ' || (o_orderkey % 2) || chr(10)) AS incar_hash FROM orders""",
    "settings_parse": "SELECT o_orderkey AS job, 6 AS n, (o_custkey % 3 + 400)::VARCHAR AS encut, '0' AS ismear, (o_orderkey % 64)::VARCHAR AS ncore FROM orders",
    "settings_defaults": f"""WITH {_SETTINGS} SELECT job, md5(regexp_replace(settings, 'NSW = [0-9]+', 'NSW = 0') || 'KSPACING = 0.2' || chr(10) || 'NELM = 10' || chr(10)) AS text_md5 FROM s""",
    "lint_warnings": "SELECT o_orderkey AS job, concat_ws('; ', CASE WHEN o_orderkey % 3 > 0 THEN 'NSW > 0: ions move' END, CASE WHEN o_orderkey % 2 <> 0 THEN 'ISYM is not 0' END) AS warnings FROM orders",
    "json_status_tally": """SELECT user_id % 10 AS dataset, count(*) AS total, count(*) FILTER (event_type IN ('purchase', 'view')) AS completed, count(*) FILTER (event_type = 'error') AS failed,
        count(*) FILTER (event_type NOT IN ('purchase', 'view', 'error')) AS pending, sum(json_extract(props, '$.k')::INTEGER)::BIGINT AS k_sum FROM events GROUP BY 1""",
    "page_paths": """WITH p AS (SELECT page_id, regexp_replace(url, '^https?://([^./]+)[^/]*/([^/]*)/(\\d+).*$', '/scratch/projects/\\1/run/\\2/struct_\\3') AS u FROM pages)
        SELECT page_id, nullif(regexp_extract(u, 'projects/([^/]+)/(?:.*/)?([^/]+)/struct_(\\d+)', 1), '') AS project, nullif(regexp_extract(u, 'projects/([^/]+)/(?:.*/)?([^/]+)/struct_(\\d+)', 2), '') AS dataset,
        nullif(regexp_extract(u, 'projects/([^/]+)/(?:.*/)?([^/]+)/struct_(\\d+)', 3), '')::BIGINT AS selected_index FROM p""",
    "scalar_coercion": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'bool' WHEN 1 THEN 'int' WHEN 2 THEN 'float' ELSE 'string' END AS kind, CASE WHEN event_id % 4 = 0 THEN TRUE END AS b,
        CASE WHEN event_id % 4 = 1 THEN user_id END AS i, CASE WHEN event_id % 4 = 2 THEN value END AS d, CASE WHEN event_id % 4 = 3 THEN event_type END AS s FROM events""",
    "walltime_seconds": """SELECT o_orderkey AS job, CASE WHEN o_orderkey % 10 = 0 THEN 'soon' ELSE printf('%02d:%02d:%02d', (o_orderkey * 37 % 200000) // 3600, (o_orderkey * 37 % 200000) // 60 % 60, (o_orderkey * 37 % 200000) % 60) END AS walltime,
        CASE WHEN o_orderkey % 10 = 0 THEN 10800 ELSE (o_orderkey * 37 % 200000)::INTEGER END AS seconds FROM orders""",
}
