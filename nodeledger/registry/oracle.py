"""The queries of the catalog in plain SQL, written independently for comparison."""

from __future__ import annotations

from nodeledger.registry.logs import MACHINE, QUEUES

CAPACITY = MACHINE.max_nodes

RAW = """
raw AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS job_name,
         CAST(l_suppkey AS VARCHAR) AS username_genid,
         CAST(l_suppkey % 25 AS VARCHAR) AS project_name_genid,
         p_brand AS queue_name,
         CAST(o_orderdate AS TIMESTAMP) AS queued_timestamp,
         CAST(l_shipdate AS TIMESTAMP)
           + to_seconds((l_partkey * 37 + l_linenumber * 3571) % 86400) AS start_timestamp,
         CAST(l_shipdate AS TIMESTAMP)
           + to_seconds((l_partkey * 37 + l_linenumber * 3571) % 86400)
           + to_seconds(CAST(floor(l_extendedprice) AS BIGINT)) AS end_timestamp,
         CAST(l_quantity * 1800 AS DOUBLE) AS walltime_seconds,
         CAST(floor(l_extendedprice) AS DOUBLE) AS runtime_seconds,
         CAST(l_quantity AS BIGINT) AS nodes_requested,
         CAST(p_size AS BIGINT) AS nodes_used,
         CAST(p_size AS DOUBLE) * floor(l_extendedprice) / 3600.0 AS used_core_hours,
         CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN -29 ELSE 1 END AS exit_code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

WAITED = """
waited AS (
  SELECT *, CASE WHEN start_timestamp >= queued_timestamp
                 THEN epoch_us(start_timestamp - queued_timestamp) / 1e6 END AS wait_seconds
  FROM raw
)"""

ORDER = ", ".join(
    f"{c} ASC NULLS LAST"
    for c in (
        "queued_timestamp",
        "start_timestamp",
        "end_timestamp",
        "walltime_seconds",
        "runtime_seconds",
        "username_genid",
        "queue_name",
        "project_name_genid",
        "nodes_requested",
        "nodes_used",
        "used_core_hours",
        "exit_code",
    )
)
KEEP = """runtime_seconds < 1.5 * walltime_seconds AND runtime_seconds >= 0
  AND walltime_seconds >= 0 AND used_core_hours >= 0"""

JOBS = f"""{RAW},{WAITED},
jobs AS (
  SELECT * EXCLUDE (copy_no) FROM (
    SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY {ORDER}) AS copy_no
    FROM waited WHERE {KEEP})
  WHERE copy_no = 1
)"""

EVENT_JOBS = """
jobs AS (
  SELECT event_type AS queue_name, ts AS start_timestamp,
         ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS end_timestamp,
         CAST(event_id % 40 + 1 AS BIGINT) AS nodes_used,
         CAST(event_id % 40 + 1 AS DOUBLE) * floor(value * 60) / 3600.0 AS used_core_hours
  FROM events
)"""

VALID = "valid AS (SELECT * FROM jobs WHERE queue_name IN ({}))".format(
    ", ".join(f"'{q}'" for q in QUEUES)
)
GOOD = "good AS (SELECT * FROM jobs WHERE exit_code IN (0, -29))"

SLICED = """
sliced AS (
  SELECT 'all' AS slice, * FROM jobs
  UNION ALL SELECT strftime(start_timestamp, '%Y'), * FROM jobs
  UNION ALL SELECT strftime(start_timestamp, '%Y-%m'), * FROM jobs
)"""


def _bins(name, bins):
    rows = ", ".join(
        f"({i}, '{b.name}', '{b.label}', {b.lo}, "
        + (f"{b.hi})" if b.hi != float("inf") else "CAST('infinity' AS DOUBLE))")
        for i, b in enumerate(bins)
    )
    return f"{name}(bin_id, bin_name, label, lo, hi) AS (VALUES {rows})"


SIZES = _bins("sizes", MACHINE.size_bins)
TIMES = _bins("times", MACHINE.walltime_bins)


def r(expression: str) -> str:
    """Rounded to four decimals, an exact half always up."""
    return f"(floor(CAST({expression} AS DOUBLE) * 10000 + 0.500001) / 10000)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


_CLEAN = f"""job_name, username_genid, project_name_genid, queue_name, queued_timestamp,
  {r('wait_seconds')} AS wait_seconds, start_timestamp, end_timestamp,
  {r('walltime_seconds')} AS walltime_seconds, {r('runtime_seconds')} AS runtime_seconds,
  nodes_requested, nodes_used, {r('used_core_hours')} AS used_core_hours, exit_code"""
_RAW = f"""job_name, username_genid, project_name_genid, queue_name, queued_timestamp,
  start_timestamp, end_timestamp,
  {r('walltime_seconds')} AS walltime_seconds, {r('runtime_seconds')} AS runtime_seconds,
  nodes_requested, nodes_used, {r('used_core_hours')} AS used_core_hours, exit_code"""


def _cleaning() -> dict[str, str]:
    times = ("queued_timestamp", "start_timestamp", "end_timestamp")
    parsed = ", ".join(
        f"""try_cast(CASE WHEN job_name LIKE '%-7' THEN 'not a time'
        ELSE CAST({t} AS VARCHAR) END AS TIMESTAMP) AS {t}"""
        for t in times
    )
    named = "concat('log_', coalesce(CAST(year(queued_timestamp) AS VARCHAR), 'none'), '_', exit_code, '.csv.gz')"
    audit = f"""WITH {RAW}, counted AS (
              SELECT count(*) AS n0,
                count(*) FILTER (runtime_seconds < 1.5 * walltime_seconds) AS n1,
                count(*) FILTER (runtime_seconds < 1.5 * walltime_seconds
                                 AND runtime_seconds >= 0 AND walltime_seconds >= 0) AS n2,
                count(*) FILTER ({KEEP}) AS n3,
                (SELECT count(*) FROM (SELECT DISTINCT job_name FROM raw WHERE {KEEP})) AS n4
              FROM raw)
            SELECT step, rule, rows_before, rows_after, rows_before - rows_after AS rows_dropped
            FROM (SELECT 1 AS step, 'runtime_within_limit' AS rule, n0 AS rows_before, n1 AS rows_after FROM counted
              UNION ALL SELECT 2, 'non_negative_times', n1, n2 FROM counted
              UNION ALL SELECT 3, 'non_negative_core_hours', n2, n3 FROM counted
              UNION ALL SELECT 4, 'unique_job_name', n3, n4 FROM counted)"""
    return {
        "cleaning_audit_of_writing": audit,
        "write_filtered_by_source": f"""WITH {RAW}, files AS (SELECT *, {named} AS source_file FROM raw),
            held AS (SELECT source_file, count(*) AS n, count(DISTINCT job_name) AS names, CAST(sum(nodes_used) AS BIGINT) AS nodes_used,
                {r('sum(runtime_seconds)')} AS runtime_seconds, min(queued_timestamp) AS first_queued, max(end_timestamp) AS last_end
              FROM files WHERE {KEEP} GROUP BY source_file)
            SELECT source_file, rows_read, coalesce(n, 0) AS rows_written, coalesce(names, 0) AS job_names, nodes_used, runtime_seconds,
              first_queued, last_end
            FROM (SELECT source_file, count(*) AS rows_read FROM files GROUP BY source_file) LEFT JOIN held USING (source_file)""",
        "clean_jobs": f"WITH {JOBS} SELECT {_CLEAN} FROM jobs",
        "write_clean_jobs": f"WITH {JOBS} SELECT {_CLEAN} FROM jobs",
        "scan_job_logs": f"WITH {RAW} SELECT {_RAW} FROM raw",
        "write_partitioned_jobs": f"""WITH {JOBS}
            SELECT CAST(year(start_timestamp) AS INTEGER) AS start_year,
                   CAST(month(start_timestamp) AS INTEGER) AS start_month, count(*) AS n_jobs
            FROM jobs GROUP BY 1, 2""",
        "parse_timestamps": f"WITH {RAW} SELECT job_name, {parsed} FROM raw",
        "derive_wait": f"WITH {RAW},{WAITED} SELECT {_RAW}, {r('wait_seconds')} AS wait_seconds FROM waited",
        "runtime_check": f"""WITH {RAW} SELECT {_RAW},
            {r('''CASE WHEN end_timestamp >= start_timestamp
                  THEN epoch_us(end_timestamp - start_timestamp) / 1e6 END''')} AS runtime_seconds_check
            FROM raw""",
        "clean_filters": f"WITH {RAW} SELECT {_RAW} FROM raw WHERE {KEEP}",
        "dedup_jobs": f"""WITH {RAW} SELECT {_RAW} FROM raw
            QUALIFY row_number() OVER (PARTITION BY job_name ORDER BY {ORDER}) = 1""",
        "cleaning_audit": audit,
        "successful_jobs": f"WITH {JOBS},{GOOD} SELECT {_CLEAN} FROM good",
        "valid_queue_jobs": f"WITH {JOBS},{VALID} SELECT {_CLEAN} FROM valid",
        "dropped_queue_jobs": f"""WITH {JOBS},{VALID}
            SELECT (SELECT count(*) FROM jobs) AS rows_before, (SELECT count(*) FROM valid) AS rows_kept,
                   (SELECT count(*) FROM jobs) - (SELECT count(*) FROM valid) AS rows_dropped""",
        "slices": f"""WITH {JOBS} SELECT DISTINCT CAST(year(start_timestamp) AS INTEGER) AS year,
            CAST(month(start_timestamp) AS INTEGER) AS month FROM jobs""",
        "slice_counts": f"WITH {JOBS},{SLICED} SELECT slice, count(*) AS n_jobs FROM sliced GROUP BY slice",
    }


def _summary(source: str, group: str = "") -> str:
    lead, part = (f"{group}, ", f"PARTITION BY {group}") if group else ("", "")
    return f"""SELECT {lead}queue_name, n_jobs, {r('hours')} AS core_hours,
          {r('100 * hours / sum(hours) OVER (' + part + ')')} AS share_percent, unique_users, unique_projects
        FROM (SELECT {lead}queue_name, count(*) AS n_jobs, sum(used_core_hours) AS hours,
                count(DISTINCT username_genid) AS unique_users,
                count(DISTINCT project_name_genid) AS unique_projects
              FROM {source} GROUP BY {lead}queue_name)"""


_METRICS = (
    "nodes_used",
    "nodes_requested",
    "walltime_seconds",
    "runtime_seconds",
    "wait_seconds",
    "used_core_hours",
)


def _metric_stats(source: str, group: str = "", rounded: bool = True) -> str:
    lead = f"{group}, " if group else ""
    shown = r if rounded else (lambda e: e)
    parts = [
        f"""SELECT {lead}queue_name, '{m}' AS metric, count({m}) AS n_values,
              {shown(f'avg({m})')} AS mean, {shown(f'quantile_cont(CAST({m} AS DOUBLE), 0.5)')} AS median,
              {shown(f'stddev_samp({m})')} AS std, {shown(f'quantile_cont(CAST({m} AS DOUBLE), 0.05)')} AS p5,
              {shown(f'quantile_cont(CAST({m} AS DOUBLE), 0.95)')} AS p95,
              {shown(f'CAST(min({m}) AS DOUBLE)')} AS min, {shown(f'CAST(max({m}) AS DOUBLE)')} AS max
            FROM {source} GROUP BY {lead}queue_name HAVING count({m}) > 0"""
        for m in _METRICS
    ]
    return " UNION ALL ".join(parts)


def _efficiency(source: str, rounded: bool = True) -> str:
    shown = r if rounded else (lambda e: e)
    return f"""SELECT queue_name, count(e) AS n_jobs, {shown('avg(e)')} AS mean_efficiency,
          {shown('quantile_cont(e, 0.5)')} AS median_efficiency, {shown('stddev_samp(e)')} AS std_efficiency
        FROM (SELECT queue_name, runtime_seconds / nullif(walltime_seconds, 0) AS e FROM {source})
        GROUP BY queue_name HAVING count(e) > 0"""


def _fmt(e: str) -> str:
    return f"""CASE WHEN {e} IS NULL THEN 'N/A' WHEN abs({e}) >= 1 THEN format('{{:,.2f}}', round(CAST({e} AS DOUBLE), 6))
        ELSE format('{{:.4f}}', round(CAST({e} AS DOUBLE), 6)) END"""


def _hms(e: str) -> str:
    whole = f"CAST(floor(round({e}, 6)) AS BIGINT)"
    return f"concat({whole} // 3600, 'h ', {whole} % 3600 // 60, 'm ', {whole} % 60, 's')"


def _percent(e: str) -> str:
    return f"CASE WHEN {e} IS NULL THEN 'nan%' ELSE format('{{:.2f}}%', round(100 * {e}, 6)) END"


def _count(e: str) -> str:
    return f"format('{{:,}}', CAST({e} AS BIGINT))"


def _lines() -> str:
    title = "Main Log – Detailed Queue Summary"
    header = [
        f"'{title}'",
        f"repeat('=', {len(title)})",
        "''",
        f"concat('Total jobs:       ', {_count('(SELECT count(*) FROM jobs)')})",
        f"concat('Total core-hours: ', {_fmt('(SELECT sum(used_core_hours) FROM jobs)')})",
        "concat('Queues:           ', (SELECT count(DISTINCT queue_name) FROM jobs))",
        "''",
    ]
    footer = [
        f"concat('Total Unique Users:    ', {_count('(SELECT count(DISTINCT username_genid) FROM jobs)')})",
        f"concat('Total Unique Projects: ', {_count('(SELECT count(DISTINCT project_name_genid) FROM jobs)')})",
    ]
    labels = {
        "nodes_used": ("Nodes Used", None),
        "nodes_requested": ("Nodes Requested", None),
        "walltime_seconds": ("Walltime", _hms),
        "runtime_seconds": ("Runtime", _hms),
        "wait_seconds": ("Wait Time", _hms),
        "used_core_hours": ("Core-Hours per Job", None),
    }
    blocks = [
        "SELECT queue_name, [repeat('-', 72), concat('Queue: ', queue_name), repeat('-', 72), "
        f"concat('  Jobs:           ', {_count('n_jobs')}), "
        f"concat('  Total Core-Hrs: ', {_fmt('hours')}, format(' ({{:.2f}}% of total)', round(100 * hours / total, 6)))]"
        " AS part, 0 AS part_no FROM per_queue",
        "SELECT queue_name, ['  Walltime Efficiency (runtime/walltime):', concat('    Mean: ', "
        f"{_percent('mean_efficiency')}, '  Median: ', {_percent('median_efficiency')}, '  Std: ', "
        f"{_percent('std_efficiency')})], 1 FROM eff",
    ]
    for i, (m, (label, duration)) in enumerate(labels.items(), start=2):
        f = duration or _fmt
        std = "" if duration else f", '  Std: ', {_fmt('std')}"
        blocks.append(
            f"SELECT queue_name, ['  {label}:', concat('    Mean: ', {f('mean')}, '  Median: ', "
            f"{f('median')}{std}), concat('    P5: ', {f('p5')}, '  P95: ', {f('p95')}), "
            f"concat('    Min: ', {f('min')}, '  Max: ', {f('max')})], {i} "
            f"FROM stats WHERE metric = '{m}'"
        )
    blocks.append(
        f"SELECT queue_name, [concat('  Unique Users:    ', {_count('users')}), "
        f"concat('  Unique Projects: ', {_count('projects')}), ''], 9 FROM per_queue"
    )

    def fixed(section, lines):
        return f"""SELECT {section} AS section, CAST(NULL AS VARCHAR) AS queue_name,
            CAST(unnest(range({len(lines)})) AS INTEGER) AS line_no, unnest([{', '.join(lines)}]) AS line"""

    return f"""WITH {JOBS}, stats AS ({_metric_stats('jobs', rounded=False)}),
        eff AS ({_efficiency('jobs', rounded=False)}),
        per_queue AS (SELECT queue_name, count(*) AS n_jobs, sum(used_core_hours) AS hours,
            (SELECT sum(used_core_hours) FROM jobs) AS total, count(DISTINCT username_genid) AS users,
            count(DISTINCT project_name_genid) AS projects FROM jobs GROUP BY queue_name),
        parts AS ({' UNION ALL '.join(blocks)}),
        blocks AS (SELECT queue_name, flatten(list(part ORDER BY part_no)) AS lines FROM parts GROUP BY queue_name)
        {fixed(0, header)} UNION ALL
        SELECT 1, queue_name, CAST(unnest(range(len(lines))) AS INTEGER), unnest(lines) FROM blocks
        UNION ALL {fixed(2, footer)}"""


def _queues() -> dict[str, str]:
    return {
        "queue_summary": f"WITH {JOBS} {_summary('jobs')}",
        "queue_summary_totals": f"""WITH {JOBS} SELECT count(*) AS total_jobs,
            {r('sum(used_core_hours)')} AS total_core_hours, count(DISTINCT queue_name) AS n_queues,
            count(DISTINCT username_genid) AS unique_users,
            count(DISTINCT project_name_genid) AS unique_projects FROM jobs""",
        "queue_efficiency": f"WITH {JOBS} {_efficiency('jobs')}",
        "queue_metric_stats": f"WITH {JOBS} {_metric_stats('jobs')}",
        "queue_summary_successful": f"WITH {JOBS},{GOOD} {_summary('good')}",
        "queue_metric_stats_successful": f"WITH {JOBS},{GOOD} {_metric_stats('good')}",
        "queue_summary_by_slice": f"WITH {JOBS},{SLICED} {_summary('sliced', 'slice')}",
        "queue_metric_stats_by_slice": f"WITH {JOBS},{SLICED} {_metric_stats('sliced', 'slice')}",
        "queue_summary_lines": _lines(),
    }


def _histogram(source: str, bins: str, column: str, group: str = "") -> str:
    lead = f"g.{group}, " if group else ""
    groups = f"(SELECT DISTINCT {group} FROM {source}) g," if group else ""
    same = f"AND s.{group} = g.{group}" if group else ""
    part = f"PARTITION BY {group}" if group else ""
    name = f"{group}, " if group else ""
    share = f"n_jobs / nullif(CAST(sum(n_jobs) OVER ({part}) AS DOUBLE), 0)"
    return f"""SELECT {name}bin_id, bin_name, range_label, bin_id AS bin_order, n_jobs,
          {r(share)} AS share, {r('100 * ' + share)} AS percent
        FROM (SELECT {lead}b.bin_id, b.bin_name, b.label AS range_label, (
                SELECT count(*) FROM {source} s WHERE s.{column} BETWEEN b.lo AND b.hi {same}) AS n_jobs
              FROM {groups} {bins} b)"""


def _grid(source: str, group: str = "") -> str:
    lead = f"g.{group}, " if group else ""
    groups = f"(SELECT DISTINCT {group} FROM {source}) g," if group else ""
    same = f"AND j.{group} = g.{group}" if group else ""
    return f"""SELECT {lead}s.bin_id AS size_bin, w.bin_id AS walltime_bin, s.label AS size_label,
          w.label AS walltime_label, (SELECT count(*) FROM {source} j WHERE j.nodes_used BETWEEN s.lo AND s.hi
            AND j.walltime_seconds BETWEEN w.lo AND w.hi {same}) AS n_jobs
        FROM {groups} sizes s, times w"""


def _scatter(source: str, lead: str = "", extra: str = "") -> str:
    size = f"5 + (nodes_used - 1) / CAST({CAPACITY - 1} AS DOUBLE) * 495"
    return f"""SELECT {lead}queued_timestamp, {r('walltime_seconds')} AS walltime_seconds, nodes_used,
        {r(size)} AS marker_size FROM {source} WHERE walltime_seconds >= 100 {extra}"""


def _binned() -> dict[str, str]:
    from_bins = f"{SIZES}, {TIMES}"
    matrix = ", ".join(
        f"max(CASE WHEN walltime_bin = {i} THEN CAST(nullif(n_jobs, 0) AS DOUBLE) END) AS \"{b.duration_label}\""
        for i, b in enumerate(MACHINE.walltime_bins)
    )
    return {
        "job_size_histogram": f"WITH {JOBS},{SIZES} {_histogram('jobs', 'sizes', 'nodes_used')}",
        "walltime_histogram": f"WITH {JOBS},{TIMES} {_histogram('jobs', 'times', 'walltime_seconds')}",
        "size_walltime_grid": f"WITH {JOBS},{from_bins} {_grid('jobs')}",
        "size_walltime_matrix": f"""WITH {JOBS},{from_bins}, grid AS ({_grid('jobs')})
            SELECT size_bin, size_label, {matrix}, (SELECT max(n_jobs) FROM grid) AS max_cell
            FROM grid GROUP BY size_bin, size_label""",
        "queue_job_size_histogram": f"""WITH {JOBS},{VALID},{SIZES}
            {_histogram('valid', 'sizes', 'nodes_used', 'queue_name')}""",
        "queue_walltime_histogram": f"""WITH {JOBS},{VALID},{TIMES}
            {_histogram('valid', 'times', 'walltime_seconds', 'queue_name')}""",
        "queue_size_walltime_grid": f"WITH {JOBS},{VALID},{from_bins} {_grid('valid', 'queue_name')}",
        "job_counts": f"""WITH {JOBS},{from_bins}
            SELECT 'job_size' AS part, range_label AS size_label, CAST(NULL AS VARCHAR) AS walltime_label, n_jobs
            FROM ({_histogram('jobs', 'sizes', 'nodes_used')})
            UNION ALL SELECT 'walltime', NULL, range_label, n_jobs FROM ({_histogram('jobs', 'times', 'walltime_seconds')})
            UNION ALL SELECT 'size_walltime', size_label, walltime_label, n_jobs FROM ({_grid('jobs')})""",
        "grid_of_machine_files": f"""WITH {JOBS},{VALID},{from_bins}
            SELECT *, {CAPACITY} AS capacity FROM ({_grid('valid')})""",
        "job_size_histogram_by_slice": f"""WITH {JOBS},{SLICED},{SIZES}
            {_histogram('sliced', 'sizes', 'nodes_used', 'slice')}""",
        "walltime_histogram_by_slice": f"""WITH {JOBS},{SLICED},{TIMES}
            {_histogram('sliced', 'times', 'walltime_seconds', 'slice')}""",
        "size_walltime_grid_by_slice": f"WITH {JOBS},{SLICED},{from_bins} {_grid('sliced', 'slice')}",
        "scatter_points": f"WITH {JOBS} {_scatter('jobs')}",
        "queue_scatter_points": f"WITH {JOBS},{VALID} {_scatter('valid', 'queue_name, ')}",
        "scatter_points_by_slice": f"""WITH {JOBS},{SLICED} {_scatter('sliced', 'slice, ',
            "AND (slice = 'all' OR strftime(queued_timestamp, '%Y') = slice"
            " OR strftime(queued_timestamp, '%Y-%m') = slice)")}""",
        "scatter_bounds": f"""WITH {JOBS} SELECT min(queued_timestamp) AS first_queued,
            max(queued_timestamp) AS last_queued,
            {r('(SELECT max(walltime_seconds) FROM jobs) * 1.1')} AS walltime_top
            FROM jobs WHERE walltime_seconds >= 100""",
    }


_DAYS = "['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']"


def _period_counts(source: str, period: str, bin_of: str, first: int, last: int, group: str = "") -> str:
    lead = f"{group}, " if group else ""
    return f"""(WITH seen AS (SELECT {lead}{period} AS period, {bin_of} AS bin FROM {source}
                WHERE start_timestamp IS NOT NULL),
          n AS (SELECT {lead}period, bin, count(*) AS n FROM seen GROUP BY {lead}period, bin),
          t AS (SELECT {lead}period, count(*) AS total FROM seen GROUP BY {lead}period),
          axis AS (SELECT CAST(unnest(range({first}, {last + 1})) AS BIGINT) AS bin)
        SELECT {lead}t.period, axis.bin, coalesce(n.n, 0) AS n_jobs, t.total AS n_period
        FROM t CROSS JOIN axis LEFT JOIN n ON n.period = t.period AND n.bin = axis.bin
          {f'AND n.{group} = t.{group}' if group else ''})""".replace(
        f"SELECT {lead}t.period", f"SELECT {'t.' + lead if lead else ''}t.period"
    )


def _temporal() -> dict[str, str]:
    hours = ("CAST(start_timestamp AS DATE)", "hour(start_timestamp)", 0, 23)
    days = ("weekofyear(start_timestamp)", "isodow(start_timestamp) - 1", 0, 6)
    year = ("year(start_timestamp)", "dayofyear(start_timestamp)", 1, 366)
    percent = "100.0 * n_jobs / n_period"
    spread = f"avg({percent}) AS m, stddev_samp({percent}) AS s"
    profile = f"""count(*) AS n_jobs, count(DISTINCT queue_name) AS n_queues,
            min(start_timestamp) AS min_start_timestamp, max(start_timestamp) AS max_start_timestamp,
            min(nodes_used) AS min_nodes_used, max(nodes_used) AS max_nodes_used,
            {r('min(walltime_seconds)')} AS min_walltime_seconds,
            {r('max(walltime_seconds)')} AS max_walltime_seconds"""

    def smooth(log: str, source: str, group: str = "") -> str:
        lead, part = (f"{group}, ", f"PARTITION BY {group} ") if group else ("", "")
        return f"""WITH {log},
            d AS (SELECT {lead}bin, {spread} FROM {_period_counts(source, *year, group)} GROUP BY {lead}bin),
            w AS (SELECT {lead}bin, m, s, avg(m) OVER near AS ms, avg(s) OVER near AS ss FROM d
                  WINDOW near AS ({part}ORDER BY bin ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
            SELECT {lead}CAST(bin AS INTEGER) AS day_of_year, {r('m')} AS mean_percent, {r('s')} AS std_percent,
              {r('ms')} AS mean_smooth, {r('ss')} AS std_smooth, {r('ms - ss')} AS band_low,
              {r('ms + ss')} AS band_high FROM w"""

    return {
        "hourly_counts": f"""WITH {JOBS} SELECT period AS date, CAST(bin AS INTEGER) AS hour, n_jobs, n_period
            FROM {_period_counts('jobs', *hours)}""",
        "weekday_counts": f"""WITH {JOBS} SELECT CAST(period AS INTEGER) AS iso_week,
            CAST(bin AS INTEGER) AS bin_order, n_jobs, n_period, {_DAYS}[bin + 1] AS weekday
            FROM {_period_counts('jobs', *days)}""",
        "dayofyear_counts": f"""WITH {JOBS} SELECT CAST(period AS INTEGER) AS year,
            CAST(bin AS INTEGER) AS day_of_year, n_jobs, n_period FROM {_period_counts('jobs', *year)}""",
        "hour_distribution": f"""WITH {JOBS} SELECT CAST(bin AS INTEGER) AS hour, {r('m')} AS mean_percent,
            {r('s')} AS std_percent FROM (SELECT bin, {spread} FROM {_period_counts('jobs', *hours)} GROUP BY bin)""",
        "weekday_distribution": f"""WITH {JOBS} SELECT CAST(bin AS INTEGER) AS bin_order,
            {_DAYS}[bin + 1] AS weekday, {r('m')} AS mean_percent, {r('s')} AS std_percent
            FROM (SELECT bin, {spread} FROM {_period_counts('jobs', *days)} GROUP BY bin)""",
        "dayofyear_distribution": smooth(JOBS, "jobs"),
        "dayofyear_distribution_by_slice": smooth(f"{JOBS},{SLICED}", "sliced", "slice"),
        "weekday_distribution_by_slice": f"""WITH {JOBS},{SLICED}
            SELECT slice, CAST(bin AS INTEGER) AS bin_order, {_DAYS}[bin + 1] AS weekday,
              {r('m')} AS mean_percent, {r('s')} AS std_percent
            FROM (SELECT slice, bin, {spread} FROM {_period_counts('sliced', *days, 'slice')}
                  GROUP BY slice, bin)""",
        "hour_distribution_by_slice": f"""WITH {JOBS},{SLICED}
            SELECT slice, CAST(bin AS INTEGER) AS hour, {r('m')} AS mean_percent, {r('s')} AS std_percent
            FROM (SELECT slice, bin, {spread} FROM {_period_counts('sliced', *hours, 'slice')}
                  GROUP BY slice, bin)""",
        "dataset_profile": f"WITH {JOBS} SELECT {profile} FROM jobs",
        "dataset_profile_by_slice": f"WITH {JOBS},{SLICED} SELECT slice, {profile} FROM sliced GROUP BY slice",
    }


def _dense_hours(source: str, bucket: str, **groups: str) -> str:
    """CTEs that end in ``dense``; ``groups`` are the slicing columns with their expressions."""
    names = list(groups)
    lead = "".join(f"{n}, " for n in names)
    given = "".join(f"{e} AS {n}, " for n, e in groups.items())
    using = lambda *cols: f"USING ({', '.join([*names, *cols])})"
    queues = f"JOIN q USING ({', '.join(names)})" if names else "CROSS JOIN q"
    return f"""
    s AS (SELECT {given}{bucket} AS bucket, queue_name, sum(used_core_hours) AS h FROM {source}
          WHERE start_timestamp IS NOT NULL AND queue_name IS NOT NULL GROUP BY ALL),
    b AS (SELECT {lead}bucket, sum(h) AS total FROM s GROUP BY {lead}bucket),
    q AS (SELECT DISTINCT {lead}queue_name FROM s),
    dense AS (SELECT {lead}bucket, queue_name, coalesce(h, 0) AS core_hours, total AS total_core_hours
              FROM b {queues} LEFT JOIN s {using('bucket', 'queue_name')})"""


_DAY = "CAST(start_timestamp AS DATE)"
_WEEK = "CAST(date_trunc('week', start_timestamp) AS DATE)"
_MONTH = "CAST(date_trunc('month', start_timestamp) AS DATE)"
_HOURS = f"{r('core_hours')} AS core_hours, {r('total_core_hours')} AS total_core_hours"


def _labelled(shown: str) -> str:
    return f"""
    totals AS (SELECT queue_name, sum(core_hours) AS total FROM dense GROUP BY queue_name),
    ranked AS (SELECT queue_name, total, row_number() OVER (ORDER BY total DESC, queue_name) AS place,
                 100 * total / sum(total) OVER () AS pct FROM totals),
    labels AS (SELECT queue_name, CASE WHEN {shown} THEN queue_name ELSE 'Other' END AS queue_label FROM ranked),
    merged AS (SELECT bucket, queue_label, sum(core_hours) AS core_hours
               FROM dense JOIN labels USING (queue_name) GROUP BY bucket, queue_label)"""


def _auto(log: str) -> str:
    return f"""WITH {log},
      span AS (SELECT epoch_us(max(start_timestamp) - min(start_timestamp)) / 86400e6 AS days FROM jobs),
      sized AS (SELECT *, CASE WHEN floor(days) < 30 THEN 'daily' WHEN floor(days) < 365 THEN 'weekly'
                ELSE 'monthly' END AS granularity FROM jobs, span),
      {_dense_hours('sized', f"CASE granularity WHEN 'daily' THEN {_DAY} WHEN 'weekly' THEN {_WEEK} ELSE {_MONTH} END",
                    granularity='granularity')}
      SELECT granularity, bucket, queue_name, {_HOURS} FROM dense"""


def _scope(log: str, source: str = "jobs", group: str = "") -> str:
    lead = f"{group}, " if group else ""
    join = f"JOIN span USING ({group})" if group else "CROSS JOIN span"
    by = f"GROUP BY {group}" if group else ""
    kept = {group: group} if group else {}
    bucket = f"CASE granularity WHEN 'daily' THEN {_DAY} WHEN 'weekly' THEN {_WEEK} ELSE {_MONTH} END"
    return f"""WITH {log},
      span AS (SELECT {lead}epoch_us(max(start_timestamp) - min(start_timestamp)) / 86400e6 AS days,
                 count(DISTINCT year(start_timestamp)) AS ys, count(DISTINCT month(start_timestamp)) AS ms
               FROM {source} {by}),
      sized AS (SELECT *, CASE WHEN ys > 1 THEN 'all' WHEN ms > 1 THEN 'year' ELSE 'month' END AS scope,
          CASE WHEN ys > 1 THEN (CASE WHEN floor(days) < 30 THEN 'daily' WHEN floor(days) < 365 THEN 'weekly'
                                 ELSE 'monthly' END)
               WHEN ms > 1 THEN 'weekly' ELSE 'daily' END AS granularity,
          CASE WHEN ys > 1 THEN 'all' WHEN ms > 1 THEN strftime(start_timestamp, '%Y')
               ELSE strftime(start_timestamp, '%Y-%m') END AS period FROM {source} {join}),
      {_dense_hours('sized', bucket, **kept, scope='scope', granularity='granularity', period='period')}
      SELECT {lead}scope, granularity, period, bucket, queue_name, {_HOURS} FROM dense"""


def _core_hours() -> dict[str, str]:
    monthly = f"WITH {JOBS},{_dense_hours('jobs', _MONTH)}"
    wide = ", ".join(
        f"{r(f'''sum(CASE WHEN queue_name = '{q}' THEN core_hours ELSE 0 END)''')} AS \"{q}\"" for q in QUEUES
    )

    def table(bucket: str) -> str:
        return f"WITH {JOBS},{_dense_hours('jobs', bucket)} SELECT bucket, queue_name, {_HOURS} FROM dense"

    def by_slice(bucket: str, pattern: str) -> str:
        label = f"strftime(start_timestamp, '{pattern}')"
        return f"""WITH {JOBS},{_dense_hours('jobs', bucket, slice=label)}
            SELECT slice, bucket, queue_name, {_HOURS} FROM dense"""

    running = "sum(core_hours) OVER (PARTITION BY queue_label ORDER BY bucket)"
    return {
        "daily_core_hours": table(_DAY),
        "weekly_core_hours": table(_WEEK),
        "monthly_core_hours": table(_MONTH),
        "monthly_core_hours_wide": f"""WITH {JOBS},{VALID},{_dense_hours('valid', _MONTH)}
            SELECT bucket, {wide}, {r('sum(core_hours)')} AS total_runtime_hours FROM dense GROUP BY bucket""",
        "core_hours_top_queues": f"""{monthly},{_labelled('place <= 10')}
            SELECT bucket, queue_label, {r('core_hours')} AS core_hours FROM merged""",
        "core_hours_cumulative": f"""{monthly},{_labelled('place <= 10 OR pct >= 3')}
            SELECT bucket, queue_label, {r('core_hours')} AS core_hours,
              {r(running)} AS cumulative_core_hours FROM merged""",
        "core_hours_share": f"""{monthly},{_labelled('pct >= 1')}
            SELECT queue_label, {r('sum(core_hours)')} AS core_hours,
              {r('100 * sum(core_hours) / (SELECT sum(core_hours) FROM merged)')} AS share_percent
            FROM merged GROUP BY queue_label""",
        "core_hours_auto": _auto(JOBS),
        "core_hours_auto_short": _auto(EVENT_JOBS),
        "core_hours_scope": _scope(JOBS),
        "core_hours_scope_short": _scope(EVENT_JOBS),
        "core_hours_scope_by_slice": _scope(f"{JOBS},{SLICED}", "sliced", "slice"),
        "weekly_core_hours_by_year": by_slice(_WEEK, "%Y"),
        "daily_core_hours_by_month": by_slice(_DAY, "%Y-%m"),
    }


def _levels(source: str, group: str = "") -> str:
    """CTEs that end in ``levels``: nodes in use from each instant on."""
    lead = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
    ev AS (SELECT {lead}start_timestamp AS t, nodes_used AS delta FROM {source} WHERE end_timestamp > start_timestamp
           UNION ALL SELECT {lead}end_timestamp, -nodes_used FROM {source} WHERE end_timestamp > start_timestamp),
    net AS (SELECT {lead}t, {big('sum(delta)')} AS delta FROM ev GROUP BY {lead}t),
    levels AS (SELECT {lead}t, delta, {big(f'sum(delta) OVER ({part}ORDER BY t)')} AS nodes_in_use,
                 row_number() OVER ({part}ORDER BY t) AS event_no, lead(t) OVER ({part}ORDER BY t) AS next_t
               FROM net)"""


def _stats(source: str, capacity: str, group: str = "") -> str:
    lead = f"{group}, " if group else ""
    join = f"JOIN m USING ({group})" if group else "CROSS JOIN m"
    shown = ", ".join(f"{r(f'100.0 * {s} / capacity')} AS {s.replace('_nodes', '')}_percent"
                      for s in ("min_nodes", "max_nodes", "mean_nodes", "std_nodes"))
    return f"""{_levels(source, group)},
    d AS (SELECT *, epoch_us(next_t - t) / 1e6 AS w FROM levels),
    m AS (SELECT {lead}sum(nodes_in_use * w) / sum(w) AS mean_nodes FROM d GROUP BY {lead.rstrip(', ') or '()'}),
    stats AS (SELECT {lead}{capacity} AS capacity, min(nodes_in_use) AS min_nodes, max(nodes_in_use) AS max_nodes,
                any_value(mean_nodes) AS mean_nodes,
                sqrt(sum((nodes_in_use - mean_nodes) * (nodes_in_use - mean_nodes) * w) / sum(w)) AS std_nodes
              FROM d {join} GROUP BY {lead.rstrip(', ') or '()'}),
    shown AS (SELECT {lead}{big('capacity')} AS capacity, min_nodes, max_nodes, {r('mean_nodes')} AS mean_nodes,
                {r('std_nodes')} AS std_nodes, {shown} FROM stats)"""


def _lead_part(group: str) -> tuple[str, str]:
    return (f"{group}, ", f"PARTITION BY {group} ") if group else ("", "")


def _grid_points(source: str, group: str = "") -> str:
    """CTEs that end in ``grid``: the level at each quarter of an hour."""
    lead, part = _lead_part(group)
    return f"""{_levels(source, group)},
    ends AS (SELECT {lead}epoch_us(min(t)) // 900000000 AS a, epoch_us(max(t)) // 900000000 AS z FROM levels
             {f'GROUP BY {group}' if group else ''}),
    axis AS (SELECT {lead}unnest(range(a, z + 1)) AS grid_index FROM ends),
    timeline AS (SELECT {lead}t, CAST(NULL AS BIGINT) AS grid_index, nodes_in_use FROM levels UNION ALL
                 SELECT {lead}make_timestamp(grid_index * 900000000), grid_index, NULL FROM axis),
    filled AS (SELECT {lead}t AS grid_time, grid_index, coalesce(last_value(nodes_in_use IGNORE NULLS) OVER (
                   {part}ORDER BY t, grid_index NULLS FIRST ROWS UNBOUNDED PRECEDING), 0) AS level FROM timeline),
    grid AS (SELECT {lead}grid_index, grid_time, level AS nodes_in_use, 100.0 * level / {CAPACITY} AS pct
             FROM filled WHERE grid_index IS NOT NULL)"""


def _over(group: str = "") -> str:
    """CTEs that end in ``intervals``: where ``levels`` are above capacity."""
    lead, part = _lead_part(group)
    return f"""
    flagged AS (SELECT *, nodes_in_use > {CAPACITY} AS over,
                  coalesce(lag(nodes_in_use) OVER ({part}ORDER BY t) > {CAPACITY}, false) AS was FROM levels),
    islands AS (SELECT *, sum(CASE WHEN over AND NOT was THEN 1 ELSE 0 END) OVER ({part}ORDER BY t) AS island FROM flagged),
    found AS (SELECT {lead}island, min(t) AS start_timestamp, max(t) AS end_timestamp,
                epoch_us(max(t) - min(t)) / 1e6 AS duration_seconds, max(nodes_in_use) AS max_nodes_used,
                avg(nodes_in_use) AS mean_nodes_used
              FROM islands WHERE over OR was GROUP BY {lead}island
              HAVING epoch_us(max(t) - min(t)) / 1e6 >= 60),
    intervals AS (SELECT row_number() OVER ({part}ORDER BY start_timestamp) AS interval_no, * FROM found)"""


def _trend(passes: int, log: str = EVENT_JOBS, source: str = "jobs", group: str = "") -> str:
    """Local regression with ``passes`` robust passes after the first fit."""
    lead, _ = _lead_part(group)
    by = f"GROUP BY {group}" if group else ""
    using = f"USING ({lead}x)"
    with_summary = lambda name: f"JOIN {name} USING ({group})" if group else f"CROSS JOIN {name}"
    same = f"c.{group} = o.{group} AND " if group else ""
    of_c = f"c.{lead}" if group else ""
    steps = [
        f"""{log},{_grid_points(source, group)},
    sized AS (SELECT {lead}count(*) AS n, CAST(floor(count(*) * 0.01 + 1e-10) AS BIGINT) AS k, min(grid_index) AS a
              FROM grid {by}),
    p0 AS (SELECT {lead}grid_time, grid_index - a AS x, pct AS y, 1.0::DOUBLE AS rw, n, k FROM grid {with_summary('sized')}),
    near AS (SELECT {lead}x, y, n, k, l, greatest(x - l, l + k - 1 - x) AS h
             FROM (SELECT *, least(greatest(x - k // 2, 0), n - k) AS l FROM p0))"""
    ]
    for i in range(passes + 1):
        steps.append(f"""
    w{i} AS (SELECT {of_c}c.x, c.y AS own, o.x - c.x AS d, o.y AS y,
               o.rw * pow(1 - pow(abs(o.x - c.x) / c.h, 3), 3) AS w
             FROM near c JOIN p{i} o ON {same}o.x >= c.l AND o.x < c.l + c.k),
    s{i} AS (SELECT {lead}x, any_value(own) AS own, sum(w) AS w, sum(w * d) AS wd, sum(w * d * d) AS wdd,
               sum(w * y) AS wy, sum(w * d * y) AS wdy FROM w{i} GROUP BY {lead}x),
    f{i} AS (SELECT {lead}x, CASE WHEN w > 0 THEN wy / w - (wd / w) * (wdy / w - (wd / w) * (wy / w))
               / greatest(wdd / w - (wd / w) * (wd / w), 1e-12) ELSE own END AS fit FROM s{i})""")
        if i < passes:
            steps.append(f"""
    med{i} AS (SELECT {lead}median(abs(y - fit)) AS med FROM p{i} JOIN f{i} {using} {by}),
    p{i + 1} AS (SELECT {lead}grid_time, x, y, n, k, pow(1 - pow(least(1.0, CASE WHEN med = 0
                 THEN (CASE WHEN abs(y - fit) > 0 THEN 1.0 ELSE 0.0 END) ELSE abs(y - fit) / (6 * med) END), 2), 2) AS rw
               FROM p{i} JOIN f{i} {using} {with_summary(f'med{i}')})""")
    return f"""WITH {','.join(steps)}
      SELECT {lead}grid_time, {r('y')} AS utilization_percent, {r('fit')} AS trend_percent
      FROM p{passes} JOIN f{passes} {using}"""


def _long_trend(passes: int) -> str:
    """The same over the whole log: inside the series every neighbourhood is a slice of its block's
    values, multiplied with the fixed weights; the neighbourhoods at both ends are joined as above."""
    fitted = lambda w, wd, wdd, wy, wdy: f"""CASE WHEN {w} > 0 THEN {wy} / {w} - ({wd} / {w}) * ({wdy} / {w} - ({wd} / {w}) * ({wy} / {w}))
                / greatest({wdd} / {w} - ({wd} / {w}) * ({wd} / {w}), 1e-12) ELSE own END"""  # noqa: E731
    steps = [
        f"""{JOBS},{_grid_points('jobs')},
    sized AS (SELECT count(*) AS n, CAST(floor(count(*) * 0.01 + 1e-10) AS BIGINT) AS k, min(grid_index) AS a FROM grid),
    p0 AS (SELECT grid_time, grid_index - a AS x, pct AS y, 1.0::DOUBLE AS rw, n, k FROM grid, sized),
    offsets AS (SELECT d, pow(1 - pow(abs(d) / (k // 2), 3), 3) AS w FROM (SELECT unnest(range(-(k // 2), k - k // 2)) AS d, k FROM sized)),
    weights AS (SELECT list(w ORDER BY d) AS t0, list(w * d ORDER BY d) AS t1, list(w * d * d ORDER BY d) AS t2 FROM offsets),
    near AS (SELECT x, y, k, l, greatest(x - l, l + k - 1 - x) AS h
             FROM (SELECT *, least(greatest(x - k // 2, 0), n - k) AS l FROM p0) WHERE l <> x - k // 2)"""
    ]
    for i in range(passes + 1):
        steps.append(f"""
    b{i} AS (SELECT block, min(x) AS x0, list(rw ORDER BY x) AS rs, list(rw * y ORDER BY x) AS vs FROM (
               SELECT x, y, rw, unnest([x // k - 1, x // k, x // k + 1]) AS block FROM p{i}) GROUP BY block),
    m{i} AS (SELECT p.x, p.y AS own, rs[p.x - k // 2 - x0 + 1 : p.x - k // 2 - x0 + k] AS r, vs[p.x - k // 2 - x0 + 1 : p.x - k // 2 - x0 + k] AS v
             FROM p{i} p JOIN b{i} ON block = p.x // k WHERE p.x >= k // 2 AND p.x - k // 2 <= n - k),
    w{i} AS (SELECT c.x, c.y AS own, o.x - c.x AS d, o.y AS y, o.rw * pow(1 - pow(abs(o.x - c.x) / c.h, 3), 3) AS w
             FROM near c JOIN p{i} o ON o.x >= c.l AND o.x < c.l + c.k),
    s{i} AS (SELECT x, any_value(own) AS own, sum(w) AS w, sum(w * d) AS wd, sum(w * d * d) AS wdd, sum(w * y) AS wy, sum(w * d * y) AS wdy
             FROM w{i} GROUP BY x
             UNION ALL SELECT x, own, list_dot_product(r, t0), list_dot_product(r, t1), list_dot_product(r, t2), list_dot_product(v, t0), list_dot_product(v, t1)
             FROM m{i}, weights),
    f{i} AS (SELECT x, {fitted('w', 'wd', 'wdd', 'wy', 'wdy')} AS fit FROM s{i})""")
        if i < passes:
            steps.append(f"""
    e{i} AS MATERIALIZED (SELECT grid_time, x, y, n, k, abs(y - fit) AS e FROM p{i} JOIN f{i} USING (x)),
    p{i + 1} AS MATERIALIZED (SELECT grid_time, x, y, n, k, pow(1 - pow(least(1.0, CASE WHEN med = 0
                 THEN (CASE WHEN e > 0 THEN 1.0 ELSE 0.0 END) ELSE e / (6 * med) END), 2), 2) AS rw FROM e{i}, (SELECT median(e) AS med FROM e{i}))""")
    return f"""WITH {','.join(steps)}
      SELECT grid_time, {r('y')} AS utilization_percent, {r('fit')} AS trend_percent FROM p{passes} JOIN f{passes} USING (x)"""


def _behind(group: str = "") -> dict[str, str]:
    """Intervals above capacity, the jobs at their edges, and the report of both."""
    lead, _ = _lead_part(group)
    suffix, log, jobs = ("_by_slice", f"{JOBS},{SLICED}", "sliced") if group else ("", JOBS, "jobs")
    found = f"WITH {log},{_levels(jobs, group)},{_over(group)}"
    instants = f"""instants AS (
              SELECT {lead}interval_no, 'start' AS edge, start_timestamp AS instant FROM intervals
              UNION ALL SELECT {lead}interval_no, 'end', end_timestamp FROM intervals)"""
    of_i = f"i.{lead}" if group else ""
    same = f"i.{group} = s.{group} AND " if group else ""
    met = f"FROM instants i JOIN {jobs} s ON {same}s.start_timestamp <= i.instant AND i.instant < s.end_timestamp"
    return {
        f"over_capacity_intervals{suffix}": f"""{found}
            SELECT {lead}interval_no, start_timestamp, end_timestamp, {r('duration_seconds')} AS duration_seconds,
              max_nodes_used, {r('mean_nodes_used')} AS mean_nodes_used FROM intervals""",
        f"over_capacity_jobs{suffix}": f"""{found}, {instants}
            SELECT {of_i}interval_no, edge, instant, job_name, nodes_used, s.start_timestamp, s.end_timestamp {met}""",
        f"over_capacity_lines{suffix}": f"""{found}, {instants},
            fixed AS (SELECT {lead}interval_no, unnest([0, 0, 0, 0, 0, 0, 0, 1, 3, 3, 5]) AS section,
                unnest([0, 1, 2, 3, 4, 5, 6, 0, 0, 1, 0]) AS line_no,
                unnest([repeat('=', 80), concat('Over-capacity interval ', interval_no),
                  concat('Start: ', start_timestamp), concat('End  : ', end_timestamp),
                  format('Duration: {{:.2f}} min', round(duration_seconds / 60, 6)),
                  concat('Max nodes used: ', max_nodes_used), '', 'Jobs running at START:', '',
                  'Jobs running at END:', '']) AS line FROM intervals)
            SELECT {lead}interval_no, CAST(section AS INTEGER) AS section, CAST(NULL AS VARCHAR) AS job_name,
              CAST(line_no AS INTEGER) AS line_no, line FROM fixed
            UNION ALL SELECT {of_i}interval_no, CASE edge WHEN 'start' THEN 2 ELSE 4 END, job_name, 0,
              concat('  - ', job_name, ': ', nodes_used, ' nodes (start: ', s.start_timestamp, ', end: ',
                     s.end_timestamp, ')') {met}""",
    }


def _over_time(group: str = "") -> dict[str, str]:
    """The statistics as text, the grid with its lines, and its rolling mean."""
    lead, part = _lead_part(group)
    suffix, log, jobs = ("_by_slice", f"{JOBS},{SLICED}", "sliced") if group else ("", JOBS, "jobs")
    lines = [
        "concat('Max nodes available: ', capacity)",
        "format('Max utilization: {} nodes ({:.2f} %)', max_nodes, 100.0::DOUBLE * max_nodes / capacity)",
        "format('Min utilization: {} nodes ({:.2f} %)', min_nodes, 100.0::DOUBLE * min_nodes / capacity)",
        "format('Mean utilization (time-weighted): {:.2f} nodes ({:.2f} %)', mean_nodes, 100.0 * mean_nodes / capacity)",
        "format('Std  utilization (time-weighted): {:.2f} nodes ({:.2f} %)', std_nodes, 100.0 * std_nodes / capacity)",
    ]
    stats = f"WITH {log},{_stats(jobs, str(CAPACITY), group)}"
    with_stats = f"JOIN stats USING ({group})" if group else "CROSS JOIN stats"
    return {
        f"utilization_lines{suffix}": f"""{stats}
            SELECT {lead}CAST(unnest(range(5)) AS INTEGER) AS line_no, unnest([{', '.join(lines)}]) AS line FROM stats""",
        f"utilization_grid{suffix}": f"""{stats}, {_grid_points(jobs, group).split('FROM net),', 1)[1]}
            SELECT {lead}grid_time, nodes_in_use, {r('pct')} AS utilization_percent,
              {r(f'100.0 * mean_nodes / {CAPACITY}')} AS mean_percent,
              {r(f'100.0 * (mean_nodes - std_nodes) / {CAPACITY}')} AS band_low,
              {r(f'100.0 * (mean_nodes + std_nodes) / {CAPACITY}')} AS band_high,
              CAST(50 AS DOUBLE) AS half_capacity FROM grid {with_stats}""",
        f"utilization_rolling{suffix}": f"""WITH {log},{_grid_points(jobs, group)}
            SELECT {lead}grid_time, nodes_in_use, {r('pct')} AS utilization_percent,
              {r(f"""avg(pct) OVER ({part}ORDER BY grid_time
                    RANGE BETWEEN INTERVAL '23 hours 59 minutes' PRECEDING AND CURRENT ROW)""")} AS rolling_percent
            FROM grid""",
    }


def _utilization() -> dict[str, str]:
    return {
        **_over_time(),
        **_over_time("slice"),
        **_behind(),
        **_behind("slice"),
        "utilization_events": f"""WITH {JOBS}
            SELECT job_name, start_timestamp AS t, nodes_used AS delta FROM jobs WHERE end_timestamp > start_timestamp
            UNION ALL SELECT job_name, end_timestamp, -nodes_used FROM jobs WHERE end_timestamp > start_timestamp""",
        "nodes_in_use": f"WITH {JOBS},{_levels('jobs')} SELECT * FROM levels",
        "utilization_stats": f"WITH {JOBS},{_stats('jobs', str(CAPACITY))} SELECT * FROM shown",
        "utilization_stats_without_capacity": f"""WITH {JOBS},
            {_stats('jobs', '(SELECT max(nodes_used) FROM jobs)')} SELECT * FROM shown""",
        "utilization_stats_by_slice": f"""WITH {JOBS},{SLICED},{_stats('sliced', str(CAPACITY), 'slice')}
            SELECT * FROM shown""",
        "utilization_trend": _trend(3),
        "utilization_trend_single_pass": _trend(0),
        "utilization_trend_long": _long_trend(3),
        "utilization_trend_by_slice": _trend(3, f"{EVENT_JOBS},{SLICED}", "sliced", "slice"),
        "jobs_running_at": f"""WITH {JOBS} SELECT job_name, nodes_used, start_timestamp, end_timestamp FROM jobs
            WHERE start_timestamp <= TIMESTAMP '1998-06-15 12:00:00'
              AND TIMESTAMP '1998-06-15 12:00:00' < end_timestamp""",
    }


def oracle_sql() -> dict[str, str]:
    """Equivalent SQL of every query."""
    return {
        **_cleaning(),
        **_queues(),
        **_binned(),
        **_temporal(),
        **_core_hours(),
        **_utilization(),
    }
