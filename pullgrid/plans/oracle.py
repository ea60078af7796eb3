"""The answers of the registered queries, restated over the raw tables."""

from __future__ import annotations

from pullgrid.plans.mirror import FIRST_ID, HOST, TICKS
from pullgrid.plans.queries import BATCH, SLICES

_ISO = "'%Y-%m-%dT%H:%M:%SZ'"

# what a listing knows
_IDS = f"""
ids AS (
  SELECT o_orderkey AS k,
         {FIRST_ID} + o_orderkey AS id,
         CAST(o_orderkey + 1 AS INTEGER) AS number,
         replace(r_name, ' ', '-') || '/' || n_name AS full_name,
         n_name AS repo, n_nationkey, o_orderdate, o_orderstatus, o_orderpriority,
         c_name, c_custkey,
         CASE WHEN o_orderkey % 7 <> 0
              THEN o_orderdate + to_days(CAST(o_orderkey % 90 AS INTEGER)) END AS updated_ts,
         coalesce(updated_ts, o_orderdate) AS version_ts,
         strftime(version_ts, {_ISO}) AS version
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY o_orderdate DESC, id DESC) AS rank
  FROM ids)"""

# all fields of every pull request
_PULLS = f"""{_IDS},
stats AS (
  SELECT l_orderkey, count(*) AS commits, sum(l_quantity) AS additions,
         sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS deletions,
         count(DISTINCT l_partkey) AS changed_files, count(DISTINCT l_suppkey) AS comments
  FROM lineitem GROUP BY l_orderkey),
pulls AS (
  SELECT k, id, rank, version, o_orderdate,
         '{HOST}/repos/' || full_name || '/pulls/' || number AS url,
         url || '.html' AS html_url, url || '.diff' AS diff_url, url || '.patch' AS patch_url,
         number,
         CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state,
         o_orderpriority AS title,
         CASE WHEN k % 10 <> 0 THEN 'order ' || k END AS body,
         CAST(epoch(o_orderdate) AS BIGINT) AS created_at,
         CAST(epoch(updated_ts) AS BIGINT) AS updated_at,
         CASE WHEN o_orderstatus = 'F'
              THEN CAST(epoch(o_orderdate + INTERVAL 30 DAY) AS BIGINT) END AS closed_at,
         o_orderstatus = 'F' AND k % 2 = 0 AS merged,
         CASE WHEN merged THEN closed_at END AS merged_at,
         'master' AS base_ref, md5(CAST(k AS VARCHAR)) AS base_sha,
         CAST(n_nationkey AS BIGINT) AS repo_id, repo AS repo_name, full_name AS repo_full_name,
         CAST(NULL AS VARCHAR) AS repo_description, n_nationkey % 2 = 1 AS repo_private,
         '{HOST}/repos/' || full_name AS repo_url, repo_url || '.html' AS repo_html_url,
         c_name AS user_login, c_custkey AS user_id,
         '{HOST}/users/' || c_custkey AS user_url, user_url || '.html' AS user_html_url,
         CASE WHEN k % 3 <> 0 THEN k % 2 = 0 END AS mergeable,
         CAST(coalesce(comments, 0) AS INTEGER) AS comments,
         CAST(coalesce(commits, 0) AS INTEGER) AS commits,
         CAST(coalesce(additions, 0) AS INTEGER) AS additions,
         CAST(coalesce(deletions, 0) AS INTEGER) AS deletions,
         CAST(coalesce(changed_files, 0) AS INTEGER) AS changed_files
  FROM ranked LEFT JOIN stats ON k = l_orderkey)"""

_FLAT = """SELECT id, url, html_url, diff_url, patch_url, number, state, title, body,
  created_at, updated_at, closed_at, merged_at, base_ref, base_sha, repo_id, repo_name,
  repo_full_name, repo_description, repo_private, repo_url, repo_html_url, user_login, user_id,
  user_url, user_html_url, merged, mergeable, comments, commits, additions, deletions,
  changed_files FROM pulls"""

# every pull request at every tick
_TICKS = f"""
ticks AS (
  SELECT id, tick, o_orderstatus,
         CASE WHEN tick - 1 >= k % 4 THEN k % 4 ELSE 0 END AS shift,
         version_ts + to_days(CAST(shift AS INTEGER)) AS moved_at,
         strftime(moved_at, {_ISO}) AS version,
         CAST(epoch(moved_at) AS BIGINT) AS seconds,
         CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state
  FROM ids CROSS JOIN (SELECT unnest(range(1, {TICKS + 1})) AS tick))"""

ORACLE: dict[str, str] = {
    "pr_scan": f"WITH {_PULLS} {_FLAT}",
    "pr_table": f"WITH {_PULLS} {_FLAT}",
    "decode_strict": f"WITH {_PULLS} {_FLAT}",
    "page_plan": """
        WITH repos AS (
          SELECT replace(r_name, ' ', '-') || '/' || n_name AS full_name,
                 1 + (n_nationkey * 41) % 1000 AS batch
          FROM nation JOIN region ON n_regionkey = r_regionkey)
        SELECT full_name, CAST(page AS INTEGER) AS page,
               CAST(least(batch, 100) AS INTEGER) AS per_page,
               CAST(least(100, batch - (page - 1) * 100) AS INTEGER) AS rows_wanted
        FROM (SELECT *, unnest(generate_series(1, CAST(ceil(batch / 100.0) AS BIGINT))) AS page
              FROM repos)""",
    "list_top_batch": f"""
        WITH {_IDS} SELECT full_name, id, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE rank <= {BATCH}""",
    "work_items": f"""
        WITH {_IDS} SELECT full_name, rank, id, number, version,
          'pr-' || id || '-' || replace(replace(version, ':', '='), ' ', '=') || '.cache'
            AS cache_key
        FROM ranked""",
    "slice_items": f"""
        WITH {_IDS}, numbered AS (
          SELECT id, count(*) OVER () AS total,
                 row_number() OVER (ORDER BY substr(md5(full_name), 1, 3), full_name, rank) - 1
                   AS position
          FROM ranked)
        SELECT CAST(((position + 1) * {SLICES} - 1) // total AS BIGINT) AS slice,
               count(*) AS n, min(id) AS min_id, max(id) AS max_id
        FROM numbered GROUP BY 1""",
    "cache_hits": f"""
        WITH {_IDS}, cached AS (
          SELECT id, version FROM ids WHERE k % 3 = 0
          UNION ALL
          SELECT id, strftime(version_ts - INTERVAL 1 DAY, {_ISO}) FROM ids WHERE k % 3 = 1)
        SELECT id, number, version FROM ids i
        WHERE EXISTS (SELECT 1 FROM cached c WHERE c.id = i.id AND c.version = i.version)""",
    "cache_misses": f"""
        WITH {_IDS}, cached AS (
          SELECT id, version FROM ids WHERE k % 3 = 0
          UNION ALL
          SELECT id, strftime(version_ts - INTERVAL 1 DAY, {_ISO}) FROM ids WHERE k % 3 = 1)
        SELECT id, number, version FROM ids i
        WHERE NOT EXISTS (SELECT 1 FROM cached c WHERE c.id = i.id AND c.version = i.version)""",
    "fetch_through_cache": f"""
        WITH {_PULLS}
        SELECT repo_full_name AS full_name, rank, id, number, version, commits,
               CASE WHEN k % 3 = 0 THEN 'cache' ELSE 'fetch' END AS origin
        FROM pulls""",
    "decode_violations": f"""
        WITH {_IDS}, found AS (
          SELECT CASE k % 11 WHEN 0 THEN 'MISSING_KEY' WHEN 1 THEN 'REQUIRED_NULL'
                   WHEN 2 THEN 'WRONG_TYPE' WHEN 3 THEN 'WRONG_TYPE' WHEN 4 THEN 'OVERFLOW'
                   WHEN 5 THEN 'BAD_TIMESTAMP' WHEN 7 THEN 'MALFORMED'
                   WHEN 9 THEN 'NOT_OBJECT' END AS rule,
                 CASE k % 11 WHEN 0 THEN 'commits' WHEN 1 THEN 'merged' WHEN 2 THEN 'title'
                   WHEN 3 THEN 'additions' WHEN 4 THEN 'additions' WHEN 5 THEN 'created_at'
                   ELSE '' END AS field
          FROM ids)
        SELECT rule, field, count(*) AS n FROM found WHERE rule IS NOT NULL GROUP BY 1, 2""",
    "fetch_quarantine": f"""
        WITH {_IDS}
        SELECT id, CASE WHEN k % 11 = 8 THEN 404 ELSE 200 END AS status,
               CASE WHEN k % 11 IN (6, 10) THEN 'ok' ELSE 'failed' END AS outcome,
               CASE k % 11 WHEN 0 THEN 'MISSING_KEY commits' WHEN 1 THEN 'REQUIRED_NULL merged'
                 WHEN 2 THEN 'WRONG_TYPE title' WHEN 3 THEN 'WRONG_TYPE additions'
                 WHEN 4 THEN 'OVERFLOW additions' WHEN 5 THEN 'BAD_TIMESTAMP created_at'
                 WHEN 7 THEN 'MALFORMED' WHEN 8 THEN 'HTTP_404' WHEN 9 THEN 'NOT_OBJECT'
                 END AS reason
        FROM ids""",
    "point_lookup": f"""
        WITH {_IDS}, keys AS (
          SELECT full_name, number FROM ids
          UNION ALL
          SELECT replace(r_name, ' ', '-') || '/' || n_name,
                 CAST(100000000 + n_nationkey AS INTEGER)
          FROM nation JOIN region ON n_regionkey = r_regionkey)
        SELECT keys.full_name, keys.number,
               CASE WHEN id IS NULL THEN 404 ELSE 200 END AS status,
               id IS NOT NULL AS found, id, o_orderpriority AS title
        FROM keys LEFT JOIN ids ON keys.full_name = ids.full_name AND keys.number = ids.number""",
    "dedup_listing": f"""
        WITH {_IDS}, overlap AS (
          SELECT id, number, version FROM ranked
          UNION ALL SELECT id, number, version FROM ranked WHERE rank BETWEEN 91 AND 135)
        SELECT id, number, max(version) AS version FROM overlap GROUP BY id, number""",
    "latest_snapshot": f"""
        WITH {_IDS}, {_TICKS}
        SELECT id, arg_max(version, seconds) AS version, arg_max(state, seconds) AS state
        FROM ticks GROUP BY id""",
    "nested_projection": f"""
        WITH {_PULLS} SELECT number, title, state, repo_full_name AS full_name,
          user_login AS login, commits, additions, deletions FROM pulls""",
    "filter_commits": """
        SELECT {first} + o_orderkey AS id, CAST(o_orderkey + 1 AS INTEGER) AS number,
               o_orderpriority AS title, CAST(count(*) AS INTEGER) AS commits
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        GROUP BY o_orderkey, o_orderpriority HAVING count(*) > 10""".format(first=FIRST_ID),
    "top_prs": f"""
        WITH {_PULLS} SELECT id, number, title FROM pulls ORDER BY id DESC LIMIT 10""",
    "sql_view": f"""
        WITH {_PULLS} SELECT number, title FROM pulls ORDER BY o_orderdate DESC, id DESC LIMIT 10""",
    "stream_full": f"""
        WITH {_PULLS}
        SELECT CAST(tick AS BIGINT) AS tick, count(*) AS n,
               CAST(sum(additions) AS BIGINT) AS additions,
               min(id) AS min_id, max(id) AS max_id
        FROM pulls CROSS JOIN (SELECT unnest(range(1, {TICKS + 1})) AS tick) GROUP BY 1""",
    "stream_changes": f"""
        WITH {_IDS}, {_TICKS}
        SELECT id, seconds AS version, CAST(min(tick) AS BIGINT) AS tick
        FROM ticks GROUP BY id, seconds""",
    "stream_upsert": f"""
        WITH {_IDS}, {_TICKS}
        SELECT id, max(seconds) AS version, arg_max(state, seconds) AS state
        FROM ticks GROUP BY id""",
    "stream_ingest": f"""
        WITH {_IDS}, {_TICKS} SELECT DISTINCT id, version, 200 AS status FROM ticks""",
    "repo_summary": f"""
        WITH {_PULLS}
        SELECT repo_full_name AS full_name, count(*) AS prs,
               count(*) FILTER (WHERE merged) AS merged,
               CAST(count(*) FILTER (WHERE merged) AS DOUBLE) / count(*) AS merge_rate,
               CAST(sum(additions) AS BIGINT) AS additions,
               CAST(sum(deletions) AS BIGINT) AS deletions,
               CAST(sum(commits) AS BIGINT) AS commits
        FROM pulls GROUP BY 1""",
    "cache_compact": f"""
        WITH {_IDS}
        SELECT id, CASE WHEN k % 3 = 0 THEN version
                        ELSE strftime(version_ts - INTERVAL 1 DAY, {_ISO}) END AS version,
               CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS fetched_ms
        FROM ids WHERE k % 3 <> 2""",
    "cache_retention": f"""
        WITH {_IDS}, {_TICKS}
        SELECT id, arg_max(version, seconds) AS version FROM ticks GROUP BY id""",
    "fetch_versions": f"""
        WITH {_IDS}, {_TICKS}
        SELECT a.id, a.version, b.version AS carried, true AS known_later
        FROM ticks a JOIN ticks b ON a.id = b.id AND a.tick = 1 AND b.tick = {TICKS}""",
    "file_cache": f"""
        SELECT {FIRST_ID} + s_suppkey AS id,
               strftime(TIMESTAMP '2016-01-01' + to_days(CAST(s_suppkey % 400 AS INTEGER)), {_ISO})
                 AS version,
               CAST(s_suppkey + 1 AS INTEGER) AS number, s_name AS title,
               s_suppkey % 2 = 0 AS merged
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    "listing_violations": f"""
        WITH {_IDS}, elements AS (
          SELECT full_name, k, (rank - 1) // 100 + 1 AS page FROM ranked),
        found AS (
          SELECT CASE k % 7 WHEN 0 THEN 'MISSING_KEY' WHEN 1 THEN 'WRONG_TYPE' WHEN 2 THEN 'OVERFLOW'
                   ELSE 'REQUIRED_NULL' END AS rule,
                 CASE k % 7 WHEN 0 THEN 'number' WHEN 1 THEN 'id' WHEN 2 THEN 'number'
                   WHEN 3 THEN 'url' ELSE 'created_at' END AS field
          FROM elements WHERE page <> 2 AND k % 7 < 5
          UNION ALL
          SELECT 'NOT_ARRAY', '' FROM elements WHERE page = 2 GROUP BY full_name)
        SELECT rule, field, count(*) AS n FROM found GROUP BY 1, 2""",
    "text_violations": f"""
        WITH {_IDS}
        SELECT CASE WHEN k % 5 IN (0, 1) THEN 'TRAILING_TEXT' WHEN k % 5 IN (2, 3)
                 THEN 'REPEATED_KEY' ELSE 'none' END AS rule, count(*) AS n
        FROM ids GROUP BY 1""",
    "poll_listing": f"""
        WITH {_IDS} SELECT full_name, rank, id, version FROM ranked""",
    "stream_diff": f"""
        WITH {_IDS}, {_TICKS}, here AS (
          SELECT tick, id, version FROM ticks WHERE (id - {FIRST_ID}) % 6 <> tick),
        steps AS (SELECT id, tick FROM ids CROSS JOIN (SELECT unnest(range(1, {TICKS + 1})) AS tick))
        SELECT CAST(s.tick AS BIGINT) AS tick, s.id,
               CASE WHEN b.id IS NULL THEN 'insert' WHEN a.id IS NULL THEN 'gone'
                 ELSE 'update' END AS change,
               a.version, b.version AS was
        FROM steps s LEFT JOIN here a ON a.id = s.id AND a.tick = s.tick
             LEFT JOIN here b ON b.id = s.id AND b.tick = s.tick - 1
        WHERE a.version IS DISTINCT FROM b.version""",
    "stream_changes_bounded": f"""
        WITH {_IDS}, {_TICKS}, here AS (
          SELECT tick, id, version FROM ticks WHERE (id - {FIRST_ID}) % 6 <> tick)
        SELECT a.id, a.version, CAST(a.tick AS BIGINT) AS tick
        FROM here a LEFT JOIN here b ON b.id = a.id AND b.tick = a.tick - 1
        WHERE a.version IS DISTINCT FROM b.version""",
}
