"""Independent ANSI-SQL (DuckDB dialect) statements for every registered query.

They read the driver's pre-registered views (``customer``, ``nation``,
``events``, ``lineitem``, ``part`` ...) and rebuild the canonical views of
``murmuration.sources.bindings`` as CTEs, so the SQL shares no code with the
Spark side.  Column names and types are aligned with the Spark results.
"""

from __future__ import annotations

from murmuration.sources.bindings import START_CENTERS

# Canonical views as SQL (mirror of sources/bindings.py, written independently).
VIEWS = """
people AS (
  SELECT c.c_custkey AS person_id, c.c_name AS name, n.n_name AS nationality,
         n.n_nationkey AS country_code, c.c_mktsegment AS hobby
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
friends AS (
  SELECT event_id AS rel_id, user_id AS person_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS friend_id,
         CAST(ts AS DATE) AS since, event_type AS relation
  FROM events
  WHERE event_type = 'signup'),
access AS (
  SELECT event_id AS access_id, user_id AS by_who,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS what_page,
         event_type AS access_type, ts AS access_time
  FROM events WHERE event_type <> 'signup'),
points AS (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity * 100 AS BIGINT) AS x,
         CAST(floor(l_extendedprice / 21) AS BIGINT) AS y
  FROM lineitem)
"""

Q09_AS_OF = "2024-02-13 00:00:00"


def _with(body: str, extra: str = "") -> str:
    ctes = VIEWS.strip()
    if extra.strip():
        ctes += ",\n" + extra.strip()
    return f"WITH {ctes}\n{body.strip()}"


SOCIAL_SQL: dict[str, str] = {
    "q01_users_by_nationality": _with("""
SELECT name, hobby FROM people WHERE lower(nationality) = 'nation_7'"""),

    # the padding added to the given values is trimmed away again
    "q02_top_pages_dedupe": """
WITH c AS (SELECT c_nationkey AS page_id, count(*) AS access_count FROM customer GROUP BY 1),
t AS (SELECT *, row_number() OVER (ORDER BY access_count DESC, page_id) AS page_rank FROM c
      ORDER BY access_count DESC, page_id LIMIT 10)
SELECT page_id, min(s_name) AS s_name, access_count, page_rank
FROM t JOIN supplier ON s_nationkey = page_id GROUP BY ALL""",

    "q11_text_times": _with(f"""
SELECT p.person_id, p.name FROM people p
WHERE p.person_id NOT IN (
  SELECT by_who FROM access WHERE access_id % 7 <> 0 AND by_who IS NOT NULL
    AND date_trunc('second', access_time) > TIMESTAMP '{Q09_AS_OF}' - INTERVAL 14 DAY)"""),

    "q02_top_pages": _with("""
SELECT p.p_partkey AS page_id, p.p_name, p.p_brand, p.p_type, t.access_count, t.page_rank
FROM part p JOIN top_n t ON p.p_partkey = t.page_id""", """
page_counts AS (SELECT l_partkey AS page_id, count(*) AS access_count FROM lineitem GROUP BY l_partkey),
top_n AS (
  SELECT page_id, access_count,
         row_number() OVER (ORDER BY access_count DESC, page_id ASC) AS page_rank
  FROM page_counts ORDER BY access_count DESC, page_id ASC LIMIT 10)"""),

    "q03_count_by_country": _with("""
SELECT nationality, count(*) AS n_people FROM people GROUP BY nationality"""),

    "q04_friend_counts_outdegree": _with("""
SELECT coalesce(b.pid, d.src) AS person_id, coalesce(b.name, 'Unknown') AS name,
       coalesce(d.friend_count, 0) AS friend_count
FROM builders b FULL OUTER JOIN outdeg d ON b.pid = d.src""", """
builders AS (SELECT s_suppkey * 3 AS pid, s_name AS name FROM supplier),
outdeg AS (SELECT person_id AS src, count(*) AS friend_count FROM friends GROUP BY person_id)"""),

    "q05_friend_counts_indegree": _with("""
SELECT p.person_id, p.name, coalesce(d.friend_count, 0) AS friend_count
FROM people p LEFT JOIN indeg d ON p.person_id = d.pid""", """
indeg AS (SELECT friend_id AS pid, count(*) AS friend_count FROM friends GROUP BY friend_id)"""),

    "q06_access_profile": _with("""
SELECT by_who AS person_id, count(*) AS total_accesses, count(DISTINCT what_page) AS distinct_pages
FROM access GROUP BY by_who"""),

    "q07_neglectful_all": _with("""
SELECT o.src AS person_id, coalesce(p.name, 'Unknown') AS name
FROM owners o LEFT JOIN people p ON o.src = p.person_id
WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.src = o.src)""", """
edges AS (SELECT person_id AS src, friend_id AS dst FROM friends),
visits AS (SELECT DISTINCT by_who AS src, what_page AS dst FROM access),
hit AS (SELECT DISTINCT e.src FROM edges e JOIN visits v ON e.src = v.src AND e.dst = v.dst),
owners AS (SELECT DISTINCT src FROM edges)"""),

    "q08_neglectful_any": _with("""
SELECT DISTINCT u.src AS person_id, p.name
FROM unvisited u JOIN people p ON u.src = p.person_id""", """
edges AS (SELECT person_id AS src, friend_id AS dst FROM friends),
visits AS (SELECT DISTINCT by_who AS src, what_page AS dst FROM access),
unvisited AS (
  SELECT DISTINCT e.src FROM edges e
  WHERE NOT EXISTS (SELECT 1 FROM visits v WHERE v.src = e.src AND v.dst = e.dst))"""),

    "q09_disconnected": _with(f"""
SELECT p.person_id, p.name
FROM people p LEFT JOIN latest l ON p.person_id = l.person_id
WHERE (l.latest_access IS NULL
       OR l.latest_access < TIMESTAMP '{Q09_AS_OF}' - INTERVAL 14 DAY)
  AND p.name IS NOT NULL""", """
latest AS (SELECT by_who AS person_id, max(access_time) AS latest_access FROM access GROUP BY by_who)"""),

    "q10_disconnected_known": _with(f"""
SELECT l.person_id, p.name
FROM latest l JOIN people p ON l.person_id = p.person_id
WHERE date_sub('day', l.latest_access, TIMESTAMP '{Q09_AS_OF}') >= 14""", """
latest AS (SELECT by_who AS person_id, max(access_time) AS latest_access FROM access GROUP BY by_who)"""),

    "q11_disconnected_antijoin": _with("""
SELECT p.person_id, p.name FROM people p
WHERE NOT EXISTS (SELECT 1 FROM active a WHERE a.person_id = p.person_id)""", """
as_of AS (SELECT max(access_time) + INTERVAL 14 DAY AS t FROM access WHERE by_who = 7),
active AS (SELECT DISTINCT a.by_who AS person_id FROM access a, as_of
           WHERE a.access_time > as_of.t - INTERVAL 14 DAY)"""),

    "q12_popular_people": _with("""
SELECT d.person_id, p.p_name AS name, d.friend_count
FROM indeg d JOIN part p ON d.person_id = p.p_partkey, mean_deg m
WHERE d.friend_count > m.a AND p.p_name IS NOT NULL""", """
indeg AS (SELECT l_partkey AS person_id, count(*) AS friend_count FROM lineitem GROUP BY l_partkey),
mean_deg AS (
  SELECT coalesce(CAST((SELECT count(*) FROM lineitem) AS DOUBLE)
                  / nullif(CAST((SELECT count(*) FROM part) AS DOUBLE), 0), 0.0) AS a)"""),

    "q13_popular_people_linked": _with("""
SELECT DISTINCT d.person_id, p.name
FROM outdeg d JOIN people p ON d.person_id = p.person_id, mean_deg m
WHERE d.num_friends > m.a""", """
outdeg AS (SELECT person_id, count(*) AS num_friends FROM friends GROUP BY person_id),
mean_deg AS (SELECT CAST(sum(num_friends) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS a FROM outdeg)"""),

    "q02_heavy_hitters": """
SELECT l_suppkey AS page_id, count(*) AS access_count FROM lineitem WHERE l_suppkey IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",

    "q04_degrees_with_counters": _with("""
SELECT coalesce(p.person_id, d.src) AS person_id, coalesce(p.name, 'Unknown') AS name,
       coalesce(d.friend_count, 0) AS friend_count, (SELECT count(*) FROM friends) AS n_edges,
       (SELECT count(*) FROM friends WHERE person_id = friend_id) AS n_self
FROM people p FULL OUTER JOIN outdeg d ON p.person_id = d.src""", """
outdeg AS (SELECT person_id AS src, count(*) AS friend_count FROM friends GROUP BY person_id)"""),

    "q04_text_ids": _with("""
SELECT CAST(coalesce(p.person_id, d.src) AS VARCHAR) AS person_id, coalesce(p.name, 'Unknown') AS name,
       coalesce(d.friend_count, 0) AS friend_count
FROM people p FULL OUTER JOIN outdeg d ON p.person_id = d.src""", """
outdeg AS (SELECT person_id AS src, count(*) AS friend_count FROM friends GROUP BY person_id)"""),

    "q05_ranked": _with("""
SELECT p.person_id, p.name, coalesce(d.friend_count, 0) AS friend_count,
       row_number() OVER (ORDER BY coalesce(d.friend_count, 0) DESC, p.person_id) AS rank
FROM people p LEFT JOIN indeg d ON p.person_id = d.pid""", """
indeg AS (SELECT friend_id AS pid, count(*) AS friend_count FROM friends GROUP BY friend_id)"""),

    "q06_profile_bucketed": _with("""
SELECT person_id, name, (SELECT count(*) FROM friends f WHERE f.person_id = p.person_id) AS n_friends,
       coalesce(n, 0) AS n_accesses, coalesce(pages, 0) AS n_pages, latest_access
FROM people p LEFT JOIN (
  SELECT by_who, count(*) AS n, count(DISTINCT what_page) AS pages, max(access_time) AS latest_access
  FROM access GROUP BY by_who) a ON a.by_who = p.person_id"""),

    "q07_neglectful_all_purchases": _with("""
SELECT o.src AS person_id, coalesce(p.name, 'Unknown') AS name
FROM owners o LEFT JOIN people p ON o.src = p.person_id
WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.src = o.src)""", """
hit AS (SELECT DISTINCT e.person_id AS src FROM friends e
        JOIN access v ON e.person_id = v.by_who AND e.friend_id = v.what_page
        WHERE v.access_type = 'purchase'),
owners AS (SELECT DISTINCT person_id AS src FROM friends)"""),

    "q08_neglectful_any_fifths": _with("""
SELECT DISTINCT e.person_id, p.name FROM friends e JOIN people p USING (person_id)
WHERE NOT EXISTS (SELECT 1 FROM access v
                  WHERE v.by_who = e.person_id AND v.what_page // 5 = e.friend_id // 5)"""),

    "q08_members_filtered": """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'signup')""",

    "q11_outsiders_filtered": """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49)""",

    "q21_access_tsv": _with("SELECT * FROM access"),
}


def all_sql() -> dict[str, str]:
    out = dict(SOCIAL_SQL)
    from murmuration import oracle_kmeans  # noqa: PLC0415  (k-means SQL builders)
    out.update(oracle_kmeans.KMEANS_SQL)
    return out


__all__ = ["SOCIAL_SQL", "START_CENTERS", "VIEWS", "all_sql"]
