"""What the registered queries must return, as SQL for another engine.

Range fragments are stated here by their bounds or in whole-number arithmetic,
not by the formula the package uses, so that the two check each other.
"""

from __future__ import annotations

# Ratings read from orders; r2 is the rating in half stars.
_RATINGS = """
r AS (
  SELECT o_custkey AS userid, o_orderkey AS movieid,
         CAST(o_orderkey % 11 AS DOUBLE) / 2.0 AS rating,
         o_orderkey % 11 AS r2, o_orderdate, o_orderpriority
  FROM orders
)
"""


def _ratings(query: str) -> str:
    return f"WITH {_RATINGS} {query}"


def _by_bounds(value: str, bounds: list[float]) -> str:
    """A CASE over explicit bounds: the first range closed, then ascending upper bounds."""
    first = f"WHEN {value} < {bounds[0]} THEN NULL WHEN {value} BETWEEN {bounds[0]} AND {bounds[1]} THEN 0"
    others = " ".join(f"WHEN {value} <= {high} THEN {i}" for i, high in enumerate(bounds[2:], 1))
    return f"CAST(CASE {first} {others} END AS INT)"


def _half_star_fragment(n: str) -> str:
    """Fragment of r2 half stars out of 10, in whole numbers: ceil(r2 * n / 10) - 1, at least 0."""
    return f"CAST(greatest(0, (r2 * {n} + 9) // 10 - 1) AS INT)"


_RANGE = _by_bounds("rating", [0, 1, 2, 3, 4, 5])
_OLD = "o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"
_ROUND_ROBIN = "CAST((row_number() OVER (ORDER BY movieid) - 1) % 5 AS INT)"
_BALANCE = _by_bounds("c_acctbal", [0, 2000, 4000, 6000, 8000])
_EVENT_RANGE = _by_bounds("value", [0, 100, 200, 300, 400, 500])

_LOADED = _ratings("SELECT userid, movieid, rating FROM r")

_SPLIT = _ratings(f"SELECT userid, movieid, rating, {_RANGE} AS fragment_id FROM r")

# Old rows first, then new ones, each in key order.
_DEALT = f"""
dealt AS (
  SELECT userid, movieid, rating,
         CAST((row_number() OVER (ORDER BY CASE WHEN {_OLD} THEN 0 ELSE 1 END, movieid) - 1) % 5 AS INT) AS fragment_id
  FROM r
)
"""

_SIZES_OF = """
SELECT CAST(i AS INT) AS fragment_id, CAST((SELECT count(*) FROM {table}) // {n}
       + CASE WHEN i < (SELECT count(*) FROM {table}) % {n} THEN 1 ELSE 0 END AS BIGINT) AS {name}
FROM range({n}) AS t(i)
"""


def _dealt_sizes(table: str, n: int, name: str = "n_rows") -> str:
    return _SIZES_OF.format(table=table, n=n, name=name)


ORACLES: dict[str, str] = {
    "load_delimited": _LOADED,
    "load_split_lines": _LOADED,
    "load_filler_columns": _LOADED,
    "load_drop_short": _ratings("""
        SELECT CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'u' ELSE '' END || CAST(userid AS VARCHAR) AS userid,
               movieid, rating
        FROM r WHERE o_orderpriority <> '1-URGENT'"""),
    "load_ignore_errors": _ratings("""
        SELECT userid, movieid, rating FROM r
        WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""),
    "load_reject_report": """
        SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'short' WHEN '2-HIGH' THEN 'long'
                    WHEN '3-MEDIUM' THEN 'untypable userid' ELSE 'accepted' END AS reason,
               CAST(count(*) AS BIGINT) AS n_lines
        FROM orders GROUP BY 1""",
    "load_quarantine": """
        WITH l AS (
          SELECT row_number() OVER (ORDER BY o_orderkey) AS position, o_orderpriority AS p,
                 CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'u' ELSE '' END || o_custkey || '::' || o_orderkey || '::'
                   || CAST(o_orderkey % 11 AS DOUBLE) / 2.0 AS head
          FROM orders)
        SELECT CAST(position AS BIGINT) AS position,
               CASE p WHEN '1-URGENT' THEN 'short' WHEN '2-HIGH' THEN 'long' ELSE 'untypable userid' END AS reason,
               '  ' || head || CASE p WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN '::838985046::x' ELSE '::838985046' END
                 || ' ' AS line
        FROM l WHERE p IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "check_load": """
        WITH c AS (SELECT CAST(count(*) AS BIGINT) AS n,
                          CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS BIGINT) AS short,
                          CAST(count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS BIGINT)
                            AS bad
                   FROM orders)
        SELECT 'fail' AS policy, n AS n_lines, CAST(0 AS BIGINT) AS left_out, n AS stored_rows, true AS agrees FROM c
        UNION ALL SELECT 'drop_short', n, short, n - short, true FROM c
        UNION ALL SELECT 'skip', n, bad, n - bad, true FROM c""",
    "load_append_twice": _ratings("""
        SELECT userid, movieid, rating FROM r UNION ALL SELECT userid, movieid, rating FROM r"""),
    "load_metrics": """
        SELECT CAST(count(*) AS BIGINT) AS n_rows,
               CAST(count(*) FILTER (WHERE c_acctbal IS NULL) AS BIGINT) AS null_rows,
               CAST(count(*) FILTER (WHERE c_acctbal IS NULL OR c_acctbal < 0 OR c_acctbal > 5000) AS BIGINT)
                 AS out_of_range_rows,
               min(c_acctbal) AS min_value, max(c_acctbal) AS max_value
        FROM customer""",
    "export_csv": _ratings("""
        SELECT CAST(userid AS VARCHAR) || ',' || CAST(movieid AS VARCHAR) || ',' || CAST(rating AS VARCHAR) AS line
        FROM r"""),
    "export_tsv": _LOADED,
    "range_partition": _SPLIT,
    "range_partition_quantity": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
               CAST(greatest(0, (CAST(l_quantity AS BIGINT) * 7 + 49) // 50 - 1) AS INT) AS fragment_id
        FROM lineitem WHERE l_quantity BETWEEN 0 AND 50""",
    "range_partition_many": f"""
        SELECT o_orderkey, o_totalprice, {_by_bounds("o_totalprice", [i * 10000 for i in range(51)])} AS fragment_id
        FROM orders WHERE o_totalprice BETWEEN 0 AND 500000""",
    "range_partition_drop": f"""
        SELECT c_custkey, c_acctbal, {_BALANCE} AS fragment_id
        FROM customer WHERE c_acctbal BETWEEN 0 AND 8000""",
    "range_partition_clamp": f"""
        SELECT c_custkey, c_acctbal,
               CAST(CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal > 8000 THEN 3 ELSE {_BALANCE} END AS INT)
                 AS fragment_id
        FROM customer WHERE c_acctbal IS NOT NULL""",
    "range_append": _SPLIT,
    "range_boundary_assign": _ratings(f"""
        SELECT rating, CAST(count(*) AS BIGINT) AS n_rows, CAST(n AS INT) AS n_fragments,
               {_half_star_fragment("n")} AS fragment_id
        FROM r, (VALUES (3), (5), (6), (7), (11), (15)) AS t(n) GROUP BY rating, r2, n"""),
    "range_fragment_scan": _ratings("""
        SELECT userid, movieid, rating FROM r WHERE rating >= 0 AND rating <= 1
        UNION ALL SELECT userid, movieid, rating FROM r WHERE rating > 3 AND rating <= 4"""),
    "range_pruned_query": _ratings(f"""
        SELECT userid, movieid, rating, {_RANGE} AS fragment_id FROM r WHERE rating BETWEEN 1.2 AND 3.5"""),
    "range_expected_counts": _ratings(f"""
        SELECT {_RANGE} AS fragment_id, CAST(count(*) AS BIGINT) AS n_rows FROM r GROUP BY 1"""),
    "range_expected_counts_sparse": _ratings(f"""
        SELECT CAST(i AS INT) AS fragment_id, CAST(count(r2) AS BIGINT) AS n_rows
        FROM range(15) AS t(i) LEFT JOIN r ON {_half_star_fragment("15")} = i GROUP BY i"""),
    "global_row_number": """
        SELECT o_orderkey, o_totalprice,
               CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_index
        FROM orders""",
    "global_row_number_hot_key": """
        SELECT event_type, event_id,
               CAST(row_number() OVER (ORDER BY event_type, event_id) - 1 AS BIGINT) AS row_index
        FROM events""",
    "rr_partition": _ratings(f"SELECT userid, movieid, rating, {_ROUND_ROBIN} AS fragment_id FROM r"),
    "rr_partition_storage_order": _dealt_sizes("lineitem", 7),
    "rr_partition_ties": _ratings("""
        SELECT userid, fragment_id, CAST(count(*) AS BIGINT) AS n_rows
        FROM (SELECT userid,
                     CAST((row_number() OVER (ORDER BY userid, movieid) - 1) % 5 AS INT) AS fragment_id
              FROM r)
        GROUP BY userid, fragment_id"""),
    "rr_partition_reserved_name": """
        SELECT o_orderkey, o_custkey AS row_index, o_totalprice AS "row",
               CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 5 AS INT) AS fragment_id
        FROM orders""",
    "append_compacted": f"""
        WITH {_RATINGS}, dealt AS (
          SELECT userid, movieid, rating,
                 CAST((row_number() OVER (
                   ORDER BY CASE WHEN {_OLD} THEN 0 WHEN movieid % 2 = 0 THEN 1 ELSE 2 END, movieid) - 1) % 5 AS INT)
                   AS fragment_id
          FROM r)
        SELECT userid, movieid, rating, fragment_id FROM dealt
        UNION ALL SELECT userid, movieid, rating, CAST(-1 AS INT) FROM r""",
    "rr_append": f"WITH {_RATINGS}, {_DEALT} SELECT userid, movieid, rating, fragment_id FROM dealt",
    "rr_append_with_base": f"""
        WITH {_RATINGS}, {_DEALT}
        SELECT userid, movieid, rating, fragment_id FROM dealt
        UNION ALL SELECT userid, movieid, rating, CAST(-1 AS INT) FROM r""",
    "rr_fragment_scan": _ratings(f"""
        SELECT userid, movieid, rating
        FROM (SELECT userid, movieid, rating, {_ROUND_ROBIN} AS fragment_id FROM r) WHERE fragment_id = 2"""),
    "rr_expected_counts": _ratings("""
        SELECT CAST((rn - 1) % 5 AS INT) AS fragment_id, CAST(count(*) AS BIGINT) AS n_rows
        FROM (SELECT row_number() OVER (ORDER BY movieid) AS rn FROM r) GROUP BY 1"""),
    "rr_cursor": """
        SELECT CAST(CASE WHEN count(*) = 0 THEN -1 ELSE (count(*) - 1) % 5 END AS INT) AS last_index FROM orders""",
    "row_count": "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM lineitem",
    "union_fragment_count": "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM orders",
    "fragment_list": _ratings(f"""
        SELECT CAST(i AS INT) AS fragment_id, 'range_part' || CAST(i AS VARCHAR) AS fragment_name,
               CAST(count(r2) AS BIGINT) AS n_rows
        FROM range(15) AS t(i) LEFT JOIN r ON {_half_star_fragment("15")} = i GROUP BY i"""),
    "fragment_count": "SELECT CAST(CASE WHEN count(*) > 0 THEN 15 END AS BIGINT) AS n_fragments FROM orders",
    "catalog_entries": f"""
        SELECT 'ratings' AS table_name, 'base' AS kind, CAST(0 AS INT) AS partition_count,
               CAST(count(*) FILTER (WHERE {_OLD}) AS BIGINT) AS n_rows, CAST(NULL AS INT) AS last_partition_index
        FROM orders
        UNION ALL
        SELECT 'ratings', 'range', 5, count(*) FILTER (WHERE {_OLD}), NULL FROM orders
        UNION ALL
        SELECT 'ratings', 'round_robin', 7, count(*), CAST((count(*) - 1) % 7 AS INT) FROM orders""",
    "fragment_catalog": _ratings(f"""
        SELECT CAST(i AS INT) AS fragment_id,
               CAST(i AS DOUBLE) * CAST(5.0 AS DOUBLE) / CAST(15.0 AS DOUBLE) AS lower_bound,
               CAST(i + 1 AS DOUBLE) * CAST(5.0 AS DOUBLE) / CAST(15.0 AS DOUBLE) AS upper_bound,
               CAST(count(r2) AS BIGINT) AS n_rows, min(rating) AS min_value, max(rating) AS max_value
        FROM range(15) AS t(i) LEFT JOIN r ON {_half_star_fragment("15")} = i GROUP BY i"""),
    "point_lookup": _ratings("""
        SELECT CAST(count(*) AS BIGINT) AS n_rows
        FROM (SELECT userid, movieid, rating FROM r UNION ALL SELECT 100, 2, 3.0)
        WHERE rating > 2 AND rating <= 3 AND userid = 100 AND movieid = 2 AND rating = 3"""),
    "rr_point_lookup": """
        SELECT CAST(i AS INT) AS fragment_id,
               CAST(CASE WHEN i = (SELECT count(*) FROM orders) % 5 THEN 1 ELSE 0 END
                    + (SELECT count(*) FROM (SELECT o_custkey AS u, o_orderkey AS m, o_orderkey % 11 AS r2,
                                                    (row_number() OVER (ORDER BY o_orderkey) - 1) % 5 AS f FROM orders)
                       WHERE u = 100 AND m = 1 AND r2 = 6 AND f = i) AS BIGINT) AS n_rows
        FROM range(5) AS t(i)""",
    "lookup_defaults": """
        SELECT 'ratings' AS table_name, CAST(CASE WHEN count(*) >= 0 THEN 5 END AS INT) AS range_count,
               CAST(0 AS INT) AS round_robin_count, CAST(0 AS INT) AS cursor_count, CAST(-1 AS INT) AS last_index
        FROM orders
        UNION ALL SELECT 'unknown', 0, 0, 0, -1""",
    "check_completeness": f"""
        WITH split AS (SELECT c_custkey, c_acctbal FROM customer WHERE {_BALANCE} IS NOT NULL),
             missing AS (SELECT c_custkey, c_acctbal FROM customer EXCEPT ALL SELECT * FROM split)
        SELECT CAST((SELECT count(*) FROM customer) AS BIGINT) AS base_rows,
               CAST((SELECT count(*) FROM split) AS BIGINT) AS split_rows,
               CAST((SELECT count(*) FROM missing) AS BIGINT) AS missing_rows,
               (SELECT count(*) FROM missing) = 0 AS complete""",
    "check_disjointness": _ratings(f"""
        , base AS (SELECT userid, movieid, rating FROM r),
        split AS (SELECT * FROM base UNION ALL SELECT userid, movieid, rating FROM r WHERE NOT ({_OLD})),
        extra AS (SELECT * FROM split EXCEPT ALL SELECT * FROM base)
        SELECT CAST((SELECT count(*) FROM base) AS BIGINT) AS base_rows,
               CAST((SELECT count(*) FROM split) AS BIGINT) AS split_rows,
               CAST((SELECT count(*) FROM extra) AS BIGINT) AS extra_rows,
               (SELECT count(*) FROM extra) = 0 AS disjoint"""),
    "check_reconstruction": """
        SELECT CAST(count(*) AS BIGINT) AS base_rows, CAST(count(*) AS BIGINT) AS split_rows,
               CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows, true AS reconstructs
        FROM lineitem""",
    "indexed_lookup": """
        SELECT movieid, CAST(n AS BIGINT) AS n_rows
        FROM (SELECT min(o_orderkey) AS movieid, 1 AS n FROM orders UNION ALL SELECT max(o_orderkey), 1 FROM orders
              UNION ALL SELECT max(o_orderkey) + 1, 0 FROM orders)""",
    "footer_profile": _ratings(f"""
        , f AS (SELECT {_half_star_fragment("15")} AS fragment_id, rating FROM r)
        SELECT CAST(i AS INT) AS fragment_id, CAST(count(rating) AS BIGINT) AS n_rows, min(rating) AS min_value, max(rating) AS max_value
        FROM range(15) AS t(i) LEFT JOIN f ON f.fragment_id = i GROUP BY i"""),
    "sketch_profile": f"""
        SELECT {_by_bounds("l_quantity", [0, 10, 20, 30, 40, 50])} AS fragment_id, CAST(count(*) AS BIGINT) AS n_rows,
               true AS ranks_within, true AS distinct_within
        FROM lineitem GROUP BY 1""",
    "interval_pairs": """
        SELECT c_custkey, CAST(count(*) AS BIGINT) AS n_orders, min(o_orderkey) AS first_order
        FROM customer JOIN orders
          ON CAST(o_totalprice AS DOUBLE) BETWEEN CAST(c_acctbal AS DOUBLE) * 10 AND CAST(c_acctbal AS DOUBLE) * 10 + 2000
        WHERE o_totalprice <= 100000 GROUP BY c_custkey""",
    "check_prints": """
        SELECT CAST(count(*) AS BIGINT) AS base_rows, CAST(count(*) AS BIGINT) AS split_rows, true AS reconstructs
        FROM orders""",
    "fragment_prints": _ratings(f"""
        SELECT CAST(CASE WHEN {_OLD} THEN 0 ELSE 1 END AS INT) AS commit, {_RANGE} AS fragment_id,
               CAST(count(*) AS BIGINT) AS n_rows
        FROM r GROUP BY 1, 2"""),
    "damaged_rows": _ratings("""
        SELECT userid, movieid, rating, CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS BIGINT) AS missing_rows,
               CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS BIGINT) AS extra_rows
        FROM r WHERE userid % 50 = 0 AND o_orderpriority IN ('1-URGENT', '5-LOW')"""),
    "check_range_fragments": _ratings(f"""
        SELECT {_half_star_fragment("7")} AS fragment_id, CAST(count(*) AS BIGINT) AS expected_rows,
               CAST(count(*) AS BIGINT) AS actual_rows, CAST(0 AS BIGINT) AS difference
        FROM r GROUP BY 1"""),
    "check_rr_fragments": f"""
        SELECT fragment_id, expected_rows, expected_rows AS actual_rows, CAST(0 AS BIGINT) AS difference
        FROM ({_dealt_sizes("orders", 7, "expected_rows")})""",
    "check_rr_balance": f"""
        SELECT min(n_rows) AS smallest, max(n_rows) AS largest, max(n_rows) - min(n_rows) <= 1 AS balanced
        FROM ({_dealt_sizes("part", 7)})""",
    "stream_range_append": f"""
        SELECT event_id, value, {_EVENT_RANGE} AS fragment_id FROM events WHERE value BETWEEN 0 AND 500""",
    "stream_range_commits": f"""
        SELECT event_id, value, {_EVENT_RANGE} AS fragment_id FROM events WHERE value BETWEEN 0 AND 500""",
    "stream_rr_append": """
        SELECT event_id, value,
               CAST((row_number() OVER (
                 ORDER BY CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END, event_id
               ) - 1) % 5 AS INT) AS fragment_id
        FROM events""",
}
