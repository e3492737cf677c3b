"""DuckDB text of the fixture tables (FIXTURES.md §2), for the oracle statements.

Each oracle statement starts with ``WITH`` + the fixture CTEs it needs, then
states its operator independently in SQL over them.  Ids are cast to BIGINT
and flags to INTEGER so both engines agree on types.
"""

from __future__ import annotations

import re

TS_DEL = "TIMESTAMP '2002-01-01 00:00:00'"

_ORDER_SPAN = ("(SELECT o_custkey, MIN(o_orderdate) AS created_at, MAX(o_orderdate) AS updated_at "
               "FROM orders GROUP BY o_custkey)")

FIXTURES: dict[str, str] = {
    "users": f"""
SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name,
       CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS mobile,
       CAST(CASE WHEN c_custkey % 20 = 0 THEN 1 WHEN c_custkey % 20 IN (1, 2) THEN 2
                 WHEN c_custkey % 20 = 3 THEN 4 ELSE 3 END AS INTEGER) AS type,
       CAST(CASE WHEN c_custkey % 20 = 2 THEN 1 WHEN c_custkey % 40 = 1 THEN NULL ELSE 0 END AS INTEGER)
           AS is_master_trainer,
       CAST(CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_nationkey END AS BIGINT) AS centre_id,
       CAST(NULL AS BIGINT) AS project_id,
       CAST(c_nationkey % 5 AS BIGINT) AS organisation_id,
       CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 WHEN c_custkey % 3 = 1 THEN 0 END AS INTEGER) AS is_ple,
       CAST(CASE WHEN c_custkey % 31 = 0 THEN 0 ELSE 1 END AS INTEGER) AS status,
       CASE WHEN c_custkey % 4 = 0 THEN 'male' WHEN c_custkey % 4 = 1 THEN 'FEMALE'
            WHEN c_custkey % 4 = 2 THEN 'x' END AS gender,
       c_mktsegment AS created_platform, o.created_at, o.updated_at,
       CASE WHEN c_custkey % 37 = 0 THEN {TS_DEL} END AS deleted_at
FROM customer LEFT JOIN {_ORDER_SPAN} o ON o.o_custkey = c_custkey""",
    "student_details": f"""
SELECT CAST(c_custkey AS BIGINT) AS user_id,
       CAST(CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_nationkey * 10 + (c_custkey + twin) % 2 END AS BIGINT) AS batch_id,
       CAST(CASE WHEN c_custkey % 5 = 0 THEN c_custkey % 6 END AS BIGINT) AS trade_id,
       CASE WHEN c_custkey % 7 = 0 THEN 'Female' END AS gender,
       CAST(c_custkey % 9 AS BIGINT) AS educational_qualification_id,
       CAST(c_custkey % 4 AS BIGINT) AS placement_status_id,
       CAST(2000 + c_custkey % 2 AS INTEGER) AS active_year,
       CAST(1998 + c_custkey % 3 AS INTEGER) AS year_of_admission,
       o.created_at, o.updated_at
FROM customer JOIN (VALUES (0), (1)) AS t(twin) ON twin = 0 OR c_custkey % 50 = 8
LEFT JOIN {_ORDER_SPAN} o ON o.o_custkey = c_custkey
WHERE c_custkey % 20 >= 3 AND c_custkey % 11 <> 0""",
    "login_logs": "SELECT CAST(user_id AS BIGINT) AS user_id, ts AS created_at FROM events",
    "centres": f"""
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_regionkey AS BIGINT) AS organisation_id,
       CAST(n_nationkey % 3 AS BIGINT) AS centre_type_id, CAST(n_nationkey % 2 AS INTEGER) AS ple_enabled,
       CAST(CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 END AS INTEGER) AS status,
       CAST(n_regionkey AS BIGINT) AS state_id, CAST(n_nationkey AS BIGINT) AS district_id,
       CASE WHEN n_nationkey = 23 THEN {TS_DEL} END AS deleted_at
FROM nation""",
    "organisations": """
SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name,
       CAST(CASE WHEN r_regionkey = 3 THEN 0 ELSE 1 END AS INTEGER) AS status,
       CAST(NULL AS TIMESTAMP) AS deleted_at
FROM region""",
    "states": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM region",
    "districts": "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation",
    "centre_types": """
SELECT DISTINCT CAST(n_nationkey % 3 AS BIGINT) AS id,
       CASE n_nationkey % 3 WHEN 0 THEN 'iti' WHEN 1 THEN 'ngo' ELSE 'vti' END AS type,
       CONCAT('Type ', CAST(n_nationkey % 3 AS VARCHAR)) AS name
FROM nation""",
    "subjects": f"""
SELECT CAST(b AS BIGINT) AS id, p_brand AS name, CAST(b % 3 AS INTEGER) AS is_ple,
       CAST(NULL AS BIGINT) AS ple_career_path_id,
       CAST(CASE WHEN b % 4 = 0 THEN NULL ELSE b % 4 - 1 END AS INTEGER) AS year_to_map,
       CAST(CASE WHEN b = 25 THEN 0 ELSE 1 END AS INTEGER) AS status,
       CASE WHEN b = 24 THEN {TS_DEL} END AS deleted_at
FROM (SELECT DISTINCT p_brand, CAST(REPLACE(p_brand, 'Brand#', '') AS INTEGER) AS b FROM part) t""",
    "lessons": f"""
SELECT CAST(p_partkey AS BIGINT) AS id,
       CASE WHEN p_partkey % 13 = 0 THEN CONCAT(p_name, ' assessment') ELSE p_name END AS name,
       CAST(REPLACE(p_brand, 'Brand#', '') AS BIGINT) AS subject_id,
       CAST(p_size AS INTEGER) AS lesson_order,
       CAST(CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_assessment,
       CAST(CASE WHEN p_partkey % 8 = 0 THEN 0 ELSE 1 END AS INTEGER) AS student_access,
       CAST(p_partkey % 2 AS INTEGER) AS facilitator_access,
       CAST(CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS mastertrainer_access,
       CAST(CASE WHEN p_partkey % 29 = 0 THEN 1 ELSE 0 END AS BIGINT) AS lesson_category_id,
       p_type AS lesson_type_id,
       CAST(CASE WHEN p_partkey % 41 = 0 THEN 0 ELSE 1 END AS INTEGER) AS status,
       CASE WHEN p_partkey % 43 = 0 THEN {TS_DEL} END AS deleted_at
FROM (SELECT p_partkey % 500 AS p_partkey, MIN(p_name) AS p_name, MIN(p_brand) AS p_brand,
             MIN(p_type) AS p_type, MIN(p_size) AS p_size FROM part GROUP BY p_partkey % 500) folded""",
    "lesson_types": """
SELECT DISTINCT p_type AS id,
       CASE p_type WHEN 'SMALL' THEN ' PDF ' WHEN 'LARGE' THEN 'mp4' WHEN 'STANDARD' THEN 'Pdf Web'
                   WHEN 'MEDIUM' THEN 'quiz' ELSE 'video' END AS name
FROM part WHERE p_type <> 'PROMO'""",
    "centre_subject": """
SELECT CAST(n_nationkey AS BIGINT) AS centre_id, s.id AS subject_id, CAST(s.id AS INTEGER) AS subject_order
FROM nation CROSS JOIN subjects s WHERE (n_nationkey + s.id) % 3 <> 0""",
    "batches": f"""
SELECT DISTINCT batch_id AS id, CONCAT('Batch ', CAST(batch_id AS VARCHAR)) AS name,
       CAST(CASE WHEN batch_id % 70 = 0 THEN 4 ELSE 1 END AS INTEGER) AS status,
       CASE WHEN batch_id % 110 = 1 THEN {TS_DEL} END AS deleted_at
FROM student_details WHERE batch_id IS NOT NULL""",
    "batch_subject": """
SELECT b.id AS batch_id, s.id AS subject_id FROM batches b CROSS JOIN subjects s
WHERE (b.id + s.id) % 4 <> 0""",
    "trades": """
SELECT DISTINCT CAST(c_custkey % 6 AS BIGINT) AS id, CONCAT('Trade ', CAST(c_custkey % 6 AS VARCHAR)) AS name,
       CAST(CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 1 + c_custkey % 2 END AS INTEGER) AS duration
FROM customer""",
    "subject_trade": """
SELECT t.id AS trade_id, s.id AS subject_id FROM trades t CROSS JOIN subjects s
WHERE (t.id + s.id) % 2 = 0""",
    "learning_activities": """
SELECT CAST(o_custkey AS BIGINT) AS user_id, CAST(l_partkey % 500 AS BIGINT) AS lesson_id,
       CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS completed,
       CAST(l_quantity * 2 AS DECIMAL(10,2)) AS score,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber % 5 + 1 AS DECIMAL(10,2)) END AS rating,
       CAST(CAST(l_quantity AS INTEGER) * 60 AS INTEGER) AS duration,
       l_shipdate AS created_at, l_shipdate AS updated_at
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "facilitator_learning_activities": "SELECT * FROM learning_activities WHERE lesson_id % 2 = 1",
    "ple_career_paths": f"""
SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name,
       CASE WHEN r_regionkey = 4 THEN {TS_DEL} END AS deleted_at
FROM region""",
    "ple_career_path_user": """
SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS BIGINT) AS user_id,
       CAST(o_orderkey % 5 AS BIGINT) AS job_type_id,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS INTEGER) AS status,
       o_orderdate AS updated_at,
       CASE WHEN o_orderkey % 17 = 0 THEN o_orderdate END AS deleted_at
FROM orders""",
    "subject_ple_career_path": """
SELECT CAST(r_regionkey AS BIGINT) AS ple_career_path_id, s.id AS subject_id
FROM region CROSS JOIN subjects s WHERE (r_regionkey + s.id) % 2 = 0""",
    "programs": """
SELECT CAST(r_regionkey AS BIGINT) AS id,
       CASE r_regionkey WHEN 0 THEN 'Program A' WHEN 1 THEN 'Program B' ELSE r_name END AS name,
       CAST(CASE WHEN r_regionkey = 4 THEN 0 ELSE 1 END AS INTEGER) AS status,
       CAST(NULL AS TIMESTAMP) AS deleted_at
FROM region""",
    "projects": """
SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(n_regionkey AS BIGINT) AS program_id,
       CONCAT('Project ', n_name) AS name,
       CAST(CASE WHEN n_nationkey = 9 THEN 0 ELSE 1 END AS INTEGER) AS status,
       CAST(NULL AS TIMESTAMP) AS deleted_at
FROM (SELECT n_nationkey % 10 AS n_nationkey, MIN(n_regionkey) AS n_regionkey, MIN(n_name) AS n_name
      FROM nation GROUP BY n_nationkey % 10) folded""",
    "centre_project": """
SELECT CAST(n_nationkey AS BIGINT) AS centre_id, p.id AS project_id
FROM nation CROSS JOIN projects p WHERE (n_nationkey + p.id) % 5 = 0""",
    "phases": """
SELECT CAST(n_nationkey AS BIGINT) AS id, CONCAT('Phase_', CAST(n_nationkey AS VARCHAR)) AS name,
       CAST(NULL AS TIMESTAMP) AS deleted_at
FROM (SELECT DISTINCT n_nationkey % 6 AS n_nationkey FROM nation) folded""",
    "phase_project": """
SELECT ph.id AS phase_id, p.id AS project_id FROM phases ph CROSS JOIN projects p
WHERE (ph.id + p.id) % 2 = 0""",
    "centre_phase": f"""
SELECT CAST(n_nationkey AS BIGINT) AS centre_id, ph.id AS phase_id,
       CASE WHEN n_nationkey = 3 THEN {TS_DEL} END AS deleted_at
FROM nation CROSS JOIN phases ph WHERE (n_nationkey + ph.id) % 2 = 0""",
    "batch_phase": """
SELECT b.id AS batch_id, ph.id AS phase_id, CAST(NULL AS TIMESTAMP) AS deleted_at
FROM batches b CROSS JOIN phases ph WHERE (b.id + ph.id) % 3 = 0""",
    "phase_users": f"""
SELECT CAST(c_custkey AS BIGINT) AS user_id, CAST(c_custkey % 6 AS BIGINT) AS phase_id,
       CASE WHEN c_custkey % 23 = 0 OR c_custkey % 2 = 1 THEN {TS_DEL} END AS deleted_at
FROM customer""",
    "languages": "SELECT CAST(r_regionkey % 3 AS BIGINT) AS id, MIN(r_name) AS name FROM region GROUP BY r_regionkey % 3",
    "ple_assessments": """
SELECT CAST(n_nationkey AS BIGINT) AS id,
       CASE WHEN n_nationkey < 3 THEN 'baseline' ELSE 'endline' END AS stage,
       CONCAT('Pathway ', CAST(n_nationkey % 3 AS VARCHAR)) AS pathway,
       CAST(NULL AS VARCHAR) AS title, CAST(NULL AS TIMESTAMP) AS deleted_at
FROM (SELECT DISTINCT n_nationkey % 6 AS n_nationkey FROM nation) folded""",
    "ple_assessment_pages": """
SELECT CAST(a.id * 10 + n_nationkey AS BIGINT) AS id, a.id AS assessment_id,
       CONCAT('Page ', CAST(n_nationkey AS VARCHAR)) AS page_title,
       CAST(n_nationkey AS INTEGER) AS sort_order, CAST(NULL AS TIMESTAMP) AS deleted_at
FROM ple_assessments a CROSS JOIN (SELECT DISTINCT n_nationkey % 2 AS n_nationkey FROM nation) folded""",
    "ple_assessment_questions": """
SELECT CAST(pg.assessment_id * 100 + l.id * 10 + n_nationkey AS BIGINT) AS id,
       pg.id AS assessment_page_id, l.id AS language_id,
       CONCAT('Q', CAST(n_nationkey AS VARCHAR), ' ', l.name) AS question,
       CAST(NULL AS VARCHAR) AS question_type, CAST(NULL AS VARCHAR) AS option_type,
       CAST(NULL AS VARCHAR) AS response_type,
       CAST(1 AS INTEGER) AS sort_order, TIMESTAMP '2001-01-01 00:00:00' AS created_at,
       CAST(NULL AS TIMESTAMP) AS deleted_at
FROM ple_assessment_pages pg CROSS JOIN languages l
CROSS JOIN (SELECT DISTINCT n_nationkey % 4 AS n_nationkey FROM nation) folded
WHERE pg.sort_order = n_nationkey % 2""",
    "ple_assessment_options": """
SELECT CAST(q.id * 10 + n_nationkey AS BIGINT) AS id, q.id AS assessment_question_id,
       CAST(CASE WHEN n_nationkey = 3 AND q.id % 5 = 0 THEN 1 ELSE n_nationkey END AS INTEGER) AS sort_order,
       CONCAT('Option ', CAST(n_nationkey AS VARCHAR)) AS opt,
       CAST(CASE WHEN n_nationkey = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_correct_option,
       CAST(CAST(n_nationkey AS DECIMAL(10,2)) / 2 AS DECIMAL(10,2)) AS score,
       CAST(NULL AS TIMESTAMP) AS deleted_at
FROM ple_assessment_questions q CROSS JOIN (SELECT DISTINCT n_nationkey % 4 AS n_nationkey FROM nation) folded""",
    "ple_assessment_responses": f"""
SELECT CAST(event_id AS BIGINT) AS id, CAST(user_id AS BIGINT) AS user_id,
       CAST(CASE WHEN event_type = 'signup' THEN user_id % 3 ELSE 3 + event_id % 3 END AS BIGINT) AS assessment_id,
       CAST(CASE WHEN value > 5 THEN 1 ELSE 0 END AS INTEGER) AS is_complete,
       CAST(value AS DECIMAL(10,2)) AS final_score, CAST(NULL AS DECIMAL(10,2)) AS rating,
       ts AS created_at, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS updated_at,
       CASE WHEN user_id % (CASE event_type WHEN 'signup' THEN 5 ELSE 4 END) = 0 THEN {TS_DEL} END AS deleted_at
FROM events WHERE event_type IN ('signup', 'purchase')""",
    "ple_assessment_response_keys": """
SELECT r.id AS assessment_responses_id, q.id AS assessment_question_id,
       CAST(CASE WHEN (r.id + q.id) % 4 = 3 THEN NULL ELSE q.id * 10 + (r.id + q.id) % 3 END AS BIGINT)
           AS assessment_option_id,
       CASE WHEN (r.id + q.id) % 4 = 3 THEN
            CASE r.id % 3 WHEN 0 THEN ' . ' WHEN 1 THEN ' free text ' ELSE '' END END AS response_text,
       CAST(NULL AS TIMESTAMP) AS deleted_at
FROM ple_assessment_responses r
JOIN ple_assessment_pages pg ON pg.assessment_id = r.assessment_id
JOIN ple_assessment_questions q ON q.assessment_page_id = pg.id AND q.language_id = r.user_id % 3""",
}

ORDER = list(FIXTURES)


def _deps(name: str) -> set[str]:
    text = FIXTURES[name]
    return {other for other in FIXTURES
            if other != name and re.search(rf"\b(FROM|JOIN)\s+{other}\b", text)}


def with_fixtures(body: str) -> str:
    """Prefix ``body`` with the fixture CTEs it (transitively) references."""
    needed: set[str] = set()
    todo = [n for n in FIXTURES if re.search(rf"\b{n}\b", body)]
    while todo:
        n = todo.pop()
        if n in needed:
            continue
        needed.add(n)
        todo.extend(_deps(n) - needed)
    ctes = [f"{n} AS ({FIXTURES[n].strip()})" for n in ORDER if n in needed]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
