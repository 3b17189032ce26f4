"""SQL twins of the catalog's queries, written independently of the operators.

They run on any ANSI engine with the usual date functions over the same tables.
"""

from __future__ import annotations

_RAW = """
raw AS (
  SELECT event_id AS n, CAST(event_id AS VARCHAR) AS ID,
         CAST(user_id % 10 AS INTEGER) AS JOURNAL_ID, CAST(user_id AS INTEGER) AS STUDENT_ID,
         CAST(ts AS DATE) AS LESSON_DATE,
         CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 0 WHEN 'purchase' THEN 2
              WHEN 'signup' THEN 3 ELSE 9 END AS INTEGER) AS ATTENDANCE_MARK,
         CAST(CASE WHEN event_id % 131 = 7 THEN 3000000000 + event_id % 3 WHEN event_id % 4 >= 2 THEN event_id % 120
              WHEN event_id % 4 = 1 THEN user_id + 1 ELSE user_id END AS BIGINT) AS MARKED_BY,
         ts AS DATE_CREATE,
         CAST(strftime(ts, '%Y%m%d') AS BIGINT) * 10 + 1
           + CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 3 AS LESSON_ID,
         0 AS TYPE_MARK, CAST(NULL AS INTEGER) AS NUMBER_CERT,
         CAST(event_id % 4 AS INTEGER) AS MARKED_BY_ROLE
  FROM events)"""

# The columns of the wire format, written out so that the twins share no code.
_RAW_COLS = [
    "ID", "JOURNAL_ID", "STUDENT_ID", "LESSON_DATE", "ATTENDANCE_MARK", "MARKED_BY",
    "DATE_CREATE", "LESSON_ID", "TYPE_MARK", "NUMBER_CERT", "MARKED_BY_ROLE",
]
_KEY = "JOURNAL_ID, STUDENT_ID, LESSON_ID, LESSON_DATE"

_VALID = _RAW + """,
valid AS (SELECT * FROM raw WHERE ATTENDANCE_MARK IN (0, 1, 2, 3))"""


def _age(key: str) -> str:
    birth = f"(DATE '1985-01-01' + CAST({key} % 6000 AS INTEGER))"
    return f"""CAST(CASE WHEN {key} % 11 = 0 OR {key} % 13 = 0 THEN 0
      ELSE 2024 - year({birth})
        - CASE WHEN month({birth}) * 100 + day({birth}) > 201 THEN 1 ELSE 0 END END AS INTEGER)"""


_PEOPLE = f"""
places AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
students AS (
  SELECT CAST(c_custkey AS VARCHAR) AS ENRICHED_STUDENT_ID, c_name AS STUDENT_FIO,
         '' AS STUDENT_LAST_NAME, '' AS STUDENT_FIRST_NAME, '' AS STUDENT_MIDDLE_NAME,
         {_age('c_custkey')} AS STUDENT_AGE,
         CASE WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'f' END AS STUDENT_SEX,
         CAST(CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 2015 + c_custkey % 8 END AS INTEGER)
           AS ADMISSION_YEAR,
         '' AS QUALIFICATION, CAST(c_custkey % 6 AS INTEGER) AS COURSE,
         c_mktsegment AS GROUP_SHORT_TITLE, n_name AS SPECIALIZATION_TITLE
  FROM customer JOIN places ON c_nationkey = n_nationkey
  WHERE c_custkey % 7 <> 3 AND c_custkey <> 0),
teachers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS ENRICHED_MARKED_BY, s_name AS TEACHER_FIO,
         '' AS TEACHER_LAST_NAME, '' AS TEACHER_FIRST_NAME, '' AS TEACHER_MIDDLE_NAME,
         CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'position ' || CAST(s_suppkey % 3 AS VARCHAR) END
           AS TEACHER_WORK_POSITION,
         r_name AS FACULTY, n_name AS KAFEDRA,
         {_age('s_suppkey')} AS TEACHER_AGE, '' AS TEACHER_SEX
  FROM supplier JOIN places ON s_nationkey = n_nationkey
  WHERE s_suppkey <> 0)"""

# The columns of the two people views.
_STUDENT_COLS = [
    "STUDENT_FIO", "STUDENT_LAST_NAME", "STUDENT_FIRST_NAME", "STUDENT_MIDDLE_NAME", "STUDENT_AGE",
    "STUDENT_SEX", "ADMISSION_YEAR", "QUALIFICATION", "COURSE", "GROUP_SHORT_TITLE",
    "SPECIALIZATION_TITLE",
]
_TEACHER_COLS = [
    "TEACHER_FIO", "TEACHER_LAST_NAME", "TEACHER_FIRST_NAME", "TEACHER_MIDDLE_NAME",
    "TEACHER_WORK_POSITION", "FACULTY", "KAFEDRA", "TEACHER_AGE", "TEACHER_SEX",
]
_ALL = ", ".join(_RAW_COLS + _STUDENT_COLS + _TEACHER_COLS)
_RAW_LIST = ", ".join(_RAW_COLS)


def _enriched(source: str) -> str:
    """CTEs up to ``enriched`` over ``raw`` or ``valid``."""
    return f"""{_VALID},{_PEOPLE},
enriched AS (
  SELECT {source}.*, {', '.join(_STUDENT_COLS + _TEACHER_COLS)}
  FROM {source}
  LEFT JOIN students ON CAST(STUDENT_ID AS VARCHAR) = ENRICHED_STUDENT_ID
  LEFT JOIN teachers ON CAST(MARKED_BY AS VARCHAR) = ENRICHED_MARKED_BY AND MARKED_BY_ROLE IN (2, 3))"""


_MART_VALUES = [c for c in _RAW_COLS[4:] if c != "LESSON_ID"] + _STUDENT_COLS + _TEACHER_COLS


def _mart(time: str = "DATE_CREATE") -> str:
    values = ", ".join(
        f"{time if c == 'DATE_CREATE' else c} AS {c.lower()}_v" for c in _MART_VALUES
    )
    names = ", ".join(f"{c.lower()}_v AS {c.lower()}" for c in _MART_VALUES)
    return f"""{_enriched('valid')},
ranked AS (
  SELECT {_KEY}, {values},
         row_number() OVER (PARTITION BY {_KEY} ORDER BY {time} DESC, ID DESC) AS place
  FROM enriched),
mart AS (SELECT {_KEY}, {names} FROM ranked WHERE place = 1)"""


_STORE_TIME = "date_trunc('millisecond', DATE_CREATE - INTERVAL 3 HOUR)"

_DOUBLED = _RAW + """,
doubled AS (
  SELECT * FROM raw
  UNION ALL
  SELECT * REPLACE (DATE_CREATE + INTERVAL 1 MINUTE AS DATE_CREATE) FROM raw WHERE n % 3 = 0)"""

_REQUESTS = _RAW + """,
requests AS (
  SELECT ID AS request_id, n % 211 = 0 AS nothing,
         CASE WHEN n % 101 <> 0 AND n % 211 <> 0 THEN JOURNAL_ID END AS journal_id,
         CASE WHEN n % 211 = 0 OR n % 103 = 0 THEN NULL WHEN n % 113 = 0 THEN 3000000000
              ELSE CAST(STUDENT_ID AS BIGINT) END AS user_id,
         n % 107 = 0 AS no_lesson, LESSON_ID AS lesson_id,
         CASE WHEN n % 211 <> 0 THEN ATTENDANCE_MARK END AS mark,
         CASE WHEN n % 211 = 0 THEN NULL WHEN n % 10 = 7 THEN LESSON_DATE + 1 WHEN n % 3 = 0 THEN LESSON_DATE END AS lesson_date,
         n % 101 = 0 AS no_journal, CASE WHEN n % 127 = 0 THEN 5000000000 ELSE MARKED_BY END AS requester,
         DATE_CREATE AS requested_at,
         CASE WHEN n % 109 = 0 THEN 'guest' WHEN MARKED_BY_ROLE >= 2 THEN 'employee' ELSE 'student' END AS kind
  FROM raw),
lessons AS (
  SELECT DISTINCT LESSON_ID AS lesson_id, LESSON_DATE AS held_on,
         CAST(1 + LESSON_ID % 8 AS INTEGER) AS NUMBER, LESSON_ID % 17 = 0 AS blocked
  FROM raw WHERE LESSON_ID % 23 <> 0),
slots(NUMBER, opens, closes) AS (VALUES
  (1, TIME '09:00:00', TIME '10:30:00'), (2, TIME '10:45:00', TIME '12:15:00'),
  (3, TIME '12:30:00', TIME '14:00:00'), (4, TIME '15:00:00', TIME '16:30:00'),
  (5, TIME '16:45:00', TIME '18:15:00'), (6, TIME '18:30:00', TIME '20:00:00'),
  (7, TIME '20:15:00', TIME '21:45:00'), (8, TIME '22:00:00', TIME '23:30:00')),
facts AS (
  SELECT r.*, l.held_on, l.NUMBER, l.blocked, s.opens,
         CAST(requested_at AS TIME) > s.opens AND CAST(requested_at AS TIME) < s.closes AS in_slot,
         coalesce((SELECT count(*) FROM supplier WHERE s_suppkey = requester
                   AND s_suppkey % 3 = 0 AND (s_suppkey + 1) % 10 = journal_id), 0) > 0 AS has_grant,
         coalesce((SELECT count(*) FROM customer WHERE c_custkey = requester
                   AND c_custkey % 10 = journal_id), 0) > 0 AS has_group,
         coalesce((SELECT count(*) FROM supplier WHERE s_suppkey = requester
                   AND s_suppkey % 10 = journal_id), 0) > 0 AS responsible,
         coalesce((SELECT count(*) FROM customer WHERE c_custkey = requester
                   AND c_custkey % 20 = journal_id + 1), 0) > 0 AS monitor,
         coalesce((SELECT count(*) FROM supplier WHERE s_suppkey = requester
                   AND s_suppkey % 4 = 0), 0) > 0 AS dean
  FROM requests r LEFT JOIN lessons l ON r.lesson_id = l.lesson_id AND NOT no_lesson AND NOT nothing
  LEFT JOIN slots s ON l.NUMBER = s.NUMBER),
judged AS (
  SELECT *,
    CASE WHEN nothing THEN 'empty'
         WHEN no_journal THEN 'missing:journalId'
         WHEN NOT coalesce(journal_id > 0, FALSE) THEN 'bad_journal'
         WHEN NOT coalesce(user_id BETWEEN 1 AND 2147483647, FALSE) THEN 'bad_user'
         WHEN no_lesson THEN 'bad_lesson'
         WHEN mark NOT IN (0, 1, 2, 3) THEN 'bad_attendance'
         WHEN requester > 4294967295 THEN 'bad_marker' END AS input_reason,
    CASE WHEN kind = 'employee' AND requester = 0 THEN 'no_dean_id'
         WHEN kind = 'employee' AND NOT has_grant AND NOT responsible THEN 'no_journal_access'
         WHEN kind = 'employee' THEN NULL
         WHEN kind = 'guest' THEN 'unknown_kind'
         WHEN monitor OR has_grant THEN
           CASE WHEN NOT has_group AND NOT has_grant THEN 'no_journal_access' END
         WHEN requester IS DISTINCT FROM user_id THEN 'only_self'
         WHEN NOT has_group THEN 'no_journal_access' END AS access_reason,
    CASE WHEN held_on IS NULL THEN 'lesson_not_found' WHEN blocked THEN 'lesson_blocked'
         WHEN lesson_date <> held_on THEN 'date_mismatch' END AS lesson_reason,
    CASE WHEN kind = 'student' AND opens IS NULL THEN 'bad_slot'
         WHEN kind = 'student' AND NOT in_slot THEN 'outside_slot' END AS slot_reason,
    CASE WHEN kind = 'employee' AND dean AND mark IN (2, 3) THEN 3
         WHEN kind = 'employee' THEN 2
         WHEN kind = 'guest' THEN NULL
         WHEN monitor OR has_grant THEN 1 ELSE 0 END AS role
  FROM facts)"""


def _arbitrated(source: str, extra: str = "") -> str:
    """Recursive walk over ``source``: each step looks at what was accepted last."""
    return f"""
numbered AS (
  SELECT {_KEY}, ID, DATE_CREATE, MARKED_BY AS who, MARKED_BY_ROLE AS role, ATTENDANCE_MARK AS mark,
         row_number() OVER (PARTITION BY {_KEY} ORDER BY DATE_CREATE, ID) AS step
  FROM {source}),
walk AS (
  SELECT {_KEY}, ID, step, CAST(NULL AS VARCHAR) AS reason, who AS s_who, role AS s_role, mark AS s_mark
  FROM numbered WHERE step = 1
  UNION ALL
  SELECT {_KEY}, ID, step, reason,
         CASE WHEN reason IS NULL THEN who ELSE s_who END,
         CASE WHEN reason IS NULL THEN role ELSE s_role END,
         CASE WHEN reason IS NULL THEN mark ELSE s_mark END
  FROM (
    SELECT {', '.join('x.' + k for k in _KEY.split(', '))}, x.ID, x.step, x.who, x.role, x.mark,
           w.s_who, w.s_role, w.s_mark,
           CASE WHEN x.role >= 2 THEN
                  CASE WHEN w.s_who = x.who AND w.s_mark = x.mark THEN 'same_value' END
                WHEN w.s_role >= 2 THEN 'teacher_mark'
                WHEN x.role = 1 THEN
                  CASE WHEN w.s_who = x.who AND w.s_mark = x.mark THEN 'same_value' END
                WHEN w.s_role = 1 AND w.s_who <> x.who THEN 'monitor_mark'
                WHEN w.s_who <> x.who THEN 'other_user'
                WHEN w.s_mark = x.mark THEN 'same_value' END AS reason
    FROM walk w JOIN numbered x
      ON {' AND '.join(f'w.{k} = x.{k}' for k in _KEY.split(', '))} AND x.step = w.step + 1) nxt)"""


_ARBITRATE = f"""WITH RECURSIVE {_VALID},{_arbitrated('valid')}
SELECT ID, reason IS NULL AS accepted, reason AS reject_reason FROM walk"""

_MART = _mart()
_SELECT_MART = f"SELECT {_KEY}, " + ", ".join(c.lower() for c in _MART_VALUES) + " FROM mart"
_MARKED = "strftime(DATE_CREATE, '%Y-%m-%d %H:%M:%S.%f') AS DATE_CREATE"
_DAY = "strftime(LESSON_DATE, '%Y-%m-%d') AS LESSON_DATE"
_TEXT_RAW = _RAW_LIST.replace("LESSON_DATE", _DAY).replace("DATE_CREATE", _MARKED)
_TEXT_ALL = _ALL.replace("LESSON_DATE", _DAY).replace("DATE_CREATE", _MARKED)

_UUID = (
    "regexp_replace(substr(sha256(ID), 1, 32), "
    "'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5')"
)
_STORE_INPUT = f"""{_enriched('valid')},
fits AS (
  SELECT * REPLACE (
    CASE WHEN n % 60 = 0 THEN NULL ELSE {_UUID} END AS ID,
    CASE WHEN n % 40 = 0 THEN NULL ELSE MARKED_BY END AS MARKED_BY,
    CAST(CASE WHEN n % 7 = 0 THEN NULL ELSE n % 200 END AS INTEGER) AS NUMBER_CERT,
    {_STORE_TIME} AS DATE_CREATE)
  FROM enriched)"""

_HISTORY_MARKS = _VALID + f""",
both_times AS (
  SELECT * REPLACE (CASE WHEN n % 5 = 0 THEN DATE_CREATE - INTERVAL 40 DAY ELSE DATE_CREATE END AS DATE_CREATE)
  FROM valid),
old AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY DATE_CREATE DESC, ID DESC) AS place
    FROM both_times WHERE n % 5 = 0) WHERE place = 1),
asked AS (
  SELECT {_RAW_LIST} FROM old UNION ALL SELECT {_RAW_LIST} FROM both_times WHERE n % 5 <> 0)"""

_ADMITTED = f"""{_REQUESTS},
admitted AS (
  SELECT request_id AS ID, CAST(journal_id AS INTEGER) AS JOURNAL_ID,
         TRY_CAST(user_id AS INTEGER) AS STUDENT_ID, lesson_id AS LESSON_ID,
         strftime(held_on, '%Y-%m-%d') AS LESSON_DATE, mark AS ATTENDANCE_MARK, requester AS MARKED_BY,
         strftime(requested_at, '%Y-%m-%d %H:%M:%S.%f') AS DATE_CREATE,
         CAST(role AS INTEGER) AS MARKED_BY_ROLE
  FROM judged WHERE coalesce(input_reason, access_reason, lesson_reason, slot_reason) IS NULL)"""

SQL: dict[str, str] = {
    "group_marks": f"""WITH {_MART}
SELECT group_short_title, attendance_mark, count(*) AS marks FROM mart GROUP BY ALL""",
    "decode_props": f"WITH {_RAW} SELECT {_TEXT_RAW} FROM raw WHERE n % 50 <> 0",
    "decode_rejects": f"WITH {_RAW} SELECT ID AS key, 'malformed_json' AS reason FROM raw WHERE n % 50 = 0",
    "duplicate_report": f"""WITH {_DOUBLED}
SELECT ID, count(*) AS copies FROM doubled GROUP BY ID HAVING count(*) > 1""",
    "dedupe_events": f"""WITH {_DOUBLED}
SELECT {_RAW_LIST} FROM (
  SELECT *, row_number() OVER (PARTITION BY ID ORDER BY DATE_CREATE) AS place FROM doubled)
WHERE place = 1""",
    "distinct_lookup_ids": f"""WITH {_RAW}
SELECT DISTINCT 'student' AS kind, CAST(STUDENT_ID AS VARCHAR) AS id FROM raw
UNION SELECT DISTINCT 'teacher', CAST(MARKED_BY AS VARCHAR) FROM raw WHERE MARKED_BY_ROLE NOT IN (0, 1)""",
    "flatten_students": f"WITH {_PEOPLE} SELECT * FROM students",
    "flatten_teachers": f"WITH {_PEOPLE} SELECT * FROM teachers",
    "age_at_date": """
SELECT o_orderkey, CAST(2020 - year(o_orderdate)
  - CASE WHEN month(o_orderdate) * 100 + day(o_orderdate) > 229 THEN 1 ELSE 0 END AS INTEGER) AS age
FROM orders""",
    "enrich_students": f"WITH {_enriched('raw')} SELECT {_RAW_LIST}, {', '.join(_STUDENT_COLS)} FROM enriched",
    "enrich_teachers": f"WITH {_enriched('raw')} SELECT {_RAW_LIST}, {', '.join(_TEACHER_COLS)} FROM enriched",
    "enrich_full": f"WITH {_enriched('raw')} SELECT {_ALL} FROM enriched",
    "requested_students": f"""WITH {_RAW},{_PEOPLE}
SELECT * FROM students WHERE ENRICHED_STUDENT_ID IN (SELECT CAST(STUDENT_ID AS VARCHAR) FROM raw)""",
    "missing_lookup_ids": f"""WITH {_RAW},{_PEOPLE},
wanted AS (
  SELECT DISTINCT 'student' AS kind, CAST(STUDENT_ID AS VARCHAR) AS id FROM raw
  UNION SELECT DISTINCT 'teacher', CAST(MARKED_BY AS VARCHAR) FROM raw WHERE MARKED_BY_ROLE IN (2, 3))
SELECT kind, id FROM wanted
WHERE NOT EXISTS (SELECT 1 FROM students WHERE kind = 'student' AND ENRICHED_STUDENT_ID = id)
  AND NOT EXISTS (SELECT 1 FROM teachers WHERE kind = 'teacher' AND ENRICHED_MARKED_BY = id)""",
    "enrichment_hit_counts": f"""WITH {_enriched('raw')}
SELECT count(*) AS events, count(STUDENT_FIO) AS student_found,
       count(*) - count(STUDENT_FIO) AS student_missing, count(TEACHER_FIO) AS teacher_found,
       count(CASE WHEN MARKED_BY_ROLE IN (2, 3) AND TEACHER_FIO IS NULL THEN 1 END) AS teacher_missing
FROM enriched""",
    "stage_counts": f"""WITH {_enriched('raw')}
SELECT 'input' AS stage, count(*) + count(CASE WHEN n % 3 = 0 THEN 1 END) AS n_rows FROM raw
UNION ALL SELECT 'unique', count(*) FROM raw
UNION ALL SELECT 'with_student', count(STUDENT_FIO) FROM enriched
UNION ALL SELECT 'with_teacher', count(TEACHER_FIO) FROM enriched
UNION ALL SELECT 'written', count(*) FROM enriched""",
    "validate_marks": f"""WITH {_REQUESTS}
SELECT request_id, coalesce(input_reason, access_reason, lesson_reason, slot_reason) AS reject_reason
FROM judged""",
    "slot_check": f"WITH {_REQUESTS} SELECT request_id, NUMBER, in_slot, slot_reason FROM judged",
    "check_access": f"WITH {_REQUESTS} SELECT request_id, access_reason FROM judged",
    "derive_role": f"""WITH {_REQUESTS}
SELECT request_id, CAST(role AS INTEGER) AS marked_by_role, CAST(requester AS BIGINT) AS marked_by FROM judged""",
    "existing_mark": f"""WITH {_VALID}
SELECT ID, DATE_CREATE, {_KEY}, lag(ID) OVER w AS prev_id, lag(MARKED_BY) OVER w AS prev_by,
       lag(ATTENDANCE_MARK) OVER w AS prev_mark, lag(MARKED_BY_ROLE) OVER w AS prev_role,
       lag(DATE_CREATE) OVER w AS prev_create
FROM valid WINDOW w AS (PARTITION BY {_KEY} ORDER BY DATE_CREATE, ID)""",
    "arbitrate_marks": _ARBITRATE,
    "arbitrate_on_history": f"""WITH RECURSIVE {_HISTORY_MARKS},{_arbitrated('asked')}
SELECT ID, reason IS NULL AS accepted, reason AS reject_reason FROM walk WHERE CAST(ID AS BIGINT) % 5 <> 0""",
    "accepted_overwrites": f"""WITH RECURSIVE {_VALID},{_arbitrated('valid')},
took AS (SELECT {_KEY}, ID, lag(ID) OVER (PARTITION BY {_KEY} ORDER BY step) AS prev_id FROM walk WHERE reason IS NULL)
SELECT {_KEY}, ID, prev_id FROM took WHERE prev_id IS NOT NULL""",
    "mark_admission": f"""WITH RECURSIVE {_ADMITTED},{_arbitrated('admitted')}
SELECT {', '.join('a.' + k for k in _KEY.split(', '))}, ATTENDANCE_MARK, MARKED_BY, MARKED_BY_ROLE, DATE_CREATE,
       reason IS NULL AS accepted, reason AS reject_reason
FROM walk w JOIN admitted a ON w.ID = a.ID""",
    "latest_marks": f"WITH {_MART} {_SELECT_MART}",
    "latest_marks_window": f"WITH {_MART} {_SELECT_MART}",
    "latest_non_null": f"""WITH {_enriched('valid')}
SELECT {_KEY}, {', '.join(f'arg_max({c}, DATE_CREATE) AS {c.lower()}' for c in _MART_VALUES)}
FROM enriched GROUP BY {_KEY}""",
    "merge_latest": f"WITH {_MART} {_SELECT_MART}",
    "conform_enriched": f"""WITH {_STORE_INPUT}
SELECT {_ALL} FROM fits WHERE ID IS NOT NULL AND MARKED_BY IS NOT NULL""",
    "conform_rejects": f"""WITH {_STORE_INPUT}
SELECT CASE WHEN ID IS NULL THEN 'ID' ELSE 'MARKED_BY' END AS reason, count(*) AS n_rows
FROM fits WHERE ID IS NULL OR MARKED_BY IS NULL GROUP BY 1""",
    "history_by_month": f"""WITH {_VALID}
SELECT strftime(LESSON_DATE, '%Y%m') AS lesson_month, count(*) AS n_rows,
       count(DISTINCT STUDENT_ID) AS students FROM valid GROUP BY 1""",
    "kafka_rows": f"""WITH {_enriched('valid')}
SELECT ID AS key, {_TEXT_ALL} FROM enriched""",
    "marks_by_group": f"""WITH {_MART}
SELECT group_short_title, attendance_mark, count(*) AS marks FROM mart
WHERE group_short_title IN ('BUILDING', 'MACHINERY') GROUP BY ALL""",
    "student_attendance": f"""WITH {_MART}
SELECT STUDENT_ID, student_fio, group_short_title,
       count(CASE WHEN attendance_mark = 1 THEN 1 END) AS present,
       count(CASE WHEN attendance_mark = 0 THEN 1 END) AS absent
FROM mart GROUP BY 1, 2, 3""",
    "marks_on_date": f"WITH {_MART} SELECT count(*) AS marks FROM mart WHERE LESSON_DATE = DATE '2024-01-15'",
    "marks_by_teacher": f"""WITH {_MART}
SELECT marked_by, teacher_fio, attendance_mark, count(*) AS marks FROM mart
WHERE teacher_fio IS NOT NULL GROUP BY 1, 2, 3""",
    "teacher_attendance_pct": f"""WITH {_MART},
counts AS (
  SELECT marked_by, teacher_fio, kafedra, count(*) AS marks,
         count(CASE WHEN attendance_mark = 1 THEN 1 END) AS present,
         count(CASE WHEN attendance_mark = 0 THEN 1 END) AS absent
  FROM mart WHERE teacher_fio IS NOT NULL GROUP BY 1, 2, 3)
SELECT marked_by, teacher_fio, kafedra, marks,
       CAST(100 AS DOUBLE) * (CAST(present AS DOUBLE) / nullif(present + absent, 0)) AS present_pct,
       CAST(100 AS DOUBLE) * (CAST(absent AS DOUBLE) / nullif(present + absent, 0)) AS absent_pct
FROM counts""",
    "stream_enrich": f"WITH {_enriched('raw')} SELECT {_TEXT_ALL} FROM enriched WHERE n % 50 <> 0",
    "stream_dedupe": f"WITH {_RAW} SELECT ID, STUDENT_ID, DATE_CREATE FROM raw",
    "stream_arbitrate": _ARBITRATE,
    "stream_settle": _ARBITRATE,
    "stream_settle_batches": _ARBITRATE,
}

_STORED_MART = _mart(_STORE_TIME)
SQL["mart_upsert"] = f"WITH {_STORED_MART} {_SELECT_MART}"
SQL["stream_latest"] = SQL["mart_upsert"]
SQL["stream_history"] = f"""WITH {_enriched('valid')}
SELECT {_ALL.replace('DATE_CREATE', _STORE_TIME + ' AS DATE_CREATE')},
  strftime(LESSON_DATE, '%Y%m') AS lesson_month
FROM enriched"""
SQL["stream_admission"] = SQL["mark_admission"]
SQL["stream_rejects"] = SQL["decode_rejects"]
SQL["store_rejects"] = SQL["conform_rejects"]

# A stored time and the event, as text that sorts like the pair.
_STORED_ORDER = f"strftime({_STORE_TIME}, '%Y-%m-%d %H:%M:%S.%f') || ID"
SQL["stream_latest_non_null"] = f"""WITH {_enriched('valid')}
SELECT {_KEY}, {', '.join(
    f"arg_max({_STORE_TIME if c == 'DATE_CREATE' else c}, {_STORED_ORDER}) AS {c.lower()}" for c in _MART_VALUES)}
FROM enriched GROUP BY {_KEY}"""
SQL["stream_dedupe_watermark"] = f"""WITH {_RAW}
SELECT DISTINCT ID, STUDENT_ID, DATE_CREATE FROM raw"""
SQL["stream_marks_per_day"] = f"""WITH {_VALID}
SELECT LESSON_DATE AS day, ATTENDANCE_MARK AS attendance_mark, count(*) AS marks FROM valid GROUP BY 1, 2"""
SQL["history_files"] = f"""WITH {_VALID}
SELECT strftime(LESSON_DATE, '%Y%m') AS lesson_month, count(*) AS n_rows, CAST(0 AS BIGINT) AS overlaps
FROM valid GROUP BY 1"""
SQL["find_mark"] = f"""WITH {_VALID},
one AS (SELECT {_KEY} FROM valid ORDER BY n LIMIT 1)
SELECT ID, MARKED_BY, ATTENDANCE_MARK, MARKED_BY_ROLE, {_STORE_TIME} AS DATE_CREATE
FROM valid JOIN one USING ({_KEY}) ORDER BY {_STORE_TIME} DESC, ID DESC LIMIT 1"""
_SHARES = """count(*) AS marks,
       CAST(100 AS DOUBLE) * (CAST(count(CASE WHEN attendance_mark = 1 THEN 1 END) AS DOUBLE)
         / nullif(count(CASE WHEN attendance_mark IN (0, 1) THEN 1 END), 0)) AS present_pct,
       CAST(100 AS DOUBLE) * (CAST(count(CASE WHEN attendance_mark = 0 THEN 1 END) AS DOUBLE)
         / nullif(count(CASE WHEN attendance_mark IN (0, 1) THEN 1 END), 0)) AS absent_pct"""
SQL["faculty_rollup"] = f"""WITH {_MART}
SELECT faculty, kafedra, CAST(grouping(faculty, kafedra) AS INTEGER) AS level, {_SHARES}
FROM mart WHERE teacher_fio IS NOT NULL GROUP BY ROLLUP (faculty, kafedra)"""
SQL["missing_sample"] = f"""WITH {_RAW},{_PEOPLE},
wanted AS (
  SELECT DISTINCT 'student' AS kind, CAST(STUDENT_ID AS VARCHAR) AS id FROM raw
  UNION SELECT DISTINCT 'teacher', CAST(MARKED_BY AS VARCHAR) FROM raw WHERE MARKED_BY_ROLE IN (2, 3)),
missing AS (
  SELECT kind, id, md5(id) AS h FROM wanted
  WHERE NOT EXISTS (SELECT 1 FROM students WHERE kind = 'student' AND ENRICHED_STUDENT_ID = id)
    AND NOT EXISTS (SELECT 1 FROM teachers WHERE kind = 'teacher' AND ENRICHED_MARKED_BY = id)),
least AS (SELECT kind, min(h) AS h FROM missing GROUP BY kind, substr(h, 1, 1)),
placed AS (SELECT kind, h, row_number() OVER (PARTITION BY kind ORDER BY h) AS place FROM least)
SELECT kind, id FROM missing JOIN placed USING (kind, h) WHERE place <= 10"""


def _cells(report: str, keys: list[str], values: list[str], source: str) -> str:
    texts = [f"CAST({k} AS VARCHAR)" for k in keys] + ["NULL"] * (3 - len(keys))
    numbers = [f"CAST({v} AS DOUBLE)" for v in values] + ["CAST(NULL AS DOUBLE)"] * (3 - len(values))
    return f"SELECT '{report}' AS report, " + ", ".join(
        [f"{x} AS key_{i}" for i, x in enumerate(texts, 1)] + [f"{x} AS value_{i}" for i, x in enumerate(numbers, 1)]
    ) + f" FROM ({source})"


SQL["stream_reports"] = f"WITH {_STORED_MART}\n" + "\nUNION ALL ".join([
    _cells("marks_by_group", ["group_short_title", "attendance_mark"], ["marks"],
           "SELECT group_short_title, attendance_mark, count(*) AS marks FROM mart"
           " WHERE group_short_title IN ('BUILDING', 'MACHINERY') GROUP BY ALL"),
    _cells("student_attendance", ["STUDENT_ID", "student_fio", "group_short_title"], ["present", "absent"],
           "SELECT STUDENT_ID, student_fio, group_short_title, count(CASE WHEN attendance_mark = 1 THEN 1 END) AS present,"
           " count(CASE WHEN attendance_mark = 0 THEN 1 END) AS absent FROM mart GROUP BY 1, 2, 3"),
    _cells("marks_on_date", [], ["marks"], "SELECT count(*) AS marks FROM mart WHERE LESSON_DATE = DATE '2024-01-15'"),
    _cells("marks_by_teacher", ["marked_by", "teacher_fio", "attendance_mark"], ["marks"],
           "SELECT marked_by, teacher_fio, attendance_mark, count(*) AS marks FROM mart"
           " WHERE teacher_fio IS NOT NULL GROUP BY 1, 2, 3"),
    _cells("teacher_attendance_pct", ["marked_by", "teacher_fio", "kafedra"], ["marks", "present_pct", "absent_pct"],
           f"SELECT marked_by, teacher_fio, kafedra, {_SHARES} FROM mart WHERE teacher_fio IS NOT NULL GROUP BY 1, 2, 3"),
])
