"""Fixed schemas and column orders. Nothing in this package infers a schema."""

from __future__ import annotations

# --- fixed values: names, types and order of the wire and store formats -------------------

RAW_EVENT = """
    ID string, JOURNAL_ID int, STUDENT_ID int, LESSON_DATE string, ATTENDANCE_MARK int,
    MARKED_BY bigint, DATE_CREATE string, LESSON_ID bigint, TYPE_MARK int, NUMBER_CERT int,
    MARKED_BY_ROLE int
"""

STUDENT = """
    ENRICHED_STUDENT_ID string, STUDENT_FIO string, STUDENT_LAST_NAME string,
    STUDENT_FIRST_NAME string, STUDENT_MIDDLE_NAME string, STUDENT_AGE int, STUDENT_SEX string,
    ADMISSION_YEAR int, QUALIFICATION string, COURSE int, GROUP_SHORT_TITLE string,
    SPECIALIZATION_TITLE string
"""

TEACHER = """
    ENRICHED_MARKED_BY string, TEACHER_FIO string, TEACHER_LAST_NAME string,
    TEACHER_FIRST_NAME string, TEACHER_MIDDLE_NAME string, TEACHER_WORK_POSITION string,
    FACULTY string, KAFEDRA string, TEACHER_AGE int, TEACHER_SEX string
"""

PERSONAL = """
    struct<fullname: string, lastname: string, name: string, surname: string, type: string,
           WORK_POSITION: string, BITRIX_USER_ID: string, birthdate: string, sex: string,
           ID_DECANAT: bigint>
"""

EDUCATION = """
    array<struct<department: struct<short_title: string>, specialization: struct<title: string>,
                 edu_year: string, edu_qualification: string, edu_course: string>>
"""

WORK = """
    array<struct<job_title: string,
                 department: struct<FACULTY_NAME_DECANAT: string, title: string>>>
"""

# One mark per student, lesson and day inside a journal.
MARK_KEY = ["JOURNAL_ID", "STUDENT_ID", "LESSON_ID", "LESSON_DATE"]

# Columns the store declares non-null.
REQUIRED = [
    "ID", "JOURNAL_ID", "STUDENT_ID", "LESSON_DATE",
    "ATTENDANCE_MARK", "MARKED_BY", "DATE_CREATE", "LESSON_ID",
]

# Store ranges of the unsigned and narrow integer columns: column -> (type, low, high).
STORE_RANGES = {
    "JOURNAL_ID": ("int", 0, 2**16 - 1),
    "STUDENT_ID": ("int", -(2**31), 2**31 - 1),
    "ATTENDANCE_MARK": ("int", 0, 2**8 - 1),
    "MARKED_BY": ("bigint", 0, 2**32 - 1),
    "LESSON_ID": ("bigint", 0, 2**63 - 1),
    "TYPE_MARK": ("int", 0, 2**8 - 1),
    "NUMBER_CERT": ("int", 0, 2**8 - 1),
    "MARKED_BY_ROLE": ("int", 0, 2**8 - 1),
    "ADMISSION_YEAR": ("int", 0, 2**16 - 1),
    "COURSE": ("int", 0, 2**8 - 1),
}

# --- end of fixed values -------------------------------------------------------------------


def names(ddl: str) -> list[str]:
    """Column names of a flat DDL text, in order."""
    return [field.split()[0] for field in ddl.split(",")]


RAW_COLUMNS = names(RAW_EVENT)
RAW_INTS = {f.split()[0]: f.split()[1] for f in RAW_EVENT.split(",") if f.split()[1] != "string"}
STUDENT_COLUMNS = names(STUDENT)[1:]
TEACHER_COLUMNS = names(TEACHER)[1:]
OUTPUT_COLUMNS = RAW_COLUMNS + STUDENT_COLUMNS + TEACHER_COLUMNS

# The enriched record as it travels in a message: like the raw event, dates stay text.
ENRICHED_EVENT = ",".join(
    [RAW_EVENT]
    + [STUDENT.split(",", 1)[1], TEACHER.split(",", 1)[1]]
)

# The latest-state mart: key columns keep their names, the others are lower case; ID is dropped.
MART_VALUES = [c for c in OUTPUT_COLUMNS if c not in MARK_KEY and c != "ID"]
MART_COLUMNS = MARK_KEY + [c.lower() for c in MART_VALUES]

_STORE_TYPES = {
    "LESSON_DATE": "date",
    "DATE_CREATE": "timestamp_ntz",
    **{c: kind for c, (kind, _, _) in STORE_RANGES.items()},
    "STUDENT_AGE": "int",
    "TEACHER_AGE": "int",
}

# Column order of the store: the raw columns that are always there, people, then the rest.
STORE_COLUMNS = (
    REQUIRED + STUDENT_COLUMNS + TEACHER_COLUMNS + ["TYPE_MARK", "NUMBER_CERT", "MARKED_BY_ROLE"]
)
STORE_TYPES = {c: _STORE_TYPES.get(c, "string") for c in STORE_COLUMNS}
STORE = ", ".join(f"{c} {kind}" for c, kind in STORE_TYPES.items())
