"""The shared test tables seen as attendance data (the mapping is in FIXTURES.md, part 3)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollmark.functions.scalars import micros_text
from rollmark.operators.admit import School
from rollmark.operators.directory import flatten_directory, student_view, teacher_view
from rollmark.plans.sizing import fits_broadcast
from rollmark.schemas import RAW_COLUMNS
from rollmark.sources.directory import parse_documents

AS_OF = date(2024, 2, 1)

# The columns of the test tables that are used here.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows over all cores: a table may be one file with one row group, which one task reads."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files."""
    return spread(
        spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


def to_raw_events(events: DataFrame) -> DataFrame:
    """Rows of the events table to raw event columns; DATE_CREATE stays a timestamp."""
    return events.selectExpr(
        "CAST(event_id AS STRING) AS ID",
        "CAST(user_id % 10 AS INT) AS JOURNAL_ID",
        "CAST(user_id AS INT) AS STUDENT_ID",
        "CAST(ts AS DATE) AS LESSON_DATE",
        "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 0 WHEN 'purchase' THEN 2"
        " WHEN 'signup' THEN 3 ELSE 9 END AS ATTENDANCE_MARK",
        "CASE WHEN event_id % 131 = 7 THEN 3000000000 + event_id % 3 WHEN event_id % 4 >= 2 THEN event_id % 120"
        " WHEN event_id % 4 = 1 THEN user_id + 1 ELSE user_id END AS MARKED_BY",
        "ts AS DATE_CREATE",
        "CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS BIGINT) * 10 + 1"
        " + CAST(get_json_object(props, '$.k') AS INT) % 3 AS LESSON_ID",
        "0 AS TYPE_MARK",
        "CAST(NULL AS INT) AS NUMBER_CERT",
        "CAST(event_id % 4 AS INT) AS MARKED_BY_ROLE",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw_events(table(spark, sf_dir, "events"))


def valid_marks(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("ATTENDANCE_MARK").isin(0, 1, 2, 3))


def to_messages(raw: DataFrame) -> DataFrame:
    """Raw events as (key, value) messages. Every 50th is malformed, and every other one carries
    MARKED_BY as quoted text."""
    number = F.col("ID").cast("bigint")
    quoted: Column = F.to_json(F.struct(*_fields(True)))
    plain: Column = F.to_json(F.struct(*_fields(False)))
    value = F.when(number % 50 == 0, "{bad").when(number % 2 == 0, quoted).otherwise(plain)
    return raw.select(F.col("ID").alias("key"), value.alias("value"))


def _fields(quote: bool) -> list[Column]:
    special = {
        "LESSON_DATE": F.date_format("LESSON_DATE", "yyyy-MM-dd"),
        "DATE_CREATE": micros_text(F.col("DATE_CREATE")),
        **({"MARKED_BY": F.col("MARKED_BY").cast("string")} if quote else {}),
    }
    return [special.get(c, F.col(c)).alias(c) for c in RAW_COLUMNS]


def directory_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as student documents and suppliers as employee documents, one JSON text each.
    Every seventh student document lacks its id, so some events have no student."""
    # Nation and region have 25 and 5 rows at every scale.
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    region = F.broadcast(table(spark, sf_dir, "region"))

    def birth(key: str) -> str:
        return (
            f"CASE WHEN {key} % 11 = 0 THEN 'unknown' WHEN {key} % 13 <> 0 THEN"
            f" concat(CAST(date_add(DATE'1985-01-01', CAST({key} % 6000 AS INT)) AS STRING), 'T00:00:00Z') END"
        )

    student = f"""to_json(named_struct(
      'PERSONAL', named_struct(
        'fullname', c_name, 'type', 'student',
        'BITRIX_USER_ID', CASE WHEN c_custkey % 7 <> 3 THEN CAST(c_custkey AS STRING) END,
        'birthdate', {birth('c_custkey')}, 'sex', CASE WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'f' END),
      'EDUCATION', array(named_struct(
        'department', named_struct('short_title', c_mktsegment),
        'specialization', named_struct('title', n_name),
        'edu_year', CASE WHEN c_custkey % 5 = 0 THEN '20x' ELSE CAST(2015 + c_custkey % 8 AS STRING) END,
        'edu_course', CAST(c_custkey % 6 AS STRING))))) AS document"""
    employee = f"""to_json(named_struct(
      'PERSONAL', named_struct(
        'fullname', s_name, 'type', 'employee', 'ID_DECANAT', s_suppkey,
        'birthdate', {birth('s_suppkey')}, 'WORK_POSITION', 'staff'),
      'WORK', array(named_struct(
        'job_title', CASE WHEN s_suppkey % 3 <> 0 THEN concat('position ', CAST(s_suppkey % 3 AS STRING)) END,
        'department', named_struct('FACULTY_NAME_DECANAT', r_name, 'title', n_name))))) AS document"""
    students = spread(table(spark, sf_dir, "customer")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).selectExpr(student)
    employees = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(employee)
    )
    return students.unionByName(employees)


def people(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Student and teacher view of the directory."""
    flat = flatten_directory(parse_documents(directory_documents(spark, sf_dir)), AS_OF)
    return student_view(flat), teacher_view(flat)


def lookups(spark: SparkSession, sf_dir: str) -> dict:
    """Both views as arguments for enrichment. A view has at most one row per document and only
    attributes found in it, so the size of the documents bounds both, at less cost than
    measuring the views."""
    documents = directory_documents(spark, sf_dir)
    flat = flatten_directory(parse_documents(documents), AS_OF)
    (fits,) = fits_broadcast(documents)
    return {"students": student_view(flat), "teachers": teacher_view(flat), "broadcast": (fits, fits)}


def lessons(raw: DataFrame) -> DataFrame:
    """Lessons the events name, with one in 23 left out and one in 17 blocked."""
    number = F.col("ID")
    return raw.select(F.col("LESSON_ID").alias("ID"), F.col("LESSON_DATE").alias("DATE")).distinct().filter(
        number % 23 != 0
    ).select(
        "ID", "DATE", (1 + number % 8).cast("int").alias("NUMBER"), (number % 17 == 0).alias("BLOCKED")
    )


def school(spark: SparkSession, sf_dir: str) -> School:
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    return School(
        lessons=lessons(raw_events(spark, sf_dir)),
        responsible_teachers=supplier.select((s % 10).alias("JOURNAL_ID"), s.alias("RESPONSIBLE_ID")),
        responsible_students=customer.filter(c % 20 >= 1).filter(c % 20 <= 10).select(
            (c % 20 - 1).alias("JOURNAL_ID"), c.alias("RESPONSIBLE_ID")
        ),
        grants=customer.select(
            c.alias("user_id"), (c % 10).alias("journal_id"), F.lit("group").alias("grant_kind")
        ).unionByName(
            supplier.filter(s % 3 == 0).select(
                s.alias("user_id"), ((s + 1) % 10).alias("journal_id"), F.lit("granted").alias("grant_kind")
            )
        ),
        dean_office=supplier.filter(s % 4 == 0).select(s.alias("user_id")),
    )


def to_requests(raw: DataFrame) -> DataFrame:
    """Raw events as mark requests in text form. Some lack a field or all of them, some name a wrong day,
    an id that fits no event, or come from nobody known; days come in all forms that are accepted."""
    odd = "n % 211 = 0"
    return raw.withColumn("n", F.col("ID").cast("bigint")).selectExpr(
        "ID AS request_id",
        f"CASE WHEN n % 101 <> 0 AND NOT {odd} THEN CAST(JOURNAL_ID AS STRING) END AS journalId",
        f"CASE WHEN {odd} THEN NULL WHEN n % 103 = 0 THEN 'none' WHEN n % 113 = 0 THEN '3000000000'"
        " ELSE CAST(STUDENT_ID AS STRING) END AS userId",
        f"CASE WHEN {odd} THEN NULL WHEN n % 107 = 0 THEN 'x1' ELSE CAST(LESSON_ID AS STRING) END AS lessonId",
        f"CASE WHEN NOT {odd} THEN CAST(ATTENDANCE_MARK AS STRING) END AS attendance",
        f"CASE WHEN {odd} THEN NULL WHEN n % 10 = 7 THEN CAST(date_add(LESSON_DATE, 1) AS STRING)"
        " WHEN n % 12 = 0 THEN date_format(LESSON_DATE, 'dd.MM.yyyy')"
        " WHEN n % 9 = 0 THEN concat(CAST(LESSON_DATE AS STRING), ' 09:30:00')"
        " WHEN n % 3 = 0 THEN CAST(LESSON_DATE AS STRING) END AS lessonDate",
        "CASE WHEN n % 127 = 0 THEN 5000000000 ELSE MARKED_BY END AS requester_id",
        "CASE WHEN n % 127 = 0 THEN 5000000000 ELSE MARKED_BY END AS requester_dean_id",
        "CASE WHEN n % 109 = 0 THEN 'guest' WHEN MARKED_BY_ROLE >= 2 THEN 'employee' ELSE 'student' END"
        " AS requester_kind",
        "DATE_CREATE AS requested_at",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_requests(raw_events(spark, sf_dir))


def request_messages(requests: DataFrame) -> DataFrame:
    """Requests as (key, value) messages, as they reach the admission job."""
    fields = [
        micros_text(F.col(c)).alias(c) if kind.startswith("timestamp") else F.col(c) for c, kind in requests.dtypes
    ]
    return requests.select(F.col("request_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))
