"""Course-shaped views over the generic test tables.

The test tables hold no course packages, so these views give their columns the
shape of the silver tables.  Each view is one statement in the SQL subset that
Spark and the checking engine share, over whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {
    # package files: parts as media files, documents as text files, pages as HTML files
    "v_files": """
        SELECT 'course-' || p_brand AS export_id,
               CASE p_type WHEN 'ECONOMY' THEN 'pages/' WHEN 'LARGE' THEN 'assets/img/' WHEN 'MEDIUM' THEN 'files/'
                           WHEN 'PROMO' THEN '__MACOSX/' WHEN 'SMALL' THEN 'quiz_d2l_' ELSE '' END
               || replace(p_name, ' ', '-') || '-' || cast(p_partkey AS string)
               || CASE WHEN p_size < 8 THEN '.html' WHEN p_size < 14 THEN '.PDF' WHEN p_size < 20 THEN '.png'
                       WHEN p_size < 26 THEN '.mp4' WHEN p_size < 32 THEN '.xml' WHEN p_size < 38 THEN '.json'
                       WHEN p_size < 44 THEN '.xhtml' ELSE '.bin' END AS rel_path,
               cast(p_size AS bigint) * 1000 + p_partkey AS bytes, p_name AS body
        FROM {part}
        UNION ALL
        SELECT 'course-' || source, 'docs/' || cast(doc_id AS string) || '.txt', n_chars, text FROM {documents}
        UNION ALL
        SELECT 'course-site', 'site/' || cast(page_id AS string) || '.html', cast(length(html) AS bigint), html FROM {pages}
    """,
    "v_manifest_files": """
        SELECT 'course-' || cast(o_custkey AS string) AS export_id,
               CASE WHEN o_orderstatus = 'F' THEN 'wrap-' || cast(o_orderkey AS string) || '/imsmanifest.xml'
                    WHEN o_orderstatus = 'O' THEN 'a/b' || cast(o_orderkey AS string) || '/imsmanifest.xml'
                    WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000 THEN 'imsmanifest.xml'
                    ELSE 'x/' || cast(o_orderkey AS string) || '.html' END AS rel_path
        FROM {orders}
    """,
    # page titles that cover the heading vocabulary
    "v_titles": """
        SELECT p_partkey AS title_no, p_brand AS course,
               CASE p_type WHEN 'ECONOMY' THEN 'Week ' || cast(p_size AS string) || ' Overview and Learning Materials'
                           WHEN 'LARGE' THEN 'Module 0' || cast(p_size AS string) || ': ' || p_name || ' Lecture Video'
                           WHEN 'MEDIUM' THEN CASE WHEN p_size > 25 THEN 'Learning Objectives ' || p_name ELSE 'Course Introduction: ' || p_name END
                           WHEN 'PROMO' THEN CASE WHEN p_size > 25 THEN p_name || ' Self-Assessment' ELSE 'Midterm EXAM ' || p_name END
                           WHEN 'SMALL' THEN CASE WHEN p_size > 25 THEN 'Weekly Checklist ' || p_name ELSE 'Reading examples: ' || p_name END
                           ELSE '  ' || p_name || ' :: ' END AS title,
               CASE WHEN p_size % 10 = 0 THEN '' ELSE p_name END AS html_title,
               p_retailprice < 1000 AS is_hidden
        FROM {part}
    """,
    # one course per order: its lines are the activities
    "v_activities": """
        SELECT cast(l_orderkey AS string) AS export_id,
               CASE l_returnflag WHEN 'A' THEN 'dropbox_folder' WHEN 'N' THEN 'discussion_topic' ELSE 'quiz' END AS kind,
               'Activity ' || cast(l_linenumber AS string) || '-' || cast(l_partkey AS string) AS name,
               'RC-' || cast(l_partkey AS string) || '-' || cast(l_linenumber AS string) AS resource_code,
               CASE WHEN l_tax > 0.005 THEN 'G-' || cast(l_partkey AS string) ELSE '' END AS grade_item_code,
               'R-' || cast(l_suppkey AS string) AS rubric_id,
               CASE WHEN l_discount > 0.055 THEN 'C-' || cast(l_linenumber AS string) ELSE '' END AS condition_set,
               cast(cast(l_quantity AS int) AS string) AS out_of,
               cast(l_linenumber AS bigint) * 100000000000 + l_partkey AS pos, l_linestatus, l_shipdate
        FROM {lineitem}
    """,
    "v_grade_items": """
        SELECT cast(l_orderkey AS string) AS export_id, 'G-' || cast(l_partkey AS string) AS resource_code, p_name AS name,
               'ID-' || cast(l_partkey AS string) AS identifier,
               CASE WHEN p_type = 'PROMO' THEN '9' ELSE '1' END AS type_id,
               CASE WHEN p_size = 13 THEN 'thirteen' WHEN p_size < 4 THEN '' WHEN p_size = 7 THEN '0' ELSE cast(p_size AS string) || '.000' END AS out_of,
               CASE WHEN p_brand = 'Brand#7' THEN 'True' ELSE 'false' END AS is_bonus,
               CASE WHEN p_brand = 'Brand#9' THEN 'true' ELSE '' END AS exclude_from_final_grade_calc,
               cast(l_linenumber AS bigint) * 100000000000 + l_partkey AS pos
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
        WHERE l_linestatus = 'F'
    """,
    "v_rubrics": """
        SELECT DISTINCT cast(l_orderkey AS string) AS export_id, 'R-' || cast(s_suppkey AS string) AS rubric_id, s_name AS rubric_name
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey WHERE s_acctbal >= 1000
    """,
    "v_conditions": """
        SELECT cast(o_orderkey AS string) AS export_id, 'C-' || cast(l_linenumber AS string) AS code
        FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey
        WHERE o_orderstatus <> 'P' AND l_linestatus = 'O'
    """,
    "v_links": """
        SELECT cast(l_orderkey AS string) AS export_id,
               '/d2l/common/quickLink.d2l?type=' || CASE l_returnflag WHEN 'A' THEN 'dropbox' WHEN 'N' THEN 'discuss' ELSE 'quiz' END
               || '&rCode=RC-' || cast(l_partkey AS string) || '-' || cast(l_linenumber AS string)
               || CASE WHEN l_quantity > 45 THEN '&rcode=RC-' || cast(l_partkey AS string) || '-' || cast(l_linenumber AS string) ELSE '' END AS href
        FROM {lineitem} WHERE l_shipdate >= timestamp '1996-01-01 00:00:00'
    """,
    # manifest items and resources
    "v_items": """
        SELECT cast(l_orderkey AS string) AS export_id, cast(l_linenumber AS bigint) * 100000000000 + l_partkey AS pos,
               CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN '' ELSE 'RES-' || cast(l_partkey AS string) END AS identifierref,
               CASE WHEN l_tax > 0.075 THEN 'D2L.LE.Lti.Link' ELSE '' END AS resource_type_key,
               'Item ' || cast(l_linenumber AS string) AS title, l_discount > 0.085 AS is_hidden,
               CASE WHEN l_quantity > 40 THEN 'described' ELSE '' END AS description
        FROM {lineitem}
    """,
    "v_resources": """
        SELECT 'RES-' || cast(p_partkey AS string) AS identifier, p_partkey AS pos,
               CASE p_type WHEN 'ECONOMY' THEN 'contentmodule' WHEN 'LARGE' THEN 'content' WHEN 'MEDIUM' THEN 'contentlink'
                           WHEN 'SMALL' THEN 'd2lquiz' WHEN 'STANDARD' THEN 'imsbasiclti_xmlv1p0' ELSE '' END AS material_type,
               CASE p_type WHEN 'LARGE' THEN 'files/' || replace(p_name, ' ', '%20') || CASE WHEN p_size > 30 THEN '.html?x=1' WHEN p_size > 15 THEN '.pdf' ELSE '' END
                           WHEN 'MEDIUM' THEN '/d2l/q.d2l?type=' || CASE WHEN p_size < 10 THEN 'quiz' WHEN p_size < 20 THEN 'dropbox' WHEN p_size < 30 THEN 'discuss' WHEN p_size < 40 THEN 'Checklist' ELSE 'news' END || '&rCode=RC-' || cast(p_partkey AS string)
                           WHEN 'ECONOMY' THEN '' ELSE 'misc/quiz-' || cast(p_partkey AS string) || '.htm' END AS href
        FROM {part} WHERE p_retailprice > 901
    """,
    # HTML with images, frames, several heading levels and visual groups, derived from the pages
    "v_rich_pages": """
        SELECT page_id, url,
               replace(replace(replace(replace(replace(html,
                   '<article>', '<article class="case-card">'),
                   '<p><b>', '<h2>Learning <em>Objectives</em></h2><p><b>'),
                   '<br>', '<img src="fig/' || cast(page_id AS string) || '.png"><br>'),
                   '<div class="ad">', '<img alt="An ad" src=''ad.png''><div class="callout">'),
                   '<footer>', '<h3>Videos</h3><iframe src="https://www.youtube.com/embed/' || cast(page_id AS string) || '" title="Clip"></iframe><iframe src="https://tool.example.org/x" data-file="p/' || cast(page_id AS string) || '.practice.json"></iframe><hr><footer>') AS html
        FROM {pages}
    """,
    # progress events: the stream of one user is one run
    "v_progress": """
        SELECT cast(user_id AS string) AS run_id, event_id AS seq, ts,
               CASE event_type WHEN 'signup' THEN 'run_start' WHEN 'view' THEN 'step_start' WHEN 'click' THEN 'step_end'
                               WHEN 'purchase' THEN 'run_end' ELSE 'step_end' END AS event,
               CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
               cast(floor(value) AS int) % 12 AS step_index
        FROM {events}
    """,
}


def _expand(text: str) -> str:
    """Inline views used by other views."""
    def swap(match: re.Match) -> str:
        name = match.group(1)
        return f"({_expand(VIEWS[name])})" if name in VIEWS else match.group(0)

    return re.sub(r"\{(\w+)\}", swap, text)


TEXT_TABLES = ("documents", "pages", "conversations")


def spread(df: DataFrame) -> DataFrame:
    """Use every core for row-wise text work when the input has fewer files than cores.

    With many files the scan is parallel already and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def run_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A statement with ``{table}`` or ``{view}`` placeholders on Spark."""
    expanded = _expand(text)
    used = {n: table(spark, sf_dir, n) for n in TABLES if f"{{{n}}}" in expanded}
    return spark.sql(expanded, **used)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return run_sql(spark, sf_dir, VIEWS[name])


def plain_sql(text: str) -> str:
    """The same statement for an engine where the tables are registered by name."""
    return re.sub(r"\{(\w+)\}", lambda m: m.group(1) if m.group(1) in TABLES else m.group(0), _expand(text))
