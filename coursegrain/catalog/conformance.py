"""Documents of every registered contract, made from the test tables with faults in them, and what the contracts say to that.

The checking SQL states the faults from the tables directly.  Kinds and collections
that a contract doesn't name are in all of them and must be accepted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import contract_schemas, json_contracts
from ..sources.standin import spread
from .registry import Tables, query

_DIGEST = "0123456789abcdef" * 4


def said(docs: DataFrame, schema_id: str, keep: str) -> DataFrame:
    return json_contracts.violations(docs, contract_schemas.REGISTERED[schema_id](), [keep])


def empty() -> Column:
    return F.create_map().cast("map<string,string>")


def none() -> Column:
    return F.array().cast("array<string>")


def source(state: Column) -> Column:
    print_of = F.struct(F.lit("sha256").alias("algorithm"), F.lit(_DIGEST).alias("digest"), F.lit("logical").alias("scope"), F.lit(7).alias("bytes"), empty().alias("extensions"))
    return F.struct(
        F.lit("cc:lineage:1").alias("source_lineage_key"), F.lit("cc:source:1").alias("source_instance_key"), state.alias("lineage_state"), F.lit("x").alias("lineage_basis"), F.lit("").alias("source_name"),
        print_of.alias("logical_fingerprint"), F.lit(None).cast("string").alias("transport_fingerprint"), empty().alias("observed_identity"), empty().alias("extensions"),
    )


def entity(key: Column, quality: Column, *more: Column) -> Column:
    identity = F.struct(quality.alias("quality"), F.lit("id").alias("basis"), F.lit("cc:lineage:1").alias("source_lineage_key"), none().alias("source_aliases"), empty().alias("extensions"))
    return F.struct(key.alias("entity_key"), identity.alias("identity"), *more)


def envelope(schema_id: str, state: Column) -> list[Column]:
    return [F.lit(schema_id).alias("schema"), F.lit("cc:run:1").alias("run_id"), source(state).alias("source"), F.lit("e").alias("export"), F.lit("l").alias("label")]


def document(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("doc")


@query("contract_progress", """
    SELECT event_id, 'total' AS path, 'minimum: 1' AS violation FROM {events} WHERE event_type = 'signup' AND user_id % 3 = 0
    UNION ALL SELECT event_id, 'index', 'minimum: 1' FROM {events} WHERE event_type = 'view' AND user_id % 5 = 0
    UNION ALL SELECT event_id, 'status', 'enum: ok, error' FROM {events} WHERE event_type = 'click' AND user_id % 4 = 0
    UNION ALL SELECT event_id, 'seconds', 'minimum: 0' FROM {events} WHERE event_type = 'click' AND value < 10
    UNION ALL SELECT event_id, 'outputs', 'additionalProperties: other' FROM {events} WHERE event_type = 'purchase' AND user_id % 6 = 0
    UNION ALL SELECT event_id, '', 'oneOf: no alternative fits' FROM {events} WHERE event_type = 'error'
""")
def contract_progress(t: Tables) -> DataFrame:
    user, kind = F.col("user_id"), F.col("event_type")
    named = lambda event: F.lit(event).alias("event")
    outputs = F.map_filter(F.create_map(F.lit("markdown"), F.lit("m.md"), F.lit("other"), F.lit("x")), lambda k, v: (k != "other") | (user % 6 == 0))
    doc = (
        F.when(kind == "signup", F.to_json(F.struct(named("run_start"), F.lit("progress/1").alias("schema"), F.lit("l").alias("label"), (user % 3).alias("total"), F.array(F.lit("s")).alias("steps"))))
        .when(kind == "view", F.to_json(F.struct(named("step_start"), (user % 5).alias("index"), F.lit(5).alias("total"), F.lit("l").alias("label"))))
        .when(kind == "click", F.to_json(F.struct(named("step_end"), F.lit(1).alias("index"), F.when(user % 4 == 0, "late").otherwise("ok").alias("status"), (F.col("value") - 10).alias("seconds"))))
        .when(kind == "purchase", F.to_json(F.struct(named("run_end"), F.lit("ok").alias("status"), outputs.alias("outputs"))))
        .otherwise(F.to_json(F.struct(named("resume"), F.lit(1).alias("index"))))
    )
    return said(spread(t.events).select("event_id", doc.alias("doc")), "progress/1", "event_id")


@query("contract_activities", """
    WITH l AS (SELECT l_orderkey, l_tax, l_discount, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_tax, l_discount) - 1 AS i FROM {lineitem}),
         k AS (SELECT DISTINCT l_orderkey FROM {lineitem})
    SELECT l_orderkey AS export_id, 'quizzes/' || i || '/entity_key' AS path, 'pattern: ^cc:entity:' AS violation FROM l WHERE l_tax > 0.075
    UNION ALL SELECT l_orderkey, 'quizzes/' || i || '/identity/quality', 'enum: durable_source_id, scoped_source_id, observed_reference, fallback, unresolved' FROM l WHERE l_discount > 0.085
    UNION ALL SELECT l_orderkey, 'source/lineage_state', 'enum: resolved, unresolved' FROM k WHERE l_orderkey % 7 = 0
    UNION ALL SELECT l_orderkey, 'diagnostics/0', 'oneOf: no alternative fits' FROM k WHERE l_orderkey % 11 = 0
    UNION ALL SELECT l_orderkey, '', 'required: joins' FROM k WHERE l_orderkey % 5 = 0
""")
def contract_activities(t: Tables) -> DataFrame:
    """Quizzes of a kind that the contract has never seen, and a collection beyond it."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("export_id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_tax", "l_discount"))).alias("lines"))
    order = F.col("export_id")
    quiz = lambda x: entity(F.when(x["l_tax"] > 0.075, "quiz").otherwise("cc:entity:q"), F.when(x["l_discount"] > 0.085, "guess").otherwise("fallback"), F.lit("adaptive").alias("kind"))
    lists = [none().alias(n) for n in ("condition_sets", "dropbox_folders", "discussions", "checklists", "grade_items")]
    made = document(
        *envelope("activities/1", F.when(order % 7 == 0, "maybe").otherwise("resolved")), empty().alias("export_identity"), F.transform("lines", quiz).alias("quizzes"), *lists, none().alias("joins"),
        F.array(order).alias("diagnostics"), empty().alias("extensions"), F.array(F.lit("kept")).alias("future_collection"),
    )
    listed = F.when(order % 11 == 0, made).otherwise(F.replace(made, F.concat(F.lit('"diagnostics":['), order.cast("string"), F.lit("]")), F.lit('"diagnostics":["note",{"code":1}]')))
    doc = F.when(order % 5 == 0, F.replace(listed, F.lit('"joins":[],'), F.lit(""))).otherwise(listed)
    return said(lines.select("export_id", doc.alias("doc")), "activities/1", "export_id")


@query("contract_structure", """
    WITH ln AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS line FROM {documents}),
         sn AS (SELECT doc_id, i, unnest(range(len(string_split(line, '. ')))) AS j, unnest(string_split(line, '. ')) AS s FROM ln)
    SELECT doc_id, 'tree/' || i || '/kind' AS path, 'minLength: 1' AS violation FROM ln WHERE length(line) < 60
    UNION ALL SELECT doc_id, 'tree/' || i || '/children/' || j || '/kind', 'minLength: 1' FROM sn WHERE s LIKE '%,%'
    UNION ALL SELECT doc_id, 'kind_counts/topic', 'type: integer' FROM {documents} WHERE lang = 'de'
    UNION ALL SELECT doc_id, 'schema', 'const: structure/1' FROM {documents} WHERE lang = 'es'
""")
def contract_structure(t: Tables) -> DataFrame:
    """Lines are nodes, sentences their children: the definition of a node contains itself."""
    def node(kind: Column, children: Column) -> Column:
        return entity(F.lit("cc:entity:n"), F.lit("fallback"), kind.alias("kind"), children.alias("children"), F.lit(None).cast("string").alias("parent_entity_key"))

    leaf = lambda s: node(F.when(s.like("%,%"), "").otherwise("container"), none())
    line = lambda x: node(F.when(F.length(x) < 60, "").otherwise("module"), F.transform(F.split(x, "[.] "), leaf))
    counts = F.create_map(F.lit("module"), F.lit("1"), F.lit("topic"), F.when(F.col("lang") == "de", "1.5").otherwise("2"))
    made = document(
        F.when(F.col("lang") == "es", "structure/0").otherwise("structure/1").alias("schema"), *envelope("", F.lit("resolved"))[1:], counts.alias("kind_counts"),
        F.transform(F.split("text", "\\n"), line).alias("tree"), none().alias("html_topics"), none().alias("diagnostics"), empty().alias("extensions"),
    )
    # numbers of an open object are written as text by a map
    plain = F.regexp_replace(made, r'"kind_counts":\{"module":"1","topic":"([\d.]+)"\}', r'"kind_counts":{"module":1,"topic":$1}')
    return said(t.documents.select("doc_id", plain.alias("doc")), "structure/1", "doc_id")


@query("contract_run", r"""
    WITH o AS (SELECT * FROM {orders} WHERE o_orderpriority <> '5-LOW')
    SELECT o_orderkey AS run_no, 'emitted_files/0/path' AS path, 'not: (^/|(^|/)\.\.(/|$))' AS violation FROM o WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT o_orderkey, 'emitted_files/0/sha256', 'pattern: ^[0-9a-f]{64}$' FROM o WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, 'steps/0', 'required: notes' FROM o WHERE o_custkey % 3 = 0
    UNION ALL SELECT o_orderkey, 'steps/0/artifact_paths/1', 'type: string' FROM o WHERE o_custkey % 4 = 0
    UNION ALL SELECT o_orderkey, 'producer/dirty', 'type: boolean or null' FROM o WHERE o_custkey % 5 = 0
    UNION ALL SELECT o_orderkey, '', 'json: not parseable' FROM {orders} WHERE o_orderpriority = '5-LOW'
""")
def contract_run(t: Tables) -> DataFrame:
    cust = F.col("o_custkey")
    nothing = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    producer = F.struct(F.lit("c").alias("component"), F.lit("git").alias("identity_state"), *nothing("version", "repository", "ref", "commit"), F.lit("DIRTY").alias("dirty"), empty().alias("extensions"))
    step = F.struct(F.lit("scan").alias("name"), F.lit("completed").alias("status"), *nothing("started_at", "finished_at"), F.array(F.lit("a"), F.lit("B")).alias("artifact_paths"), none().alias("diagnostic_ids"), none().alias("notes"), empty().alias("extensions"))
    written = F.struct(
        F.when(F.col("o_orderpriority") == "1-URGENT", "out/../x").otherwise("out/x").alias("path"), F.lit(1).alias("bytes"), F.when(F.col("o_orderstatus") == "F", _DIGEST.upper()).otherwise(_DIGEST).alias("sha256"),
        F.lit("text/plain").alias("media_type"), *nothing("contract"), empty().alias("extensions"),
    )
    made = document(
        F.lit("run/1").alias("schema"), F.lit("cc:run:1").alias("run_id"), F.lit("ok").alias("status"), *nothing("started_at", "finished_at"), source(F.lit("resolved")).alias("source"), producer.alias("producer"),
        none().alias("contracts"), empty().alias("parameters"), F.array(step).alias("steps"), F.array(written).alias("emitted_files"), F.lit("r.json").alias("receipt_path"), none().alias("diagnostics"), empty().alias("extensions"),
    )
    swap = lambda c, old, new: F.replace(c, F.lit(old), F.lit(new))
    dirty = F.when(cust % 5 == 0, swap(made, '"DIRTY"', "1")).otherwise(swap(made, '"DIRTY"', "false"))
    typed = F.when(cust % 4 == 0, swap(dirty, '"B"', "2")).otherwise(dirty)
    noted = F.when(cust % 3 == 0, swap(typed, '"notes":[],', "")).otherwise(typed)
    return said(spread(t.orders).select(F.col("o_orderkey").alias("run_no"), F.when(F.col("o_orderpriority") == "5-LOW", F.lit("{")).otherwise(noted).alias("doc")), "run/1", "run_no")


@query("contract_blueprint", """
    WITH ln AS (SELECT doc_id, lang, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS line FROM {documents})
    SELECT doc_id, 'weeks/' || i || '/assignments/0/blocks/0/kind' AS path, 'enum: p, li, label, practice, visual, dropdown, embed, image, file, hidden, divider' AS violation FROM ln WHERE length(line) % 5 = 0
    UNION ALL SELECT doc_id, 'weeks/' || i || '/assignments/0/blocks/0/blocks/0/runs/0', 'additionalProperties: bold, size' FROM ln WHERE length(line) % 3 = 0
    UNION ALL SELECT doc_id, 'weeks/' || i || '/assignments/0/blocks/0/meta/width', 'type: string' FROM ln WHERE length(line) % 4 = 0
    UNION ALL SELECT doc_id, '', 'required: front_matter' FROM {documents} WHERE lang = 'fr'
""")
def contract_blueprint(t: Tables) -> DataFrame:
    """Weeks, sections, blocks, blocks inside blocks, runs: as deep as the format goes."""
    def week(line: Column) -> Column:
        size = F.length(line)
        run = F.struct(F.lit("t").alias("text"), F.lit("").alias("href"))
        inner = F.struct(F.lit("li").alias("kind"), F.lit(1).alias("level"), F.array(run).alias("runs"))
        text = F.to_json(F.struct(F.when(size % 5 == 0, "quote").otherwise("p").alias("kind"), F.lit(0).alias("level"), none().alias("runs"), F.array(inner).alias("blocks"), F.create_map(F.lit("width"), F.lit("W")).alias("meta")))
        styled = F.when(size % 3 == 0, F.replace(text, F.lit('"href":""'), F.lit('"href":"","size":1,"bold":true'))).otherwise(text)
        block = F.replace(styled, F.lit('"W"'), F.when(size % 4 == 0, "9").otherwise('"9"'))
        return F.concat(F.lit('{"title":"Week","assignments":[{"label":"L","blocks":['), block, F.lit("]}]}"))

    front = ",".join(f'"{n}":[]' for n in ("course_description", "required_materials", "course_learning_outcomes", "course_introduction"))
    head = F.concat(F.lit('{"schema":"blueprint/4","course_title":"C","before_week_1":[],'), F.when(F.col("lang") == "fr", "").otherwise(f'"front_matter":{{{front}}},'))
    doc = F.concat(head, F.lit('"weeks":['), F.array_join(F.transform(F.split("text", "\\n"), week), ","), F.lit("]}"))
    return said(t.documents.select("doc_id", doc.alias("doc")), "blueprint/4", "doc_id")


@query("contract_rubrics", """
    WITH p AS (SELECT * FROM {part} WHERE p_size % 3 <> 0)
    SELECT p_partkey AS file_no, 'rubrics/0/criteria/0/cells/0/points' AS path, 'type: number or null' AS violation FROM p WHERE p_size % 7 = 0
    UNION ALL SELECT p_partkey, 'rubrics/0/attributes/max', 'type: string' FROM p WHERE p_size % 5 = 0
    UNION ALL SELECT p_partkey, 'rubrics/0/levels/0/sort_order', 'type: integer' FROM p WHERE p_size % 4 = 0
    UNION ALL SELECT p_partkey, 'rubrics', 'type: array' FROM {part} WHERE p_size % 3 = 0
""")
def contract_rubrics(t: Tables) -> DataFrame:
    size = F.col("p_size")
    points = F.when(size % 7 == 0, '"ten"').when(size % 2 == 0, "null").otherwise("9.5")
    rubric = F.concat(
        F.lit('{"id":"1","resource_code":"r","name":"n","scoring_method":"","description":"","overall_levels":[],"attributes":{"max":'), F.when(size % 5 == 0, "3").otherwise('"3"'),
        F.lit('},"levels":[{"level_id":"l","name":"n","score_band":"","sort_order":'), F.when(size % 4 == 0, "1.5").otherwise("2.0"), F.lit('}],"criteria":[{"name":"c","sort_order":0,"cells":[{"level_id":"l","level_name":"n","points":'),
        points, F.lit(',"points_raw":"","description":""}]}]}'),
    )
    doc = F.concat(F.lit('{"schema":"rubrics/1","source_file":"f","diagnostics":[],"rubrics":'), F.when(size % 3 == 0, F.lit("{}")).otherwise(F.concat(F.lit("["), rubric, F.lit("]"))), F.lit("}"))
    return said(spread(t.part).select(F.col("p_partkey").alias("file_no"), doc.alias("doc")), "rubrics/1", "file_no")
