"""The review extract over tables of a few rows."""

from datetime import datetime

from pyspark.sql import functions as F

from coursegrain.catalog import QUERIES

LINES = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"


def test_review_sheets_has_every_sheet(spark, tmp_path):
    day = datetime(1997, 1, 1)
    tables = {
        "lineitem": ([(1, 10, 5, 1, 30.0, 0.06, 0.01, "A", "F", day), (1, 11, 5, 2, 15.0, 0.0, 0.01, "N", "F", day), (1, 12, 5, 3, 25.0, 0.0, 0.01, "R", "O", day),
                      (1, 13, 5, 4, 10.0, 0.0, 0.0, "A", "F", day)], LINES),
        "part": ([(n, f"part {n}", "Brand#7", "SMALL", 9) for n in (10, 11, 12, 13)], "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"),
        "supplier": ([(5, "five", 2000.0)], "s_suppkey bigint, s_name string, s_acctbal double"),
        "orders": ([(1, "O")], "o_orderkey bigint, o_orderstatus string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = QUERIES["review_sheets"](spark, str(tmp_path)).filter(F.col("export_id") == "1").collect()
    by_sheet = {}
    for r in found:
        by_sheet.setdefault(r["sheet"], set()).add(tuple(r[f"c{i}"] for i in range(1, 10)) + (r["n"],))
    assert by_sheet.keys() == {"Dropbox_Folders", "Discussions", "Grade_Items", "Checklists", "Quizzes", "Activity_Joins", "Diagnostics"}
    assert ("", "Activity 1-10", "RC-10-1", "30", "G-10", "", "", "C-1", "", 1) in by_sheet["Dropbox_Folders"]
    assert by_sheet["Discussions"] == {("discussion_topic", "", "", "Activity 2-11", "RC-11-2", "15", "G-11", "", "", 1)}
    assert by_sheet["Quizzes"] == {("", "", "Activity 3-12", "RC-12-3", "G-12", "no", "2", "5", "", 1)}
    assert by_sheet["Checklists"] == {("", "Activity 1-10", "RC-10-1", "", "", "", "", "", "", 1), ("", "Activity 4-13", "RC-13-4", "", "", "", "", "", "", 1)}
    assert {r[2] for r in by_sheet["Grade_Items"]} == {"G-10", "G-11", "G-13"}
    assert {r[0] for r in by_sheet["Diagnostics"]} == {"R01", "R02", "R04", "R19"}
