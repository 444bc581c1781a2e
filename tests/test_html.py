from pyspark.sql import functions as F

from civicloom.queries import queries
from civicloom.sources.html import extract_contacts, extract_html_rows


def rows_of(spark, *pages, **options):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    return extract_html_rows(df, **options)


def cells(df):
    return [(r["page_id"], r["table_idx"], r["row_idx"], r["cells"])
            for r in df.orderBy("page_id", "table_idx", "row_idx").collect()]


def test_rows(spark):
    page = ("<TABLE><tr></tr><tr><td> a <b>b</b><!-- x --> c&amp;d</td><th>e<br>f</th></tr></TABLE>"
            "<table><tr><td>g<script>var x='</p>';</script></td></tr></table>")
    assert cells(rows_of(spark, page, "<p>no</p>", None)) == [
        (0, 0, 1, ["abc&d", "ef"]), (0, 1, 0, ["g"])]


def test_nested_and_unclosed(spark):
    nested = "<table><tr><td>a<table><tr><td>b</td></tr></table></td></tr></table>"
    assert cells(rows_of(spark, nested)) == [
        (0, 0, 0, ["ab", "b"]), (0, 0, 1, ["b"]), (0, 1, 0, ["b"])]
    assert cells(rows_of(spark, "<table><tr><td>a<td>b</table>")) == [(0, 0, 0, ["ab", "b"])]


def test_class_is_preferred_page_by_page(spark):
    plain = "<table><tr><td>p</td></tr></table>"
    marked = "<table class='x mark'><tr><td>m</td></tr></table>"
    df = rows_of(spark, plain + marked, plain, table_class="mark")
    assert [(r["page_id"], r["table_idx"], r["by_class"], r["cells"]) for r in df.orderBy("page_id").collect()] == [
        (0, 0, True, ["m"]), (1, 0, False, ["p"])]


def contact_rows(spark, table, by_class=True):
    rows = [(i, row) for i, row in enumerate(table)]
    return spark.createDataFrame(
        [(1, 0, by_class, rows)],
        "page_id long, table_idx int, by_class boolean, rows array<struct<row_idx: int, cells: array<string>>>")


def stations(spark, table, by_class=True):
    found = extract_contacts(contact_rows(spark, table, by_class), "stations").orderBy("row_idx").collect()
    return [(r["name"], r["phone"], r["fax"]) for r in found]


def test_stations(spark):
    table = [
        ["early", "1", "2"],
        ["no.", "ชื่อสถานี", "หมายเลขโทรศัพท์", "โทรสาร"],
        ["1", "ก", "02", "03"],
        ["2", "ข"],
        ["x", "y", "z", "หมายเลข"],
        ["3", "ค", "04", "05"],
        ["only"],
        ["4", "", "06", "07"],
    ]
    assert stations(spark, table) == [("early", "1", "2"), ("ก", "02", "03"), ("ข", "", ""), ("ค", "05", "05")]


def test_station_rules_differ_by_pass(spark):
    table = [["ชื่อ", "FAX", "หมายเลข"], ["a", "b", "c"], ["โทรศัพท์", "d", "e"]]
    assert stations(spark, table, True) == [("a", "c", "b")]
    assert stations(spark, table, False) == [("a", "c", "c"), ("โทรศัพท์", "e", "e")]


def test_hospitals(spark):
    table = [
        ["1", "before", "x", "y"],
        ["ลำดับ", "ชื่อสถานพยาบาล", "List of Network Hospital", "หมายเลขโทรศัพท์"],
        ["1", "โรงพยาบาลก", "A Hospital", "02"],
        ["2", "ข", "B Clinic", "03"],
        ["3", "short"],
        ["4", "12", "x", "y"],
        ["5", "---", "x", "y"],
        ["6", "", "x", "y"],
    ]
    rows = contact_rows(spark, table)

    def got(**options):
        found = extract_contacts(rows, "hospitals", **options).orderBy("row_idx").collect()
        return [(r["row_idx"], r["name_th"], r["name_en"], r["phone"]) for r in found]

    assert got() == [(2, "โรงพยาบาลก", "A Hospital", "02"), (3, "ข", "B Clinic", "03")]
    assert got(any_hospital_row_is_heading=True) == [(3, "ข", "B Clinic", "03")]


def one_file_of_customers(spark, folder):
    """Customers as one file that only one task can read."""
    rows = [(key, f"Customer {key}", key % 5, "MACHINERY") for key in range(60)]
    df = spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    df.coalesce(1).write.parquet(f"{folder}/customer.parquet")
    return folder


def test_hospital_pages_of_one_file_are_read_by_all_cores(spark, folder):
    found = queries()["extract_hospital_contacts"](spark, one_file_of_customers(spark, folder))
    assert found.count() == 60
    assert found.select(F.spark_partition_id()).distinct().count() >= spark.sparkContext.defaultParallelism


def test_station_pages_of_one_file_are_read_by_all_cores(spark, folder):
    found = queries()["extract_contacts"](spark, one_file_of_customers(spark, folder))
    assert found.count() == 120
    assert found.select(F.spark_partition_id()).distinct().count() >= spark.sparkContext.defaultParallelism
