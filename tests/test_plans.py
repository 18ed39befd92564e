"""What the plans look like: pushed filters, join strategies, skew, code size."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import duplicates
from ledgerloom.operators.either_key import either_key_left_join
from ledgerloom.plans import ar_keys, ar_mart, client_keys, revenue_mart
from ledgerloom.plans.revenue_classify import revenue_classify
from ledgerloom.sources.tables import DocumentTables
from tests import messy

PLANS = {
    "ar_mart": ar_mart.ar_mart,
    "ar_keys": ar_keys.ar_keys,
    "revenue_mart": revenue_mart.revenue_mart,
    "revenue_classify": lambda t: revenue_classify(revenue_mart.revenue_mart(t), t),
    "client_keys": client_keys.client_keys,
    "dominant": lambda t: client_keys.client_keys(t, dominant_only=True),
    "rekey": lambda t: duplicates.rekey_duplicates(ar_keys.ar_keys(t)),
}


@pytest.fixture(scope="module")
def stored(spark, make, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    rows = messy.tables(3)
    paths = {}
    for name in schemas.ALL:
        paths[name] = str(folder / name)
        make(name, rows[name]).write.parquet(paths[name])
    return DocumentTables.load(spark, paths)


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_all(options: dict[str, str]) -> None:
        for key, value in options.items():
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def explain(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.mark.parametrize("name", PLANS)
def test_no_nested_loops_and_no_python(stored, conf, name):
    conf(NO_BROADCAST)
    plan = explain(PLANS[name](stored))
    for node in ("NestedLoop", "Cartesian", "EvalPython", "InPandas", "InArrow", "CollectLimit", "Broadcast"):
        assert node not in plan


@pytest.mark.parametrize("name", PLANS)
@pytest.mark.parametrize("broadcast", [True, False])
def test_generated_methods_can_be_compiled(stored, conf, name, broadcast):
    """The JVM compiles methods of up to 8000 bytes only."""
    conf({"spark.sql.adaptive.enabled": "false", **({} if broadcast else NO_BROADCAST)})
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", explain(PLANS[name](stored), "codegen"))
    assert sizes and max(map(int, sizes)) <= 8000


def scans(plan, table):
    """(pushed filters, columns read) of each scan of a table."""
    found = []
    for block in plan.split("\n\n"):
        if re.search(rf"Location: .*/{table}\]", block):
            pushed = re.search(r"PushedFilters: \[(.*)\]", block)
            columns = re.search(r"ReadSchema: struct<(.*)>", block).group(1)
            found.append((pushed.group(1) if pushed else "", {c.split(":")[0] for c in columns.split(",")}))
    return found


def test_filters_reach_the_scans(stored, conf):
    plan = explain(ar_mart.ar_mart(stored))
    (head_filters, head_columns), = scans(plan, "dochead")
    for part in ("GreaterThanOrEqual(docdate", "In(cmpcode", "Not(In(doccode", "Not(EqualTo(cdc_operation_type,D))"):
        assert part in head_filters
    assert "curdoc" not in head_columns
    totals, jobs = sorted(scans(plan, "docline"), key=lambda scan: -len(scan[1]))
    assert "StringStartsWith(el2,021)" in totals[0] and "Not(EqualTo(statpay,665))" in totals[0]
    assert "el4" not in totals[1]
    assert jobs[1] == {"cmpcode", "doccode", "docnum", "el2", "el4"}


def test_revenue_filters_reach_the_scans(stored):
    plan = explain(revenue_mart.revenue_mart(stored))
    by_width = sorted(scans(plan, "docline"), key=lambda scan: len(scan[1]))
    assert len(by_width) == 3
    jobs, customers, lines = by_width
    assert jobs[1] == {"cmpcode", "doccode", "docnum", "el4"}
    assert customers[1] == {"cmpcode", "doccode", "docnum", "statpay", "el2", "el3"}
    assert "StringStartsWith(el2,4)" in lines[0] and "Not(In(doccode" in lines[0]
    for filters, _ in scans(plan, "dochead"):
        assert "docdate" in filters or filters.count("IsNotNull") == 0


def test_ranking_is_not_planned_unless_asked(stored):
    assert "Window" not in explain(client_keys.client_keys(stored))
    assert "Window" in explain(client_keys.client_keys(stored, dominant_only=True))


def test_no_window_over_rows_of_a_hot_key(stored):
    assert "Window" not in explain(duplicates.rekey_duplicates(ar_keys.ar_keys(stored)))


def final_plan(df):
    """The adaptive plan after the frame has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


SKEW = {
    **NO_BROADCAST,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def hot(spark, make):
    """One document with a third of all lines, every line different."""
    lines = spark.range(0, 9000, 1, 8).select(
        F.lit("BAS").alias("cmpcode"),
        F.lit("SINV").alias("doccode"),
        F.expr("if(id % 3 = 0, '1', string(id % 500))").alias("docnum"),
        F.lit(84).alias("statpay"),
        *[F.lit(200).cast("long").alias(c) for c in ("valuedoc", "valuehome")],
        *[F.lit(2).alias(c) for c in ("valuedoc_dp", "valuehome_dp")],
        F.expr("if(id % 5 = 0, '0211', '40100')").alias("el2"),
        F.expr("concat('D', id % 4)").alias("el3"),
        F.lit("J").alias("el4"),
        *[F.expr(f"concat('{c}-', id)").alias(c) for c in ("ref1", "ref2", "ref3", "ref4", "ref5")],
    )
    heads = [
        {"cmpcode": "BAS", "doccode": "SINV", "docnum": f" {n}", "docdate": date(2020, 1, 1),
         "curdoc": "USD", "cdc_operation_type": "I"}
        for n in range(500)
    ]
    customers = [
        {"el3_cmpcode": "BAS", "el3_code": f"D{i}", "el3_elmlevel": 3, "el3_name": "n"} for i in range(4)
    ]
    return DocumentTables(
        docline=lines,
        dochead=make("dochead", heads),
        company=make("company", [{"code": "BAS", "homecur": "USD"}]),
        el2_element=make("el2_element", [
            {"el2_cmpcode": "BAS", "el2_code": "40100", "el2_elmlevel": 2, "el2_name": "a"}]),
        el3_element=make("el3_element", customers),
    )


def test_hot_document_is_split(hot, conf):
    conf(SKEW)
    groups = revenue_mart.revenue_groups(hot)
    assert "SortMergeJoin(skew=true)" in final_plan(groups)
    total = groups.agg(F.sum("valuehome")).first()[0]
    assert total == hot.docline.filter("el2 = '40100'").count() * 200.0


def test_hot_document_amounts(hot):
    """Sums count every (revenue line, receivable line) pair of a document."""
    lines = hot.docline.groupBy("docnum").agg(
        F.count(F.when(F.col("el2") == "40100", 1)).alias("revenue"),
        F.count(F.when(F.col("el2") == "0211", 1)).alias("receivable"),
    )
    pairs = lines.agg(F.sum(F.col("revenue") * F.col("receivable"))).first()[0]
    got = revenue_mart.revenue_mart(hot).agg(F.sum("valuehome")).first()[0]
    assert got == pairs * 200.0


def test_hot_key_of_duplicates_is_split(spark, conf):
    conf(SKEW)
    df = spark.range(0, 6000, 1, 8).selectExpr(
        "if(id % 3 = 0, NULL, string(id)) AS _key_global_identifier",
        "'pass-through' AS AR_Invoice_Type",
        "string(id) AS AR_Invoice_Number",
        "'S' AS `AR Billing Site`",
    )
    rekeyed = duplicates.rekey_duplicates(df)
    assert "SortMergeJoin(skew=true)" in final_plan(rekeyed)
    assert rekeyed.filter("new_key_global_identifier like 'S-%'").count() == 2000
    assert rekeyed.count() == 6000


def skewed_joins(plan):
    """(split joins, all sort-merge joins) of a plan that has run."""
    return plan.count("SortMergeJoin(skew=true)"), plan.count("SortMergeJoin")


def test_hot_first_key_of_the_either_key_join_is_split(spark, conf):
    conf(SKEW)
    left = spark.range(0, 9000, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 'hot', concat('a', id)) AS k1", "concat('b', id % 700) AS k2", "repeat('x', 40) AS pad"
    )
    right = spark.range(0, 900, 1, 4).selectExpr("if(id = 0, 'hot', concat('b', id)) AS rk", "id AS v")
    joined = either_key_left_join(left, right, "k1", "k2", "rk")
    plan = final_plan(joined)
    assert skewed_joins(plan) == (1, 1)  # the only join
    assert joined.filter("k1 = 'hot' AND rk = 'hot'").count() == 3000
    want = left.join(right, (F.col("k1") == F.col("rk")) | (F.col("k2") == F.col("rk")), "left")
    assert joined.count() == want.count()


def test_either_key_reads_its_inputs_once(spark, stored, conf):
    conf(NO_BROADCAST)
    from ledgerloom.plans import ar_corrections

    mart = ar_corrections.with_correction_keys(ar_mart.ar_mart(stored))
    lookup = ar_corrections.correction_lookup(stored.ref_correction)
    plan = explain(either_key_left_join(mart, lookup, ar_corrections.SITE_KEY, ar_corrections.INVOICE_KEY, "InterimKey"))
    assert len(scans(plan, "ref_correction")) == 1
    assert len(re.findall(r"\(\d+\) Scan parquet", plan)) == len(re.findall(r"\(\d+\) Scan parquet", explain(mart))) + 1


def test_job_defaults_shuffle_only_early_documents(spark, make, conf):
    """Lines and headers are cut down, without an exchange of their own, before they are grouped by document."""
    conf(NO_BROADCAST)
    days = 2000
    heads = spark.range(0, 20 * days, 1, 8).selectExpr(
        "concat('C', id % 20) AS cmpcode", "'S' AS doccode", "string(id) AS docnum",
        f"date_add(date'2015-01-01', int(pmod(xxhash64(id), {days}))) AS docdate", "'USD' AS curdoc", "'I' AS cdc_operation_type",
    )
    lines = spark.range(0, 20 * days, 1, 8).select(
        F.expr("concat(if(id % 3 = 0, ' ', ''), 'C', id % 20) AS cmpcode"), F.lit("S").alias("doccode"), F.expr("concat(' ', id) AS docnum"),
        F.lit(84).alias("statpay"), *[F.lit(200).cast("long").alias(c) for c in ("valuedoc", "valuehome")],
        *[F.lit(2).alias(c) for c in ("valuedoc_dp", "valuehome_dp")], F.expr("if(id % 20 < 5, '40100', '0211') AS el2"), F.lit("D").alias("el3"),
        F.expr("if(id % 7 = 0, '', concat('J', id)) AS el4"), *[F.lit("x").alias(c) for c in ("ref1", "ref2", "ref3", "ref4", "ref5")],
    )
    t = DocumentTables(docline=lines, dochead=heads)

    def defaults(**options):
        return {tuple(row) for row in revenue_mart.job_defaults(t, **options).collect()}

    want = defaults(reduced=False)
    assert len(want) > 20 and defaults(reduced=True) == want
    assert defaults(reduced=True, nulls="first") == defaults(reduced=False, nulls="first")
    blank = revenue_mart.is_revenue() & (F.col("el4") == "")
    some = defaults(reduced=True, needed=blank)
    assert some <= want and {c for c, _ in some} >= {"C0", " C0"} and len(some) < len(want)

    early_lines, early_heads = revenue_mart._early(t, lines.filter("el4 <> ''"), revenue_mart.with_document_key(heads), "ignore", F.lit(True))
    assert early_heads.count() < 20 * days / 8 and early_lines.count() < 20 * days / 8
    # Both keep the 8 partitions of their tables: only bounded tables are exchanged for them.
    conf({"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "3"})
    for frame in (early_lines, early_heads):
        plan = frame.select("*")._jdf.queryExecution().executedPlan()
        assert plan.outputPartitioning().numPartitions() == 8


@pytest.fixture(scope="module")
def many_customers(spark, make):
    """One document with a third of all lines, each with a customer element of its own."""
    lines = spark.range(0, 9000, 1, 8).select(
        F.expr("if(id % 3 = 0, 'BAS', concat('C', id % 7))").alias("cmpcode"),
        F.expr("if(id % 3 = 0, 'SINV', concat('K', id % 5))").alias("doccode"),
        F.expr("if(id % 3 = 0, '1', string(id % 500))").alias("docnum"),
        F.lit(84).alias("statpay"),
        *[F.lit(200).cast("long").alias(c) for c in ("valuedoc", "valuehome")],
        *[F.lit(2).alias(c) for c in ("valuedoc_dp", "valuehome_dp")],
        F.lit("0211").alias("el2"),
        F.expr("concat('D', id)").alias("el3"),
        *[F.lit("x").alias(c) for c in ("el4", "ref1", "ref2", "ref3", "ref4", "ref5")],
    )
    heads = [
        {"cmpcode": f" C{c}", "doccode": f"K{k}", "docnum": str(n), "docdate": date(2020, 1, 1), "cdc_operation_type": "I"}
        for c in range(7) for k in range(5) for n in range(0, 500, 9)
    ]
    own = [
        {"cmpcode": "BAS", "doccode": "SINV", "docnum": "1", "docdate": date(2020, 1, d), "cdc_operation_type": "I"}
        for d in (1, 1, 2)
    ]
    return DocumentTables(docline=lines, dochead=make("dochead", heads + own))


@pytest.mark.parametrize("dedup", [False, True])
def test_document_of_many_customers_is_split(many_customers, conf, dedup):
    conf(SKEW)
    customers = revenue_mart.customer_lines(many_customers, dedup=dedup)
    assert skewed_joins(final_plan(customers))[0] >= 1
    own = customers.filter("cmpcode = 'BAS'").groupBy("ar_copies").count().collect()
    assert [(row.ar_copies, row["count"]) for row in own] == [(1 if dedup else 3, 3000)]


def test_clients_are_read_once(stored):
    plan = explain(client_keys.parent_counts(stored))
    assert len(scans(plan, "client_master")) == 1 and len(scans(plan, "client_xref")) == 1


def test_hot_client_is_split_and_clients_without_code_bypass(spark, conf):
    conf(SKEW)
    master = spark.range(0, 9000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'hot' ELSE string(id) END AS m_code",
        "concat('p', id) AS client_ultimate_parent_id", "concat('n', id) AS global_ultimate_business_name",
    )
    xref = spark.range(0, 3000, 1, 4).selectExpr(
        "if(id < 5, 'hot', string(id)) AS m_code", "concat(id, 'S') AS site_id", "string(id) AS c_code"
    )
    t = DocumentTables(client_master=master, client_xref=xref)
    counts = client_keys.parent_counts(t)
    assert skewed_joins(final_plan(counts))[0] >= 1
    got = {row.parent_id: row.parent_row_count for row in counts.collect()}
    assert len(got) == 9000 and got["p0"] == 0 and got["p1"] == 5 and got["p8"] == 1 and got["p8999"] == 0
    keys = client_keys.client_keys(t, strict=False)
    assert skewed_joins(final_plan(keys))[0] >= 1
    assert keys.filter("ClientKey IS NULL").count() == 3000 + sum(i % 3 == 2 and not 5 <= i < 3000 for i in range(9000))


def test_an_exploding_lookup_is_not_broadcast_by_its_planned_size(spark, tmp_path):
    from ledgerloom.operators import lookups

    path = str(tmp_path / "lookup")
    spark.range(10).selectExpr("string(id) AS code", "array_repeat('name', 100000) AS names").write.parquet(path)
    lookup = spark.read.parquet(path).selectExpr("code", "explode(names) AS name")
    assert lookups.planned_bytes(lookup) is None
    joined = lookups.lookup_join(spark.range(5).selectExpr("string(id) AS c"), lookup, {"c": "code"})
    assert "ResolvedHint" not in explain(joined, "extended")
    bounded = lookups.lookup_join(
        spark.range(5).selectExpr("string(id) AS c"), lookup, {"c": "code"}, sized_by=spark.read.parquet(path).select("code")
    )
    assert "ResolvedHint" in explain(bounded, "extended")


def test_rekey_reads_its_inputs_once(stored, conf):
    """Counts and rows come from the same keyed invoices; the plan that ran reuses their exchanges."""
    conf(NO_BROADCAST)
    plan = final_plan(duplicates.rekey_duplicates(ar_keys.ar_keys(stored)))
    final = plan.split("+- == Final Plan ==")[-1]
    assert len(re.findall(r"FileScan parquet", final)) <= 9
