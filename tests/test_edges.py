"""Hand-computed results for the rows that are easy to get wrong."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import ClassifyConfig, KeyConfig, ReceivablesConfig, RevenueConfig
from ledgerloom.functions import columns, invoice
from ledgerloom.operators import duplicates
from ledgerloom.operators.aggregates import earliest_value
from ledgerloom.plans import ar_mart as ar
from ledgerloom.plans import client_keys as clients
from ledgerloom.plans import revenue_mart as revenue
from ledgerloom.plans.ar_corrections import ar_corrections

CFG, REV = ReceivablesConfig(), RevenueConfig()


def column(spark, rows, schema, *expressions):
    df = spark.createDataFrame(rows, schema)
    return [tuple(row) for row in df.select(*expressions).collect()]


@pytest.mark.parametrize(
    "mode, expected",
    [("zero", [12345.0, 1234.5, 123450.0, 0.0, 0.0]), ("raw", [12345.0, 1234.5, 123450.0, 12345.0, None])],
)
def test_scaled_amount(spark, mode, expected):
    rows = [(12345, dp) for dp in (2, 3, 1, 0, None)]
    got = column(spark, rows, "v long, dp int", columns.scaled_amount("v", "dp", mode))
    assert [value for value, in got] == expected
    df = spark.createDataFrame(rows, "v long, dp int")
    sums = df.groupBy("dp").agg(columns.summed_amount("v", "dp", mode).alias("s"))
    assert {row.dp: row.s for row in sums.collect()} == dict(zip((2, 3, 1, 0, None), expected))


@pytest.mark.parametrize("mode", ["zero", "raw"])
@pytest.mark.parametrize("copies", [None, "n"])
def test_exact_sums_of_many_places(spark, mode, copies):
    rows = [
        (v, dp, 3) for dp in [*range(-5, 24), None] for v in (7, -123456789012, 9 * 10**17 + 1, None)
    ]
    df = spark.createDataFrame(rows, "v long, dp int, n long")
    got = df.groupBy("v", "dp").agg(columns.summed_amount("v", "dp", mode, copies=copies).alias("s"))
    for row in got.collect():
        if row.dp is None or (mode == "zero" and row.dp == 0):
            want = 0.0 if mode == "zero" else None
        elif row.v is None:
            want = None
        else:
            want = float(row.v) / 10.0 ** (row.dp - 2 if row.dp else 0) * (3 if copies else 1)
        assert row.s == (want if not want else pytest.approx(want, rel=1e-12, abs=0.0))


def test_exact_sums_do_not_depend_on_order(spark):
    rows = [(v, dp, i) for dp in (3, 12) for i, v in enumerate([1, 10**15, 3, -10**15, 7] * 20)]
    df = spark.createDataFrame(rows, "v long, dp int, i int")
    total = columns.summed_amount("v", "dp").alias("s")
    orders = [F.col("i"), F.desc("i"), F.col("v"), F.xxhash64("i")]
    assert len({df.coalesce(1).sort(order).agg(total).first().s for order in orders}) == 1
    assert df.agg(total).first().s == pytest.approx(22.0 + 22e-9, rel=1e-15)


AR_SCHEMA = (
    "cmpcode string, doccode string, docnum string, el3 string, el4 string, "
    "ref1 string, ref2 string, ref3 string, ref4 string, ref5 string"
)


def ar_row(cmpcode, **values):
    names = ["doccode", "docnum", "el3", "el4", "ref1", "ref2", "ref3", "ref4", "ref5"]
    return (cmpcode, *[values.get(name) for name in names])


def ar_fields(spark, rows):
    df = spark.createDataFrame(rows, AR_SCHEMA).withColumn("carrier", invoice.carrier(CFG))
    df = df.withColumn("carried", invoice.carried(CFG)).select(
        invoice.delivery_site(CFG),
        invoice.delivery_site_invoice_number(CFG),
        invoice.invoice_type(CFG),
        invoice.job_number(CFG),
    )
    return [tuple(row) for row in df.collect()]


def test_carried_by_ref5(spark):
    rows = [
        ar_row("BAS", docnum="  7", ref5="PT1234-99", ref3="j"),
        ar_row("BAS", docnum="  7", ref5="zz", el4="e"),
        ar_row("BAS", docnum="  7"),
        ar_row("BAS", docnum="  7", ref5="PT1"),
        ar_row("WAR", docnum="  7", ref5="PT1234-99", ref3="j", el4="e", el3="ICOM1"),
    ]
    assert ar_fields(spark, rows) == [
        ("PT1234", "99", "3PD-PT", "j"),
        ("BAS", "7", "3PD-OWN", "e"),
        ("UNKNOWN", "Unknown", "3PD-OWN", ""),
        ("PT1", "", "3PD-PT", None),
        ("PT1234", "99", "IC", "e"),
    ]


def test_carried_by_el4_and_ref3(spark):
    rows = [
        ar_row("MP", el4="Xa", ref1="r1"),
        ar_row("MP", el4="Xa", ref1="r1", ref5="r5", el3="X2"),
        ar_row("ALLENTOWN", el4="J1", ref1="r1", ref5="r5"),
        ar_row("CLINTRAK", ref1="r1"),
        ar_row("MAI", ref3="PT1234-99", ref1="r1", el3="IF1"),
        ar_row("MAI", ref3="a", ref1="r1"),
        ar_row("HEG", ref5="PT1234-99", docnum="  7"),
    ]
    assert ar_fields(spark, rows) == [
        ("XA", None, "3PD-PT", "Xa"),
        ("XA", "r5", "IC", "Xa"),
        ("ALLENTOWN", "r1", "3PD-OWN", "J1"),
        ("UNKNOWN", "Unknown", "3PD-OWN", ""),
        ("PT1234", "99", "IC", ""),
        ("MAI", "r1", "3PD-OWN", ""),
        ("UNKNOWN", "Unknown", "3PD-OWN", ""),
    ]


def test_company_in_two_carrier_rules():
    with pytest.raises(ValueError):
        invoice.carrier(ReceivablesConfig(carriers=CFG.carriers + CFG.carriers[:1]))


def test_site_and_client_key(spark):
    rows = [("ALLENTOWN", "c"), ("HEG", None), ("nowhere", "c"), (None, "c")]
    site = invoice.site_id("cmpcode")
    got = column(spark, rows, "cmpcode string, el3 string", site, invoice.client_id_key(site, F.col("el3")))
    assert got == [("0", "0-c"), ("38", None), ("Unknown", "Unknown-c"), ("Unknown", "Unknown-c")]


REV_SCHEMA = (
    "head_company string, docdate date, head_number string, "
    "ref1 string, ref2 string, ref3 string, ref4 string"
)


def revenue_fields(spark, company, day, ref1="CN55", number="7"):
    day = date.fromisoformat(day) if day else None
    row = (company, day, number, ref1, "2", "3", "4")
    return column(
        spark, [row], REV_SCHEMA, invoice.revenue_invoice_number(REV),
        invoice.revenue_purchase_order(REV), invoice.revenue_protocol(REV),
    )[0]


@pytest.mark.parametrize(
    "company, day, po, protocol",
    [
        ("SUZHOU", "2020-01-01", "2", "3"),
        ("WAR", "2020-11-09", "4", "2"),
        ("WAR", "2020-11-10", "3", "2"),
        ("KOREA", "2024-07-12", "2", "3"),
        ("KOREA", "2024-07-13", "4", "2"),
        ("KOREA", "2024-07-23", "3", "2"),
        ("JAPAN", "2024-07-31", "2", "3"),
        ("JAPAN", "2024-08-01", "4", "2"),
        ("JAPAN", "2024-08-20", "2", "3"),
        ("JAPAN", None, "4", "2"),
        ("BAS", "2020-01-01", "4", "2"),
    ],
)
def test_dated_rules(spark, company, day, po, protocol):
    assert revenue_fields(spark, company, day)[1:] == (po, protocol)


@pytest.mark.parametrize(
    "company, ref1, expected",
    [
        ("SINGAPORE", "CN55", "55"), ("SINGAPORE", "55", "Unknown"), ("SINGAPORE", None, "Unknown"),
        ("INDY", "a", "a"), ("HEG", "a", "7"), ("KOREA", "a", "a"), ("OTHERCO", "a", "Unknown"),
    ],
)
def test_revenue_invoice_number(spark, company, ref1, expected):
    assert revenue_fields(spark, company, "2020-01-01", ref1)[0] == expected


def test_none_contained_keeps_null(spark):
    rows = [("xReimbx",), ("Consolidated",), (None,), ("ok",)]
    df = spark.createDataFrame(rows, "x string")
    kept = df.filter(columns.none_contained(F.col("x"), **ar.REIMBURSED)).collect()
    assert [row.x for row in kept] == [None, "ok"]


def test_account_range_is_text(make):
    lines = make("docline", [{"el2": e, "cmpcode": "HEG", "doccode": "SINV"}
                             for e in ("23160", "231605", "2318", "23181", "4", "24300", None)])
    kept = {row.el2 for row in revenue.revenue_lines(lines).collect()}
    assert kept == {"23160", "231605", "2318", "4"}


def test_line_exclusions_with_null(make):
    rows = [
        {"cmpcode": "MP", "el4": None}, {"cmpcode": "BAS", "el4": None}, {"cmpcode": "MP", "el4": "X1"},
        {"cmpcode": "INDY", "el4": "J"}, {"cmpcode": "MAI", "ref2": None},
        {"cmpcode": "MAI", "ref2": "Recharges 1"}, {"cmpcode": "HEG", "ref2": "Recharges 1"},
        {"cmpcode": "KOREA", "doccode": None}, {"cmpcode": "KOREA", "doccode": "PINV"},
    ]
    lines = make("docline", [{"el2": "40", "doccode": "SINV", **row} for row in rows])
    kept = sorted(row.cmpcode for row in revenue.revenue_lines(lines).collect())
    assert kept == ["BAS", "HEG", "INDY"]


def test_cdc_flag(make_tables):
    heads = [
        {"cmpcode": "HEG", "doccode": "SINV", "docnum": str(i), "docdate": date(2020, 1, 1),
         "cdc_operation_type": flag}
        for i, flag in enumerate(("I", "D", None))
    ]
    t = make_tables(dochead=heads)
    kept = {r.docnum for r in ar.document_heads(t.dochead, CFG, True).collect()}
    assert kept == {"0"}
    assert ar.document_heads(t.dochead, CFG, False).count() == 3


@pytest.mark.parametrize("nulls, expected", [("ignore", "b"), ("first", "a")])
def test_earliest_value(spark, nulls, expected):
    rows = [("k", None, "a"), ("k", date(2020, 1, 1), "c"), ("k", date(2020, 1, 1), "b"),
            ("k", date(2020, 1, 2), "0")]
    df = spark.createDataFrame(rows, "k string, d date, v string")
    assert earliest_value(df, ["k"], "d", "v", "first", nulls).collect() == [("k", expected)]


def test_earliest_value_without_dates(spark):
    df = spark.createDataFrame([("k", None, "a")], "k string, d date, v string")
    assert earliest_value(df, ["k"], "d", "v", "first").collect() == [("k", None)]


@pytest.mark.parametrize("site, expected", [("12AB", "12-c"), ("AB", "-c"), (None, None)])
def test_client_key(spark, site, expected):
    got = column(spark, [(site, "c")], "s string, c string", clients.client_key(F.col("s"), F.col("c")))
    assert got == [(expected,)]


def test_parent_ties_share_rank_one(make_tables):
    master = [
        {"m_code": "1", "client_ultimate_parent_id": "9", "global_ultimate_business_name": "a"},
        {"m_code": "2", "client_ultimate_parent_id": "9", "global_ultimate_business_name": "b"},
        {"m_code": "3", "client_ultimate_parent_id": "9", "global_ultimate_business_name": "c"},
        {"m_code": "4", "client_ultimate_parent_id": None, "global_ultimate_business_name": "d"},
    ]
    xref = [{"m_code": m, "site_id": "1", "c_code": c}
            for m, c in (("1", "x"), ("1", "y"), ("2", "x"), ("2", "z"), ("3", "x"), ("3", None))]
    t = make_tables(client_master=master, client_xref=xref)
    ranked = {(r.parent_id, r.parent_name): (r.parent_row_count, r.parent_row_rank)
              for r in clients.ranked_parents(t).collect()}
    assert ranked == {("9", "a"): (2, 1), ("9", "b"): (2, 1), ("9", "c"): (1, 2), (None, "d"): (0, 1)}
    leading = {r.m_code for r in clients.client_keys(t, dominant_only=True).collect()}
    assert leading == {1, 2, 4}
    assert clients.client_keys(t).count() == 7


def test_client_codes_that_are_no_numbers(make_tables):
    t = make_tables(client_master=[{"m_code": "x1", "client_ultimate_parent_id": "2"}])
    assert clients.client_keys(t, strict=False).collect() == [(None, 2, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clients.client_keys(t).collect()


KEYED = "_key_global_identifier string, AR_Invoice_Type string, AR_Invoice_Number string, `AR Billing Site` string"
KEYED_ROWS = [
    ("u", "pass-through", "1", "S"),
    ("d", "pass-through", "2", "S"),
    ("d", "pass-through", "2", None),
    ("d", "IC", "3", "S"),
    (None, "pass-through", "4", "S"),
    (None, "IC", "5", "S"),
    ("n", "pass-through", "6", "S"),
    ("n", "pass-through", None, "S"),
]


def rekeyed(spark, **options):
    df = duplicates.rekey_duplicates(spark.createDataFrame(KEYED_ROWS, KEYED), **options)
    return sorted((r.AR_Invoice_Number, r.new_key_global_identifier) for r in df.collect())


def test_rekey_as_written(spark):
    assert rekeyed(spark) == [("1", "u"), ("2", "S-2"), ("2", "null-2"), ("4", "S-4")]


def test_rekey_keep_unflagged(spark):
    df = duplicates.rekey_duplicates(spark.createDataFrame(KEYED_ROWS, KEYED), keep_unflagged=True)
    assert df.count() == len(KEYED_ROWS)
    assert df.filter("AR_Invoice_Number = '3'").first().new_key_global_identifier == "d"


def test_rekey_distinct_numbers(spark):
    rows = [("d", "pass-through", "2", "S"), ("d", "pass-through", "2", "T")]
    df = spark.createDataFrame(rows, KEYED)
    assert duplicates.rekey_duplicates(df).count() == 2
    assert duplicates.rekey_duplicates(df, distinct_numbers=True).count() == 0


def test_rekey_null_keys_alone(spark):
    assert ("5", None) in rekeyed(spark, nulls_as_duplicates=False)
    assert ("4", None) in rekeyed(spark, nulls_as_duplicates=False)


def test_rekey_counts_add_up(spark):
    df = spark.createDataFrame(KEYED_ROWS, KEYED)
    flagged = duplicates.flag_duplicates(df)
    unique = flagged.filter("dup_count = 1").count()
    renewed = flagged.filter("Flag = 'Y'").count()
    dropped = flagged.filter("dup_count > 1 and Flag = 'N'").count()
    assert unique + renewed + dropped == len(KEYED_ROWS)
    assert duplicates.rekey_duplicates(df).count() == unique + renewed


@pytest.mark.parametrize(
    "company, customer, flag, kind",
    [
        ("BAS", "D4199", "BASD4199", "PT"),
        ("MAI", "D4400", "MAID4400", "PT"),
        ("MAI", "D1", "MAID1", "Not classified as PT"),
        ("MAI", "ax", "MAIax", "PT"),
        ("ALLENTOWN", "X9", "X", "PT"),
        ("ALLENTOWN", None, "Other", "Not classified as PT"),
        ("HEG", "X9", "Other", "Not classified as PT"),
    ],
)
def test_pass_through(spark, company, customer, flag, kind):
    df = spark.createDataFrame([(company, customer)], "cmpcode string, el3 string")
    df = df.withColumn("Pass_Through_Flag", invoice.pass_through_flag())
    assert df.select("Pass_Through_Flag", invoice.pass_through_class()).first() == (flag, kind)


def test_currency_text(spark):
    rows = [(1234567.891,), (-1234.5,), (None,)]
    got = column(spark, rows, "x double", columns.currency_text(F.col("x")),
                 columns.currency_text(F.col("x"), None))
    assert got == [("$1,234,567.89",) * 2, ("$-1,234.50",) * 2, ("$nu", None)]


@pytest.mark.parametrize(
    "number, entity, kind, partner, expected",
    [
        ("12A", "k", "3PD-PT", "p", "cmp-inv"),
        ("Unknown", "k", "3PD-PT", "p", "cmp-inv"),
        ("9", "WARWAR", "IC", "p", "WAR-9"),
        ("9", "k", "IC", "p", "cmp-inv"),
        ("9", "k", "3PD-OWN", "p", "P-9"),
        (None, "k", "3PD-OWN", "p", "P-"),
    ],
)
def test_global_key(spark, number, entity, kind, partner, expected):
    schema = "c string, n string, k string, e string, p string, d string"
    key = invoice.global_invoice_key(*[F.col(x) for x in "cnkepd"])
    assert column(spark, [("cmp", "inv", kind, entity, partner, number)], schema, key) == [(expected,)]


def test_small_texts(spark):
    rows = [("SCancel", "F-", "1", "MAIN"), ("SINV", None, None, "KOREA")]
    got = column(
        spark, rows, "code string, prefix string, number string, cmpcode string",
        invoice.cancellation_key(F.col("code"), F.col("prefix"), F.col("number")),
        invoice.site_display(F.col("cmpcode")),
        invoice.company_display(),
    )
    assert got == [("SCancelc", "HORSHAMN", "MAIN"), ("", "KOREA", "SOUTH KOREA")]


def test_day_cuts_time(spark):
    got = column(spark, [("2024-07-23 13:00:00",), ("2024-07-23",)], "t string", columns.day(F.col("t")))
    assert got == [(date(2024, 7, 23),)] * 2


def test_correction_of_one_field(make_tables):
    key = {"cmpcode": "BAS", "doccode": "SINV", "docnum": "7"}
    t = make_tables(
        dochead=[{**key, "docdate": date(2020, 1, 1), "cdc_operation_type": "I"}],
        docline=[{**key, "statpay": 84, "el2": "0211", "el3": "D1", "ref5": "PT1234-99"}],
        ref_correction=[{"Instance": "BAS", "DocCode": "SINV", "Title": "7",
                         "Field": "ServiceDeliverySite", "FieldValue": "PT9"}],
    )
    names = ("New_ServiceDeliverySite", "New_ServiceDeliverySiteInvoiceNumber", "_InvoiceSite_DeliverySite")
    assert ar_corrections(t).select(*names).collect() == [("PT9", "PT9", "BASPT9")]
    assert ar_corrections(t, by_field=True).select(*names).collect() == [("PT9", "99", "BASPT9")]


def test_keys_and_classes_of_other_companies(spark):
    keys = KeyConfig(
        company_display={"NORTH": "North Co"}, cancel_mark="void", corrected_suffix="-Z", unknown="?",
        own_warehouse_key="NORTHHUB", own_warehouse_prefix="HUB-", site_display_pattern=(" Co", ""),
    )
    rows = [("NORTH", "SVOID", "7", "IX", "a", "p", "n1"), ("NORTH", "S", "7", "IX", "NORTHHUB", "p", "n2"), ("SOUTH", "S", "7", "IX", "a", "p", "n3-Z")]
    got = column(
        spark, rows, "cmpcode string, doccode string, number string, kind string, entity string, partner string, delivery string",
        invoice.site_display(invoice.company_display(cfg=keys), keys),
        invoice.cancellation_key(F.col("doccode"), F.lit("pre-"), F.col("number"), keys),
        invoice.global_invoice_key(
            F.col("cmpcode"), F.col("number"), F.col("kind"), F.col("entity"), F.col("partner"), F.col("delivery"), keys),
    )
    assert got == [("North", "SVOIDc", "P-n1"), ("North", "pre-7", "HUB-n2"), ("SOUTH", "pre-7", "SOUTH-7")]
    cfg = ClassifyConfig(by_initial=("NORTH",), by_customer=("SOUTH",), marks=("Q",), company="WEST", keys=("SOUTHx",))
    flags = column(
        spark, [("NORTH", "Q1"), ("SOUTH", "x"), ("SOUTH", "y"), ("BAS", "ICOM1")], "cmpcode string, el3 string",
        invoice.pass_through_flag(cfg=cfg).alias("f"),
    )
    assert [flag for flag, in flags] == ["Q", "SOUTHx", "SOUTHy", "Other"]
    classes = column(spark, flags, "Pass_Through_Flag string", invoice.pass_through_class(cfg=cfg))
    assert [kind for kind, in classes] == ["PT", "PT", *["Not classified as PT"] * 2]
