"""Plain forms of the rewritten steps, timed side by side.

Each pair computes the same rows: once as one would first write it, once as the
plans do.  Run ``python -m benchmarks.pairs``; the environment is that of
``bench.py``.
"""

from __future__ import annotations

import json
import os
import sys
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from bench import medians
from ledgerloom import catalogue
from ledgerloom.config import ReceivablesConfig, RevenueConfig
from ledgerloom.functions import invoice
from ledgerloom.functions.columns import none_contained, scaled_amount
from ledgerloom.operators import duplicates
from ledgerloom.operators.either_key import either_key_left_join
from ledgerloom.operators.keys import RAW_KEY
from ledgerloom.plans import ar_corrections as corrections
from ledgerloom.plans import ar_keys as keys
from ledgerloom.plans import ar_mart as ar
from ledgerloom.plans import client_keys as clients
from ledgerloom.plans import revenue_mart as revenue
from ledgerloom.session import build_session
from ledgerloom.sources import testdata

CFG, REV = ReceivablesConfig(), RevenueConfig()


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in RAW_KEY})


def _same_document(left: str, right: str):
    tests = [F.trim(F.col(left + c)) == F.trim(F.col(right + c)) for c in RAW_KEY]
    return reduce(lambda a, b: a & b, tests)


def plain_documents(t) -> DataFrame:
    """Trim in every join condition, outer joins, the company table joined too."""
    totals = _named(ar.receivable_totals(t.docline, CFG), "t_")
    jobs = _named(ar.job_attributes(t.docline, CFG), "j_")
    joined = (
        t.dochead.join(totals, _same_document("", "t_"), "left")
        .join(jobs, _same_document("t_", "j_"), "left")
        .join(t.company.select("code"), F.col("t_cmpcode") == F.col("code"), "left")
    )
    scope = (
        F.col("cmpcode").isin(*CFG.companies)
        & (F.col("statpay") != CFG.paid_status)
        & (F.col("docdate") >= F.lit(CFG.first_day))
        & (F.col("cdc_operation_type") != "D")
        & ~F.col("doccode").isin(*CFG.excluded_codes)
    )
    return joined.filter(scope).select(
        "cmpcode", "doccode", F.ltrim("docnum").alias("docnum"), "docdate",
        "statpay", "valuehome", "valuedoc", "el3", "ref1", "ref2", "ref3", "ref4", "ref5", "el4",
    ).distinct()


def shaped_documents(t) -> DataFrame:
    return ar.documents(t, CFG, True).select(
        "cmpcode", "doccode", "docnum", "docdate", "statpay", "valuehome", "valuedoc",
        "el3", "ref1", "ref2", "ref3", "ref4", "ref5", "el4",
    ).distinct()


def plain_revenue(t) -> DataFrame:
    """Two row-level joins of lines and headers, paired row by row, then grouped."""
    heads = _named(t.dochead.filter(F.col("docdate") >= F.lit(REV.first_day)), "h_")
    live = heads.filter("cdc_operation_type != 'D'")
    extra = F.col("cmpcode").isin(*REV.customer_extra_companies) & (F.col("el2") == "28020")
    receivable = t.docline.filter(
        (F.col("el2").startswith("021") | extra) & (F.col("statpay") != 665)
    )
    customers = receivable.join(live, _same_document("", "h_")).select(
        *RAW_KEY, F.col("el3").alias("customer_el3")
    )
    selected = revenue.revenue_lines(t.docline, REV)
    base = selected.join(heads, _same_document("", "h_")).withColumns({
        "head_company": F.col("h_cmpcode"), "head_number": F.ltrim("h_docnum"),
    }).withColumns({
        "global_identifier": invoice.revenue_global_identifier(REV),
        "invoice_number": invoice.revenue_invoice_number(REV),
        "po_value": invoice.revenue_purchase_order(REV),
        "protocol_value": invoice.revenue_protocol(REV),
    })
    amounts = [
        F.sum(scaled_amount(name, f"{name}_dp", "raw")).alias(name) for name in ("valuehome", "valuedoc")
    ]
    return base.join(customers, list(RAW_KEY)).groupBy(*revenue.LINE_KEYS, "customer_el3").agg(*amounts)


def shaped_revenue(t) -> DataFrame:
    customers = revenue.customer_lines(t, REV)
    return revenue.revenue_groups(t, REV).join(customers, list(RAW_KEY)).withColumns({
        name: F.col(name) * F.col("ar_copies") for name in ("valuehome", "valuedoc")
    }).drop("ar_copies")


def plain_revenue_mart(t) -> DataFrame:
    """The whole mart as first written: row-level pairing, then accounts, companies, customers and default jobs."""
    names = t.el3_element.filter("el3_elmlevel = 3").select("el3_cmpcode", "el3_code", "el3_name")
    accounts = t.el2_element.filter("el2_elmlevel = 2").select("el2_cmpcode", "el2_code", "el2_name")
    defaults = plain_defaults(t).withColumnsRenamed({"cmpcode": "d_company", "el4": "default_el4"})
    joined = (
        plain_revenue(t)
        .join(names, (F.col("cmpcode") == F.col("el3_cmpcode")) & (F.col("customer_el3") == F.col("el3_code")))
        .join(accounts, (F.col("cmpcode") == F.col("el2_cmpcode")) & (F.col("el2") == F.col("el2_code")))
        .join(t.company, F.col("cmpcode") == F.col("code"))
        .join(defaults, F.col("cmpcode") == F.col("d_company"), "left")
    )
    return joined.withColumn("JobNumber", invoice.job_or_default(F.col("el4"), F.col("default_el4"))).drop(
        "el3_cmpcode", "el3_code", "el2_cmpcode", "el2_code", "code", "d_company"
    )


def plain_defaults(t) -> DataFrame:
    heads = _named(t.dochead, "h_")
    base = t.docline.filter("el4 != ''").join(heads, _same_document("", "h_"))
    order = Window.partitionBy("cmpcode").orderBy("docdate", "el4")
    return base.withColumn("rn", F.row_number().over(order)).filter("rn = 1").select("cmpcode", "el4")


def _keyed(t) -> DataFrame:
    mart = ar.ar_mart(t, drop_cdc_deletes=False, drop_reimbursed=False)
    return corrections.with_correction_keys(mart)


def plain_corrections(t) -> DataFrame:
    lookup = corrections.correction_lookup(t.ref_correction)
    key = F.col("InterimKey")
    either = (F.col(corrections.SITE_KEY) == key) | (F.col(corrections.INVOICE_KEY) == key)
    return _keyed(t).join(lookup, either, "left").distinct()


def shaped_corrections(t) -> DataFrame:
    return corrections.with_corrections(
        _keyed(t), corrections.correction_lookup(t.ref_correction)
    )


def shaped_either(t) -> DataFrame:
    """The general either-key join, which knows nothing of how the two keys are made."""
    lookup = corrections.correction_lookup(t.ref_correction)
    return either_key_left_join(_keyed(t), lookup, corrections.SITE_KEY, corrections.INVOICE_KEY, "InterimKey")


def plain_keys(t) -> DataFrame:
    """Corrections by OR, then entity and partner by plain joins."""
    joined = plain_corrections(t)
    number = F.col("ServiceDeliverySiteInvoiceNumber")
    fallback = F.when(number == "", F.col("InvoiceNumber")).otherwise(number)
    corrected = joined.withColumns({
        "New_ServiceDeliverySite": F.coalesce("FieldValue", "ServiceDeliverySite"),
        "New_ServiceDeliverySiteInvoiceNumber": F.coalesce(F.col("FieldValue"), fallback),
    }).withColumn("_InvoiceSite_DeliverySite", F.concat("cmpcode", "New_ServiceDeliverySite"))
    known = corrected.filter(none_contained(F.col("New_ServiceDeliverySiteInvoiceNumber"), **ar.REIMBURSED)).filter("InvoiceNumber != ''")
    entities = t.map_entity.select("CODA", "gpm_site", "cForia")
    partners = t.map_ic_entity.select(
        F.col("InvoiceCmp-OriginatingIC").alias("site"), F.col("IC_Partner-OMNI").alias("IC_Partner_OMNI"), F.col("IC_Partner-CODA").alias("own_partner")
    )
    matched = known.join(entities, F.col("cmpcode") == F.col("CODA"), "left").join(
        partners, F.col("_InvoiceSite_DeliverySite") == F.col("site"), "left"
    )
    return keys.reconciliation_keys(matched)


def plain_parents(t) -> DataFrame:
    joined = t.client_master.join(t.client_xref.drop("site_id"), "m_code", "left")
    group = Window.partitionBy(clients.PARENT, clients.NAME)
    rank = Window.partitionBy(clients.PARENT).orderBy(F.desc("n"))
    counted = joined.withColumn("n", F.count("c_code").over(group))
    names = counted.select(clients.PARENT, clients.NAME, "n").distinct()
    return names.withColumn("rank", F.dense_rank().over(rank))


def plain_flags(t) -> DataFrame:
    group = Window.partitionBy(duplicates.KEY)
    counted = catalogue.keyed_invoices(t).withColumn("dup_count", F.count("*").over(group))
    many = F.count("AR_Invoice_Number").over(group) > 1
    kind = F.col("AR_Invoice_Type") == duplicates.REKEY_TYPE
    return counted.withColumn("Flag", F.when((F.col("dup_count") > 1) & kind & many, "Y").otherwise("N"))


PAIRS = {
    "receivable documents": (plain_documents, shaped_documents),
    "corrections": (plain_corrections, shaped_corrections),
    "either key": (plain_corrections, shaped_either),
    "reconciliation keys": (plain_keys, keys.ar_keys),
    "revenue": (plain_revenue, shaped_revenue),
    "revenue mart": (plain_revenue_mart, revenue.revenue_mart),
    "revenue mart, history cut": (plain_revenue_mart, lambda t: revenue.revenue_mart(t, reduce_history=True)),
    "job default": (plain_defaults, lambda t: revenue.job_defaults(t, "first")),
    "parent ranks": (plain_parents, clients.ranked_parents),
    "duplicate flags": (plain_flags, lambda t: duplicates.flag_duplicates(catalogue.keyed_invoices(t))),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        "ledgerloom-pairs",
        shuffle_partitions=cpus,
        **{
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or list(PAIRS)
    for name in chosen:
        pair = PAIRS[name]
        forms = dict(zip(("plain", "shaped"), pair))
        times = medians(
            {form: lambda build=build: build(testdata.load(spark, sf_dir)) for form, build in forms.items()},
            runs,
        )
        print(json.dumps({"step": name, **times}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
