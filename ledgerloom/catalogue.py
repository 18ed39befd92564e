"""Named queries over the test tables: every plan, and every operator by itself."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom import schemas
from ledgerloom.config import ReceivablesConfig
from ledgerloom.functions import invoice
from ledgerloom.functions.columns import scaled_amount
from ledgerloom.operators import aggregates, duplicates
from ledgerloom.operators.either_key import either_key_left_join
from ledgerloom.operators.keys import document_join, with_document_key
from ledgerloom.operators.lookups import lookup_join
from ledgerloom.plans import ar_corrections as corrections
from ledgerloom.plans import ar_keys as keys
from ledgerloom.plans import ar_mart as ar
from ledgerloom.plans import client_keys as clients
from ledgerloom.plans import revenue_mart as revenue
from ledgerloom.plans.revenue_classify import revenue_classify
from ledgerloom.sources import by_document, sinks, tables, testdata
from ledgerloom.sources.tables import DocumentTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CFG = ReceivablesConfig()


def _query(build: Callable[[DocumentTables], DataFrame]) -> Callable[[DocumentTables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(testdata.load(spark, sf_dir))
    return build


def _cents(df: DataFrame) -> DataFrame:
    """Round amounts, whose last bits depend on the order of addition."""
    return df.withColumns({
        name: F.round(name, 2) for name in ("valuehome", "valuedoc") if name in df.columns
    })


def _through(spark: SparkSession, name: str, write_and_read: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of a table written to the shared scratch folder, which is then removed.

    They are checkpointed, as a frame that is used later cannot hold on to the folder.
    """
    path = sinks.scratch_path(spark, name)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(sinks.scratch_path(spark, "rows"))
    try:
        return write_and_read(path).checkpoint()
    finally:
        sinks.remove(spark, path)


# scans and single operators ------------------------------------------------

@_query
def document_lines(t):
    return t.docline


@_query
def document_heads(t):
    return t.dochead


@_query
def line_aggregate_scaled_zero(t):
    return _cents(ar.receivable_totals(t.docline))


@_query
def line_scaled_raw(t):
    amounts = [
        F.sum(scaled_amount(name, f"{name}_dp", "raw")).alias(name) for name in ("valuehome", "valuedoc")
    ]
    return _cents(t.docline.groupBy("cmpcode", "doccode", "el2", "el3").agg(*amounts))


@_query
def doc_attr_max(t):
    return ar.job_attributes(t.docline)


@_query
def site_map(t):
    return t.dochead.groupBy("cmpcode").agg(F.count("*").alias("documents")).withColumn(
        "SiteID", invoice.site_id()
    )


@_query
def doc_type(t):
    return t.dochead.groupBy("doccode").agg(F.count("*").alias("documents")).withColumn(
        "DocType", invoice.document_type()
    )


@_query
def delivery_site(t):
    documents = ar.documents(t, CFG, drop_cdc_deletes=False).select(
        "cmpcode",
        "doccode",
        "docnum",
        "statpay",
        invoice.delivery_site(CFG).alias("ServiceDeliverySite"),
        invoice.delivery_site_invoice_number(CFG).alias("ServiceDeliverySiteInvoiceNumber"),
    )
    return documents.distinct().withColumn(
        "ICEntityMapKey", F.upper(F.concat("cmpcode", "ServiceDeliverySite"))
    ).groupBy(
        "cmpcode", "ServiceDeliverySite", "ICEntityMapKey", "ServiceDeliverySiteInvoiceNumber"
    ).agg(F.count("*").alias("documents"))


@_query
def invoice_type(t):
    documents = ar.documents(t, CFG, drop_cdc_deletes=False).select(
        "cmpcode", "doccode", "docnum", "statpay", invoice.invoice_type(CFG).alias("InvoiceType")
    )
    return documents.distinct().groupBy("cmpcode", "InvoiceType").agg(
        F.count("*").alias("documents")
    )


@_query
def trimmed_key_left_join(t):
    heads = with_document_key(t.dochead).select(
        "key_company", "key_code", "key_number", "cmpcode", "doccode",
        F.ltrim("docnum").alias("docnum"), "docdate",
    )
    totals = with_document_key(ar.receivable_totals(t.docline)).select(
        "key_company", "key_code", "key_number", "statpay", "el3", "valuehome"
    )
    joined = document_join(heads, totals, "left")
    return _cents(joined.drop("key_company", "key_code", "key_number"))


@_query
def trimmed_key_inner_join(t):
    heads = with_document_key(t.dochead)
    lines = with_document_key(t.docline).select(
        "key_company", "key_code", "key_number", "el2", "valuedoc"
    )
    return document_join(lines, heads).groupBy("cmpcode", "doccode", "docdate", "curdoc", "el2").agg(
        F.count("*").alias("lines"), F.sum("valuedoc").alias("raw_value")
    )


@_query
def lookup_with_level(t):
    grouped = t.docline.groupBy("cmpcode", "el3").agg(F.count("*").alias("lines"))
    names = t.el3_element.filter("el3_elmlevel = 3").drop("el3_elmlevel")
    named = lookup_join(grouped, names, {"cmpcode": "el3_cmpcode", "el3": "el3_code"})
    return named.groupBy("cmpcode", "el3", "el3_name").agg(F.sum("lines").alias("lines"))


@_query
def lookup_inner_level(t):
    grouped = t.docline.groupBy("cmpcode", "el2").agg(F.count("*").alias("lines"))
    accounts = t.el2_element.filter("el2_elmlevel = 2").drop("el2_elmlevel")
    named = lookup_join(
        grouped, accounts, {"cmpcode": "el2_cmpcode", "el2": "el2_code"}, how="inner"
    )
    priced = lookup_join(named, t.company, {"cmpcode": "code"}, how="inner")
    return priced.groupBy("cmpcode", "el2", "el2_name", "homecur").agg(F.sum("lines").alias("lines"))


# receivables ----------------------------------------------------------------

@_query
def ar_mart_core(t):
    documents = ar.documents(t, CFG, drop_cdc_deletes=True)
    core = documents.select(
        invoice.site_id().alias("SiteID"),
        "cmpcode",
        "doccode",
        F.col("docdate").alias("InvoiceDate"),
        invoice.receivable_invoice_number(CFG).alias("InvoiceNumber"),
        invoice.document_type().alias("DocType"),
        "statpay",
        "valuehome",
        "valuedoc",
    )
    return _cents(core.distinct())


@_query
def ar_mart(t):
    return _cents(ar.ar_mart(t))


@_query
def correction_keys(t):
    mart = ar.ar_mart(t, drop_cdc_deletes=False, drop_reimbursed=False)
    return _cents(corrections.with_correction_keys(mart))


@_query
def either_key_join(t):
    mart = ar.ar_mart(t, drop_cdc_deletes=False, drop_reimbursed=False)
    joined = either_key_left_join(
        corrections.with_correction_keys(mart),
        corrections.correction_lookup(t.ref_correction),
        corrections.SITE_KEY,
        corrections.INVOICE_KEY,
        "InterimKey",
    )
    return joined.select(
        "cmpcode", "doccode", "InvoiceNumber", "statpay", "PO", "InterimKey", "FieldValue"
    )


@_query
def ar_corrections(t):
    return _cents(corrections.ar_corrections(t))


@_query
def ar_keys(t):
    return _cents(keys.ar_keys(t))


# revenue --------------------------------------------------------------------

@_query
def ar_lines(t):
    return revenue.customer_lines(t)


@_query
def ar_lines_dedup(t):
    return revenue.customer_lines(t, dedup=True, drop_cdc_deletes=False).drop("ar_copies")


@_query
def revenue_base(t):
    heads = with_document_key(t.dochead).select(
        "key_company", "key_code", "key_number",
        F.col("cmpcode").alias("head_company"),
        F.ltrim("docnum").alias("head_number"),
        "docdate", "curdoc",
    )
    return revenue.with_line_fields(t.docline, heads, revenue.RevenueConfig()).select(
        "cmpcode", "doccode", "docnum", "statpay", "el2", "el3", "el4", "docdate", "curdoc",
        "global_identifier", "invoice_number", "po_value", "protocol_value",
    )


@_query
def revenue_filter(t):
    return revenue.revenue_lines(t.docline).select(
        "cmpcode", "doccode", "docnum", "el2", "el3", "el4", "ref2"
    )


@_query
def job_default_min_by(t):
    return revenue.job_defaults(t, "ignore")


@_query
def job_default_row_number(t):
    return revenue.job_defaults(t, "first")


@_query
def job_default_reduced(t):
    return revenue.job_defaults(t, "ignore", reduced=True)


@_query
def revenue_mart_reduced(t):
    return _cents(revenue.revenue_mart(t, reduce_history=True))


@_query
def revenue_mart_dealt(t):
    return _cents(revenue.revenue_mart(t, deal_hot_documents=True))


def _revenue_b(t: DocumentTables) -> DataFrame:
    return revenue.revenue_mart(
        t, dedup_ar_lines=True, drop_cdc_deletes=False, default_nulls="first"
    )


@_query
def revenue_mart_a(t):
    return _cents(revenue.revenue_mart(t))


@_query
def revenue_mart_b(t):
    return _cents(_revenue_b(t))


QUERIES["revenue_classify"] = lambda spark, sf_dir: (
    lambda t: revenue_classify(_cents(revenue.revenue_mart(t)), t)
)(testdata.load(spark, sf_dir))


# clients --------------------------------------------------------------------

@_query
def client_keys(t):
    return clients.client_keys(t)


@_query
def client_keys_dominant(t):
    return clients.client_keys(t, dominant_only=True)


@_query
def parent_counts(t):
    return clients.parent_counts(t)


@_query
def ranked_parents(t):
    return clients.ranked_parents(t)


@_query
def dominant_parent(t):
    return clients.ranked_parents(t).filter("parent_row_rank = 1").drop("parent_row_rank")


# duplicate keys ---------------------------------------------------------------

def keyed_invoices(t: DocumentTables) -> DataFrame:
    """Keyed receivables in which carried invoices have the type that is re-keyed."""
    kind = F.col("AR_Invoice_Type")
    return _cents(keys.ar_keys(t)).withColumn(
        "AR_Invoice_Type", F.when(kind == "3PD-PT", duplicates.REKEY_TYPE).otherwise(kind)
    )


@_query
def dup_flag(t):
    return duplicates.flag_duplicates(keyed_invoices(t))


@_query
def rekey_duplicates(t):
    return duplicates.rekey_duplicates(keyed_invoices(t))


@_query
def rekey_as_written(t):
    return duplicates.rekey_duplicates(_cents(keys.ar_keys(t)))


@_query
def duplicate_report(t):
    rekeyed = duplicates.rekey_duplicates(keyed_invoices(t))
    return aggregates.duplicate_report(rekeyed, [duplicates.NEW_KEY])


@_query
def full_row_duplicates(t):
    """Of the keyed invoices as a stored table, which is what is reported on."""
    keyed = _cents(keys.ar_keys(t))

    def report(path: str) -> DataFrame:
        sinks.overwrite(keyed, path)
        return aggregates.full_row_duplicates(sinks.read_back(keyed.sparkSession, path))

    return _through(keyed.sparkSession, "ar_keys", report)


# tables stored by document --------------------------------------------------------

def _by_document(t: DocumentTables, build: Callable[[DocumentTables], DataFrame]) -> DataFrame:
    """``build`` on lines and headers that were stored by document; its rows are checkpointed and the tables removed."""
    spark = t.docline.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = {name: sinks.scratch_path(spark, name) for name in ("docline", "dochead")}
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(sinks.scratch_path(spark, "rows"))
    try:
        for name, path in paths.items():
            by_document.store_by_document(getattr(t, name), path, buckets)
        by_document.require_alike(spark, *paths.values())
        opened = {name: by_document.open_by_document(spark, path) for name, path in paths.items()}
        others = {name: partial(getattr, t, name) for name in schemas.ALL if name not in paths}
        return build(DocumentTables(**opened, **others)).checkpoint()
    finally:
        for path in paths.values():
            by_document.forget(spark, path)


@_query
def ar_mart_by_document(t):
    return _by_document(t, lambda stored: _cents(ar.ar_mart(stored)))


@_query
def revenue_mart_by_document(t):
    return _by_document(t, lambda stored: _cents(revenue.revenue_mart(stored)))


@_query
def ar_mart_listed(t):
    """Tables partitioned by company, cut to the companies of one home currency when the plan runs."""
    spark = t.docline.sparkSession
    listed = t.company.filter(F.col("homecur") == "USD").select("code")

    def mart(path: str) -> DataFrame:
        parts = {name: f"{path}/{name}" for name in ("docline", "dochead")}
        for name, part in parts.items():
            sinks.overwrite(getattr(t, name), part, partition_by=("cmpcode",), rebalance=True)
        opened = {name: partial(tables.read_table, spark, part) for name, part in parts.items()}
        others = {name: partial(getattr, t, name) for name in schemas.ALL if name not in parts}
        return _cents(ar.ar_mart(DocumentTables(**opened, **others), companies=listed))

    return _through(spark, "by_company", mart)


# sources and sinks --------------------------------------------------------------

@_query
def lookup_csv(t):
    spark = t.category.sparkSession

    def csv(path: str) -> DataFrame:
        tables.write_csv(t.category, path)
        return tables.read_csv(spark, path, schemas.CATEGORY)

    return _through(spark, "category", csv)


@_query
def sink_roundtrip(t):
    mart = _cents(ar.ar_mart(t))

    def table(path: str) -> DataFrame:
        sinks.overwrite(mart, path)
        return sinks.read_back(mart.sparkSession, path)

    return _through(mart.sparkSession, "ar_mart", table)


@_query
def sink_checked(t):
    """The mart written with a check of its content, twice: the second time from the table that it replaces."""
    mart = _cents(ar.ar_mart(t))

    def table(path: str) -> DataFrame:
        first = sinks.overwrite_checked(mart, path)
        again = sinks.overwrite_checked(sinks.read_back(mart.sparkSession, path), path)
        if again != first:
            raise sinks.ContentMismatch(f"{again} after {first}")
        return sinks.read_back(mart.sparkSession, path)

    return _through(mart.sparkSession, "ar_mart_checked", table)


@_query
def sink_schema_evolution(t):
    mart = _cents(ar.ar_mart(t))

    def table(path: str) -> DataFrame:
        sinks.overwrite(mart.withColumn("RetiredColumn", F.lit("old")), path)
        sinks.overwrite(mart, path, evolve_schema=True)
        return sinks.read_back(mart.sparkSession, path)

    return _through(mart.sparkSession, "ar_mart_evolved", table)


@_query
def sanitize_columns(t):
    return sinks.sanitize_columns(_cents(keys.ar_keys(t)))


@_query
def row_count(t):
    return ar.ar_mart(t).agg(F.count("*").alias("mart_rows"))
