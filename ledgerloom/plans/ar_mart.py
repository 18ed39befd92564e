"""Receivables mart: one distinct row per document, payment status and attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.config import CDC_DELETE, ReceivablesConfig
from ledgerloom.functions import invoice
from ledgerloom.functions.columns import none_contained, since, summed_amount
from ledgerloom.operators.aggregates import filtered_max, sum_max
from ledgerloom.operators.keys import KEY, company_of, document_columns, document_join, with_document_key
from ledgerloom.operators.lookups import lookup_join
from ledgerloom.operators.scope import listed
from ledgerloom.sources.tables import DocumentTables

# Texts that mark an invoice as no receivable of its own.
REIMBURSED = {"upper": ("REIMB",), "lower": ("olidated",)}
CUSTOMER_LEVEL = 3


def receivable_totals(docline: DataFrame, cfg: ReceivablesConfig = ReceivablesConfig()) -> DataFrame:
    """Scaled sums and attribute maxima of the receivable lines, per document and status.

    The mart is made distinct over all columns, sums included.  They are summed
    exactly: a lost task that is repeated must send its rows where they went before.
    """
    exact = cfg.exact_amounts
    lines = docline.filter(F.col("el2").startswith(cfg.account_prefix))
    return sum_max(
        lines,
        [*document_columns(docline), "statpay"],
        {
            "valuedoc": summed_amount("valuedoc", "valuedoc_dp", "zero", exact),
            "valuehome": summed_amount("valuehome", "valuehome_dp", "zero", exact),
        },
        ["el2", "el3", "ref1", "ref2", "ref3", "ref4", "ref5"],
    )


def job_attributes(docline: DataFrame, cfg: ReceivablesConfig = ReceivablesConfig()) -> DataFrame:
    """Largest non-empty job element of the other lines, per document."""
    other = ~F.col("el2").startswith(cfg.account_prefix) & (F.col("el4") != "")
    return filtered_max(docline, other, document_columns(docline), "el4")


def document_heads(
    dochead: DataFrame, cfg: ReceivablesConfig, drop_cdc_deletes: bool, companies: DataFrame | None = None
) -> DataFrame:
    """Headers in scope, each once.  Copies of a header add nothing to a distinct result."""
    code = F.col("doccode")
    dochead = listed(dochead, companies, F.col("cmpcode"))
    heads = since(dochead, "docdate", cfg.first_day).filter(
        F.col("cmpcode").isin(*cfg.companies) & ~code.isin(*cfg.excluded_codes)
    )
    if drop_cdc_deletes:
        heads = heads.filter(F.col("cdc_operation_type") != CDC_DELETE)
    return (
        with_document_key(heads)
        .select(
            *KEY, "cmpcode", "doccode", F.ltrim("docnum").alias("docnum"), "docdate",
            invoice.carrier(cfg),
        )
        .distinct()
    )


def documents(
    tables: DocumentTables, cfg: ReceivablesConfig, drop_cdc_deletes: bool, companies: DataFrame | None = None
) -> DataFrame:
    """Headers with their receivable totals and job element.

    Both line aggregates shrink the line table before it meets the headers, and
    all three frames are joined on the same key columns.  Each is aggregated on the
    stored key parts before it is joined on the trimmed ones: two exchanges each, or
    none where the tables are stored by document.
    """
    lines = listed(tables.docline, companies, company_of(tables.docline), trimmed=True)
    in_scope = lines.filter(company_of(lines).isin(*cfg.companies))
    unpaid = in_scope.filter(F.col("statpay") != cfg.paid_status)
    totals = with_document_key(receivable_totals(unpaid, cfg)).select(
        *KEY, F.col("cmpcode").alias("line_company"), "statpay", "valuedoc", "valuehome",
        "el3", "ref1", "ref2", "ref3", "ref4", "ref5",
    )
    jobs = with_document_key(job_attributes(in_scope, cfg)).select(*KEY, "el4")
    heads = document_heads(tables.dochead, cfg, drop_cdc_deletes, companies)
    joined = document_join(document_join(heads, totals), jobs, "left")
    return joined.withColumn(invoice.CARRIED, invoice.carried(cfg))


def customer_names(el3_element: DataFrame) -> DataFrame:
    return (
        el3_element.filter(F.col("el3_elmlevel") == CUSTOMER_LEVEL)
        .select("el3_cmpcode", "el3_code", "el3_name")
        .distinct()
    )


def ar_mart(
    tables: DocumentTables,
    cfg: ReceivablesConfig = ReceivablesConfig(),
    drop_cdc_deletes: bool = True,
    drop_reimbursed: bool = True,
    unique_lookups: bool = False,
    companies: DataFrame | None = None,
) -> DataFrame:
    """The full mart; with ``companies`` only for those in its first column.

    The company table is not joined: as a left join without columns it cannot
    change a distinct result.
    """
    named = lookup_join(
        documents(tables, cfg, drop_cdc_deletes, companies),
        customer_names(tables.el3_element),
        {"line_company": "el3_cmpcode", "el3": "el3_code"},
        spread_by=KEY,
        unique=unique_lookups,
    )
    sited = named.withColumns({
        "SiteID": invoice.site_id(site_ids=cfg.site_ids),
        "ServiceDeliverySite": invoice.delivery_site(cfg),
        "ServiceDeliverySiteInvoiceNumber": invoice.delivery_site_invoice_number(cfg),
    })
    if drop_reimbursed:
        sited = sited.filter(none_contained(F.col("ServiceDeliverySiteInvoiceNumber"), **REIMBURSED))
    # The names of the mart's columns.
    return sited.select(
        "SiteID",
        "cmpcode",
        "doccode",
        F.col("docdate").alias("InvoiceDate"),
        invoice.receivable_invoice_number(cfg).alias("InvoiceNumber"),
        invoice.document_type().alias("DocType"),
        "ServiceDeliverySite",
        "ServiceDeliverySiteInvoiceNumber",
        invoice.invoice_type(cfg).alias("InvoiceType"),
        F.upper(F.concat("cmpcode", "ServiceDeliverySite")).alias("ICEntityMapKey"),
        invoice.client_id_key(F.col("SiteID"), F.col("el3")).alias("_keyClientID"),
        F.col("el3").alias("CustomerNumber"),
        F.col("el3_name").alias("CustomerName"),
        invoice.purchase_order(cfg).alias("PO"),
        invoice.protocol(cfg).alias("Protocol"),
        invoice.job_number(cfg).alias("JobNumber"),
        "statpay",
        "valuehome",
        "valuedoc",
    ).distinct()
