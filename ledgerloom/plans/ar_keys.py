"""Reconciliation keys on corrected receivables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.config import KeyConfig, ReceivablesConfig
from ledgerloom.functions import invoice
from ledgerloom.functions.columns import joined_text
from ledgerloom.operators.lookups import lookup_join
from ledgerloom.plans.ar_corrections import ar_corrections
from ledgerloom.sources.tables import DocumentTables


def with_partners(
    corrected: DataFrame, tables: DocumentTables, unique_lookups: bool = False
) -> DataFrame:
    """Entity and intercompany partner of each invoice that has a number."""
    numbered = corrected.filter(F.col("InvoiceNumber") != "")
    entities = tables.map_entity.select("CODA", "gpm_site", "cForia")
    partners = tables.map_ic_entity.select(
        F.col("InvoiceCmp-OriginatingIC").alias("site"),
        F.col("IC_Partner-OMNI").alias("IC_Partner_OMNI"),
        F.col("IC_Partner-CODA").alias("own_partner"),
    )
    spread_by = ("InvoiceNumber", "doccode", "InvoiceDate", "PO")
    sited = lookup_join(
        numbered, entities, {"cmpcode": "CODA"}, spread_by=spread_by, unique=unique_lookups
    )
    return lookup_join(
        sited,
        partners,
        {"_InvoiceSite_DeliverySite": "site"},
        spread_by=spread_by,
        unique=unique_lookups,
    )


def reconciliation_keys(matched: DataFrame, cfg: KeyConfig = KeyConfig()) -> DataFrame:
    """Derive the keys and give the columns their reporting names."""
    ready = matched.withColumns({
        "company_display": invoice.company_display(cfg=cfg),
        "partner": F.coalesce("own_partner", F.lit(cfg.unknown)),
    })
    number = F.col("InvoiceNumber")
    delivery_number = F.col("ServiceDeliverySiteInvoiceNumber")
    global_key = invoice.global_invoice_key(
        F.col("company_display"), number, F.col("InvoiceType"), F.col("ICEntityMapKey"),
        F.col("partner"), delivery_number, cfg,
    )
    # The names of the reporting columns.
    return ready.select(
        "SiteID",
        invoice.site_display(F.col("company_display"), cfg).alias("AR Billing Site"),
        "doccode",
        F.col("InvoiceDate").alias("Invoice_Date"),
        number.alias("AR_Invoice_Number"),
        F.col("DocType").alias("AR_Doc_Type"),
        F.col("InvoiceType").alias("AR_Invoice_Type"),
        "ICEntityMapKey",
        "_keyClientID",
        F.col("CustomerNumber").alias("AR_Customer_Number"),
        F.col("CustomerName").alias("AR_Customer_Name"),
        F.col("PO").alias("AR_PO"),
        F.col("Protocol").alias("AR_Protocol"),
        F.col("JobNumber").alias("AR_Job_Number"),
        F.col("statpay").alias("Stat_Pay"),
        "valuehome",
        "valuedoc",
        invoice.site_display(F.col("ServiceDeliverySite"), cfg).alias("AR Originating Site"),
        delivery_number.alias("AR_Originating_Invoice"),
        "_InvoiceSite_DeliverySite",
        "gpm_site",
        "cForia",
        "IC_Partner_OMNI",
        F.col("partner").alias("IC_Partner_CODA"),
        invoice.cancellation_key(F.col("doccode"), F.col("cForia"), number, cfg).alias("_keyCforia"),
        global_key.alias("_key_global_identifier"),
        joined_text(F.col("SiteID"), F.lit("-"), number).alias("_key_AR_CODA"),
    )


def ar_keys(
    tables: DocumentTables,
    cfg: ReceivablesConfig = ReceivablesConfig(),
    by_field: bool = False,
    unique_lookups: bool = False,
    keys: KeyConfig = KeyConfig(),
) -> DataFrame:
    """Corrected receivables with reconciliation keys.

    Rows that differed only in dropped correction columns stay as copies;
    ``distinct()`` the result where each row should appear once.
    """
    corrected = ar_corrections(tables, cfg, by_field=by_field)
    return reconciliation_keys(with_partners(corrected, tables, unique_lookups), keys)
