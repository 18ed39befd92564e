"""Receivables mart with manual corrections of site and invoice number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.config import INVOICE_FIELD, SITE_FIELD, ReceivablesConfig
from ledgerloom.functions.columns import none_contained
from ledgerloom.plans.ar_mart import REIMBURSED, ar_mart
from ledgerloom.sources.tables import DocumentTables

SITE_KEY = "InterimKey_SVCDVSite"
INVOICE_KEY = "InterimKey_SVCDVSiteIN"


def with_correction_keys(mart: DataFrame) -> DataFrame:
    """``company-code-number-field`` for the two fields that can be corrected."""
    parts = [F.col("cmpcode"), F.col("doccode"), F.trim("InvoiceNumber")]
    return mart.withColumns({
        SITE_KEY: F.concat_ws("-", *parts, F.lit(SITE_FIELD)),
        INVOICE_KEY: F.concat_ws("-", *parts, F.lit(INVOICE_FIELD)),
    })


def correction_lookup(ref_correction: DataFrame) -> DataFrame:
    return ref_correction.select(
        F.concat_ws("-", "Instance", "DocCode", "Title", "Field").alias("InterimKey"), "FieldValue"
    )


def _stem(key: Column, field: str) -> Column:
    """The part of a key before its field; NULL where that is all the key holds.

    A document without company, code and number has keys that are bare field
    names, since joining texts leaves NULLs out.
    """
    end = f"-{field}"
    cut = F.left(key, F.length(key) - F.lit(len(end)))
    return F.when(key.endswith(end), cut)


def with_corrections(keyed: DataFrame, corrections: DataFrame) -> DataFrame:
    """Left join to the corrections that match either key of a row.

    The two keys of a row differ only in the field name at their end.  A
    correction key with that ending cut off therefore equals the common part of
    both, and "either key matches" is one equality.  ``corrections`` holds each
    (key, value) once, so distinct rows stay distinct.
    """
    fields = (SITE_FIELD, INVOICE_FIELD)
    key = F.col("InterimKey")
    # A bare field name has a stem of its own that no text can be.
    bare = F.when(key.isin(*fields), F.lit("\0"))
    stem = F.coalesce(*[_stem(key, field) for field in fields], bare)
    lookup = corrections.distinct().withColumn("__stem", stem).filter("__stem is not null")
    own = F.coalesce(_stem(F.col(SITE_KEY), SITE_FIELD), F.lit("\0"))
    joined = keyed.withColumn("__own_stem", own)
    return joined.join(lookup, F.col("__own_stem") == F.col("__stem"), "left").drop(
        "__own_stem", "__stem"
    )


def ar_corrections(
    tables: DocumentTables,
    cfg: ReceivablesConfig = ReceivablesConfig(),
    by_field: bool = False,
    drop_cdc_deletes: bool = False,
) -> DataFrame:
    """Apply corrections.

    As the source data has it, one correction fills both corrected columns,
    whichever key it matched.  ``by_field=True`` lets a correction change only
    the field it names.
    """
    mart = ar_mart(tables, cfg, drop_cdc_deletes=drop_cdc_deletes, drop_reimbursed=False)
    joined = with_corrections(with_correction_keys(mart), correction_lookup(tables.ref_correction))
    value = F.col("FieldValue")
    number_fix, site_fix = value, value
    if by_field:
        number_fix = F.when(F.col("InterimKey") == F.col(INVOICE_KEY), value)
        site_fix = F.when(F.col("InterimKey") == F.col(SITE_KEY), value)
    number = F.col("ServiceDeliverySiteInvoiceNumber")
    fallback = F.when(number == "", F.col("InvoiceNumber")).otherwise(number)
    corrected = joined.withColumns({
        "Corrected_Originating_Invoice": number_fix,
        "Corrected_OriginatingSite": site_fix,
    }).withColumns({
        "New_ServiceDeliverySite": F.coalesce("Corrected_OriginatingSite", "ServiceDeliverySite"),
        "New_ServiceDeliverySiteInvoiceNumber": F.coalesce(
            F.col("Corrected_Originating_Invoice"), fallback
        ),
    })
    site = F.concat("cmpcode", "New_ServiceDeliverySite")
    return corrected.withColumn("_InvoiceSite_DeliverySite", site).filter(
        none_contained(F.col("New_ServiceDeliverySiteInvoiceNumber"), **REIMBURSED)
    )
