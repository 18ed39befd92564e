"""Derived invoice fields.

Receivables fields expect the flat columns ``cmpcode doccode docnum docdate el3
el4 ref1 .. ref5`` of a document, some of them also ``carrier`` and ``carried``.
Revenue fields expect a line with ``docdate``,
``head_company`` and ``head_number`` of its header.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom import config as C
from ledgerloom.functions.columns import blank_to_null, joined_text
from ledgerloom.functions.rules import (
    any_of, by_source, carrier_index, code_map, first_match, literal, per_carrier, starts, tail,
)

_UNKNOWN = literal(C.UNKNOWN)


def site_id(company: str = "cmpcode", site_ids: dict[str, str] = C.SITE_IDS) -> Column:
    return F.expr(code_map(company, site_ids, _UNKNOWN))


def document_type(code: str = "doccode") -> Column:
    credit = f"contains({code}, {literal(C.CREDIT_NOTE_MARK)})"
    return F.expr(first_match([(credit, "'Credit Note'")], "'Invoice'"))


def receivable_invoice_number(cfg: C.ReceivablesConfig) -> Column:
    return F.expr(by_source(cfg.invoice_number, "cmpcode", "ltrim(docnum)"))


CARRIER, CARRIED = "carrier", "carried"


def carrier(cfg: C.ReceivablesConfig) -> Column:
    """Position of the company's carrier rule.

    Headers get this column before they are made distinct, so that it is a
    stored value when the fields below are derived, filtered on and generated.
    """
    return F.expr(carrier_index(cfg.carriers, "cmpcode")).alias(CARRIER)


def carried(cfg: C.ReceivablesConfig) -> Column:
    """Whether the marker says that another site delivered; NULL when unknown."""
    marked = per_carrier(cfg.carriers, CARRIER, lambda rule: starts(rule.marker, rule.prefix))
    return F.expr(marked)


def delivery_site(cfg: C.ReceivablesConfig) -> Column:
    def site(rule: C.CarrierRule) -> str:
        return rule.marker if rule.site_length is None else f"left({rule.marker}, {rule.site_length})"

    branches = [(CARRIED, per_carrier(cfg.carriers, CARRIER, site)), (f"NOT {CARRIED}", "cmpcode")]
    return F.expr(f"upper({first_match(branches, _UNKNOWN)})")


def delivery_site_invoice_number(cfg: C.ReceivablesConfig) -> Column:
    def own(rule: C.CarrierRule) -> str:
        return "ltrim(docnum)" if rule.own_source == "docnum" else rule.own_source

    def other(rule: C.CarrierRule) -> str:
        return tail(rule.carried_source, rule.carried_start)

    branches = [
        (CARRIED, per_carrier(cfg.carriers, CARRIER, other)),
        (f"NOT {CARRIED}", per_carrier(cfg.carriers, CARRIER, own)),
    ]
    return F.expr(first_match(branches, _UNKNOWN))


def invoice_type(cfg: C.ReceivablesConfig) -> Column:
    intercompany = per_carrier(
        cfg.carriers, CARRIER, lambda rule: starts("el3", rule.intercompany_prefix)
    )
    return F.expr(first_match([(intercompany, "'IC'"), (CARRIED, "'3PD-PT'")], "'3PD-OWN'"))


def purchase_order(cfg: C.ReceivablesConfig) -> Column:
    return F.expr(by_source(cfg.purchase_order, "cmpcode", "ref4"))


def protocol(cfg: C.ReceivablesConfig) -> Column:
    return F.expr(by_source(cfg.protocol, "cmpcode", "ref2"))


def job_number(cfg: C.ReceivablesConfig) -> Column:
    carried = f"cmpcode = {literal(cfg.job_from_ref3)} AND {CARRIED}"
    return F.expr(first_match([(carried, "ref3")], "coalesce(el4, '')"))


def client_id_key(site: Column, customer: Column) -> Column:
    return F.concat(site, F.lit("-"), customer)


# revenue ------------------------------------------------------------------

def revenue_global_identifier(cfg: C.RevenueConfig) -> Column:
    number = by_source(cfg.global_identifier, "cmpcode", "ltrim(docnum)")
    return F.expr(f"concat(upper(cmpcode), '-', {number})")


def revenue_invoice_number(cfg: C.RevenueConfig) -> Column:
    return F.expr(by_source(cfg.invoice_number, "head_company", _UNKNOWN))


def revenue_purchase_order(cfg: C.RevenueConfig) -> Column:
    return F.expr(by_source(cfg.purchase_order, "head_company", "ref4"))


def revenue_protocol(cfg: C.RevenueConfig) -> Column:
    return F.expr(by_source(cfg.protocol, "head_company", "ref2"))


def job_or_default(job: Column, default: Column) -> Column:
    return F.coalesce(blank_to_null(job), default)


def pass_through_flag(
    company: str = "cmpcode", customer: str = "el3", cfg: C.ClassifyConfig = C.ClassifyConfig()
) -> Column:
    return F.expr(first_match(
        [
            (f"{customer} IS NULL", "'Other'"),
            (any_of(company, cfg.by_initial), f"left({customer}, 1)"),
            (any_of(company, cfg.by_customer), f"concat({company}, {customer})"),
        ],
        "'Other'",
    ))


def pass_through_class(
    flag: str = "Pass_Through_Flag", cfg: C.ClassifyConfig = C.ClassifyConfig()
) -> Column:
    tests = [f"contains({flag}, {literal(mark)})" for mark in cfg.marks]
    tests += [starts(flag, cfg.company), any_of(flag, cfg.keys)]
    return F.expr(first_match([(" OR ".join(tests), "'PT'")], "'Not classified as PT'"))


# reconciliation keys -------------------------------------------------------

def company_display(company: str = "cmpcode", cfg: C.KeyConfig = C.KeyConfig()) -> Column:
    return F.expr(code_map(company, cfg.company_display, company))


def cancellation_key(
    code: Column, prefix: Column, number: Column, cfg: C.KeyConfig = C.KeyConfig()
) -> Column:
    cancelled = F.lower(code).contains(cfg.cancel_mark)
    return F.when(cancelled, F.concat(code, F.lit("c"))).otherwise(joined_text(prefix, number))


def global_invoice_key(
    company: Column, number: Column, kind: Column, entity_key: Column,
    partner: Column, delivery_number: Column, cfg: C.KeyConfig = C.KeyConfig(),
) -> Column:
    own = joined_text(company, F.lit("-"), number)
    unsited = delivery_number.endswith(cfg.corrected_suffix) | (delivery_number == cfg.unknown)
    warehouse = joined_text(F.lit(cfg.own_warehouse_prefix), delivery_number)
    return (
        F.when(unsited, own)
        .when(entity_key == cfg.own_warehouse_key, warehouse)
        .when(kind == "IC", own)
        .otherwise(joined_text(F.upper(partner), F.lit("-"), delivery_number))
    )


def site_display(site: Column, cfg: C.KeyConfig = C.KeyConfig()) -> Column:
    pattern, replacement = cfg.site_display_pattern
    return F.regexp_replace(site, pattern, replacement)
