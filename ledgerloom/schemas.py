"""Declared input schemas, checked when a table is bound."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()

DOCLINE = _schema(
    cmpcode=_S, doccode=_S, docnum=_S, statpay=_I,
    valuedoc=_L, valuehome=_L, valuedoc_dp=_I, valuehome_dp=_I,
    el2=_S, el3=_S, el4=_S, ref1=_S, ref2=_S, ref3=_S, ref4=_S, ref5=_S,
)
DOCHEAD = _schema(
    cmpcode=_S, doccode=_S, docnum=_S, docdate=_D, curdoc=_S, cdc_operation_type=_S,
)
COMPANY = _schema(code=_S, homecur=_S)
EL2_ELEMENT = _schema(el2_cmpcode=_S, el2_code=_S, el2_elmlevel=_I, el2_name=_S)
EL3_ELEMENT = _schema(el3_cmpcode=_S, el3_code=_S, el3_elmlevel=_I, el3_name=_S)
CLIENT_MASTER = _schema(
    m_code=_S, client_ultimate_parent_id=_S, global_ultimate_business_name=_S,
)
CLIENT_XREF = _schema(m_code=_S, site_id=_S, c_code=_S)
REF_CORRECTION = _schema(Instance=_S, DocCode=_S, Title=_S, Field=_S, FieldValue=_S)
MAP_ENTITY = _schema(CODA=_S, gpm_site=_S, cForia=_S)
MAP_IC_ENTITY = _schema(**{
    "InvoiceCmp-OriginatingIC": _S, "IC_Partner-OMNI": _S, "IC_Partner-CODA": _S,
})
CATEGORY = _schema(**{
    "Facility|GLCode-CPQREF": _S,
    "AI Enhanced - CPQ Category": _S,
    "AI Enhanced - CPQ SubCategory": _S,
})

ALL = {
    "docline": DOCLINE,
    "dochead": DOCHEAD,
    "company": COMPANY,
    "el2_element": EL2_ELEMENT,
    "el3_element": EL3_ELEMENT,
    "client_master": CLIENT_MASTER,
    "client_xref": CLIENT_XREF,
    "ref_correction": REF_CORRECTION,
    "map_entity": MAP_ENTITY,
    "map_ic_entity": MAP_IC_ENTITY,
    "category": CATEGORY,
}
