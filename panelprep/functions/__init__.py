from panelprep.functions.codes import (
    CODE_FAMILIES, code_family, hierarchy_key, hk_default, hk_key, to_raw_code,
)
from panelprep.functions.dates import date_between
from panelprep.functions.text import (
    doc_id, doc_url, key_value, literal_type, meta_map, normalize_ws, slug, split_lines, strip,
)

__all__ = [
    "CODE_FAMILIES", "code_family", "date_between", "doc_id", "doc_url", "hierarchy_key", "hk_default",
    "hk_key", "key_value", "literal_type", "meta_map", "normalize_ws", "slug", "split_lines",
    "strip", "to_raw_code",
]
