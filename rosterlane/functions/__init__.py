"""Column functions; every one is a built-in Catalyst expression."""

from rosterlane.functions.dates import export_stamp, local_date, parse_report_date, report_date
from rosterlane.functions.ids import id_as_int_text, normalize_id, to_number
from rosterlane.functions.roles import role_rank
from rosterlane.functions.text import any_of, contains_ci, is_blank, python_text, trim_ws

__all__ = [
    "any_of",
    "contains_ci",
    "export_stamp",
    "id_as_int_text",
    "is_blank",
    "local_date",
    "normalize_id",
    "parse_report_date",
    "python_text",
    "report_date",
    "role_rank",
    "to_number",
    "trim_ws",
]
