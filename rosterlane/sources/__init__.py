"""Reading landed inputs."""

from rosterlane.sources.chains import page_chains
from rosterlane.sources.pages import explode_records, parse_pages, read_pages
from rosterlane.sources.tables import (
    crm_contacts,
    learning_enrolments,
    portals,
    read_table,
    inperson_engagements,
)

__all__ = [
    "crm_contacts",
    "explode_records",
    "learning_enrolments",
    "page_chains",
    "parse_pages",
    "portals",
    "read_pages",
    "read_table",
    "inperson_engagements",
]
