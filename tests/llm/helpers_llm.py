"""Plain Python versions of what the operators compute."""

import re
from pathlib import Path

FOLDER = Path("/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)
