"""One CSV dialect for reading and writing, so that text survives the round trip."""

from __future__ import annotations

#: Header line, RFC 4180 quoting (a quote is doubled).
DIALECT = {"header": "true", "quote": '"', "escape": '"'}


def read_options(multi_line: bool) -> dict[str, str]:
    """Header names are checked against the schema instead of trusted."""
    return {
        **DIALECT,
        "multiLine": str(multi_line).lower(),
        "enforceSchema": "false",
    }


def write_options() -> dict[str, str]:
    """Padding is kept; Spark's writer trims it by default."""
    return {
        **DIALECT,
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
