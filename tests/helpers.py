"""Shared test helpers."""

import contextlib
import io

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def plan_text(df) -> str:
    """The formatted physical plan (``explain("formatted")``), which is not truncated."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
