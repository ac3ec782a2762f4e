"""Reports of a bounded number of rows, formatted on the driver."""

from __future__ import annotations

from html import escape

from pyspark.sql import DataFrame


def text_report(summary: DataFrame, top: DataFrame, n: int = 10) -> str:
    """Key and value lines of a one-row summary, then the first n rows of a ranked table."""
    row = summary.first().asDict()
    lines = ["Summary", "======="] + [f"{k:<24}{v:,.4f}" if isinstance(v, float) else f"{k:<24}{v}" for k, v in row.items()]
    best = top.limit(n).collect()
    if best:
        lines += ["", "\t".join(best[0].__fields__)] + ["\t".join(str(v) for v in r) for r in best]
    return "\n".join(lines) + "\n"


def html_report(title: str, top: DataFrame, n: int = 500) -> str:
    """A table of the first n ranked rows; the first 10 and 50 ranks have their own row class."""
    rows = top.limit(n).collect()
    cells = lambda values, tag: "".join(f"<{tag}>{escape(str(v))}</{tag}>" for v in values)
    body = []
    for r in rows:
        kind = "first" if r["rank"] <= 10 else "good" if r["rank"] <= 50 else "rest"
        body.append(f'<tr class="{kind}">{cells(r, "td")}</tr>')
    head = cells(top.columns, "th")
    return f"<!DOCTYPE html><html><head><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1><table><tr>{head}</tr>{''.join(body)}</table></body></html>"
