"""Reports as text: small result frames as Markdown or HTML files.

A report is read by people, so its tables are small; one with more rows than
``MOST`` is an error, not a cut table.
"""

from __future__ import annotations

import html
from collections.abc import Mapping

from pyspark.sql import DataFrame, Row, SparkSession

from tidewell.sources.publish import write_text

MOST = 10_000


def _rows(df: DataFrame, most: int) -> list[Row]:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report's table has over {most} rows; aggregate it first")
    return rows


def _cell(value: object) -> str:
    if value is None:
        return ""
    return f"{value:.6g}" if isinstance(value, float) else str(value)


def markdown(title: str, tables: Mapping[str, DataFrame], most: int = MOST) -> str:
    """A heading for each table, then its rows in the frame's order."""
    escaped = lambda x: _cell(x).replace("\\", "\\\\").replace("|", "\\|").replace("\n", " ")
    out = [f"# {title}"]
    for name, df in tables.items():
        lines = [df.columns, ["-"] * len(df.columns), *_rows(df, most)]
        out += ["", f"## {name}", "", *("| " + " | ".join(map(escaped, x)) + " |" for x in lines)]
    return "\n".join(out) + "\n"


def page(title: str, tables: Mapping[str, DataFrame], most: int = MOST) -> str:
    """The same as an HTML page without scripts."""
    escaped = lambda x: html.escape(_cell(x))
    row = lambda tag, cells: "<tr>" + "".join(f"<{tag}>{escaped(c)}</{tag}>" for c in cells) + "</tr>"
    body = []
    for name, df in tables.items():
        body += [f"<h2>{escaped(name)}</h2>", "<table>", row("th", df.columns), *(row("td", r) for r in _rows(df, most)), "</table>"]
    return "\n".join(["<!DOCTYPE html>", f'<html><head><meta charset="utf-8"><title>{escaped(title)}</title></head><body>', f"<h1>{escaped(title)}</h1>", *body, "</body></html>"]) + "\n"


def save(spark: SparkSession, path: str, title: str, tables: Mapping[str, DataFrame], most: int = MOST) -> None:
    """Write the report to ``path``, on any of Hadoop's file systems: HTML if it ends in .html, else Markdown."""
    write_text(spark, path, (page if path.endswith(".html") else markdown)(title, tables, most))
