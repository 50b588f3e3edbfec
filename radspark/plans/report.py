"""The quality report as HTML with inline charts, and as JSON. Rows are few: the tidy report of ``operators.quality``."""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame


def _rows(report: DataFrame) -> list[dict]:
    return [r.asDict() for r in report.orderBy("section", "metric", "key").collect()]  # as many as metrics and categories


def to_json(report: DataFrame, path: str | None = None, name: str = "dataset") -> dict:
    out: dict = {"dataset_name": name}
    for r in _rows(report):
        out.setdefault(r["section"], {}).setdefault(r["key"], {})[r["metric"]] = r["value"]
    if path:
        with open(path, "w") as f:
            json.dump(out, f, indent=1)
    return out


def bars(items: list[tuple[str, float, str]], width: int = 640, height: int = 180) -> str:
    """A bar chart as SVG: label, value and colour of each."""
    top = max([v for _, v, _ in items], default=0) or 1
    step = width / max(1, len(items))
    parts = []
    for i, (label, v, colour) in enumerate(items):
        h = (height - 30) * v / top
        parts.append(f'<rect x="{i * step + step * 0.05:.1f}" y="{height - 20 - h:.1f}" width="{step * 0.9:.1f}" height="{h:.1f}" fill="{colour}"><title>{html.escape(label)}: {v:g}</title></rect>')
        if step > 24:
            parts.append(f'<text x="{(i + 0.5) * step:.1f}" y="{height - 6}" font-size="10" text-anchor="middle">{html.escape(label[:12])}</text>')
    return f'<svg width="{width}" height="{height}" role="img">{"".join(parts)}</svg>'


def completeness_colour(share: float) -> str:
    return "#2e7d32" if share >= 0.95 else "#ef6c00" if share >= 0.80 else "#c62828"


def to_html(report: DataFrame, path: str | None = None, name: str = "dataset", histogram: DataFrame | None = None) -> str:
    """Cards, charts, warnings, advice and tables in order of count with shares."""
    rows = _rows(report)
    of = lambda s: [r for r in rows if r["section"] == s]
    total = max([r["value"] for r in of("distribution") if r["metric"] == "count"], default=0)
    e = html.escape
    out = [f"<!DOCTYPE html><meta charset='utf-8'><title>{e(name)}</title><style>body{{font:14px sans-serif;margin:2em}}table{{border-collapse:collapse}}td,th{{border:1px solid #ccc;padding:4px 8px}}.warning{{color:#c62828}}</style><h1>{e(name)}</h1>",
           f"<p class='card'>Samples: {total:g}</p><p class='card'>Warnings: {len(of('warning'))}</p>"]
    if histogram is not None:
        out.append("<h2>Distribution</h2>" + bars([(f"{(r['low'] + r['high']) / 2:.3g}", float(r["count"]), "#1565c0") for r in histogram.orderBy("bin").collect()]))
    if of("completeness"):
        out.append("<h2>Completeness</h2>" + bars([(r["key"], r["value"], completeness_colour(r["value"])) for r in of("completeness")]))
    for title, section in (("Warnings", "warning"), ("Recommendations", "recommendation")):
        if of(section):
            out.append(f"<h2>{title}</h2><ul>" + "".join(f"<li class='{section}'>{e(r['metric'])} {e(r['key'])}</li>" for r in of(section)) + "</ul>")
    for field in sorted({r["metric"] for r in of("categorical")}):
        own = sorted((r for r in of("categorical") if r["metric"] == field), key=lambda r: (-r["value"], r["key"]))
        n = sum(r["value"] for r in own) or 1
        out.append(f"<h2>{e(field)}</h2>" + bars([(r["key"], r["value"], "#6a1b9a") for r in own[:40]]) + "<table><tr><th>value<th>count<th>share</tr>" + "".join(f"<tr><td>{e(r['key'])}<td>{r['value']:g}<td>{100 * r['value'] / n:.1f} %</tr>" for r in own) + "</table>")
    for section in ("distribution", "outliers_iqr", "class_balance"):
        if of(section):
            out.append(f"<h2>{section}</h2><table>" + "".join(f"<tr><td>{e(r['key'])}<td>{e(r['metric'])}<td>{r['value']:.6g}</tr>" for r in of(section)) + "</table>")
    text = "\n".join(out)
    if path:
        with open(path, "w") as f:
            f.write(text)
    return text
