"""Report-API response pages written by hand: JSON lines, one folder a window."""

from __future__ import annotations

import json
import os

DIMS = ("ga:isoweek", "ga:date", "ga:eventLabel", "ga:eventCategory", "ga:eventAction")
METS = ("ga:totalevents", "ga:users")


def page(start, end, token, rows, row_count, golden=True, sampled=False, dims=DIMS, mets=METS):
    """One response page. ``rows``: (dimension values..., metric values...) in the
    order of ``dims`` and ``mets``; None: a page without rows."""
    data = {"rowCount": row_count}
    if rows is not None:
        data["rows"] = [{"dimensions": list(r[:len(dims)]), "metrics": [{"values": list(r[len(dims):])}]} for r in rows]
    if golden:
        data["isDataGolden"] = True
    if sampled:
        data["samplesReadCounts"] = ["5"]
    header = {"dimensions": list(dims),
              "metricHeader": {"metricHeaderEntries": [{"name": m, "type": "INTEGER"} for m in mets]}}
    return {"startDate": start, "endDate": end, "pageToken": token,
            "reports": [{"columnHeader": header, "data": data}]}


LABELS = ("banner_card_onlinebuy_view", "Banner_SERP_protection_click", "banner_guarantee_lk")


def day_rows(day: int, n: int = 3):
    """Rows of one January day."""
    return [(f"{(day + 6) // 7:02d}", f"202401{day:02d}", LABELS[i % 3], "c", "click", str(day + i), str(1 + i % 2))
            for i in range(n)]


def daily_pages(days, page_size: int = 2, rows_a_day: int = 3):
    """Pages of one-day windows, several a window."""
    out = []
    for day in days:
        rows, name = day_rows(day, rows_a_day), f"2024-01-{day:02d}"
        for at in range(0, len(rows), page_size):
            out.append(page(name, name, str(at), rows[at:at + page_size], len(rows)))
    return out


def write_landing(path: str, pages) -> None:
    for i, p in enumerate(pages):
        folder = os.path.join(path, f"startDate={p['startDate']}")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"page-{i}.json"), "w") as fh:
            json.dump({k: v for k, v in p.items() if k != "startDate"}, fh)
