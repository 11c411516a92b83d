"""Test helpers: write real landing files from the lines fixture."""

from __future__ import annotations

import os
from collections import defaultdict


def write_landing(spark, sf_dir: str, root: str, feed: str = "OCC") -> dict[str, str]:
    """Materialise the csv_lines fixture as real files (LF line ends; the
    CRLF file keeps its CRs).  Small fixture only (sf0.001)."""
    from cdrflow.plans.fixtures import csv_lines

    rows = csv_lines(spark, sf_dir).collect()
    files: dict[str, list] = defaultdict(list)
    for r in rows:
        files[r["FILE_NAME"]].append((r["LINE_NO"], r["LINE"]))
    folder = os.path.join(root, feed)
    os.makedirs(folder, exist_ok=True)
    for name, lines in files.items():
        lines.sort()
        crlf = name.endswith("_07.csv")
        with open(os.path.join(folder, name), "w", newline="") as fh:
            for _, text in lines:
                fh.write(text + ("\r\n" if crlf else "\n"))
    return {feed: folder}
