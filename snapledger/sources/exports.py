"""CSV, zip, JSON and Markdown exports of small results.

Big tables are written in parallel as directories; only reports (aggregates of
a known few rows) are put together on the driver.
"""

from __future__ import annotations

import codecs
import json
import shutil
import zipfile
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, single: bool = False, drop: Sequence[str] = ()) -> None:
    """CSV with a header; ``single`` makes one part file, for exports of a bounded size."""
    out = df.drop(*drop)
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def zip_dirs(target: str, members: Mapping[str, str], bom: bool = False) -> list[str]:
    """Part files of local directories into one zip, named by member; returns the names that were missing.

    ``bom`` puts a byte order mark before each, for spreadsheets that guess encodings.
    """
    missing = []
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for name, directory in members.items():
            parts = sorted(p for p in Path(directory).glob("part-*") if p.is_file()) if Path(directory).exists() else []
            if not parts:
                missing.append(name)
            for i, p in enumerate(parts):
                with z.open(name if len(parts) == 1 else f"{Path(name).stem}-{i:05d}{Path(name).suffix}", "w") as out, p.open("rb") as part:
                    out.write(codecs.BOM_UTF8 if bom else b"")
                    shutil.copyfileobj(part, out)
    return missing


def summary_json(path: str, payload: Mapping[str, Any]) -> None:
    Path(path).write_text(json.dumps(payload, indent=2, sort_keys=True, default=str) + "\n", encoding="utf-8")


def read_sidecar(path: str) -> dict[str, Any]:
    """A JSON file beside the data; anything wrong with it gives the empty mapping."""
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8"))
        return found if isinstance(found, dict) else {}
    except (OSError, ValueError):
        return {}


def markdown_report(title: str, facts: Mapping[str, Any], tables: Mapping[str, DataFrame], rows: int = 50) -> str:
    """Release notes: facts as a list, then each table's first ``rows`` rows in its own order."""
    out = [f"# {title}", "", *[f"- **{k}:** {v}" for k, v in facts.items()]]
    for name, df in tables.items():
        got = df.limit(rows).collect()
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in got]
    return "\n".join(out) + "\n"


def human_duration(seconds: float) -> str:
    h, rest = divmod(int(seconds), 3600)
    m, s = divmod(rest, 60)
    return f"{h}h {m}m {s}s" if h else f"{m}m {s}s" if m else f"{s}s"


def human_bytes(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if n < 1024:
            return f"{n:.1f} {unit}" if unit != "B" else f"{int(n)} B"
        n /= 1024
    return f"{n:.1f} TB"
