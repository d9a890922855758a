"""Writers for machine-log fixture files (hourly ';' CSV and daily plate logs)."""

from __future__ import annotations

import os

from vitrine.spec import REQUIRED_FILE_COLUMNS

# Raw header spellings: three are known exactly, the rest are spelled with spaces and
# mixed case so that header normalisation is exercised.
RAW_NAMES = {"time": "Time", "lite_id": "Lite id", "cap_id": "Cap id"}


def raw_header(name: str) -> str:
    return RAW_NAMES.get(name) or " ".join(w.capitalize() for w in name.split("_"))


HEADER = [raw_header(c) for c in REQUIRED_FILE_COLUMNS]


def row(time="07:05:03", lite="12", cap="15", measure="1.5", result="OK", **over):
    vals = {}
    for c in REQUIRED_FILE_COLUMNS:
        vals[c] = measure
    vals.update({"time": time, "lite_id": lite, "cap_id": cap, "total_result": result})
    vals.update(over)
    return vals


def write_hourly(root: str, day: str, hour: int, rows: list[dict], header=None, sep=";",
                 raw_lines: list[str] | None = None, encoding_bytes: bytes | None = None) -> str:
    y, m, d = day.split("-")
    folder = os.path.join(root, y, m, d)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{hour:02d}.csv")
    header = header or HEADER
    names = [_norm(h) for h in header]
    lines = [sep.join(header)]
    for r in rows:
        lines.append(sep.join(str(r.get(n, "")) for n in names))
    lines += raw_lines or []
    data = ("\n".join(lines) + "\n").encode()
    if encoding_bytes:
        data += encoding_bytes
    with open(path, "wb") as f:
        f.write(data)
    return path


def write_plate(root: str, day: str, rows: list[tuple[str, str]], extra_cols=("Result",)) -> str:
    ym = day[:7]
    folder = os.path.join(root, ym)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{day}-PlateLog.txt")
    lines = ["\t".join(["Date", "GrpID", *extra_cols])]
    for date_text, grp in rows:
        lines.append("\t".join([date_text, grp, *["x"] * len(extra_cols)]))
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def _norm(h):
    from vitrine.functions.clean import normalize_name
    return normalize_name(h)
